from reelscope.plans.oracle import ORACLE_SQL
from reelscope.plans.registry import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
