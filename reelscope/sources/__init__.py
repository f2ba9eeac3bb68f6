from reelscope.sources.star import star_tables
from reelscope.sources.tables import Tables

__all__ = ["Tables", "star_tables"]
