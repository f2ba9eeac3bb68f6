import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck_connection
from reelscope.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, sf001_dir, name):
    outcome = compare(name, QUERIES[name](spark, sf001_dir), ORACLE_SQL[name], duck_connection(sf001_dir))
    assert outcome.ok, outcome
