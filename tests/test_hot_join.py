"""Split joins: exact with AQE off, and no task with much more than its share."""

import collections

import pytest
from fixtures import make_tables
from test_skew import conf

from pyspark.sql import functions as F

from reelscope.operators.hot_join import hot_keys, split_join
from reelscope.plans import analyses as a
from reelscope.plans import distributed as d

NO_AQE = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 40_000


@pytest.fixture(scope="module")
def half_one_user(spark):
    """User 1 has half of all ratings, user 2 a tenth."""
    users = [(u, "F", 1, u % 3, str(u)) for u in range(1, 301)]
    ratings = [(1 if i % 2 else 2 if i % 10 == 0 else 3 + i % 298, 1 + (i * 7919) % 997, float(1 + i % 5)) for i in range(ROWS)]
    movies = [(m, f"M {m}", ("Drama|War", "War")[m % 2]) for m in range(1, 998)]
    return make_tables(spark, ratings, users, movies, [(0, "a"), (1, "b"), (2, "c")]), ratings


def test_summary_finds_the_hot_keys(spark, half_one_user):
    t, ratings = half_one_user
    counts = collections.Counter(u for u, _, _ in ratings)
    found = {r.user_id: r.splits for r in hot_keys(t.ratings, "user_id", 1000).collect()}
    assert found == {u: -(-n // 1000) for u, n in counts.items() if n > 1000} and len(found) == 2
    assert hot_keys(t.ratings, "user_id", ROWS).collect() == []
    assert hot_keys(t.ratings.limit(0), "user_id", 1).collect() == []
    with pytest.raises(ValueError):
        hot_keys(t.ratings, "user_id", 0)


def _largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]


def test_split_bounds_the_largest_task(spark, half_one_user):
    t, _ = half_one_user
    ratings, users = t.ratings.select("user_id", "movie_id"), t.users.select("user_id", "occupation_id")
    with conf(spark, NO_AQE):
        plain = _largest_task(ratings.join(users, "user_id"))
        split = split_join(ratings, users, "user_id", hot_keys(ratings, "user_id", 1000))
        assert _largest_task(split) < ROWS / 8 < ROWS / 2 < plain
        assert split.columns == ["user_id", "movie_id", "occupation_id"]
        same = split.exceptAll(ratings.join(users, "user_id")).count(), split.count()
    assert same == (0, ROWS)


def test_analysis_is_exact_without_aqe(spark, half_one_user):
    t, _ = half_one_user
    with conf(spark, NO_AQE):
        got = sorted(map(tuple, d.occupation_genre_counts_split(t, rows_per_split=1000).collect()))
        assert got == sorted(map(tuple, a.occupation_genre_counts_direct(t).collect()))


def test_duplicates_on_the_other_side_and_missing_keys(spark):
    large = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (None, 1), (3, 9)], "k bigint, v int")
    other = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k bigint, w string")
    got = split_join(large, other, "k", hot_keys(large, "k", 10))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, large.join(other, "k").collect())) and got.count() == 101
