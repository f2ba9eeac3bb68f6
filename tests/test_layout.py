"""Materialized tables give the same answers and prune on user_id."""

import contextlib
import io
import tempfile

import pytest

from reelscope.plans import QUERIES
from reelscope.sources.layout import default_location, materialize
from reelscope.sources.star import star_tables

SAMPLE = [
    "r1_table_counts",
    "r2_user_movies",
    "r3_top_avg_detail",
    "r5_cohort_semi_top100",
    "r8_year_genre_counts",
    "r9_occupation_genre_counts",
    "x_all_age_top10",
]


@pytest.fixture(scope="module")
def both(spark, sf001_dir):
    raw = star_tables(spark, sf001_dir)
    out = tempfile.mkdtemp(prefix="reelscope-layout-")
    return raw, materialize(raw, out, ratings_partitions=4)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_results(both, name):
    raw, mat = both
    x, y = QUERIES[name](raw), QUERIES[name](mat)
    assert sorted(x.collect()) == sorted(y.collect())


def test_user_filter_is_pushed_to_the_ratings_files(both):
    _, mat = both
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["r2_user_movie_count"](mat).explain(mode="formatted")
    assert "EqualTo(user_id,18)" in buf.getvalue()


def test_ratings_files_are_clustered_by_user(both, spark):
    _, mat = both
    from pyspark.sql import functions as F

    per_file = (
        mat.ratings.withColumn("f", F.input_file_name())
        .groupBy("f")
        .agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert len(per_file) == 4
    for a, b in zip(per_file, per_file[1:]):
        assert a.hi <= b.lo


def test_default_location_is_under_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    base = configured or spark.sparkContext.getCheckpointDir()
    assert default_location(spark, "x") == f"{base.rstrip('/')}/tables/x"


def test_hot_user_spans_several_files(spark):
    from fixtures import make_tables
    from pyspark.sql import functions as F

    # user 1 holds half of all ratings
    ratings = [(1, m, 4.0) for m in range(1, 4001)] + [(2 + i % 50, i % 997, 3.0) for i in range(4000)]
    users = [(u, "F", 1, 0, "z") for u in range(1, 52)]
    t = make_tables(spark, ratings, users, [(1, "A (1990)", "Drama")])
    mat = materialize(t, tempfile.mkdtemp(prefix="reelscope-hot-"), ratings_partitions=8)
    files = (
        mat.ratings.where(F.col("user_id") == 1)
        .select(F.input_file_name().alias("f"))
        .distinct()
        .count()
    )
    assert files >= 3
    assert mat.ratings.count() == len(ratings)
