"""Reports share one intermediate and give the same results as the single analyses."""

import pytest
from pyspark import StorageLevel

from reelscope.functions import YEAR_PATTERN_PLAIN, title_pattern_name
from reelscope.plans import analyses as a
from reelscope.plans.reports import cohort_report, movie_report
from reelscope.sources.star import star_tables


@pytest.fixture(scope="module")
def t(spark, sf001_dir):
    return star_tables(spark, sf001_dir)


SINGLE_MOVIE = {
    "top_avg": a.top_avg,
    "top_avg_detail": a.top_avg_detail,
    "top_watched": a.top_watched,
    "top_watched_detail": a.top_watched_detail,
}

SINGLE_COHORT = {
    "cohort_user_count": a.cohort_user_count,
    "rating_count": a.rating_count,
    "cohort_rating_count": a.cohort_rating_count,
    "cohort_top_avg": a.cohort_top_avg,
    "cohort_top_named": a.cohort_top_named,
    "cohort_multikey": a.cohort_multikey,
    "cohort_semi_count": a.cohort_semi_count,
    "cohort_semi_top": a.cohort_semi_top,
}


@pytest.mark.parametrize("keep", ["persist", "checkpoint"])
def test_movie_report_equals_single_analyses(t, keep):
    report = movie_report(t, keep=keep)
    kept = list(report._kept)
    assert len(kept) == (1 if keep == "persist" else 0)
    with report as r:
        assert set(r) == set(SINGLE_MOVIE)
        for name, fn in SINGLE_MOVIE.items():
            assert r[name].collect() == fn(t).collect(), name
    assert all(df.storageLevel == StorageLevel.NONE for df in kept)


@pytest.mark.parametrize("keep", ["persist", "checkpoint"])
def test_cohort_report_equals_single_analyses(t, keep):
    with cohort_report(t, keep=keep) as r:
        assert set(r) == set(SINGLE_COHORT)
        for name, fn in SINGLE_COHORT.items():
            assert r[name].collect() == fn(t).collect(), name


def test_report_rejects_unknown_keep(t):
    with pytest.raises(ValueError):
        movie_report(t, keep="memory")


def test_title_pattern_name(spark):
    df = spark.createDataFrame(
        [("Toy Story (1995)",), ("Foo (1990) Bar (1995) x",), ("Heat (1995)",)], "title string"
    )
    rows = df.select(
        title_pattern_name("title").alias("two_word"),
        title_pattern_name("title", YEAR_PATTERN_PLAIN).alias("plain"),
    ).collect()
    assert [(r.two_word, r.plain) for r in rows] == [
        ("Story", "Toy Story"),
        ("(1990) Bar", "Foo (1990) Bar"),
        ("", "Heat"),
    ]
