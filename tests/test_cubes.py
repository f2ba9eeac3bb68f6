import pytest
from test_plans import plan

from reelscope.operators.cubes import rating_sets
from reelscope.plans import analyses as a
from reelscope.plans import distributed as d
from reelscope.sources.star import star_tables
from reelscope.session import tune
from fixtures import make_tables


def test_levels_against_single_aggregates(spark):
    rows = [(i % 5, [None, "F", "M"][i % 3], float(1 + i % 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "m int, g string, rating double")
    got = {(r.level, r.m, r.g): (r.total, r.n, r.avg_rating) for r in rating_sets(df, [["m"], ["g", "m"], ["g"]]).collect()}
    expected = {}
    for m, g, x in rows:
        for key in ((0, m, None), (1, m, g), (2, None, g)):
            total, n = expected.get(key, (0.0, 0))
            expected[key] = (total + x, n + 1)
    assert got == {k: (t, n, t / n) for k, (t, n) in expected.items()}  # a null gender is a group, not a level
    assert rating_sets(df.limit(0), [["m"]]).collect() == []
    with pytest.raises(ValueError):
        rating_sets(df, [[]])


def test_one_scan_and_one_shuffle_of_ratings(spark, sf001_dir):
    text = plan(d.rating_levels(star_tables(tune(spark), sf001_dir)))
    tree = text.split("\n(1)")[0]
    assert sum("lineitem" in line for line in text.splitlines() if "Location" in line) == 1
    assert tree.count("Scan parquet") == 3 and "Expand" not in tree


def test_unknown_users_count_for_the_movie_alone(spark):
    t = make_tables(spark, [(1, 10, 5.0), (2, 10, 3.0), (99, 10, 4.0)], [(1, "F", 1, 0, "z"), (2, "M", 25, 0, "z")], [(10, "x", "y")])
    got = {(r.level, r.gender, r.age): (r.total, r.n) for r in d.rating_levels(t).collect()}
    assert got == {(0, None, None): (12.0, 3), (1, "F", None): (5.0, 1), (1, "M", None): (3.0, 1), (2, None, 1): (5.0, 1), (2, None, 25): (3.0, 1)}


def test_lists_equal_the_single_analyses(spark, smoke_dir):
    t = star_tables(spark, smoke_dir)
    lists = {}
    for r in sorted(d.report_lists(t).collect(), key=lambda r: r["rank"]):
        lists.setdefault((r["list"], r["of"]), []).append(r.movie_id)
    ids = lambda df: [r.movie_id for r in df.collect()]
    assert lists["best mean", "all"] == ids(a.top_avg(t))
    assert lists["most watched", "all"] == ids(a.top_watched(t))
    assert lists["largest sum", "F"] == ids(a.top_total_by_gender(t, "F"))
    assert lists["best mean", "M"] == ids(a.top_avg_detail_by_gender(t, "M"))
    assert lists["best mean", "1"] == ids(a.cohort_top_avg(t))
