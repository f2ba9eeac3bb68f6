"""Global positions and paged lists against Python's sort, with hot keys and ties."""

import random

import pytest
from test_plans import plan
from test_skew import conf

from pyspark.sql import functions as F

from reelscope.operators.positions import paged_lists, unpaged, with_positions

SMALL = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def rows_of(seed, n=3000):
    """A third of all rows share one value, others are rare; nulls included."""
    rng = random.Random(seed)
    return [(None if rng.random() < 0.02 else 7 if rng.random() < 0.33 else rng.randrange(400), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_positions_against_sort(spark, seed):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, "v int, id bigint").repartition(7)
    with conf(spark, SMALL):
        got = {r.id: r.position for r in with_positions(df, F.desc("v"), "id").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))  # nulls last, as descending orders have them
    assert got == {i: place for place, (_, i) in enumerate(order, 1)}


def test_equal_rows_have_neighbouring_positions(spark):
    df = spark.createDataFrame([(5,)] * 40 + [(1,)] * 3 + [(9,)] * 2, "v int").repartition(4)
    with conf(spark, SMALL):
        got = sorted((r.position, r.v) for r in with_positions(df, "v").collect())
    assert got == list(enumerate([1] * 3 + [5] * 40 + [9] * 2, 1))


def test_no_row_meets_all_others(spark):
    """The rows lie in many sorted partitions, and the plan that numbers them has no exchange to one."""
    df = spark.createDataFrame(rows_of(3), "v int, id bigint")
    with conf(spark, SMALL):
        out = with_positions(df, "v", "id")
    assert "SinglePartition" not in plan(out) and "Window" not in plan(out)
    assert len({f for f in out.inputFiles() if "positions" in f}) >= 12  # the hot value is split too


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], "v int, _row int, _part int")
    assert with_positions(empty, "v").collect() == []
    df = spark.createDataFrame([(2, 8, 9), (1, 6, 7)], "v int, _row int, _part int")
    assert sorted(map(tuple, with_positions(df, "v", name="place").collect())) == [(1, 6, 7, 1), (2, 8, 9, 2)]
    with pytest.raises(ValueError):
        with_positions(df, "v", name="v")
    with pytest.raises(ValueError):
        with_positions(df)


@pytest.mark.parametrize("size", [1, 7, 50, 10_000])
def test_pages_read_back_to_the_exact_lists(spark, size):
    rows = rows_of(size)
    df = spark.createDataFrame(rows, "v int, id bigint").repartition(5)
    with conf(spark, SMALL):
        pages = paged_lists(df, "v", "id", size)
        found = pages.collect()
        back = unpaged(pages, "v", "id", size).collect()
    lists = {}
    for v, i in rows:
        lists.setdefault(v, []).append(i)
    assert {(r.v, r.page): r["items"] for r in found} == {
        (v, p): ids[p * size : (p + 1) * size] for v, ids in lists.items() for p in range(-(-len(ids) // size))
    }
    assert all(r.n == len(r["items"]) <= size for r in found)
    assert sorted(((r.v, r.place, r.id) for r in back), key=repr) == sorted(
        ((v, place, i) for v, ids in lists.items() for place, i in enumerate(ids)), key=repr
    )


def test_pages_of_a_hot_key_lie_in_many_tasks(spark):
    """A key of a third of the rows: its pages come from many tasks, no row holds more than a page."""
    df = spark.createDataFrame(rows_of(9, 6000), "v int, id bigint")
    with conf(spark, SMALL):
        pages = paged_lists(df, "v", "id", 20).withColumn("task", F.spark_partition_id()).where("v = 7").collect()
    assert len(pages) > 80 and len({r.task for r in pages}) >= 8


def test_lists_with_an_order_of_their_own_repeats_and_nulls(spark):
    rows = [("a", 3, None), ("a", 1, "x"), ("a", 2, "x"), (None, 5, "y"), (None, 4, None)]
    df = spark.createDataFrame(rows, "k string, at int, item string")
    got = {r.k: r["items"] for r in paged_lists(df, "k", "item", 10, F.desc("at")).collect()}
    assert got == {"a": [None, "x", "x"], None: ["y", None]}
    assert paged_lists(df.limit(0), "k", "item", 10).collect() == []
    with pytest.raises(ValueError):
        paged_lists(df, "k", "item", 0)
