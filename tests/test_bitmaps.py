"""Bitmaps against Python sets, over several buckets, with hot buckets and odd ids."""

import random

import pytest
from test_skew import SKEW_CONF, conf

from pyspark.sql import functions as F

from reelscope.operators.bitmaps import BUCKET_IDS, bitmap_sizes, id_bitmaps, intersection_of, members, set_overlaps, union_of


@pytest.fixture(scope="module")
def sets():
    rng = random.Random(4)
    odd = [0, -1, 1, BUCKET_IDS, BUCKET_IDS + 1, -BUCKET_IDS, -BUCKET_IDS - 1, 2**40, 2**62, -(2**62)]
    pools = {"a": 10_000, "b": 100_000, "c": 300_000}
    return {s: {rng.randrange(-n, n) for _ in range(2000)} | set(rng.sample(odd, 6)) for s, n in pools.items()} | {"d": {10**12}}


@pytest.fixture(scope="module")
def bitmaps(spark, sets):
    rows = [(s, i) for s, ids in sets.items() for i in ids] * 2 + [("a", None)]
    return id_bitmaps(spark.createDataFrame(rows, "s string, id bigint").repartition(5), "id", "s").cache()


def test_sizes_unions_and_intersections(sets, bitmaps):
    assert {r.s: r.n for r in bitmap_sizes(bitmaps, "s").collect()} == {s: len(ids) for s, ids in sets.items()}
    ab = bitmaps.where("s in ('a', 'b')")
    assert bitmap_sizes(union_of(ab)).first().n == len(sets["a"] | sets["b"])
    assert bitmap_sizes(intersection_of(ab, 2)).first().n == len(sets["a"] & sets["b"])
    assert bitmap_sizes(intersection_of(bitmaps, 4)).first().n in (None, 0)


def test_overlaps(sets, bitmaps):
    got = {(r.a, r.b): (r.n_a, r.n_b, r.n_both, r.n_either, r.n_only_a) for r in set_overlaps(bitmaps, "s").collect()}
    expected = {}
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x & y:
                expected[a, b] = (len(x), len(y), len(x & y), len(x | y), len(x - y))
    assert got == expected and len(got) >= 3


@pytest.mark.parametrize("budget", [None, 0, 10**9])
def test_members_keep_each_row_once(spark, sets, bitmaps, budget):
    rng = random.Random(6)
    rows = [rng.choice([rng.randrange(-300_000, 300_000), rng.choice(sorted(sets["c"])), 2**40, None]) for _ in range(4000)]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(rows)], "id bigint, n int")
    with conf(spark, SKEW_CONF):
        got = members(df, "id", bitmaps.where("s = 'c'"), budget)
        assert got.columns == ["id", "n"]
        assert sorted(r.n for r in got.collect()) == [n for n, i in enumerate(rows) if i in sets["c"]]


def test_one_bit_an_id(spark):
    """A million users take 125,000 bytes, whatever their ratings."""
    users = spark.range(1, 1_000_001, numPartitions=8).select(F.col("id").alias("user_id"))
    size = id_bitmaps(users.union(users), "user_id").agg(F.sum(F.octet_length("bits")).alias("bytes"), F.sum(F.bitmap_count("bits")).alias("n")).first()
    assert size.n == 1_000_000
    assert size.bytes == -(-1_000_000 // BUCKET_IDS) * BUCKET_IDS // 8  # 1 bit an id, the last bucket whole


def test_empty(spark):
    none = spark.createDataFrame([(None,)], "id bigint")
    assert id_bitmaps(none, "id").collect() == []
    assert members(spark.range(5), "id", id_bitmaps(none, "id")).collect() == []
