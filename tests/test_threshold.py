"""Threshold top-k against plain sums, and how little its last phase moves."""

import random
from collections import Counter

import pytest
from test_skew import conf

from reelscope.operators.threshold import partial_sums, threshold_candidates, top_k_sums


def frame(spark, rows, parts):
    return spark.createDataFrame(rows, "movie_id bigint, rating double").repartition(parts)


def brute(rows, k):
    sums = Counter()
    for m, r in rows:
        if m is not None and r is not None:
            sums[m] += r
    return sorted(((s, m) for m, s in sums.items()), key=lambda x: (-x[0], x[1]))[:k]


def result(df):
    assert df.columns == ["total", "movie_id"]
    return [(r.total, r.movie_id) for r in df.collect()]


def zipf(seed, n=20_000, movies=3000):
    rng = random.Random(seed)
    return [(int(rng.paretovariate(0.6)) % movies, float(rng.randrange(1, 6))) for _ in range(n)]


@pytest.mark.parametrize("k", [0, 1, 10, 100])
@pytest.mark.parametrize("parts", [1, 6])
def test_against_plain_sums(spark, k, parts):
    rows = zipf(k + parts)
    assert result(top_k_sums(frame(spark, rows, parts), "movie_id", "rating", k)) == brute(rows, k)


@pytest.mark.parametrize("seed", range(4))
def test_negative_sums_ties_and_nulls(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(30), float(rng.randrange(-9, [10, 2, 0, -3][seed]))) for _ in range(400)]
    rows += [(None, 50.0), (3, None)]
    for k in (1, 5, 29, 40):
        assert result(top_k_sums(frame(spark, rows, 5), "movie_id", "rating", k)) == brute(rows, k)


def test_ties_at_the_cut(spark):
    rows = [(m, 2.0) for m in range(50) for _ in range(4)]
    assert result(top_k_sums(frame(spark, rows, 4), "movie_id", "rating", 7)) == [(8.0, m) for m in range(7)]


def test_empty(spark):
    assert result(top_k_sums(frame(spark, [], 2), "movie_id", "rating", 3)) == []
    assert result(top_k_sums(frame(spark, [(None, None)], 2), "movie_id", "rating", 3)) == []


def test_a_full_node_is_written_and_the_next_one_begun(spark):
    rows = zipf(8, 5000)
    with conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "100"}):
        parts = partial_sums(frame(spark, rows, 2), "movie_id", "rating", node_keys=50)
        places = parts.groupBy("node").agg({"place": "max", "*": "count"}).collect()
        sums = Counter()
        for r in parts.collect():
            sums[r.key] += r.part
    assert sorted(((s, m) for m, s in sums.items()), key=lambda x: (-x[0], x[1])) == brute(rows, None)
    assert len(places) > 2 and all(r[1] == r[2] for r in places)


def test_few_keys_reach_the_last_phase(spark):
    """With popular movies, the exact sums are shuffled for far fewer keys than there are."""
    rows = zipf(3, 60_000, 20_000)
    parts = partial_sums(frame(spark, rows, 8), "movie_id", "rating").cache()
    movies = parts.select("key").distinct().count()
    candidates = {r.key for r in threshold_candidates(parts, 10).collect()}
    parts.unpersist()
    assert {m for _, m in brute(rows, 10)} <= candidates
    assert movies > 1500 and len(candidates) <= 40


def test_partial_sums_are_not_shuffled(spark):
    from test_plans import plan

    assert "Exchange" not in plan(partial_sums(spark.range(100).selectExpr("id % 7 as movie_id", "1.0D as rating"), "movie_id", "rating"))
