"""Hot keys: one user with over a third of all ratings, one movie with a third.

Broadcasts are switched off and AQE's skew thresholds lowered so the
sort-merge joins really run with split partitions; results are checked
against a brute-force count in Python.
"""

import collections
import contextlib
import io

import pytest
from fixtures import make_tables

from reelscope.plans import analyses as a

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _java_split(s):
    if s == "":
        return [""]
    parts = s.split("|")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.fixture(scope="module")
def skewed(spark):
    # user 1 (in age band 1) holds half of all ratings, movie 7 a quarter
    users = [(u, "F" if u % 2 else "M", 1 if u % 2 else 25, u % 4, str(u)) for u in range(1, 41)]
    movies = [
        (m, f"Movie {m} (19{m % 100:02d})", ("Drama|Comedy", "Action|", "War")[m % 3])
        for m in range(1, 5001)
    ]
    ratings = [(1, 1 + (i * 7919) % 5000, float(1 + i % 5)) for i in range(30000)]
    ratings += [(2 + i % 39, 7, float(1 + i % 5)) for i in range(15000)]
    ratings += [(2 + i % 39, 1 + (i * 31) % 5200, float(1 + (i * 3) % 5)) for i in range(15000)]
    occupations = [(0, "artist"), (1, "doctor"), (2, "lawyer")]  # 3 has no name
    t = make_tables(spark, ratings, users, movies, occupations)
    return t, ratings, users, movies, occupations


def test_occupation_genre_counts_under_skew(spark, skewed):
    t, ratings, users, movies, occupations = skewed
    occ_name = dict(occupations)
    user_occ = {u: occ_name[o] for u, _, _, o, _ in users if o in occ_name}
    genres = {m: _java_split(g) for m, _, g in movies}
    expected = collections.Counter()
    for u, m, _ in ratings:
        if u in user_occ and m in genres:
            for g in genres[m]:
                expected[(user_occ[u], g)] += 1

    with conf(spark, SKEW_CONF):
        df = a.occupation_genre_counts(t)
        got = {(r.occupation_name, r.genre): r.n for r in df.collect()}
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
    assert got == dict(expected)
    assert "SortMergeJoin" in buf.getvalue()


def test_cohort_stats_under_skew(spark, skewed):
    t, ratings, users, movies, _ = skewed
    band = {u for u, _, age, _, _ in users if age == 1}
    sums, counts = collections.Counter(), collections.Counter()
    for u, m, r in ratings:
        if u in band:
            sums[m] += r
            counts[m] += 1
    stats = [(sums[m] / counts[m], counts[m], m) for m in counts]
    by_id = [(avg, m) for avg, _, m in sorted(stats, key=lambda x: (-x[0], x[2]))[:100]]
    by_text = [(avg, m) for avg, _, m in sorted(stats, key=lambda x: (-x[0], -x[1], str(x[2])))[:100]]

    with conf(spark, SKEW_CONF):
        semi = a.cohort_semi_top(t, broadcast_max_bytes=0).collect()
        inner = a.cohort_top_avg(t, k=100).collect()
    assert [(r.avg_rating, r.movie_id) for r in semi] == by_text
    assert [(r.avg_rating, r.movie_id) for r in inner] == by_id


def test_skew_join_split_is_used(spark, skewed):
    t = skewed[0]
    with conf(spark, SKEW_CONF):
        df = a.occupation_genre_counts(t)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()  # after the action this shows the final adaptive plan
    final = buf.getvalue()
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin(skew=true)" in final
    assert "AQEShuffleRead skewed" in final
