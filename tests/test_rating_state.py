import random

import pytest

from reelscope.operators.exact import exact_rating_stats
from reelscope.operators.rating_state import RatingState


def frame(spark, rows):
    return spark.createDataFrame(rows, "movie_id bigint, rating double")


def ratings(seed, n=300):
    rng = random.Random(seed)
    return [(rng.randrange(12), rng.randrange(1, 11) / 7) for _ in range(n)]


def stats(df):
    return sorted((r.movie_id, r.total, r.n, r.avg_rating) for r in df.collect())


def test_batches_and_withdrawals_equal_the_whole(spark, tmp_path):
    rows = ratings(1)
    state = RatingState(spark, str(tmp_path / "s"))
    assert stats(state.stats()) == [] and state.batches() == []
    assert state.apply("a", added=frame(spark, rows[:100]))
    assert state.apply("b", added=frame(spark, rows[100:]), withdrawn=frame(spark, rows[:50]))
    assert stats(state.stats()) == stats(exact_rating_stats(frame(spark, rows[50:])))
    assert state.apply("c", withdrawn=frame(spark, [r for r in rows[50:] if r[0] == 3]))
    assert stats(state.stats()) == stats(exact_rating_stats(frame(spark, [r for r in rows[50:] if r[0] != 3])))
    assert sorted(state.batches()) == ["a", "b", "c"]


def test_a_batch_counts_once(spark, tmp_path):
    rows = frame(spark, ratings(2))
    state = RatingState(spark, str(tmp_path / "s"))
    assert state.apply("a", added=rows) and not state.apply("a", added=rows)
    assert not RatingState(spark, str(tmp_path / "s")).apply("a", added=rows)
    assert stats(state.stats()) == stats(exact_rating_stats(rows))


def test_a_failed_batch_is_not_seen_and_can_be_sent_again(spark, tmp_path):
    rows = ratings(3)
    state = RatingState(spark, str(tmp_path / "s"))
    state.apply("a", added=frame(spark, rows[:200]))
    broken = frame(spark, rows[200:]).selectExpr("movie_id", "if(movie_id = 5, raise_error('lost'), rating) as rating")
    with pytest.raises(Exception, match="lost"):
        state.apply("b", added=broken)
    assert state.batches() == ["a"]
    assert stats(state.stats()) == stats(exact_rating_stats(frame(spark, rows[:200])))
    assert state.apply("b", added=frame(spark, rows[200:]))
    assert stats(state.stats()) == stats(exact_rating_stats(frame(spark, rows)))


def test_withdrawing_what_is_not_there_raises(spark, tmp_path):
    state = RatingState(spark, str(tmp_path / "s"))
    state.apply("a", added=frame(spark, [(1, 2.0), (2, 3.0)]))
    with pytest.raises(Exception, match="more ratings withdrawn than there are of movie 2"):
        state.apply("b", withdrawn=frame(spark, [(2, 3.0), (2, 3.0)]))
    assert stats(state.stats()) == [(1, 2.0, 1, 2.0), (2, 3.0, 1, 3.0)]


def test_all_withdrawn_and_empty_batches(spark, tmp_path):
    state = RatingState(spark, str(tmp_path / "s"))
    state.apply("none")
    state.apply("a", added=frame(spark, [(1, 0.1), (1, 0.2)]))
    state.apply("b", withdrawn=frame(spark, [(1, 0.2), (1, 0.1)]))
    assert stats(state.stats()) == [] and state.state().collect() == []
