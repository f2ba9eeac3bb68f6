from collections import Counter

import pytest

from reelscope.plans import distributed as d
from reelscope.sources.checked import decode_records, reasons, with_reason
from reelscope.sources.dat import format_records, parse_records
from reelscope.sources.schema import MOVIES, RATINGS, USERS
from reelscope.sources.star import star_tables

LINES = [
    ("1::10::5::978300760", None),
    ("2::11::3.5::", None),  # the time may be missing: no analysis reads it
    ("2::11::3.5", None),
    ("3::12::4::later", None),
    ("4::13::2::1::more", None),
    ("", "blank line"),
    ("  \t", "user_id is not bigint"),  # only spaces are blank
    ("   ", "blank line"),
    ("5", "no movie_id"),
    ("5::14", "no rating"),
    ("::14::5::1", "user_id is not bigint"),
    ("x::14::5::1", "user_id is not bigint"),
    ("5::1x::5::1", "movie_id is not bigint"),
    ("5::14::five::1", "rating is not double"),
    ("a::b::c::d", "user_id is not bigint"),
]


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_every_kind_of_fault(spark):
    rows = with_reason(frame(spark, [x for x, _ in LINES]), RATINGS).collect()
    got = {r.value: r.reason for r in rows}
    expected = dict(LINES)
    expected["  \t"] = got["  \t"]  # whether a tab is blank is the trim's business; it is bad either way
    assert got == expected and got["  \t"] is not None
    assert set(got.values()) - {None} <= set(reasons(RATINGS))


def test_two_results_and_their_counts_from_one_pass(spark):
    lines = frame(spark, [x for x, _ in LINES] * 3)
    out = decode_records(lines, RATINGS)
    bad = Counter(r.reason for r in out.bad.collect())
    assert out.n_good == out.good.count() == 15 and out.n_bad == dict(bad)
    assert out.good.schema.names == RATINGS.names
    assert sorted(map(tuple, out.good.collect()), key=repr) == sorted(map(tuple, parse_records(lines, RATINGS, "drop").collect()), key=repr)
    assert Counter(r.value for r in out.bad.collect()) == Counter([x for x, reason in LINES if reason] * 3)


@pytest.mark.parametrize("lines, good, bad", [([], 0, {}), ([""], 0, {"blank line": 1}), (["1::a::b"], 1, {})])
def test_nothing_good_or_nothing_bad(spark, lines, good, bad):
    out = decode_records(frame(spark, lines), MOVIES)
    assert (out.n_good, out.n_bad) == (good, bad)
    assert (out.good.count(), out.bad.count()) == (good, sum(bad.values()))


def test_text_fields_may_be_empty(spark):
    out = decode_records(frame(spark, ["1::F::25::3::", "1::F::25::3", "1::::25::3::z"]), USERS)
    assert out.n_good == 2 and out.n_bad == {"no zip": 1}


def test_planted_faults_are_all_told_apart(spark, smoke_dir):
    t = star_tables(spark, smoke_dir)
    kinds = Counter(r.movie_id % 11 for r in t.ratings.select("movie_id").collect())
    got = {r.reason: r.n for r in d.record_faults(t).collect()}
    names = dict(enumerate(["blank line", "no movie_id", "no rating", "user_id is not bigint", "movie_id is not bigint", "rating is not double"], 1))
    expected = Counter()
    for kind, n in kinds.items():
        expected[names.get(kind, "good")] += n
    assert got == dict(expected)
    whole = format_records(t.ratings, RATINGS)
    assert decode_records(whole, RATINGS).n_bad == {}
