"""The sf0.01 tables written as ``::`` files and parsed back answer the same."""

import tempfile

import pytest

from reelscope.plans import QUERIES
from reelscope.sources.dat import dat_tables, line_counts, write_dat_tables
from reelscope.sources.star import star_tables

SAMPLE = [
    "r1_table_counts",
    "r1_users_by_occupation",
    "r2_user_movies",
    "r3_top_avg_detail",
    "r4_top_avg_named_female",
    "r5_cohort_semi_top100",
    "r6_genre_counts",
    "r7_year_counts",
    "r8_year_genre_counts_two_word",
    "r9_occupation_genre_counts",
]


@pytest.fixture(scope="module")
def both(spark, sf001_dir):
    raw = star_tables(spark, sf001_dir)
    out = tempfile.mkdtemp(prefix="reelscope-dat-rt-")
    write_dat_tables(raw, out)
    return raw, dat_tables(spark, out, mode="fail"), out


@pytest.mark.parametrize("name", SAMPLE)
def test_same_results_from_text(both, name):
    raw, dat, _ = both
    assert sorted(QUERIES[name](dat).collect()) == sorted(QUERIES[name](raw).collect())


def test_line_counts_match_rows(spark, both):
    raw, _, out = both
    got = {r.table_name: r.n for r in line_counts(spark, out).collect()}
    assert got == {"occupations": 25, "movies": 2000, "users": 1500, "ratings": 60000}
