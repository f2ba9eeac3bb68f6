"""The ``::`` text source: typed decode, malformed rows, blank lines, Latin-1."""

import os
import tempfile

import pytest

from reelscope.plans import analyses as a
from reelscope.sources import schema as S
from reelscope.sources.dat import dat_tables, line_counts, read_dat

RATINGS = "1::10::5::978300760\n1::20::3::978302109\n2::10::4::978301968\n\n2::30::2::978300275\n"
USERS = "1::F::1::10::48067\n2::M::56::16::70072\n3::M::25::15::55117\n"
MOVIES = "10::Toy Story (1995)::Animation|Children's|Comedy\n20::Heat (1995)::Action|Crime|\n30::Café (1990)::Drama\n"
OCCUPATIONS = "10::K-12 student\n15::scientist\n16::self-employed"


@pytest.fixture(scope="module")
def dat_dir():
    d = tempfile.mkdtemp(prefix="reelscope-dat-")
    for name, text in [
        ("ratings.dat", RATINGS),
        ("users.dat", USERS),
        ("movies.dat", MOVIES),
        ("occupations.dat", OCCUPATIONS),
    ]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    with open(os.path.join(d, "bad.dat"), "w", encoding="utf-8") as f:
        f.write("1::10::5::1\n3::short\nx::y::z::1\n")
    latin = os.path.join(d, "latin")
    os.mkdir(latin)
    with open(os.path.join(latin, "movies.dat"), "wb") as f:
        f.write('30::Café (1990)::Drama\n31::"Quoted" (1991)::A||B\n'.encode("latin-1"))
    return d


def test_line_counts_include_blank_lines(spark, dat_dir):
    got = {r.table_name: r.n for r in line_counts(spark, dat_dir).collect()}
    assert got == {"occupations": 3, "movies": 3, "users": 3, "ratings": 5}


def test_typed_schema(spark, dat_dir):
    df = read_dat(spark, os.path.join(dat_dir, "ratings.dat"), S.RATINGS, mode="drop")
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "bigint",
        "bigint",
        "double",
        "timestamp",
    ]
    assert df.count() == 4


def test_fail_mode_raises_on_blank_line(spark, dat_dir):
    with pytest.raises(Exception, match="malformed record"):
        read_dat(spark, os.path.join(dat_dir, "ratings.dat"), S.RATINGS).collect()


def test_drop_mode_drops_short_and_non_numeric_rows(spark, dat_dir):
    path = os.path.join(dat_dir, "bad.dat")
    rows = read_dat(spark, path, S.RATINGS, mode="drop").collect()
    assert [(r.user_id, r.movie_id, r.rating) for r in rows] == [(1, 10, 5.0)]
    with pytest.raises(Exception, match="malformed record"):
        read_dat(spark, path, S.RATINGS, mode="fail").collect()


def test_bad_mode_rejected(spark, dat_dir):
    with pytest.raises(ValueError):
        read_dat(spark, os.path.join(dat_dir, "users.dat"), S.USERS, mode="skip")


def test_latin1_titles_kept(spark, dat_dir):
    path = os.path.join(dat_dir, "latin", "movies.dat")
    rows = read_dat(spark, path, S.MOVIES, encoding="ISO-8859-1").orderBy("movie_id").collect()
    assert [r.title for r in rows] == ["Café (1990)", '"Quoted" (1991)']
    assert rows[1].genres == "A||B"


def test_analyses_run_on_dat_tables(spark, dat_dir):
    t = dat_tables(spark, dat_dir, mode="drop")
    assert {r.table_name: r.n for r in a.table_counts(t).collect()} == {
        "occupations": 3,
        "movies": 3,
        "users": 3,
        "ratings": 4,
    }
    top = a.top_avg_detail(t).collect()
    assert [(r.movie_id, r.avg_rating, r.n) for r in top] == [(10, 4.5, 2), (20, 3.0, 1), (30, 2.0, 1)]
    genres = {r.genre: r.n for r in a.genre_counts(t).collect()}
    assert genres["Action"] == 1 and "" not in genres
    occ = {(r.occupation_name, r.genre): r.n for r in a.occupation_genre_counts(t).collect()}
    assert occ[("K-12 student", "Animation")] == 1
    assert occ[("self-employed", "Animation")] == 1
    years = {r.year: r.n for r in a.year_counts(t).collect()}
    assert years == {-1: 2, 1995: 1}


def test_each_line_is_split_once(spark, dat_dir):
    import contextlib
    import io

    df = read_dat(spark, os.path.join(dat_dir, "ratings.dat"), S.RATINGS, mode="drop")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.groupBy("movie_id").count().explain()
    plan = buf.getvalue()
    assert plan.count("split(value") == 1
    assert "Generate inline" in plan


def test_blank_lines_count_as_malformed_in_every_encoding(spark, tmp_path):
    for encoding in ("UTF-8", "ISO-8859-1"):
        path = tmp_path / f"{encoding}.dat"
        path.write_bytes("30::Café (1990)::Drama\n\n31::B::C\n".encode(encoding))
        with pytest.raises(Exception, match="malformed record"):
            read_dat(spark, str(path), S.MOVIES, encoding=encoding).collect()
        rows = read_dat(spark, str(path), S.MOVIES, mode="drop", encoding=encoding).collect()
        assert [r.title for r in rows] == ["Café (1990)", "B"]


def test_encodings_with_wide_line_breaks_are_refused(spark, tmp_path):
    for encoding in ("UTF-16", "UTF-32", "no-such-charset"):
        with pytest.raises(ValueError):
            read_dat(spark, str(tmp_path), S.MOVIES, encoding=encoding)


def test_empty_file_counts_zero_lines(spark, tmp_path):
    for name, text in [("ratings", ""), ("users", "x\n"), ("movies", "a\n\nb"), ("occupations", "\n")]:
        (tmp_path / f"{name}.dat").write_text(text)
    got = {r.table_name: r.n for r in line_counts(spark, str(tmp_path)).collect()}
    assert got == {"ratings": 0, "users": 1, "movies": 3, "occupations": 1}
