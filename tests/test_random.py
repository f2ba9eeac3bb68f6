"""Randomized tables vs brute force in plain Python.

Small id ranges make ties, duplicate users, ratings without a movie and
users without an occupation common; genre strings include empty, trailing
and repeated pieces.
"""

import collections

from fixtures import make_tables
from hypothesis import given, settings
from hypothesis import strategies as st

from reelscope.plans import analyses as a

GENRE_STRINGS = ["Drama", "Drama|Comedy", "Drama|", "|", "", "War||War", "|Crime", "Comedy|Drama|Drama"]
TITLES = ["Heat (1995)", "Toy Story (1995)", "NoYear", "Seven (Se7en) (1996)", "A B (90)"]

ratings_st = st.lists(
    st.tuples(st.integers(1, 6), st.integers(1, 9), st.sampled_from([1.0, 2.0, 3.0, 4.0, 5.0])),
    min_size=0,
    max_size=40,
)
users_st = st.lists(
    st.tuples(
        st.integers(1, 6),
        st.sampled_from(["F", "M"]),
        st.sampled_from([1, 18, 25]),
        st.integers(0, 3),
        st.just("z"),
    ),
    min_size=1,
    max_size=8,
)
movies_st = st.dictionaries(
    st.integers(1, 8),
    st.tuples(st.sampled_from(TITLES), st.sampled_from(GENRE_STRINGS)),
    max_size=8,
)


def java_split(s):
    if s == "":
        return [""]
    parts = s.split("|")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def stats(ratings):
    total, n = collections.Counter(), collections.Counter()
    for _, m, r in ratings:
        total[m] += r
        n[m] += 1
    return {m: (total[m], n[m], total[m] / n[m]) for m in n}


@settings(max_examples=12, deadline=None)
@given(ratings_st, users_st, movies_st)
def test_analyses_match_brute_force(spark, ratings, users, movies):
    movie_rows = [(m, title, g) for m, (title, g) in movies.items()]
    occupations = [(0, "artist"), (1, "doctor"), (2, "artist"), (1, "nurse")]  # id 3 unknown, a name and an id used twice
    t = make_tables(spark, ratings, users, movie_rows, occupations)
    s = stats(ratings)

    # top 10 by mean, short and detailed
    by_avg = sorted(s, key=lambda m: (-s[m][2], m))
    assert [(r.avg_rating, r.movie_id) for r in a.top_avg(t).collect()] == [
        (s[m][2], m) for m in by_avg[:10]
    ]
    detailed = [m for m in by_avg if m in movies][:10]
    assert [(r.movie_id, r.title, r.total, r.n) for r in a.top_avg_detail(t).collect()] == [
        (m, movies[m][0], s[m][0], s[m][1]) for m in detailed
    ]

    # cohort by join (multiplies duplicate users) and by semi-join
    band = [u for u, _, age, _, _ in users if age == 1]
    assert a.cohort_rating_count(t).first().n == sum(band.count(u) for u, _, _ in ratings)
    assert a.cohort_semi_count(t).first().n == sum(1 for u, _, _ in ratings if u in band)

    # semi-join top 100, ids compared as text
    semi = stats([r for r in ratings if r[0] in band])
    order = sorted(semi, key=lambda m: (-semi[m][2], -semi[m][1], str(m)))
    assert [(r.movie_id, r.n) for r in a.cohort_semi_top(t).collect()] == [
        (m, semi[m][1]) for m in order[:100]
    ]

    # genre pieces
    genres = collections.Counter(g for _, (_, gs) in movies.items() for g in java_split(gs))
    assert {r.genre: r.n for r in a.genre_counts(t).collect()} == dict(genres)

    # occupation x genre, with inner-join multiplicities on every side
    names = collections.defaultdict(list)
    for oid, name in occupations:
        names[oid].append(name)
    expected = collections.Counter()
    for u, m, _ in ratings:
        if m not in movies:
            continue
        for uu, _, _, occ, _ in users:
            if uu != u:
                continue
            for name in names.get(occ, []):
                for g in java_split(movies[m][1]):
                    expected[(name, g)] += 1
    got = {(r.occupation_name, r.genre): r.n for r in a.occupation_genre_counts(t).collect()}
    assert got == dict(expected)
    direct = {(r.occupation_name, r.genre): r.n for r in a.occupation_genre_counts_direct(t).collect()}
    assert direct == dict(expected)


@settings(max_examples=8, deadline=None)
@given(ratings_st, users_st, movies_st)
def test_per_band_top_matches_brute_force(spark, ratings, users, movies):
    movie_rows = [(m, title, g) for m, (title, g) in movies.items()]
    t = make_tables(spark, ratings, users, movie_rows)
    rated = [(age, m, r) for u, m, r in ratings for uu, _, age, _, _ in users if uu == u]
    expected = []
    for age in sorted({age for age, _, _ in rated}):
        s = stats([(None, m, r) for a_, m, r in rated if a_ == age])
        order = sorted(s, key=lambda m: (-s[m][2], m))[:3]
        expected += [(age, rank, m, s[m][2], s[m][1]) for rank, m in enumerate(order, 1)]
    got = [
        (r.age, r.rank, r.movie_id, r.avg_rating, r.n)
        for r in a.top_avg_per_age(t, k=3).orderBy("age", "rank").collect()
    ]
    assert got == expected
