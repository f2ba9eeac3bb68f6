"""The analyses: each printed result of the reference as one lazy DataFrame.

Every function takes a ``Tables`` bundle plus parameters (defaults are the
reference's constants) and returns a DataFrame; nothing is collected.

Shape rules shared by all of them:

* counts are rating rows (``n``), never distinct users;
* top-k orders end with ``movie_id`` so ties at the cut are deterministic;
* a detailed top-k joins movies first and limits after, so an inner join
  cannot leave it short of ``k`` rows;
* per-movie statistics are aggregated before joining movie details, so the
  join moves one row per movie, never one row per rating.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.functions.columns import (
    YEAR_PATTERN_PLAIN,
    YEAR_PATTERN_TWO_WORD,
    age_band_label,
    title_name,
    title_pattern_name,
)
from reelscope.operators import (
    by_count,
    by_mean,
    cohort,
    count_by,
    count_map,
    explode_genres,
    rating_stats,
    rating_totals,
    row_count,
    top_k,
    top_k_per_group,
    with_movie,
    with_occupation,
    with_year,
)
from reelscope.sources.dat import format_records, parse_records
from reelscope.sources.schema import RATINGS
from reelscope.sources.tables import Tables

# The reference's default parameters.
DEFAULT_K = 10
DEFAULT_USER_ID = 18
DEFAULT_AGE = 1
SEMI_TOP_K = 100
# A genre of the test adapter for the map lookup.
DEFAULT_GENRE = "MEDIUM"


# --- requirement 1: table sizes, users with their occupation -----------------


def table_counts(t: Tables) -> DataFrame:
    """``table_name, n`` for occupations, movies, users, ratings."""
    named = [
        ("occupations", t.occupations),
        ("movies", t.movies),
        ("users", t.users),
        ("ratings", t.ratings),
    ]
    frames = [row_count(df).select(F.lit(name).alias("table_name"), "n") for name, df in named]
    return reduce(DataFrame.unionByName, frames)


def users_by_occupation(t: Tables) -> DataFrame:
    """Every user with a known occupation, with the occupation's name."""
    return with_occupation(t.users, t.occupations).select(
        "occupation_id", "user_id", "gender", "age", "zip", "occupation_name"
    )


def joined_user_count(t: Tables) -> DataFrame:
    return row_count(users_by_occupation(t))


# --- requirement 2: one user's movies ----------------------------------------


def _user_ratings(t: Tables, user_id: int) -> DataFrame:
    return t.ratings.where(F.col("user_id") == F.lit(user_id)).select("movie_id", "user_id")


def user_movie_count(t: Tables, user_id: int = DEFAULT_USER_ID) -> DataFrame:
    """Ratings by one user (a movie rated twice counts twice)."""
    return row_count(_user_ratings(t, user_id))


def user_movies(t: Tables, user_id: int = DEFAULT_USER_ID) -> DataFrame:
    """``movie_id, user_id, title, genres`` of one user's ratings."""
    return with_movie(_user_ratings(t, user_id), t.movies).select(
        "movie_id", "user_id", "title", "genres"
    )


def user_movies_brief(t: Tables, user_id: int = DEFAULT_USER_ID) -> DataFrame:
    """Older shape: ``movie_id, title, genres``."""
    return user_movies(t, user_id).select("movie_id", "title", "genres")


# --- requirement 3: best-rated and most-rated movies --------------------------


def top_avg(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``avg_rating, movie_id``: best mean rating, movies without a row included."""
    return top_k(rating_stats(t.ratings), k, *by_mean()).select("avg_rating", "movie_id")


def top_avg_detail(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``avg_rating, movie_id, title, genres, total, n``."""
    joined = with_movie(rating_stats(t.ratings), t.movies)
    return top_k(joined, k, *by_mean()).select(
        "avg_rating", "movie_id", "title", "genres", "total", "n"
    )


def top_avg_detail_brief(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    return top_avg_detail(t, k).select("avg_rating", "movie_id", "title", "genres")



def top_watched(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``n, movie_id``: most ratings."""
    return top_k(count_by(t.ratings, "movie_id"), k, *by_count()).select("n", "movie_id")


def top_watched_detail(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``n, movie_id, title, genres, total, avg_rating``."""
    joined = with_movie(rating_stats(t.ratings), t.movies)
    return top_k(joined, k, *by_count()).select(
        "n", "movie_id", "title", "genres", "total", "avg_rating"
    )


def top_watched_detail_brief(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    joined = with_movie(count_by(t.ratings, "movie_id"), t.movies)
    return top_k(joined, k, *by_count()).select("n", "movie_id", "title", "genres")


def decoded_rating_stats(t: Tables) -> DataFrame:
    """``movie_id, total, n, avg_rating`` of the ratings written as ``::``
    lines and decoded again, as the text source hands them over."""
    lines = format_records(t.ratings, RATINGS)
    return rating_stats(parse_records(lines, RATINGS)).select("movie_id", "total", "n", "avg_rating")


# --- requirement 4: by gender ------------------------------------------------


def _gender_ratings(t: Tables, gender: str) -> DataFrame:
    # The gender filter reaches the users scan; users keep only user_id.
    return cohort(t.ratings, t.users, F.col("gender") == F.lit(gender))


def top_total_by_gender(t: Tables, gender: str, k: int = DEFAULT_K) -> DataFrame:
    """``total, movie_id``: largest rating sum among one gender's ratings."""
    totals = rating_totals(_gender_ratings(t, gender))
    return top_k(totals, k, F.desc("total"), F.asc("movie_id")).select("total", "movie_id")


def top_avg_detail_by_gender(t: Tables, gender: str, k: int = DEFAULT_K) -> DataFrame:
    """``avg_rating, movie_id, total, n, title, genres``."""
    joined = with_movie(rating_stats(_gender_ratings(t, gender)), t.movies)
    return top_k(joined, k, *by_mean()).select(
        "avg_rating", "movie_id", "total", "n", "title", "genres"
    )


def top_avg_named_by_gender(t: Tables, gender: str, k: int = DEFAULT_K) -> DataFrame:
    """Older shape: ``movie_id, name, total, n, avg_rating`` (name = title cut)."""
    joined = with_movie(rating_stats(_gender_ratings(t, gender)), t.movies, "title")
    return top_k(joined, k, *by_mean()).select(
        "movie_id", title_name("title").alias("name"), "total", "n", "avg_rating"
    )


# --- requirement 5: one age band ---------------------------------------------


def _age(age: int) -> Column:
    return F.col("age") == F.lit(age)


def cohort_user_count(t: Tables, age: int = DEFAULT_AGE) -> DataFrame:
    return row_count(t.users.where(_age(age)))


def rating_count(t: Tables) -> DataFrame:
    return row_count(t.ratings)


def cohort_rating_count(t: Tables, age: int = DEFAULT_AGE) -> DataFrame:
    """Ratings joined to the band's users (a duplicated user counts twice)."""
    return row_count(cohort(t.ratings, t.users, _age(age)))


def _cohort_stats(t: Tables, age: int) -> DataFrame:
    return rating_stats(cohort(t.ratings, t.users, _age(age)))


def cohort_top_avg(t: Tables, age: int = DEFAULT_AGE, k: int = DEFAULT_K) -> DataFrame:
    """``avg_rating, movie_id, total, n``."""
    return top_k(_cohort_stats(t, age), k, *by_mean()).select(
        "avg_rating", "movie_id", "total", "n"
    )


def cohort_top_avg_brief(t: Tables, age: int = DEFAULT_AGE, k: int = DEFAULT_K) -> DataFrame:
    """Older shape: ``movie_id, avg_rating``."""
    return top_k(_cohort_stats(t, age), k, *by_mean()).select("movie_id", "avg_rating")


def cohort_top_named(t: Tables, age: int = DEFAULT_AGE, k: int = DEFAULT_K) -> DataFrame:
    """``movie_id, name, avg_rating, total, n, genres``."""
    joined = with_movie(_cohort_stats(t, age), t.movies)
    return top_k(joined, k, *by_mean()).select(
        "movie_id", title_name("title").alias("name"), "avg_rating", "total", "n", "genres"
    )


def cohort_top_named_brief(t: Tables, age: int = DEFAULT_AGE, k: int = DEFAULT_K) -> DataFrame:
    """Older shape: ``movie_id, name, avg_rating``."""
    joined = with_movie(_cohort_stats(t, age), t.movies, "title")
    return top_k(joined, k, *by_mean()).select(
        "movie_id", title_name("title").alias("name"), "avg_rating"
    )


def cohort_multikey(t: Tables, age: int = DEFAULT_AGE, k: int = DEFAULT_K) -> DataFrame:
    """``movie_id, title, genres, avg_rating, total, n`` ordered by mean down,
    count down, title up."""
    joined = with_movie(_cohort_stats(t, age), t.movies)
    order = (F.desc("avg_rating"), F.desc("n"), F.asc("title"), F.asc("movie_id"))
    return top_k(joined, k, *order).select(
        "movie_id", "title", "genres", "avg_rating", "total", "n"
    )


def _cohort_semi(t: Tables, age: int, broadcast_max_bytes: int | None) -> DataFrame:
    return cohort(
        t.ratings, t.users, _age(age), how="left_semi", broadcast_max_bytes=broadcast_max_bytes
    )


def cohort_semi_count(
    t: Tables, age: int = DEFAULT_AGE, broadcast_max_bytes: int | None = None
) -> DataFrame:
    """Ratings whose user is in the band, each counted once (semi-join).

    With ``broadcast_max_bytes`` the band's users are measured by a job and
    broadcast if they fit."""
    return row_count(_cohort_semi(t, age, broadcast_max_bytes))


def cohort_semi_top(
    t: Tables,
    age: int = DEFAULT_AGE,
    k: int = SEMI_TOP_K,
    broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """``movie_id, total, n, avg_rating`` ordered by mean down, count down and
    the id compared as text (so 10 comes before 9)."""
    stats = rating_stats(_cohort_semi(t, age, broadcast_max_bytes))
    order = (F.desc("avg_rating"), F.desc("n"), F.asc(F.col("movie_id").cast("string")))
    return top_k(stats, k, *order).select("movie_id", "total", "n", "avg_rating")


# --- requirements 6-8: genres and years --------------------------------------


def genre_counts(t: Tables) -> DataFrame:
    """``genre, n``: movies per genre piece (a repeated genre counts twice)."""
    return count_by(explode_genres(t.movies), "genre")


def year_counts(t: Tables, pattern: str = YEAR_PATTERN_TWO_WORD) -> DataFrame:
    """``year, n`` ordered by year; ``-1`` collects titles without a year."""
    return count_by(with_year(t.movies, pattern), "year").orderBy("year")


def title_parts(t: Tables) -> DataFrame:
    """``movie_id, name_two_word, name_plain``: the name group of both year
    patterns for every movie, ``''`` where a pattern does not match."""
    return t.movies.select(
        "movie_id",
        title_pattern_name("title", YEAR_PATTERN_TWO_WORD).alias("name_two_word"),
        title_pattern_name("title", YEAR_PATTERN_PLAIN).alias("name_plain"),
    )


def year_genre_lookup(t: Tables, genre: str = DEFAULT_GENRE, pattern: str = YEAR_PATTERN_TWO_WORD) -> DataFrame:
    """``year, n_genres, n``: from each year's map of genre counts, its size
    and the count of one genre (0 where the map lacks it)."""
    pieces = explode_genres(with_year(t.movies, pattern), "year")
    maps = count_map(pieces, "year", "genre")
    return maps.select(
        "year",
        F.size("counts").cast("bigint").alias("n_genres"),
        F.coalesce(F.try_element_at("counts", F.lit(genre)), F.lit(0)).cast("bigint").alias("n"),
    )


def year_genre_counts(t: Tables, pattern: str = YEAR_PATTERN_TWO_WORD) -> DataFrame:
    """``year, genre, n`` ordered by year (then genre)."""
    pieces = explode_genres(with_year(t.movies, pattern), "year")
    return count_by(pieces, "year", "genre").orderBy("year", "genre")


# --- requirements 9-10: occupation x genre -----------------------------------


def _rating_occupations(t: Tables) -> DataFrame:
    """``occupation_id, movie_id`` for every rating by a known user."""
    return t.ratings.select("user_id", "movie_id").join(
        t.users.select("user_id", "occupation_id"), "user_id"
    ).select("occupation_id", "movie_id")


def occupation_genre_counts(t: Tables) -> DataFrame:
    """``occupation_name, genre, n``: rating x genre-piece rows per pair.

    Counted per (occupation id, movie) first and fanned out to genres after,
    so the join with the genre pieces moves one row of numbers per
    (occupation, movie) instead of one per rating; names join the counts of
    (occupation id, genre) at the end, which merges ids of one name and
    repeats a count for an id listed twice, as joining them first would.
    Genres are split once per movie, before the join (splitting after it
    would repeat the split for every occupation of a movie).
    """
    per_movie = count_by(_rating_occupations(t), "occupation_id", "movie_id")
    per_genre = (
        per_movie.join(explode_genres(t.movies), "movie_id")
        .groupBy("occupation_id", "genre")
        .agg(F.sum("n").alias("n"))
    )
    return (
        with_occupation(per_genre, t.occupations)
        .groupBy("occupation_name", "genre")
        .agg(F.sum("n").alias("n"))
    )


def occupation_genre_counts_direct(t: Tables) -> DataFrame:
    """Same result as ``occupation_genre_counts`` in the reference's order:
    every rating joined to every genre piece, then counted.  Kept to check
    the pre-aggregated plan against."""
    rows = with_occupation(_rating_occupations(t), t.occupations).join(explode_genres(t.movies), "movie_id")
    return count_by(rows, "occupation_name", "genre")


def occupation_genre_sink_rows(t: Tables) -> DataFrame:
    """The rows written to the ``result(occ, mtype, nums)`` sink."""
    return occupation_genre_counts(t).select(
        F.col("occupation_name").alias("occ"),
        F.col("genre").alias("mtype"),
        F.col("n").alias("nums"),
    )


# --- the requirement text's "for different age groups", in one pass ---------


def top_avg_per_age(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``age, age_band, rank, movie_id, avg_rating, total, n``: top ``k`` of
    every age band in one job instead of one run per band."""
    rated = t.ratings.join(t.users.select("user_id", "age"), "user_id")
    stats = rating_stats(rated, "age", "movie_id")
    return top_k_per_group(stats, ["age"], k, *by_mean()).select(
        "age", age_band_label("age").alias("age_band"), "rank", "movie_id", "avg_rating", "total", "n"
    )


def top_avg_per_gender(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``gender, rank, movie_id, avg_rating, total, n`` for every gender at once."""
    rated = t.ratings.join(t.users.select("user_id", "gender"), "user_id")
    stats = rating_stats(rated, "gender", "movie_id")
    return top_k_per_group(stats, ["gender"], k, *by_mean()).select(
        "gender", "rank", "movie_id", "avg_rating", "total", "n"
    )

