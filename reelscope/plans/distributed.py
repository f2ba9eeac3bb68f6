"""Analyses whose mechanism is made for a cluster: global positions, paged
lists, threshold top-k, one scan for many answers, bitmaps, split hot keys,
order-free sums, states kept up to date, checked records, appends that count once.

They answer questions of ``plans.analyses`` or their natural extensions.  Those
that write an intermediate table (``sources.kept``) run jobs while they are built.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.functions.columns import YEAR_PATTERN_PLAIN
from reelscope.operators import (
    by_count,
    by_mean,
    count_by,
    explode_genres,
    rating_stats,
    row_count,
    top_k_per_group,
    with_occupation,
    with_year,
)
from reelscope.operators.bitmaps import id_bitmaps, members, set_overlaps
from reelscope.operators.cubes import rating_sets
from reelscope.operators.exact import exact_rating_stats
from reelscope.operators.hot_join import hot_keys, split_join
from reelscope.operators.positions import paged_lists, unpaged, with_positions
from reelscope.operators.rating_state import RatingState
from reelscope.operators.threshold import top_k_sums
from reelscope.plans.analyses import DEFAULT_AGE, DEFAULT_K, occupation_genre_sink_rows
from reelscope.sinks.jdbc import as_sink
from reelscope.sinks.ledger import append_once, read_committed
from reelscope.sources.checked import decode_records
from reelscope.sources.dat import format_records
from reelscope.sources.kept import kept
from reelscope.sources.layout import default_location
from reelscope.sources.schema import RATINGS, RESULT_SINK
from reelscope.sources.tables import Tables

PAGE_SIZE = 50
# Rows of one user from which its join is split.
SPLIT_ROWS = 1_000_000
STATE_DATE = dt.datetime(1995, 1, 1)
WITHDRAWN_YEAR = 1996


# --- global positions --------------------------------------------------------


def movie_positions(t: Tables) -> DataFrame:
    """``position, movie_id, avg_rating, n``: every rated movie's place by mean."""
    return with_positions(rating_stats(t.ratings), *by_mean()).select("position", "movie_id", "avg_rating", "n")


def year_genre_positions(t: Tables, pattern: str = YEAR_PATTERN_PLAIN) -> DataFrame:
    """``position, year, genre, n``: the year x genre counts in order, numbered."""
    counts = count_by(explode_genres(with_year(t.movies, pattern), "year"), "year", "genre")
    return with_positions(counts, "year", "genre").select("position", "year", "genre", "n")


# --- paged lists -------------------------------------------------------------


def year_movie_pages(t: Tables, page_size: int = PAGE_SIZE, pattern: str = YEAR_PATTERN_PLAIN) -> DataFrame:
    """``year, page, n, movie_ids``: the movies of each year, by id, in pages."""
    pages = paged_lists(with_year(t.movies, pattern).select("year", "movie_id"), "year", "movie_id", page_size)
    return pages.select("year", "page", "n", F.array_join(F.col("items").cast("array<string>"), ",").alias("movie_ids"))


def year_genre_counts_from_pages(t: Tables, page_size: int = PAGE_SIZE, pattern: str = YEAR_PATTERN_PLAIN) -> DataFrame:
    """``year, genre, n`` counted from the grouped lists of genre pieces, read back from their pages."""
    pieces = explode_genres(with_year(t.movies, pattern), "year")
    pages = paged_lists(pieces, "year", "genre", page_size, "movie_id", "genre")
    return count_by(unpaged(pages, "year", "genre", page_size), "year", "genre")


# --- threshold top-k ---------------------------------------------------------


def top_total_by_threshold(t: Tables, gender: str, k: int = DEFAULT_K) -> DataFrame:
    """``total, movie_id``: the movies with the largest rating sum of one gender."""
    users = t.users.where(F.col("gender") == F.lit(gender)).select("user_id")
    return top_k_sums(t.ratings.join(users, "user_id"), "movie_id", "rating", k)


# --- many answers from one scan ----------------------------------------------

SETS = (("movie_id",), ("gender", "movie_id"), ("age", "movie_id"))


def _sets(t: Tables) -> DataFrame:
    """Statistics by movie, (gender, movie) and (age, movie); ratings by unknown users count for the movie alone."""
    users = t.users.select("user_id", "gender", "age", F.lit(True).alias("known"))
    sets = rating_sets(t.ratings.join(users, "user_id", "left"), [(*s, "known") for s in SETS])
    # By movie alone known and unknown users are two rows of the smallest level: added up once more.
    return sets.where((F.col("level") == 0) | F.col("known")).groupBy("level", "gender", "age", "movie_id").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )


def rating_levels(t: Tables) -> DataFrame:
    """``level, gender, age, movie_id, total, n, avg_rating`` at all three levels, from one scan of the ratings."""
    return _sets(t).withColumn("avg_rating", F.col("total") / F.col("n"))


def report_lists(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """``list, of, rank, movie_id, total, n``: the top lists of requirements 3 to 5
    (by mean, most watched, largest sum; of all, of each gender, of each age
    band), all from one written table of sums."""
    sums = kept(rating_levels(t), "rating-levels").withColumn(
        "of", F.when(F.col("level") == 0, "all").when(F.col("level") == 1, F.col("gender")).otherwise(F.col("age").cast("string"))
    )
    lists = (
        ("best mean", sums, by_mean()),
        ("most watched", sums.where("level = 0"), by_count()),
        ("largest sum", sums.where("level = 1"), (F.desc("total"), F.asc("movie_id"))),
    )
    frames = [
        top_k_per_group(rows, ["level", "of"], k, *order).select(F.lit(name).alias("list"), "of", "rank", "movie_id", "total", "n")
        for name, rows, order in lists
    ]
    return reduce(DataFrame.unionByName, frames)


# --- bitmaps -----------------------------------------------------------------


def cohort_bitmap_count(t: Tables, age: int = DEFAULT_AGE) -> DataFrame:
    """Ratings whose user is in the band, each once; the band's users as a bitmap."""
    band = id_bitmaps(t.users.where(F.col("age") == F.lit(age)), "user_id")
    return row_count(members(t.ratings.select("user_id"), "user_id", band))


def cohort_overlaps(t: Tables) -> DataFrame:
    """``a, b, n_a, n_b, n_both, n_either, n_only_a`` of every two cohorts of
    users (genders, age bands, occupations) that share a user."""
    names = F.array(
        F.concat(F.lit("gender "), "gender"),
        F.concat(F.lit("age "), F.col("age").cast("string")),
        F.concat(F.lit("occupation "), F.col("occupation_id").cast("string")),
    )
    return set_overlaps(id_bitmaps(t.users.select("user_id", F.explode(names).alias("cohort")), "user_id", "cohort"), "cohort")


# --- hot keys ----------------------------------------------------------------


def occupation_genre_counts_split(t: Tables, rows_per_split: int = SPLIT_ROWS) -> DataFrame:
    """``occupation_genre_counts`` with the ratings of very active users split over
    several tasks, whether or not AQE is on."""
    ratings = t.ratings.select("user_id", "movie_id")
    known = split_join(ratings, t.users.select("user_id", "occupation_id"), "user_id", hot_keys(ratings, "user_id", rows_per_split))
    per_movie = count_by(known, "occupation_id", "movie_id")
    per_genre = per_movie.join(explode_genres(t.movies), "movie_id").groupBy("occupation_id", "genre").agg(F.sum("n").alias("n"))
    return with_occupation(per_genre, t.occupations).groupBy("occupation_name", "genre").agg(F.sum("n").alias("n"))


# --- sums without an order, states kept up to date ---------------------------


def exact_thirds(t: Tables) -> DataFrame:
    """``movie_id, total, n, avg_rating`` of a third of each rating: sums of
    fractions that come out the same bits however the rows are partitioned."""
    return exact_rating_stats(t.ratings.select("movie_id", (F.col("rating") / 3).alias("rating")))


def _state(t: Tables) -> RatingState:
    spark = t.ratings.sparkSession
    return RatingState(spark, default_location(spark, f"state-{uuid.uuid4().hex}"))


def stats_from_state(t: Tables, date: dt.datetime = STATE_DATE) -> DataFrame:
    """``movie_id, total, n, avg_rating``: the state of the ratings before ``date``
    brought up to date with the rest, the last batch sent twice."""
    state, later = _state(t), F.col("rated_at") >= F.lit(date)
    rows = t.ratings.select("movie_id", "rating", "rated_at")
    state.apply("before", added=rows.where(~later | later.isNull()))
    state.apply("rest", added=rows.where(later))
    state.apply("rest", added=rows.where(later))
    return state.stats()


def stats_after_withdrawal(t: Tables, year: int = WITHDRAWN_YEAR) -> DataFrame:
    """``movie_id, total, n, avg_rating`` after all ratings of one year are withdrawn from the state."""
    state, rows = _state(t), t.ratings.select("movie_id", "rating", "rated_at")
    state.apply("all", added=rows)
    state.apply("withdrawn", withdrawn=rows.where(F.year("rated_at") == year))
    return state.stats()


# --- records and appends -----------------------------------------------------


def with_planted_faults(t: Tables) -> DataFrame:
    """The ratings as ``::`` lines, some of them broken, told by the movie's id
    (a fixture made of given rows: one kind of fault for each remainder by 11)."""
    parts = F.split("value", "::", -1)
    kind = F.get(parts, 1).cast("bigint") % 11
    line = lambda *fields: F.concat_ws("::", *fields)
    user, movie, rating, at = (F.get(parts, i) for i in range(4))
    return format_records(t.ratings, RATINGS).select(
        F.when(kind == 1, F.lit(" "))
        .when(kind == 2, user)
        .when(kind == 3, line(user, movie))
        .when(kind == 4, line(F.lit(""), movie, rating, at))
        .when(kind == 5, line(user, F.lit("m12"), rating, at))
        .when(kind == 6, line(user, movie, F.lit("five"), at))
        .otherwise(F.col("value"))
        .alias("value")
    )


def record_faults(t: Tables) -> DataFrame:
    """``reason, n``: the bad lines by reason and the good ones, decoded once and read back."""
    decoded = decode_records(with_planted_faults(t), RATINGS)
    good = decoded.good.select(F.lit("good").alias("reason"))
    return count_by(good.unionByName(decoded.bad.select("reason")), "reason")


def stats_of_good_records(t: Tables) -> DataFrame:
    """``movie_id, total, n, avg_rating`` of the lines that decode."""
    return rating_stats(decode_records(with_planted_faults(t), RATINGS).good).select("movie_id", "total", "n", "avg_rating")


def sink_rows_written_twice(t: Tables) -> DataFrame:
    """``occ, mtype, nums``: the sink's rows, appended and sent again under the same id, read back."""
    spark = t.ratings.sparkSession
    rows = kept(as_sink(occupation_genre_sink_rows(t), RESULT_SINK), "sink-rows")
    path = default_location(spark, f"result-{uuid.uuid4().hex}")
    append_once(rows, path, "load", partitions=8, steps=2)
    append_once(rows, path, "load", partitions=8)
    return read_committed(spark, path)
