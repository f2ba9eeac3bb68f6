"""Joins of the rating tables.

All joins are inner equi-joins, as in the reference: a user without a known
occupation and a rating without a movie row drop out of detailed results.

No join here carries a broadcast hint: the optimizer decides from file sizes,
and AQE re-plans from the bytes a shuffle really wrote (small side ->
broadcast, skewed key -> split), so building a query starts no job.  A caller
who wants a hint asks for one with a byte budget (``bounded_broadcast``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a broadcast costs beside its strings: a row's header and hash-table slot,
# and each column (2M single-bigint rows were measured at 83 MB, 42 bytes each).
ROW_BYTES = 34
COLUMN_BYTES = 8


def broadcast_bytes(df: DataFrame) -> int:
    """An upper bound of what broadcasting ``df`` takes.  An action: one
    aggregation of row count and longest strings, each task ships one row."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    longest = [F.coalesce(F.max(F.octet_length(F.col(c))), F.lit(0)) for c in strings]
    rows, *widths = df.agg(F.count(F.lit(1)), *longest).first()
    return rows * (ROW_BYTES + COLUMN_BYTES * len(df.columns) + sum(widths))


def bounded_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """``broadcast(df)`` if that takes at most ``max_bytes``, else ``df``.

    This runs a job to measure ``df`` (see ``broadcast_bytes``), so nothing in
    the analyses calls it by itself.  Without the hint the join still runs
    (sort-merge, or a broadcast chosen by AQE from runtime sizes).  A stream
    cannot be measured and is refused.
    """
    if df.isStreaming:
        raise ValueError("a stream has no size to check")
    return F.broadcast(df) if broadcast_bytes(df) <= max_bytes else df


def with_movie(df: DataFrame, movies: DataFrame, *cols: str) -> DataFrame:
    """Inner join on ``movie_id`` adding ``cols`` (default title, genres).

    When ``df`` is an aggregate keyed on ``movie_id`` its shuffle is reused
    for the join, so only ``movies`` moves.
    """
    cols = cols or ("title", "genres")
    return df.join(movies.select("movie_id", *cols), "movie_id")


def with_occupation(users: DataFrame, occupations: DataFrame) -> DataFrame:
    """users joined to their occupation name (map-side when occupations is small)."""
    return users.join(occupations, "occupation_id")


def cohort(
    ratings: DataFrame,
    users: DataFrame,
    condition: Column,
    how: str = "inner",
    broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """Ratings of the users matching ``condition``.

    ``how='inner'`` repeats a rating once per matching user row (a user
    listed twice counts twice); ``how='left_semi'`` keeps it once.  With
    ``broadcast_max_bytes`` the member list is measured by a job and
    broadcast when it fits; the ratings side is never shuffled then.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"how must be 'inner' or 'left_semi', not {how!r}")
    members = users.where(condition).select("user_id")
    if broadcast_max_bytes is not None:
        members = bounded_broadcast(members, broadcast_max_bytes)
    return ratings.join(members, "user_id", how)
