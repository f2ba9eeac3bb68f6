"""Aggregations.  All of them plan as a partial ``HashAggregate`` before the
shuffle and a final one after it, so a hot key (one movie with a third of
all ratings) is combined map-side and ships one row per map task, not one
row per rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rating_stats(ratings: DataFrame, *keys: str) -> DataFrame:
    """``keys..., total, n, avg_rating`` per key (default ``movie_id``).

    ``n`` counts rating rows, not distinct users; ``avg_rating`` is
    ``total / n`` as a double.
    """
    keys = keys or ("movie_id",)
    return (
        ratings.groupBy(*keys)
        .agg(F.sum("rating").alias("total"), F.count(F.lit(1)).alias("n"))
        .withColumn("avg_rating", F.col("total") / F.col("n"))
    )


def rating_totals(ratings: DataFrame, *keys: str) -> DataFrame:
    """``keys..., total``: sum of ratings per key (default ``movie_id``)."""
    keys = keys or ("movie_id",)
    return ratings.groupBy(*keys).agg(F.sum("rating").alias("total"))


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key combination, as ``keys..., n`` (bigint)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A one-row frame with the row count of ``df``; stays lazy."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_map(df: DataFrame, key: str, item: str, name: str = "counts") -> DataFrame:
    """``key, counts``: per key a ``map<item, bigint>`` of row counts, the
    reference's per-group map before it is flattened.

    Rows are counted per ``(key, item)`` first (partial aggregation, so a hot
    key is combined map-side); only then are the counts of one key packed
    into a map, which therefore holds one entry per distinct item of that
    key, never one per row.  Use it where the item domain is small (genres
    per year or per occupation); ``count_by(df, key, item)`` is the flat form.
    ``item`` must not be null: map keys cannot be (an empty genre is ``''``).
    """
    pairs = count_by(df, key, item)
    return pairs.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(item), F.col("n")))).alias(name)
    )
