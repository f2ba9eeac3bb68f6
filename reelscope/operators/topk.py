"""Top-k, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_mean() -> tuple[Column, ...]:
    """Best mean rating first; ties by ``movie_id``."""
    return (F.desc("avg_rating"), F.asc("movie_id"))


def by_count() -> tuple[Column, ...]:
    """Most ratings first; ties by ``movie_id``."""
    return (F.desc("n"), F.asc("movie_id"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows by ``order``.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps only its best ``k`` rows and the driver merges those, so there is
    no full sort and no shuffle of the input.  Callers end ``order`` with a
    unique key so ties at the cut are deterministic.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame, group: list[str], k: int, *order: Column, rank_col: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group, with their 1-based rank (bigint).

    ``row_number() <= k`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle: every map task forwards at most ``k`` rows per group,
    so even a group holding most of the rows arrives small.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))
