"""Global positions: the place of every row in a total order, without a
single-partition window.

``row_number`` over an unpartitioned window sends all rows to one task.  Here
the rows are range-partitioned by the order and sorted inside their partitions,
each row gets its place in its partition as it is written, the partitions are
counted, and the counts before a partition are added to its places.  All rows
move once; what meets in one place is one count a partition.

End ``order`` with a unique key: then positions are determined by the rows, and
a value that many rows share is split over several partitions.  Rows that are
equal in the whole order get neighbouring positions, in any order.  Nulls sort
as in ``orderBy`` (first ascending, last descending).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.sources.kept import kept

# monotonically_increasing_id: the partition above this bit, the place in it below.
_PLACE_BITS = 33


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = "_" + name
    return name


def numbered(df: DataFrame, order: list[Column | str], position: str, part: str) -> DataFrame:
    """``df`` with each row's position (from 1) in ``order``, and the number of
    the sorted partition it was written in."""
    spark = df.sparkSession
    row = _free(df, "_row")
    rows = kept(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id()), "positions"
    )
    rows = rows.withColumn(part, F.shiftright(row, _PLACE_BITS))
    sizes = sorted((r[part], r["count"]) for r in rows.groupBy(part).count().collect())  # one row a partition
    before = accumulate((n for _, n in sizes), initial=0)
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], f"`{part}` bigint, `_before` bigint")
    place = F.col(row).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return rows.join(F.broadcast(offsets), part).select(*df.columns, (F.col("_before") + place + 1).alias(position), part)


def with_positions(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """``df`` with the position (bigint, from 1) of every row in ``order``.

    The sorted rows are written once (see ``sources.kept``), so this is an action.
    """
    if not order:
        raise ValueError("an order is needed")
    if name in df.columns:
        raise ValueError(f"{name!r} is a column already")
    part = _free(df, "_part")
    return numbered(df, list(order), name, part).drop(part)


def paged_lists(df: DataFrame, key: str, item: str, page_size: int, *order: Column | str) -> DataFrame:
    """``key, page, n, items``: the items of each key, in ``order`` (default:
    by item), in pages of ``page_size``; the last one of a key may be shorter.

    The grouped list of the reference, without its limit: a key with a third of
    all rows has many pages in many tasks, and no row holds more than a page.
    A row's place in its key is its global position less the key's first one,
    which is looked up by (key, sorted partition), so no join meets all rows of
    a key either.  Repeated items are repeated in the list, nulls included, and
    a null key has pages of its own.
    """
    if page_size < 1:
        raise ValueError("page_size must be >= 1")
    order = order or (item,)
    rows = numbered(df, [F.col(key), *order], "_position", "_part").select(
        F.col(key).alias("key"), F.col(item).alias("item"), "_position", "_part"
    )
    heads = rows.groupBy("key", "_part").agg(F.min("_position").alias("low"))
    starts = heads.groupBy("key").agg(F.min("low").alias("start")).select(F.col("key").alias("k"), "start")
    starts = heads.join(starts, F.col("key").eqNullSafe(F.col("k"))).select("k", F.col("_part").alias("p"), "start")
    placed = rows.join(starts, F.col("key").eqNullSafe(F.col("k")) & (F.col("_part") == F.col("p")))
    place = F.col("_position") - F.col("start")
    pages = placed.select("key", "item", place.alias("place"), F.floor(place / page_size).alias("page"))
    listed = F.array_sort(F.collect_list(F.struct("place", "item")))
    return pages.groupBy("key", "page").agg(F.count(F.lit(1)).alias("n"), listed.alias("rows")).select(
        F.col("key").alias(key), "page", "n", F.col("rows.item").alias("items")
    )


def unpaged(pages: DataFrame, key: str, item: str, page_size: int) -> DataFrame:
    """``key, place, item``: the rows of ``paged_lists``, places from 0 in each key."""
    rows = pages.select(key, "page", F.posexplode("items").alias("_at", item))
    return rows.select(key, (F.col("page") * page_size + F.col("_at")).alias("place"), item)
