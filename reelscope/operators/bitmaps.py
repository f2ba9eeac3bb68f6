"""Sets of ids as exact bitmaps, one bit an id.

Ids fall into buckets of ``BUCKET_IDS``; a set is one row of ``BUCKET_IDS / 8``
bytes for every bucket that holds an id of it.  Bitmaps are built by a partial
aggregate (one row a bucket and task is moved, however often an id occurs),
combined bucket by bucket, and joined to rows by bucket, so nothing grows with
more than one bit an id and nothing is whole in one place.  Negative ids and
zero have buckets of their own; null ids are in no set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.operators.joins import bounded_broadcast

# Fixed value: ids in a row of Spark's bitmap functions.
BUCKET_IDS = 32_768


def id_bitmaps(df: DataFrame, id_col: str, *group: str) -> DataFrame:
    """``group..., bucket, bits``: the distinct ids of every group."""
    ids = df.where(F.col(id_col).isNotNull())
    return ids.groupBy(*group, F.bitmap_bucket_number(id_col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits")
    )


def bitmap_sizes(bitmaps: DataFrame, *group: str) -> DataFrame:
    """``group..., n``: how many ids each set has."""
    return bitmaps.groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def union_of(bitmaps: DataFrame, *group: str) -> DataFrame:
    """The sets of ``bitmaps`` that agree in ``group``, united."""
    return bitmaps.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def intersection_of(bitmaps: DataFrame, sets: int, *group: str) -> DataFrame:
    """What all of the ``sets`` sets of each ``group`` have in common: a bucket
    that one of them lacks is in no intersection."""
    both = bitmaps.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("_sets"), F.bitmap_and_agg("bits").alias("bits"))
    return both.where(F.col("_sets") == sets).drop("_sets")


def set_overlaps(bitmaps: DataFrame, name: str) -> DataFrame:
    """``a, b, n_a, n_b, n_both, n_either, n_only_a`` for every two sets ``a < b``
    (told apart by ``name``) that have an id in common.

    Two bitmaps meet by bucket, so a pair costs a bit an id, whatever the ids' rows.
    """
    one = bitmaps.select("bucket", F.col(name).alias("a"), F.col("bits").alias("bits_a"))
    two = bitmaps.select("bucket", F.col(name).alias("b"), F.col("bits").alias("bits_b"))
    met = one.join(two, "bucket").where("a < b")
    sides = met.select("a", "b", "bucket", F.explode(F.array("bits_a", "bits_b")).alias("bits"))
    common = bitmap_sizes(intersection_of(sides, 2, "a", "b"), "a", "b").where("n > 0")
    sizes = bitmap_sizes(bitmaps, name)
    return (
        common.withColumnRenamed("n", "n_both")
        .join(sizes.select(F.col(name).alias("a"), F.col("n").alias("n_a")), "a")
        .join(sizes.select(F.col(name).alias("b"), F.col("n").alias("n_b")), "b")
        .select("a", "b", "n_a", "n_b", "n_both", (F.col("n_a") + F.col("n_b") - F.col("n_both")).alias("n_either"), (F.col("n_a") - F.col("n_both")).alias("n_only_a"))
    )


def _bit(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int"))


def members(df: DataFrame, id_col: str, bitmaps: DataFrame, broadcast_max_bytes: int | None = None) -> DataFrame:
    """The rows of ``df`` whose id is in the set ``bitmaps`` (``bucket, bits``), once each.

    Joined by bucket and tested by bit.  With ``broadcast_max_bytes`` the set is
    measured and broadcast when it fits; otherwise adaptive execution decides,
    and splits a bucket that many rows fall into.
    """
    own = bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    if broadcast_max_bytes is not None:
        own = bounded_broadcast(own, broadcast_max_bytes)
    held = df.join(own, F.bitmap_bucket_number(id_col) == F.col("_bucket"))
    return held.where(_bit(F.col("_bits"), F.bitmap_bit_position(id_col)) == 1).select(*df.columns)
