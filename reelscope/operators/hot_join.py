"""Joins on a key of which a few values hold much of the rows, without relying on AQE.

AQE splits a skewed partition of a sort-merge join, but only where nothing
above needs the rows of a key together, and only if it is on.  Here the hot
keys are found first, by a mergeable summary of bounded size, and only they
are split: their rows on the large side are dealt over several salts by a hash
of the whole row, and their rows on the other side are repeated once a salt.
All other keys join as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys the summary may return, and those it tracks: one with more than about
# one in MAX_HOT of the rows is always among them.
MAX_HOT = 1_000
TRACKED = 10_000
# Salts for each split: several that hash to one task then add up to little more than its share.
SALTS = 4


def hot_keys(df: DataFrame, key: str, rows_per_split: int) -> DataFrame:
    """``key, splits``: the keys with more than ``rows_per_split`` rows and how
    many parts they need; at most ``MAX_HOT`` keys.

    One pass with a frequent-items sketch, merged from one of bounded size a
    task.  Its estimates may be high by a bounded error, which splits a key
    that needs no split and changes no result.
    """
    if rows_per_split < 1:
        raise ValueError("rows_per_split must be >= 1")
    found = df.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {MAX_HOT}, {TRACKED})").alias("top")).first().top
    hot = [(x.item, math.ceil(x["count"] / rows_per_split)) for x in found or [] if x["count"] > rows_per_split]
    return df.sparkSession.createDataFrame(hot, f"`{key}` {df.schema[key].dataType.simpleString()}, splits int")


def split_join(large: DataFrame, other: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner equi-join of ``large`` and ``other`` on ``key``, the ``hot`` keys split.

    The salt of a row is a hash of all its columns, never a random number, so a
    task that is run again deals its rows as before.  Rows of a hot key that
    are equal in every column share a salt: count them together before.
    """
    hot = F.broadcast(hot)  # MAX_HOT rows at most
    splits = F.coalesce(F.col("splits") * SALTS, F.lit(1))
    salt = F.pmod(F.xxhash64(*large.columns), splits).cast("int")
    dealt = large.join(hot, key, "left").select(*large.columns, salt.alias("_salt"))
    repeated = other.join(hot, key, "left").select(*other.columns, F.explode(F.sequence(F.lit(0), splits - 1)).alias("_salt"))
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")
