"""Statistics at several levels of grouping from one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rating_sets(rows: DataFrame, sets: Sequence[Sequence[str]], value: str = "rating") -> DataFrame:
    """``level, <keys>, total, n, avg_rating`` for every one of the grouping ``sets``.

    ``level`` is the position of the set (from 0); keys that are not of the set
    are null.  ``rows`` are aggregated once by all keys together, with a partial
    aggregate before the shuffle; only those sums are repeated for the sets and
    added up again, so neither the scan nor the shuffle of rows is.  A level is
    told by its number, not by its nulls, so a null key is a group like any other.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    if not sets or not all(sets):
        raise ValueError("every grouping set needs a key")
    finest = rows.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
    level = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), *(F.col(k) if k in s else F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in keys)) for i, s in enumerate(sets))))
    spread = finest.select(level.alias("_set"), "total", "n").select("_set.*", "total", "n")
    return (
        spread.groupBy("level", *keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .withColumn("avg_rating", F.col("total") / F.col("n"))
    )
