"""Generated rows: a numbered list of names, the input of the batch-insert trial."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Prefix and size of the trial name list ("张0" .. "张100").
NAME_PREFIX = "张"
NAME_COUNT = 101


def numbered_names(
    spark: SparkSession, prefix: str = NAME_PREFIX, count: int = NAME_COUNT
) -> DataFrame:
    """``name``: ``prefix + i`` for ``i`` in ``0 .. count-1``, generated on the
    executors by ``spark.range`` (nothing is built on the driver)."""
    return spark.range(count).select(
        F.concat(F.lit(prefix), F.col("id").cast("string")).alias("name")
    )
