"""Relational sink through Spark's JDBC writer.

Spark writes each partition in its own connection and transaction, sending
rows in batches of ``batchsize`` -- the same unit of work as an open/insert/
commit per partition, with memory bounded by the batch size.  URL and
credentials always come from the caller.

Retries: a task that fails after its commit and is retried inserts its rows
again, as any append does.  For an idempotent load write with
``mode='overwrite'`` or into a fresh table and swap it in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelscope.sources.memory import NAME_COUNT, NAME_PREFIX, numbered_names
from reelscope.sources.schema import PERSON_SINK

MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


def count_written(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and return how many rows went through it.

    The count is observed in the write itself, so nothing is computed twice
    and a failed write reports no rows.
    """
    observed = Observation()
    write(df.observe(observed, F.count(F.lit(1)).alias("rows")))
    return observed.get["rows"]


def as_sink(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df``'s columns by name, with the sink's types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    *,
    properties: dict[str, str] | None = None,
    batch_size: int = 1000,
    isolation_level: str = "READ_COMMITTED",
    max_connections: int | None = None,
) -> int:
    """Write ``df`` to ``table`` and return the number of rows sent.

    ``max_connections`` caps concurrent connections (Spark coalesces to that
    many partitions before writing); leave it unset to use one connection
    per partition.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")

    def write(rows: DataFrame) -> None:
        writer = (
            rows.write.mode(mode)
            .option("batchsize", str(batch_size))
            .option("isolationLevel", isolation_level)
        )
        if max_connections is not None:
            writer = writer.option("numPartitions", str(max_connections))
        writer.jdbc(url, table, properties=dict(properties or {}))

    return count_written(df, write)


def write_numbered_names(
    spark: SparkSession,
    url: str,
    table: str = "person",
    mode: str = "append",
    prefix: str = NAME_PREFIX,
    count: int = NAME_COUNT,
    **options,
) -> int:
    """The generated name list into ``person(name)``."""
    return write_jdbc(as_sink(numbered_names(spark, prefix, count), PERSON_SINK), url, table, mode, **options)
