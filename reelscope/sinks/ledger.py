"""Appends that add their rows once, however often they are tried.

An append has a ``write_id``.  Its rows are dealt into partitions by a hash of
the row, each written below ``rows/write_id=.../part=...``; a partition counts
when the ledger has it.  So

* a write that fails half-way leaves files that no reader sees, and its retry
  replaces the partitions that are not in the ledger and skips the others;
* a write that succeeded and is sent again adds nothing;
* rows of other writes are never touched.

Within one attempt Spark's commit protocol keeps one output of every task.
Only files are used, through Spark's own readers and writers.  The rows of a
retry must be those of the first try: derive them from stored tables, without
random numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelscope.sources.files import exists

PARTITIONS = 64
FILE_RECORDS = 16_000_000
_LEDGER = "part int, n bigint, partitions int, write_id string"
_OWN = ("write_id", "part")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``write_id, part, n, partitions``: the partitions committed to ``path``, their rows
    and how many partitions the write has."""
    where = f"{path.rstrip('/')}/ledger"
    rows = spark.read.schema(_LEDGER).parquet(where) if exists(spark, where) else spark.createDataFrame([], _LEDGER)
    return rows.select("write_id", "part", "n", "partitions")


def append_once(df: DataFrame, path: str, write_id: str, partitions: int = PARTITIONS, steps: int = 1) -> int:
    """Append ``df`` to ``path`` under ``write_id``; the number of rows added by this call.

    With ``steps`` the partitions are committed in so many rounds, each its own
    job, so that a failure repeats at most one round.  A retry must name as
    many partitions as the first try did.  One writer to a ``write_id`` at a time.
    """
    if partitions < 1 or steps < 1 or not write_id:
        raise ValueError("partitions and steps must be >= 1, write_id not empty")
    if clash := [c for c in df.columns if c.lower() in _OWN]:
        raise ValueError(f"columns {clash} are the ledger's own")
    spark, path = df.sparkSession, path.rstrip("/")
    entered = ledger(spark, path).where(F.col("write_id") == write_id).collect()  # at most one row a partition
    if any(r.partitions != partitions for r in entered):
        raise ValueError(f"write {write_id!r} was begun with {entered[0].partitions} partitions")
    done = {r.part for r in entered}
    rows = df.select("*", F.lit(write_id).alias("write_id"), F.pmod(F.xxhash64(*df.columns), F.lit(partitions)).cast("int").alias("part"))
    added = 0
    for step in range(steps):
        open_parts = [p for p in range(step, partitions, steps) if p not in done]
        if not open_parts:
            continue
        own = rows.where(F.col("part").isin(open_parts)).hint("rebalance", "part")
        (
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_RECORDS)
            .partitionBy(*_OWN).parquet(f"{path}/rows")
        )
        added += _commit(spark, path, write_id, partitions, open_parts)
    return added


def _commit(spark: SparkSession, path: str, write_id: str, partitions: int, parts: list[int]) -> int:
    """Enter ``parts`` into the ledger: one file, so all of them or none."""
    written = _rows(spark, path).where((F.col("write_id") == write_id) & F.col("part").isin(parts))
    sizes = dict.fromkeys(parts, 0) | {r.part: r["count"] for r in written.groupBy("part").count().collect()}
    entries = spark.createDataFrame([(p, n, partitions, write_id) for p, n in sorted(sizes.items())], _LEDGER)
    entries.coalesce(1).write.mode("append").partitionBy("write_id").parquet(f"{path}/ledger")
    return sum(sizes.values())


def _rows(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.parquet(f"{path}/rows").schema
    own = [f for f in found if f.name not in _OWN]
    types = T.StructType([*own, T.StructField("write_id", T.StringType()), T.StructField("part", T.IntegerType())])
    return spark.read.schema(types).parquet(f"{path}/rows")  # an id like '17' is no number


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed partitions below ``path``; fails where nothing was ever written."""
    path = path.rstrip("/")
    return _rows(spark, path).join(ledger(spark, path).select(*_OWN), list(_OWN), "left_semi").drop(*_OWN)
