"""Folder-watching ``::`` source and checkpoint placement for streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelscope.session import ensure_checkpoint_dir
from reelscope.sources.dat import lines_from, parse_records


def read_dat_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    mode: str = "drop",
    max_files_per_trigger: int | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Streaming DataFrame of the records in new ``::`` files under ``folder``.

    Same decoding as ``read_dat``; ``mode`` defaults to ``'drop'`` because a
    raised error stops a long-running query.  ``max_files_per_trigger``
    bounds the size of one micro-batch.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_records(lines_from(reader, folder, encoding), schema, mode)


def checkpoint_location(spark: SparkSession, query_name: str) -> str:
    """``<spark.checkpoint.dir>/streams/<query_name>``: progress and state of a
    streaming query live in the shared folder the cluster names, so a
    restarted driver or lost executor resumes from it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
