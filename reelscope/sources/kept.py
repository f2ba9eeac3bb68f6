"""Intermediate tables that several steps of one operator read.

They are written as Parquet below ``spark.checkpoint.dir`` and read back, so a
lost executor costs a re-read of files and the lineage stays short.  Every
folder belongs to the application that wrote it; ``release_kept`` removes them
when no result that reads them is needed any more (Spark's own checkpoint
files are the folder's retention to remove, as ever).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelscope.sources.layout import default_location


def _base(spark: SparkSession) -> str:
    return default_location(spark, f"kept-{spark.sparkContext.applicationId}")


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back, with the same schema."""
    path = f"{_base(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_kept(spark: SparkSession) -> bool:
    """Delete every table this application kept; results that read them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_base(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
