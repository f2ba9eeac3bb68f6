"""Tables written between the steps of one operator.

A step whose result several later steps read, or whose lineage would grow
with each iteration, is written as Parquet in the shared folder that the
cluster names in ``spark.checkpoint.dir`` and read back.  A lost executor
then costs a re-read of files; nothing is kept on an executor's own disk.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelscope.session import ensure_checkpoint_dir


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of about 2 MB in its session unless a size is set there.

    By default a batch may hold 10,000 rows of any length, and the JVM and the
    Python worker each keep one.
    """
    conf = df.sparkSession.conf
    if conf.get(ARROW_BYTES, None) is None:
        conf.set(ARROW_BYTES, "2m")
    return df


class Staging:
    """One operator run's folder below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it read back (with the same schema)."""
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no later step and no returned result reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
