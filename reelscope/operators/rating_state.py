"""Rating statistics kept up to date: a written state, new rows and withdrawals.

The state holds, for every movie, the exact parts of its rating sum and its
number of ratings (``operators.exact``).  A batch of rows added or withdrawn is
reduced to the same form and merged, so the work follows the batch and the
number of movies, never the ratings seen so far, and what is withdrawn leaves
no rounding behind: statistics are the same bits as those of the rows that are
left, computed anew.

Each batch writes a new version below ``location`` and becomes the current one
when its files are committed; a batch that failed half-way is not seen.  The
names of the batches a version contains are written with it, so a batch that is
applied again (a retry) changes nothing.  There may be one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelscope.operators.exact import exact_parts, exact_sums, merged_parts
from reelscope.sources.files import complete, folders

_KEY = ["movie_id"]
_STATE = "movie_id bigint, limb int, part decimal(38,0), n bigint"


class RatingState:
    """Statistics by movie over all batches applied to ``location``."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def _version(self) -> int:
        found = [int(name[1:]) for name in folders(self.spark, self.location) if name.startswith("v")]
        return max((v for v in found if complete(self.spark, f"{self._at(v)}/state")), default=0)

    def _at(self, version: int) -> str:
        return f"{self.location}/v{version:08d}"

    def batches(self) -> list[str]:
        """Names of the batches applied so far, in no order."""
        version = self._version()
        if not version:
            return []
        return [r.batch for r in self.spark.read.schema("batch string").parquet(f"{self._at(version)}/batches").collect()]

    def state(self) -> DataFrame:
        """The current state: ``movie_id, limb, part, n``."""
        version = self._version()
        if not version:
            return self.spark.createDataFrame([], _STATE)
        return self.spark.read.schema(_STATE).parquet(f"{self._at(version)}/state")

    def apply(self, batch: str, added: DataFrame | None = None, withdrawn: DataFrame | None = None) -> bool:
        """Merge rows (``movie_id, rating``) into the state; False if ``batch`` is in it already.

        Withdrawing a rating that is not there raises, and nothing changes.
        """
        done = self.batches()
        if batch in done:
            return False
        parts = self.state()
        for rows, sign in ((added, 1), (withdrawn, -1)):
            if rows is not None:
                own = rows.select("movie_id", "rating", F.lit(sign).alias("w"))
                parts = parts.unionByName(exact_parts(own, _KEY, "rating", "w"))
        path = self._at(self._version() + 1)
        self.spark.createDataFrame([(b,) for b in [*done, batch]], "batch string").write.mode("overwrite").parquet(f"{path}/batches")
        checked = F.when(
            F.col("limb").isNull() & (F.col("n") < 0),
            F.raise_error(F.concat(F.lit("more ratings withdrawn than there are of movie "), F.col("movie_id").cast("string"))),
        ).otherwise(F.col("n"))
        merged = merged_parts(parts, _KEY).withColumn("n", checked)
        merged.select("movie_id", "limb", F.col("part").cast("decimal(38,0)").alias("part"), "n").write.mode("overwrite").parquet(f"{path}/state")
        return True

    def stats(self) -> DataFrame:
        """``movie_id, total, n, avg_rating`` over the rows that are in."""
        return exact_sums(self.state(), _KEY).withColumn("avg_rating", F.col("total") / F.col("n"))
