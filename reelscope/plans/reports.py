"""Several results over one shared intermediate, computed once.

One program of the reference prints four top-10 lists from a single
per-movie aggregate, another eight results from one age cohort.  A report
builds that intermediate once, keeps it for the duration of a ``with``
block, and derives every result from it::

    with movie_report(t) as r:
        r["top_avg"].show()
        r["top_watched_detail"].show()

``keep='persist'`` caches the intermediate on the executors (lost blocks
are recomputed from lineage); ``keep='checkpoint'`` writes it to the shared
``spark.checkpoint.dir`` and cuts the lineage, so a lost executor costs a
re-read, not a recomputation (the files are removed by Spark's cleaner when
``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, otherwise by the
folder's own retention).  Results equal the single analyses in
``reelscope.plans.analyses`` (tested).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.functions.columns import title_name
from reelscope.operators import (
    by_count,
    by_mean,
    rating_stats,
    row_count,
    top_k,
    with_movie,
)
from reelscope.plans.analyses import DEFAULT_AGE, DEFAULT_K, SEMI_TOP_K
from reelscope.session import ensure_checkpoint_dir
from reelscope.sources.tables import Tables

KEEP_MODES = ("persist", "checkpoint")


class Report:
    """Named result frames plus the intermediates they share."""

    def __init__(self, frames: dict[str, DataFrame], kept: list[DataFrame]):
        self.frames = frames
        self._kept = kept

    def __enter__(self) -> dict[str, DataFrame]:
        return self.frames

    def __exit__(self, *exc) -> bool:
        self.release()
        return False

    def release(self) -> None:
        for df in self._kept:
            df.unpersist()
        self._kept = []


def _keep(df: DataFrame, keep: str, kept: list[DataFrame]) -> DataFrame:
    if keep not in KEEP_MODES:
        raise ValueError(f"keep must be one of {KEEP_MODES}, not {keep!r}")
    if keep == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return kept[-1]




def movie_report(t: Tables, k: int = DEFAULT_K, keep: str = "persist") -> Report:
    """``top_avg``, ``top_avg_detail``, ``top_watched``, ``top_watched_detail``
    from one per-movie aggregate."""
    kept: list[DataFrame] = []
    stats = _keep(rating_stats(t.ratings), keep, kept)
    detail = with_movie(stats, t.movies)
    frames = {
        "top_avg": top_k(stats, k, *by_mean()).select("avg_rating", "movie_id"),
        "top_avg_detail": top_k(detail, k, *by_mean()).select(
            "avg_rating", "movie_id", "title", "genres", "total", "n"
        ),
        "top_watched": top_k(stats, k, *by_count()).select("n", "movie_id"),
        "top_watched_detail": top_k(detail, k, *by_count()).select(
            "n", "movie_id", "title", "genres", "total", "avg_rating"
        ),
    }
    return Report(frames, kept)


def cohort_report(
    t: Tables,
    age: int = DEFAULT_AGE,
    k: int = DEFAULT_K,
    semi_k: int = SEMI_TOP_K,
    keep: str = "persist",
) -> Report:
    """The eight results of one age band from one member list and one
    joined per-movie aggregate."""
    kept: list[DataFrame] = []
    members = _keep(t.users.where(F.col("age") == F.lit(age)).select("user_id"), keep, kept)
    joined = t.ratings.join(members, "user_id")
    stats = _keep(rating_stats(joined), keep, kept)
    detail = _keep(with_movie(stats, t.movies), keep, kept)
    semi = t.ratings.join(members, "user_id", "left_semi")
    semi_stats = rating_stats(semi)
    semi_order = (F.desc("avg_rating"), F.desc("n"), F.asc(F.col("movie_id").cast("string")))
    multikey = (F.desc("avg_rating"), F.desc("n"), F.asc("title"), F.asc("movie_id"))
    frames = {
        "cohort_user_count": row_count(members),
        "rating_count": row_count(t.ratings),
        "cohort_rating_count": row_count(joined),
        "cohort_top_avg": top_k(stats, k, *by_mean()).select("avg_rating", "movie_id", "total", "n"),
        "cohort_top_named": top_k(detail, k, *by_mean()).select(
            "movie_id", title_name("title").alias("name"), "avg_rating", "total", "n", "genres"
        ),
        "cohort_multikey": top_k(detail, k, *multikey).select(
            "movie_id", "title", "genres", "avg_rating", "total", "n"
        ),
        "cohort_semi_count": row_count(semi),
        "cohort_semi_top": top_k(semi_stats, semi_k, *semi_order).select(
            "movie_id", "total", "n", "avg_rating"
        ),
    }
    return Report(frames, kept)


__all__ = ["Report", "cohort_report", "movie_report"]
