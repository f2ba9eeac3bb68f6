"""One-to-many and derived-column views of ``movies``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.functions.columns import YEAR_PATTERN_TWO_WORD, split_genres, title_year


def explode_genres(movies: DataFrame, *keep: str) -> DataFrame:
    """``movie_id, keep..., genre``: one row per piece of the genre list
    (repeats kept, trailing empties dropped as the reference's split does)."""
    return movies.select("movie_id", *keep, F.explode(split_genres("genres")).alias("genre"))


def with_year(movies: DataFrame, pattern: str = YEAR_PATTERN_TWO_WORD) -> DataFrame:
    """``movies`` plus ``year`` parsed from the title (-1 when unknown)."""
    return movies.withColumn("year", title_year("title", pattern))
