"""The bundle of four DataFrames every analysis takes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    """ratings(user_id, movie_id, rating, rated_at), users(user_id, gender,
    age, occupation_id, zip), movies(movie_id, title, genres) and
    occupations(occupation_id, occupation_name).

    Where the frames come from (``::`` text, parquet, the star adapter) is
    the caller's choice; the analyses only depend on these columns.
    """

    ratings: DataFrame
    users: DataFrame
    movies: DataFrame
    occupations: DataFrame
