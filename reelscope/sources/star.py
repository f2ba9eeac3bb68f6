"""Adapter: the four rating tables as views over the TPC-H-like star schema.

The mapping is a fixed test definition, so both engines in the oracle check
see the same inputs.  Every nation is an occupation, every part a movie.  It
contains edge cases on purpose: one-word titles, a second bracket in the
title, titles without a year, and genre strings with repeated, trailing and
inner-empty pieces.

Only columns a query asks for are read: every expression below is a plain
projection, so Catalyst prunes the parquet ``ReadSchema`` and pushes
filters on ``user_id`` / ``occupation_id`` / ``movie_id`` into the scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the adapter (must equal the oracle's CTEs).
FEMALE_SEGMENTS = ("FURNITURE", "BUILDING")
# Account-balance upper bounds of the age bands 1, 18, 25, 35, 45, 50; 56 above.
AGE_BAND_BOUNDS = ((0, 1), (2000, 18), (4000, 25), (6000, 35), (7000, 45), (8000, 50))
AGE_BAND_TOP = 56
ZIP_BASE = 10000
RATING_LEVELS = 5
YEAR_BASE, YEAR_STEP, YEAR_SPAN = 1950, 7, 60


# The star columns the adapter reads, with their types.  They are selected from
# the file's own schema, so a column that is not there is an error; the
# optimizer prunes the scan further per query.
STAR_COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = T.StructType.fromDDL(STAR_COLUMNS[name])
    return table.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))


def occupations_view(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").alias("occupation_id"),
        F.col("n_name").alias("occupation_name"),
    )


def _age_band(balance: Column) -> Column:
    expr = None
    for bound, band in AGE_BAND_BOUNDS:
        expr = (F.when if expr is None else expr.when)(balance < bound, F.lit(band))
    return expr.otherwise(F.lit(AGE_BAND_TOP))


def users_view(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment").isin(*FEMALE_SEGMENTS), F.lit("F"))
        .otherwise(F.lit("M"))
        .alias("gender"),
        _age_band(F.col("c_acctbal")).alias("age"),
        F.col("c_nationkey").alias("occupation_id"),
        (F.lit(ZIP_BASE) + F.col("c_custkey")).cast("string").alias("zip"),
    )


def ratings_view(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One rating per line item; the order says who rated and when.

    At scale this is the one large-by-large join of the adapter; it is a
    key-only sort-merge join on the order key (both sides pruned to the
    columns below), and AQE splits a hot order key.
    """
    quantity = F.col("l_quantity").cast("int")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.lit(1) + (quantity - F.lit(1)) % F.lit(RATING_LEVELS)).cast("double").alias("rating"),
        F.col("o_orderdate").alias("rated_at"),
    )


def movies_view(part: DataFrame) -> DataFrame:
    key, name, ptype = F.col("p_partkey"), F.col("p_name"), F.col("p_type")
    year = (F.lit(YEAR_BASE) + (key * F.lit(YEAR_STEP)) % F.lit(YEAR_SPAN)).cast("string")
    first_word = F.split_part(name, F.lit(" "), F.lit(1))
    second_word = F.split_part(name, F.lit(" "), F.lit(2))
    kind = key % 10
    title = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat(first_word, F.lit(" ("), year, F.lit(")")))
        .when(kind == 2, F.concat(name, F.lit(" (alt) ("), year, F.lit(")")))
        .otherwise(F.concat(name, F.lit(" ("), year, F.lit(")")))
    )
    shape = F.col("p_size") % 6
    bar = F.lit("|")
    genres = (
        F.when(shape == 0, ptype)
        .when(shape == 1, F.concat(ptype, bar, second_word))
        .when(shape == 2, F.concat(ptype, bar, second_word, bar, first_word))
        .when(shape == 3, F.concat(ptype, bar, ptype))
        .when(shape == 4, F.concat(ptype, bar, second_word, bar))
        .otherwise(F.concat(ptype, bar, bar, second_word))
    )
    return part.select(key.alias("movie_id"), title.alias("title"), genres.alias("genres"))


class StarTables:
    """The four rating tables over ``{sf_dir}/*.parquet``, as ``Tables`` has them.

    A table's files are looked at when an analysis first asks for it, so a
    query opens only what it reads.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return _read(self._spark, self._sf_dir, name)

    @cached_property
    def ratings(self) -> DataFrame:
        return ratings_view(self._read("lineitem"), self._read("orders"))

    @cached_property
    def users(self) -> DataFrame:
        return users_view(self._read("customer"))

    @cached_property
    def movies(self) -> DataFrame:
        return movies_view(self._read("part"))

    @cached_property
    def occupations(self) -> DataFrame:
        return occupations_view(self._read("nation"))


def star_tables(spark: SparkSession, sf_dir: str) -> StarTables:
    """The four rating tables over ``{sf_dir}/*.parquet``; no row is read yet."""
    return StarTables(spark, sf_dir)
