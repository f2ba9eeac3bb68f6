"""Typed schemas of the four input tables and the two sink tables.

Non-nullable fields are the ones every analysis reads; a record missing one
of them is malformed.  ``rated_at`` is nullable because no analysis reads it.
"""

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("movie_id", T.LongType(), False),
        T.StructField("rating", T.DoubleType(), False),
        T.StructField("rated_at", T.TimestampType(), True),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("gender", T.StringType(), False),
        T.StructField("age", T.IntegerType(), False),
        T.StructField("occupation_id", T.IntegerType(), False),
        T.StructField("zip", T.StringType(), False),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movie_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("genres", T.StringType(), False),
    ]
)

OCCUPATIONS = T.StructType(
    [
        T.StructField("occupation_id", T.IntegerType(), False),
        T.StructField("occupation_name", T.StringType(), False),
    ]
)

# Sink layouts: occupation x genre counts, and a one-column name list.
RESULT_SINK = T.StructType(
    [
        T.StructField("occ", T.StringType(), False),
        T.StructField("mtype", T.StringType(), False),
        T.StructField("nums", T.LongType(), False),
    ]
)

PERSON_SINK = T.StructType([T.StructField("name", T.StringType(), False)])

# File name of each table inside a ``.dat`` folder.
DAT_FILES = {
    "ratings": ("ratings.dat", RATINGS),
    "users": ("users.dat", USERS),
    "movies": ("movies.dat", MOVIES),
    "occupations": ("occupations.dat", OCCUPATIONS),
}
