"""Compare a Spark result with DuckDB SQL: row count, schema, value hash.

Columns are compared by name (sorted), rows as an order-insensitive
multiset, doubles rounded to 9 decimals.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

STAR_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_SPARK_TO_DUCK = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR",
    T.TimestampNTZType: "TIMESTAMP",
    T.BooleanType: "BOOLEAN",
}


@dataclass
class Outcome:
    name: str
    spark_rows: int
    oracle_rows: int
    spark_schema: list[tuple[str, str]]
    oracle_schema: list[tuple[str, str]]
    spark_hash: str
    oracle_hash: str

    @property
    def ok(self) -> bool:
        return (
            self.spark_rows == self.oracle_rows
            and self.spark_schema == self.oracle_schema
            and self.spark_hash == self.oracle_hash
        )


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return repr(v)


def _digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for line in sorted("|".join(_norm(v) for v in r) for r in rows):
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()[:16]


def compare(name: str, df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> Outcome:
    names = sorted(df.columns)
    spark_schema = [
        (f.name, _SPARK_TO_DUCK.get(type(f.dataType), f.dataType.simpleString()))
        for f in sorted(df.schema.fields, key=lambda f: f.name)
    ]
    spark_rows = [tuple(r[c] for c in names) for r in df.collect()]
    rel = con.sql(sql)
    duck_names = list(rel.columns)
    duck_types = [str(t) for t in rel.types]
    oracle_schema = sorted(zip(duck_names, duck_types))
    order = [duck_names.index(c) for c in sorted(duck_names)]
    oracle_rows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    return Outcome(
        name,
        len(spark_rows),
        len(oracle_rows),
        spark_schema,
        oracle_schema,
        _digest(spark_rows),
        _digest(oracle_rows),
    )
