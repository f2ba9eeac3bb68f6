"""``::`` records decoded once into two results: good rows, and bad lines with the reason.

``parse_records`` either stops at a malformed record or drops it.  Here one pass
decodes every line, writes good rows and bad lines side by side and counts both
as it writes, by reason, so nothing is parsed twice and no line disappears.  The
good rows are exactly those of ``mode='drop'``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelscope.sources.dat import FIELD_SEPARATOR, typed_field
from reelscope.sources.layout import default_location

BLANK = "blank line"


def reasons(schema: T.StructType) -> list[str]:
    """Every reason a line can be bad for, in the order in which they are looked for."""
    needed = [f for f in schema.fields if not f.nullable]
    typed = [f for f in needed if not isinstance(f.dataType, T.StringType)]
    return [BLANK, *(f"no {f.name}" for f in needed), *(f"{f.name} is not {f.dataType.simpleString()}" for f in typed)]


def with_reason(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``value, record, reason``: ``record`` a struct of ``schema``, ``reason`` null where it is good.

    A line has the first reason of ``reasons(schema)`` that holds: a field that
    is not there (an empty one counts as there), then one that is not of its type.
    """
    split = lines.select("value", F.split(F.col("value"), FIELD_SEPARATOR, -1).alias("_parts"))
    fields = [typed_field(F.get(F.col("_parts"), i), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    rows = split.select(F.inline(F.array(F.struct("value", "_parts", F.struct(*fields).alias("record")))))
    needed = [(i, f) for i, f in enumerate(schema.fields) if not f.nullable]
    found: Column = F.when(F.length(F.trim("value")) == 0, F.lit(BLANK))
    for i, f in needed:
        found = found.when(F.get(F.col("_parts"), i).isNull(), F.lit(f"no {f.name}"))
    for _, f in needed:
        if not isinstance(f.dataType, T.StringType):
            found = found.when(F.col(f"record.{f.name}").isNull(), F.lit(f"{f.name} is not {f.dataType.simpleString()}"))
    return rows.select("value", "record", found.otherwise(F.lit(None)).alias("reason"))


@dataclass(frozen=True)
class Decoded:
    """``good`` (rows of the schema), ``bad`` (``value, reason``), ``n_good`` and ``n_bad`` by reason."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: dict[str, int]


def decode_records(lines: DataFrame, schema: T.StructType, location: str | None = None) -> Decoded:
    """Decode ``lines`` (``value``) once, below ``location`` (default: a new shared folder)."""
    spark = lines.sparkSession
    path = location or default_location(spark)
    rows = with_reason(lines, schema)
    seen = Observation()
    counts = [F.count(F.when(F.col("reason") == r, 1)).alias(f"bad{i}") for i, r in enumerate(reasons(schema))]
    rows = rows.observe(seen, F.count(F.when(F.col("reason").isNull(), 1)).alias("good"), *counts)
    good = F.col("reason").isNull()
    flat = rows.select(
        *(F.when(good, F.col(f"record.{f.name}")).alias(f"r_{f.name}") for f in schema.fields),
        F.when(~good, F.col("value")).alias("value"), "reason", good.cast("int").alias("good"),
    )
    flat.write.mode("overwrite").partitionBy("good").parquet(path)
    written = spark.read.schema(flat.schema).parquet(path)  # `good` prunes to one of the two folders
    return Decoded(
        written.where("good = 1").select(*(F.col(f"r_{f.name}").alias(f.name) for f in schema.fields)),
        written.where("good = 0").select("value", "reason"),
        seen.get["good"],
        {r: n for i, r in enumerate(reasons(schema)) if (n := seen.get[f"bad{i}"])},
    )
