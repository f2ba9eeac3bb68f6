"""Sums of doubles that do not depend on the order of the rows.

A floating-point sum changes in its last bits with the order of addition, which
in Spark follows the partitioning and the order in which tasks end.  Here every
double is cut, without error, into at most three integers at fixed powers of
``2^32``.  Integers add exactly in any order and the state (one row for each key
and power that occurs) merges and takes withdrawals; the sum is rounded to a
double once, at the end, to the nearest (ties to even).  All of it is built-in
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LIMB = 32
_BASE = 1 << _LIMB
# Limbs that stand for rows without a finite value.
_NAN, _PLUS_INF, _MINUS_INF = 1000, 1001, 1002
_WIDE = "decimal(38,0)"


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2^exponent``; by two factors, as one may be too small or too large for a double."""
    half = F.floor(exponent / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def _with_parts(rows: DataFrame) -> DataFrame:
    """``_parts``: integers with ``_x = sum(part * 2^(32 limb))``, and a row that counts.

    Each step is a column of its own, so that none is computed twice.  Casting
    truncates, which leaves a rest of the same sign, below 1; scaling by a power
    of two, the cast and the difference are all exact.
    """
    x = F.col("_x")
    finite = F.when((x != 0) & ~F.isnan(x) & (F.abs(x) != float("inf")), x)
    special = F.when(F.isnan(x), F.lit(_NAN)).when(x == float("inf"), F.lit(_PLUS_INF)).when(x == float("-inf"), F.lit(_MINUS_INF))
    entry = lambda limb, part, count: F.struct(limb.cast("int").alias("limb"), part.cast("bigint").alias("part"), F.lit(count).alias("count"))
    return (
        rows.withColumn("_finite", finite)
        # The limb of the leading bit; one off at a power of two does no harm.
        .withColumn("_top", F.floor(F.log2(F.abs("_finite")) / _LIMB).cast("int"))
        .withColumn("_s0", _scaled(F.col("_finite"), -F.col("_top") * _LIMB))
        .withColumn("_p0", F.col("_s0").cast("bigint"))
        .withColumn("_s1", (F.col("_s0") - F.col("_p0")) * float(_BASE))
        .withColumn("_p1", F.col("_s1").cast("bigint"))
        .withColumn("_p2", ((F.col("_s1") - F.col("_p1")) * float(_BASE)).cast("bigint"))
        .withColumn(
            "_parts",
            F.array(
                entry(F.lit(None), F.lit(0), 1),
                *(entry(F.col("_top") - i, F.col(f"_p{i}"), 0) for i in range(3)),
                entry(special, F.when(special.isNotNull(), F.lit(1)), 0),
            ),
        )
    )


def exact_parts(rows: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """``keys..., limb, part, n``: the mergeable state of the sums of ``value``.

    The row with a null ``limb`` counts the rows of a key.  ``weight`` names a
    column of 1 (row added) or -1 (row withdrawn)."""
    w = F.lit(1) if weight is None else F.col(weight)
    # A key's rows are brought together first: combined where they happen to lie, nearly every row would be
    # a key of its own, several entries each, in the task's memory.  With the weight beside the keys the sums
    # still need a shuffle of their own, so adaptive execution may split a hot key over several tasks here.
    near = rows.select(*keys, w.cast("bigint").alias("_w"), F.col(value).cast("double").alias("_x"))
    cut = _with_parts(near.hint("rebalance", *keys, "_w"))
    # outer, as a plain generator brings a filter on the whole array below the steps
    entries = cut.select(*keys, "_w", F.inline_outer("_parts")).where("count = 1 or part <> 0")
    return entries.groupBy(*keys, "limb").agg(
        F.sum((F.col("part") * F.col("_w")).cast("decimal(19,0)")).cast(_WIDE).alias("part"), F.sum(F.col("count") * F.col("_w")).alias("n")
    )


def merged_parts(state: DataFrame, keys: list[str]) -> DataFrame:
    """States laid under one another (``unionByName``) as one state; what came to nothing goes."""
    both = state.groupBy(*keys, "limb").agg(F.sum("part").cast(_WIDE).alias("part"), F.sum("n").alias("n"))
    return both.where((F.col("part") != 0) | (F.col("n") != 0))


def _carried(digits: Column) -> Column:
    """``digits`` (from low to high) brought into ``[0, 2^32)``, and what is
    carried out of the last one (-1: the number is negative)."""
    base = F.lit(_BASE).cast("decimal(10,0)")
    start = F.struct(F.lit(0).cast(_WIDE).alias("carry"), F.array().cast(f"array<{_WIDE}>").alias("digits"))

    def step(acc: Column, part: Column) -> Column:
        # a struct of two fields that both need the sum: taken once, by a transform over it
        whole = F.array((part + acc["carry"]).cast(_WIDE))
        cut = F.transform(whole, lambda w: F.struct(w.alias("w"), F.pmod(w, base).cast(_WIDE).alias("digit")))
        return F.element_at(
            F.transform(
                cut,
                lambda c: F.struct(
                    F.floor((c["w"] - c["digit"]) / base).cast(_WIDE).alias("carry"),
                    F.concat(acc["digits"], F.array(c["digit"])).alias("digits"),
                ),
            ),
            1,
        )

    return F.aggregate(digits, start, step)


def _with_rounded(rows: DataFrame, total: str) -> DataFrame:
    """``total``: the double nearest to ``sum(part * 2^(32 limb))`` over ``_limbs`` (in order of limb).

    Each step is a column of its own, so that none is computed twice."""
    zero = F.lit(0).cast(_WIDE)
    # Room above for carries: a part is below 2^127, four limbs.
    every = F.sequence(F.col("_low"), F.get("_limbs", F.size("_limbs") - 1)["limb"] + 5)
    held = F.map_from_entries("_limbs")
    lead, digits = F.col("_lead"), F.col("_digits")

    def digit(back: int) -> Column:
        return F.when(lead >= back, F.get(digits, lead - back)).otherwise(zero)

    # The leading digit and the two below hold 65 bits at least; the rest only breaks ties.
    base = F.lit(_BASE).cast("decimal(10,0)")
    whole = ((digit(0) * base + digit(1)).cast("decimal(28,0)") * base).cast(_WIDE) + digit(2)
    sticky = F.when(F.exists(F.slice(digits, 1, F.greatest(lead - 2, F.lit(0))), lambda d: d > 0), 1).otherwise(0)
    near = (whole.cast("decimal(37,0)") * 2 + sticky).cast(_WIDE).cast("double")
    return (
        rows.withColumn("_low", F.get("_limbs", F.lit(0))["limb"])
        .withColumn("_held", held)
        .withColumn("_row", F.transform(every, lambda i: F.coalesce(F.try_element_at("_held", i), zero)))
        .withColumn("_once", _carried(F.col("_row")))
        .withColumn("_minus_sign", F.col("_once.carry") < 0)
        .withColumn(
            "_digits",
            F.when(F.col("_minus_sign"), _carried(F.transform("_row", lambda p: (-p).cast(_WIDE)))["digits"]).otherwise(F.col("_once.digits")),
        )
        .withColumn("_lead", F.array_max(F.transform("_digits", lambda d, i: F.when(d > 0, i))))
        .withColumn("_near", _scaled(near, (F.col("_low") + lead - 2) * _LIMB - 1))
        .withColumn(total, F.when(lead.isNull(), F.lit(0.0)).when(F.col("_minus_sign"), -F.col("_near")).otherwise(F.col("_near")))
    )


def exact_sums(state: DataFrame, keys: list[str], total: str = "total") -> DataFrame:
    """``keys..., total, n`` of a state: each sum rounded once.

    NaN, and infinities of both signs, give NaN; a key whose rows are all withdrawn is gone."""
    one = F.when(F.col("limb") < _NAN, F.struct("limb", "part"))
    held = lambda limb: F.coalesce(F.max(F.when(F.col("limb") == limb, F.col("part"))), F.lit(0)) > 0
    rows = state.groupBy(*keys).agg(
        F.sort_array(F.collect_list(one)).alias("_limbs"), F.sum("n").alias("n"),
        held(_NAN).alias("_nan"), held(_PLUS_INF).alias("_plus"), held(_MINUS_INF).alias("_minus"),
    )
    value = (
        F.when(F.col("_nan") | (F.col("_plus") & F.col("_minus")), F.lit(float("nan")))
        .when(F.col("_plus"), F.lit(float("inf"))).when(F.col("_minus"), F.lit(float("-inf")))
        .otherwise(F.coalesce("_total", F.lit(0.0)))
    )
    return _with_rounded(rows.where(F.col("n") != 0), "_total").select(*keys, value.alias(total), "n")


def exact_rating_stats(ratings: DataFrame, *keys: str) -> DataFrame:
    """``rating_stats`` with totals that are the same bits however the rows are partitioned."""
    names = list(keys or ("movie_id",))
    sums = exact_sums(exact_parts(ratings, names, "rating"), names)
    return sums.withColumn("avg_rating", F.col("total") / F.col("n"))
