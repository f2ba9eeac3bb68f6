"""Source divergence audit: how far apart the sources of a language use its words.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  A
language keeps the terms that occur in at least ``MIN_DOCS`` of its documents.
Every (lang, source) group, and every language, gives each kept term the scaled
smoothed probability ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``; a term's
divergence between two is ``floor((p - q)^2 / (p + q))``.

Method: count-level bitmaps.

1. Terms are counted by group, with the documents that hold them; kept terms
   get ids in order of their count in the language.
2. For each (group, count) the ids of the terms that the group has exactly so
   often are stored as bitsets of 64 ids.  A term of at least ``OWN_BLOCK``
   occurrences a source has a block of its own, since few others share its
   count anywhere.
3. For two groups of a language, AND and popcount of the bitsets of a block give
   the number of terms with count c in one and d in the other.  All these terms
   have the same divergence, so each joint cell is multiplied by it once.
4. Cells with a zero on either side are never formed.  They follow by
   complement: the sum over all terms is that over the joint cells, each less
   what it would be with zeros, plus each group's own levels against zero, plus
   ``V`` times zero against zero.

Texts are counted in numpy over bounded slices, everything else is joins and
aggregates of written tables; the joins are on (lang, block), so a hot language
or source spreads over its blocks.  Nothing but the result's pairs of sources
grows with their square.  All arithmetic is exact: products that may pass 64
bits are decimals.

Defined cases: a null text, lang or source is ''.  A group without terms, or
without kept terms, takes part with counts of zero; in a language that keeps no
term every pair has the value 0.  Repeated rows are documents of their own, ids
are not read, and neither are other columns, whatever their names.  Ties are
ordered by item, in UTF-8 order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging, bounded_batches
from reelscope.llm.textgrams import slices, utf8

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# Mean occurrences a source from which a term has a block of its own.
OWN_BLOCK = 4

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
# A byte as part of a term (0 where it is none): letters lower-cased, all bytes of non-ASCII characters.
_TERM_BYTE = np.zeros(256, dtype=np.uint8)
_TERM_BYTE[97:123] = _TERM_BYTE[65:91] = np.arange(97, 123)
_TERM_BYTE[128:] = np.arange(128, 256)


def _terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and each one's row."""
    data, rows = utf8(column)
    letters = _TERM_BYTE[data]
    inner = np.r_[letters > 0, False]
    fresh = np.zeros(len(inner), dtype=bool)
    fresh[rows] = True
    before = np.r_[False, inner[:-1]]
    starts = np.flatnonzero(inner & (fresh | ~before))
    ends = np.flatnonzero(before & (fresh | ~inner))
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    flat = np.ascontiguousarray(letters[inner[:-1]])
    terms = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    return terms, np.searchsorted(rows, starts, side="right") - 1


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``keys``, sorted, and how often each occurs."""
    return np.unique(keys, return_counts=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group of a slice; a row '' names a group that occurs."""
    for batch in slices(batches, "text"):
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        terms, row = _terms(batch.column("text"))
        terms = terms.dictionary_encode()
        code, kinds = terms.indices.to_numpy().astype(np.int64), max(1, len(terms.dictionary))
        keys, n = _runs(group[row] * kinds + code)
        held = np.unique(row * kinds + code)  # a document's terms once
        _, docs = _runs(group[held // kinds] * kinds + held % kinds)
        present = np.unique(group)
        where = pa.array(np.r_[present, keys // kinds] // len(source.dictionary))
        which = pa.array(np.r_[present, keys // kinds] % len(source.dictionary))
        words = pa.concat_arrays([pa.array([""] * len(present), pa.string()), terms.dictionary.take(pa.array(keys % kinds))])
        none = np.zeros(len(present), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(where), source.dictionary.take(which), words, pa.array(np.r_[none, n]), pa.array(np.r_[none, docs])],
            names=["lang", "source", "term", "n", "docs"],
        )


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def _probability(n: Column | str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE (n + 2) / (total + 2 kept))``; 0 where the language keeps no term."""
    share = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (_exact(n) + 2), _exact(total) + 2 * _exact(kept))
    return F.when(F.col(kept) > 0, share + 1).otherwise(F.lit(0)).cast("bigint")


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"if({p} + {q} > 0, ({p} - {q}) * ({p} - {q}) div nullif({p} + {q}, 0), 0)")


def _ranked(rows: DataFrame, part: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    out = rows.withColumn("rank", F.row_number().over(order))
    out = out if most is None else out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` over all of ``docs`` (``lang``, ``source``, ``text``).

    Part ``pair``: every other source of the language, with the divergence
    summed over all kept terms.  Part ``term``: the ``top_terms`` terms that a
    source uses more than its language does, with their divergence from it.
    """
    stage = Staging(docs.sparkSession, "divergence")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = stage.write(
        bounded_batches(rows).mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")
        ),
        "counts",
    )
    groups = counts.where("term = ''").select("lang", "source")
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))

    # Kept terms, numbered in order of their counts: ids are unique, not gapless.
    kept = (
        counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs).join(sources, "lang")
        .withColumn("own", F.col("total") >= OWN_BLOCK * F.col("n_sources"))
        .repartitionByRange("lang", F.desc("total"), "term").sortWithinPartitions("lang", F.desc("total"), "term")
        .select("lang", "term", "total", "own", F.monotonically_increasing_id().alias("id"))
    )
    kept = stage.write(
        kept.select("lang", "term", "total", F.expr("if(own, -1 - id, id >> 6)").alias("block"), F.expr("if(own, 0, id & 63)").alias("bit")),
        "kept",
    )
    held = stage.write(counts.where("n > 0").drop("docs").join(kept, ["lang", "term"]), "held")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    langs = sources.select("lang").join(langs, "lang", "left").na.fill(0)
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = stage.write(
        groups.join(sizes, ["lang", "source"], "left").na.fill(0, ["group_n"]).join(langs, "lang")
        .withColumn("p0", _probability(F.lit(0), "group_n", "v")),
        "groups",
    )

    # Count-level bitmaps, with the probability that belongs to the count.
    levels = held.groupBy("lang", "source", "block", "n").agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("bits"))
    levels = stage.write(
        levels.join(groups, ["lang", "source"])
        .select("lang", "block", "source", "bits", _probability("n", "group_n", "v").alias("p"), "p0"),
        "levels",
    )
    one = levels.select("lang", "block", F.col("source").alias("a"), F.col("bits").alias("bits_a"), F.col("p").alias("pa"), F.col("p0").alias("a0"))
    two = levels.select("lang", "block", F.col("source").alias("b"), F.col("bits").alias("bits_b"), F.col("p").alias("pb"), F.col("p0").alias("b0"))
    cells = one.join(two, ["lang", "block"]).where("a < b").withColumn("cell", F.expr("bit_count(bits_a & bits_b)")).where("cell > 0")
    over = _divergence("pa", "pb") - _divergence("pa", "b0") - _divergence("a0", "pb") + _divergence("a0", "b0")
    joint = stage.write(cells.groupBy("lang", "a", "b").agg(F.sum(F.col("cell") * over).alias("joint")), "joint")

    # Every level of a group against the zeros of the others.
    pairs = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "v").join(
        groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0")), "lang"
    ).where("a <> b")
    counted = levels.groupBy("lang", F.col("source").alias("a"), F.col("p").alias("pa")).agg(F.sum(F.bit_count("bits")).alias("size"))
    own = pairs.join(counted, ["lang", "a"]).groupBy("lang", "a", "b").agg(
        F.sum(F.col("size") * (_divergence("pa", "b0") - _divergence("a0", "b0"))).alias("own")
    )
    mirror = joint.unionByName(joint.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "joint"))
    value = F.col("v") * _divergence("a0", "b0") + sum((F.coalesce(c, F.lit(0)) for c in ("joint", "own_a", "own_b")), F.lit(0))
    own = stage.write(own, "own")
    keys = ["lang", "a", "b"]
    whole = (
        pairs.join(mirror, keys, "left")
        .join(own.withColumnRenamed("own", "own_a"), keys, "left")
        .join(own.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("own").alias("own_b")), keys, "left")
        .select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.cast("bigint").alias("value"))
    )

    terms = (
        held.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), _probability("n", "group_n", "v").alias("p"), _probability("total", "lang_n", "v").alias("q"))
        .where("p > q")
        .select("lang", "source", "item", _divergence("p", "q").cast("bigint").alias("value"))
    )
    return _ranked(whole, "pair", None).unionByName(_ranked(terms, "term", top_terms))
