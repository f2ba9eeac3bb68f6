"""Line dedup: lines that several documents share stay in one document only.

A line's key is the line without ``\\x20\\x09-\\x0D`` at either end and with A-Z
lower-cased.  A key of at least ``MIN_CHARS`` code points found in at least
``MIN_DOCS`` documents loses all its lines except those in the largest
``doc_id`` that holds it.

Method: hashes are range-partitioned and sorted inside their partition by hash,
document (largest first) and position, so that the first occurrences stream by
first and every later one meets its key's count.  What comes back is no text
but a compressed keep bitmap a document:

1. Lines are hashed where they are read and written as (document, position,
   128-bit hash), in a tenth or less of the space of the text.
2. A mergeable frequent-item summary names the ``HOT_KEYS`` most common hashes.
   They are counted apart, by partial aggregation, and their few counts are
   broadcast to their lines, so that a line of a third of all documents meets
   in no task.  What the summary leaves out is bounded: a key below it holds at
   most about one in ``HOT_TRACKED`` of all lines.
3. All other hashes are range-partitioned; the window over the sorted stream
   needs no further shuffle.
4. The positions dropped become 64-bit words of a bitmap, joined to the text by
   document.  Words in which nothing is dropped are not stored.

Everything is built-in functions; no Python touches a row.  No key, position or
bitmap of all documents reaches the driver, only the hashes of step 2.

Defined cases: a null or empty text is one empty line, which has no key.  Rows
that repeat a ``doc_id`` are one document: they count once for a key, and each
row keeps or loses its own lines.  Rows without ``doc_id`` are together one
document that is smaller than any other.  A key repeated inside the document
that keeps it stays repeated there.  Other columns are not read, whatever their
names.  Keys are compared by 128 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging

MIN_CHARS = 20
MIN_DOCS = 3
# Keys counted apart from the sorted stream, and those the summary tracks to find them.
HOT_KEYS = 1_000
HOT_TRACKED = 10_000

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DOC = ("doc_id", "t1", "t2")


def _documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, text without nulls, and the hashes that tell rows of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select("*", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hashed(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row for each line long enough to have a key."""
    lines = rows.select(*_DOC, F.posexplode(_lines(F.translate("text", _UPPER, _UPPER.lower()))).alias("pos", "line"))
    keys = lines.select(*_DOC, "pos", F.btrim("line", F.lit(_BLANKS)).alias("key"))
    return keys.where(F.length("key") >= min_chars).select(
        *_DOC, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def _hot(lines: DataFrame) -> list[int]:
    """The most common values of ``h1``, at most ``HOT_KEYS`` of them."""
    found = lines.agg(F.expr(f"approx_top_k(h1, {HOT_KEYS}, {HOT_TRACKED})").alias("top")).first().top
    return [x.item for x in found or []]


def _dropped(lines: DataFrame, min_docs: int) -> DataFrame:
    """``doc_id, t1, t2, pos`` of the lines that go."""
    spark = lines.sparkSession
    hot = F.broadcast(spark.createDataFrame([(h,) for h in _hot(lines)], "h1 bigint"))

    common = lines.join(hot, "h1", "left_semi")
    counts = common.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last")
    )
    keys = F.broadcast(counts.where(F.col("n_docs") >= min_docs))  # HOT_KEYS rows at most
    first = common.join(keys, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))

    key = Window.partitionBy("h1", "h2")
    stream = lines.join(hot, "h1", "left_anti").repartitionByRange("h1", "h2")
    ranked = stream.withColumn("place", F.dense_rank().over(key.orderBy(F.desc_nulls_last("doc_id"))))
    counted = ranked.withColumn("n_docs", F.max("place").over(key))
    rest = counted.where((F.col("place") > 1) & (F.col("n_docs") >= min_docs))
    return first.select(*_DOC, "pos").unionByName(rest.select(*_DOC, "pos"))


def _bitmaps(dropped: DataFrame) -> DataFrame:
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos") % 64))
    words = dropped.groupBy(*_DOC, F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(bits.alias("gone"))
    return words.groupBy(*_DOC).agg(
        F.sum(F.bit_count("gone")).cast("bigint").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, t1, t2, n_dropped, keep`` for every document that loses a line.

    ``keep`` lists ``(word, bits)`` in order of ``word``: bit ``i`` of ``bits``
    tells whether line ``64 * word + i`` stays.  Words that are not listed stay
    whole, and so do documents without a row.  ``t1`` and ``t2`` are 64-bit
    hashes of the text, which tell apart rows of one ``doc_id``.
    """
    stage = Staging(docs.sparkSession, "line-dedup")
    lines = stage.write(_hashed(_documents(docs), min_chars), "lines")
    return stage.write(_bitmaps(_dropped(lines, min_docs)), "bitmaps")


def kept_lines(lines: Column, keep: Column) -> Column:
    """The elements of ``lines`` that the bitmap ``keep`` lets stay, in time linear in both."""
    # from: the line after the word listed before
    spans = F.transform(
        keep,
        lambda x, i: F.struct(x["word"].alias("word"), x["bits"].alias("bits"),
                              F.when(i == 0, F.lit(0)).otherwise((F.get(keep, i - 1)["word"] + 1) * 64).alias("from")),
    )

    def part(x: Column) -> Column:
        own = F.slice(lines, x["word"] * 64 + 1, F.lit(64))
        stay = F.filter(own, lambda _, i: F.getbit(x["bits"], i) == 1)
        return F.concat(F.slice(lines, x["from"] + 1, x["word"] * 64 - x["from"]), stay)

    after = (F.element_at(keep, -1)["word"] + 1) * 64
    rest = F.slice(lines, after + 1, F.greatest(F.size(lines) - after, F.lit(0)))
    return F.concat(F.flatten(F.transform(spans, part)), rest)


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``, one row for each row of ``docs``; ``text`` is what is left."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "n_dropped", "keep"
    )
    rows = _documents(docs).withColumn("n_lines", F.size(_lines(F.col("text"))).cast("bigint"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    left = F.array_join(kept_lines(_lines(F.col("text")), F.col("keep")), "\n")
    return rows.join(bitmaps, same, "left").select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(left).alias("text"),
        "n_lines",
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
    )
