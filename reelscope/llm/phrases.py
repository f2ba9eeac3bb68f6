"""Phrase collocations: word sequences that occur together more than their parts suggest.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and ``\\x0A-\\x0D`` and
pieces into words at spaces and tabs.  Everything is counted by language.  A
candidate is a phrase of 2 to ``MAX_WORDS`` words with ``a >= MIN_COUNT``
occurrences inside pieces, overlapping ones included.  Cut after its first k
words it has ``floor(2000000 a / (l + r))``, l and r the occurrences of the two
parts; its score is that of the lowest-scoring cut (the smallest k of equals).
A candidate goes when a longer candidate that contains it has
``INSIDE_PERCENT`` of its occurrences or more.

Method: prefix-free parsing.

1. A window of ``WINDOW`` words triggers a cut where its hash is a multiple of
   ``EVERY``.  A chunk runs from one trigger to the end of the next trigger's
   window, so neighbours overlap by the window, and chunks start and end with
   triggers wherever the same text occurs.  A piece starts a chunk, and so does
   every ``RUN``-th word without a trigger, which bounds chunks.
2. Equal chunks of a language become one entry of a dictionary with its parse
   frequency.  From here on the texts are not read again: copies cost nothing.
3. N-grams are counted inside distinct chunks, weighted by parse frequency.
   One that starts in the overlap belongs to the next chunk, so that each
   occurrence is counted once; the window, one word short of the longest phrase,
   holds the rest of any that start before it.
4. Lengths are counted one after the other.  An n-gram is only counted where
   both its (n-1)-grams are frequent; a bounded bitmap of these, at most 16 MB
   however many they are, rules out most others before they travel.  A false
   positive of the bitmap is counted and dropped, so counts never depend on it;
   at very many frequent phrases it rules out less.
5. Parts and containing phrases of the candidates, which are few, are joined.

Phrases are compared as text, not by hash.  Products that may pass 64 bits are
decimals.

Defined cases: a null or blank text has no words; a null language is ``und``
and joins that language; repeated rows count each.  A word is never cut, however
long; a text of any length is read whole.  Ids and other columns are not read,
whatever their names.  Ties of score are ordered by a (descending), then by
phrase in UTF-8 order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.ngram_join import _bloom, _in_bloom
from reelscope.llm.staging import Staging, bounded_batches
from reelscope.llm.textgrams import Words, mix, slices, span_hashes, utf8

MAX_WORDS = 4
MIN_COUNT = 30
INSIDE_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"
# Words of a trigger's window: one fewer than the longest phrase has.
WINDOW = MAX_WORDS - 1
EVERY = 16
RUN = 512

_INSIDE, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans of ``data``, which may overlap, as strings."""
    size = ends - starts
    offsets = np.r_[0, np.cumsum(size)]
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    flat = pa.py_buffer(np.ascontiguousarray(data[places]))
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), flat])


def _pieces(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words of the texts' pieces (each piece as a text of its own), and each word's row."""
    data, rows = utf8(texts)
    data = _LOWER[data]
    kind = _KIND[data]
    inner = np.r_[kind == _INSIDE, False]
    fresh = np.zeros(len(inner), dtype=bool)
    fresh[rows] = True
    before = np.r_[False, inner[:-1]]
    starts = np.flatnonzero(inner & (fresh | ~before))
    ends = np.flatnonzero(before & (fresh | ~inner))
    row = np.searchsorted(rows, starts, side="right") - 1
    breaks = np.cumsum(kind == _BREAK)
    piece = breaks[starts] if len(starts) else starts
    new = np.r_[True, (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])] if len(starts) else np.zeros(0, dtype=bool)
    first = np.r_[np.flatnonzero(new), len(starts)]
    return Words(data, rows, starts, ends, first, span_hashes(data, starts, ends)), row


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, chunk (its words joined by one space), number of its words that are not of the next chunk."""
    for batch in slices(batches, "text"):
        w, row = _pieces(batch.column("text"))
        n = len(w.starts)
        at, window = w.gram(WINDOW)
        cut = np.zeros(n + 1, dtype=bool)
        cut[w.first[:-1]] = True
        cut[at[window % np.uint64(EVERY) == 0]] = True
        start = np.flatnonzero(cut)
        more = (np.diff(np.r_[start, n]) - 1) // RUN
        cut[np.repeat(start, more) + RUN * (1 + np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more))] = True
        start = np.flatnonzero(cut)
        after = np.r_[start[1:], n][: len(start)]
        room = np.repeat(w.first[1:], w.counts)  # one past the last word of the piece
        end = np.minimum(after + WINDOW, room[start])

        size = w.ends - w.starts + 1  # with a space behind
        offsets = np.r_[0, np.cumsum(size)]
        letter = np.ones(offsets[-1], dtype=bool)
        letter[offsets[1:] - 1] = False
        flat = np.full(offsets[-1], 0x20, dtype=np.uint8)
        flat[letter] = w.data[_KIND[w.data] == _INSIDE]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang").take(pa.array(row[start])),
                _strings(flat, offsets[start], offsets[end] - 1),
                pa.array(after - start, pa.int64()),
            ],
            names=["lang", "chunk", "own"],
        )


def _entries(batch: pa.RecordBatch, column: str) -> tuple[Words, np.ndarray, pa.DictionaryArray]:
    """Words of entries whose words are joined by one space, each one's entry, the entries'
    languages; the words' hashes depend on the language."""
    data, rows = utf8(batch.column(column))
    edge = np.r_[data == 0x20, False]
    start = np.zeros(len(data) + 1, dtype=bool)
    start[1:][edge[:-1]] = True
    start[rows] = True
    starts = np.flatnonzero(start[:-1])
    end = edge.copy()
    end[rows[1:]] = True
    ends = np.flatnonzero(end)
    first = np.searchsorted(starts, rows)
    entry = np.repeat(np.arange(len(rows) - 1), np.diff(first))
    lang = batch.column("lang").dictionary_encode()
    names, bounds = utf8(pc.binary_join_element_wise(lang.dictionary, " ", ""))  # a space behind, as a span has a byte at least
    of_lang = span_hashes(names, bounds[:-1], bounds[1:])
    hashes = mix(span_hashes(data, starts, ends) + of_lang[lang.indices.to_numpy()][entry])
    return Words(data, rows, starts, ends, first, hashes), entry, lang


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, phrase (one word), its weighted occurrences in a slice of the dictionary."""
    for batch in slices(batches, "chunk"):
        w, entry, lang = _entries(batch, "chunk")
        place = np.arange(len(w.starts)) - w.first[entry]
        keep = place < batch.column("own").to_numpy()[entry]
        entry = entry[keep]
        phrase = _strings(w.data, w.starts[keep], w.ends[keep]).dictionary_encode()
        kinds = max(1, len(phrase.dictionary))
        key = lang.indices.to_numpy().astype(np.int64)[entry] * kinds + phrase.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        total = np.add.reduceat(batch.column("f").to_numpy()[entry][order], head) if len(key) else head
        key = key[head]
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(key // kinds)), phrase.dictionary.take(pa.array(key % kinds)), pa.array(total)],
            names=["lang", "phrase", "f"],
        )


def _grams(n: int, frequent) -> Callable:
    """lang, phrase of n words, weight: each n-gram of a slice of the dictionary whose two
    (n-1)-grams the bitmap ``frequent`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "chunk"):
            w, entry, _ = _entries(batch, "chunk")
            at, shorter = w.gram(n - 1)
            holds = np.zeros(len(w.starts) + 1, dtype=bool)
            holds[at[_in_bloom(shorter, frequent.value)]] = True
            room = w.first[entry + 1]
            i = np.flatnonzero(holds[:-1] & holds[1:])
            i = i[i + n <= room[i]]
            e = entry[i]
            inside = i - w.first[e] < batch.column("own").to_numpy()[e]
            i, e = i[inside], pa.array(e[inside])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(e), _strings(w.data, w.starts[i], w.ends[i + n - 1]), batch.column("f").take(e)],
                names=["lang", "phrase", "f"],
            )

    return run


def _keys(n: int) -> Callable:
    """The hash under which ``_grams`` looks up each phrase of n words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "phrase"):
            w, _, _ = _entries(batch, "phrase")
            yield pa.RecordBatch.from_arrays([pa.array(w.gram(n)[1].view(np.int64))], names=["token"])

    return run


def parse_dictionary(docs: DataFrame) -> DataFrame:
    """``lang, chunk, own, f``: the distinct chunks of all texts and how often each is parsed.

    ``own`` is the number of its words that do not start the next chunk.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang")
    rows = docs.select(lang, F.col("text").cast("string").alias("text"))
    chunks = bounded_batches(rows).mapInArrow(_chunks, "lang string, chunk string, own bigint")
    return chunks.groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("f"))


def _count_phrases(chunks: DataFrame, stage: Staging, min_count: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, f`` of all frequent phrases of up to ``MAX_WORDS`` words, and ``lang, n``."""
    spark = chunks.sparkSession
    schema = "lang string, phrase string, f bigint"
    total = F.sum("f").alias("f")
    every = stage.write(chunks.mapInArrow(_words, schema).groupBy("lang", "phrase").agg(total), "words")
    found = every.where(F.col("f") >= min_count)
    tables = [found.withColumn("k", F.lit(1))]
    for n in range(2, MAX_WORDS + 1):
        frequent = spark.sparkContext.broadcast(_bloom(found.select("lang", "phrase").mapInArrow(_keys(n - 1), "token bigint")))
        grams = chunks.mapInArrow(_grams(n, frequent), schema).groupBy("lang", "phrase").agg(total)
        found = stage.write(grams.where(F.col("f") >= min_count), f"grams{n}")
        frequent.unpersist()
        tables.append(found.withColumn("k", F.lit(n)))
    counts = tables[0]
    for t in tables[1:]:
        counts = counts.unionByName(t)
    return counts, every.groupBy("lang").agg(F.sum("f").alias("n"))


def _span(start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of ``docs`` (``lang``, ``text``)."""
    stage = Staging(docs.sparkSession, "phrases")
    chunks = bounded_batches(stage.write(parse_dictionary(docs), "chunks"))
    counts, sizes = _count_phrases(chunks, stage, min_count)
    phrases = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    # Every cut of every candidate, with the counts of its parts: both are frequent, as the candidate is.
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _span(1, F.col("cut")).alias("head"), _span(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail")
    )
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    score = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * _exact("a"), _exact("l") + _exact("r"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    # The most frequent longer candidate around each candidate.
    shorter = phrases.where("k > 2").select("lang", "words", "k", "a", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    shorter = shorter.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    around = shorter.select("lang", _span(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    lone = best.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact("longer") < inside_percent * _exact("a"))
    )

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = lone.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score")
    )
