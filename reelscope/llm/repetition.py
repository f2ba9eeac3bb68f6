"""Quality rules: how much of a text lies in repeated n-grams and lines.

Method: rolling hashes of every n-gram length from 5 to 10 words over flat
word-hash arrays; the characters of the words covered by n-grams that occur
twice or more in their own text are set against all word characters, and so
are the characters of lines equal to an earlier line.  Longer n-grams are
looked up only at the positions where a 5-gram repeats, since a repeated
longer n-gram starts with a repeated 5-gram.

One pass over the rows, no shuffle; a task holds one bounded slice of texts.

Defined cases: a null, empty or blank text has no words, so all counts are 0
and it fails the base rule; repeated rows give repeated result rows; other
columns of the input, whatever their names, are not read.  Two different
n-grams of one text are taken as equal only on a 64-bit hash collision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reelscope.llm.staging import bounded_batches
from reelscope.llm.textgrams import Words, slices, utf8, words

MIN_WORDS = 10
BASE_REPEAT_PERCENT = 20
# Most characters, in percent of all word characters, inside n-grams that repeat
# (their first occurrence included, so one repeated tenth of a text is 20 %).
GRAM_PERCENT = {5: 20, 6: 20, 7: 20, 8: 20, 9: 20, 10: 20}
# Most characters, in percent of all characters of lines, in lines seen before.
LINE_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, line_chars bigint, dup_line_chars bigint, "
    + ", ".join(f"dup_chars_{n} bigint" for n in GRAM_PERCENT)
)

_IS_SYMBOL = np.zeros(256, dtype=np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1
_BLANK = " \t\n\v\f\r"


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    return total[bounds[1:]] - total[bounds[:-1]]


def _covered(w: Words, row: np.ndarray, n: int, at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of n-grams that occur twice or more in their text, and a mask of the words they cover."""
    at, h = w.gram(n, at)
    order = np.lexsort((h, row[at]))
    h, r = h[order], row[at[order]]
    same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = at[twice]
    edge = np.zeros(len(row) + 1, dtype=np.int64)
    edge[at] += 1
    np.subtract.at(edge, at + n, 1)
    return at, np.cumsum(edge)[:-1] > 0


def _lines(text: str | None) -> tuple[int, int, int]:
    """Lines equal to an earlier one, their characters, and the characters of all lines with a word."""
    seen: set[str] = set()
    repeats = repeated = total = 0
    for line in (text or "").split("\n"):
        if line.strip(_BLANK):
            total += len(line)
            if line in seen:
                repeats += 1
                repeated += len(line)
            else:
                seen.add(line)
    return repeats, repeated, total


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        column = batch.column("text")
        w = words(column)
        row = w.row_of_word()
        chars = np.r_[0, np.cumsum((w.data & 0xC0) != 0x80)]
        length = chars[w.ends] - chars[w.starts]
        word_chars = _per_row(length, w.first)
        data, rows = utf8(column)
        symbols = _per_row(_IS_SYMBOL[data], rows)
        lines = np.array([_lines(t) for t in column.to_pylist()], dtype=np.int64).reshape(-1, 3)

        at, mask = _covered(w, row, 5, None)
        repeat_words = _per_row(mask.astype(np.int64), w.first)
        dup = {5: _per_row(length * mask, w.first)}
        for n in list(GRAM_PERCENT)[1:]:
            at, mask = _covered(w, row, n, at)
            dup[n] = _per_row(length * mask, w.first)

        failed = (w.counts < MIN_WORDS) | (100 * repeat_words > BASE_REPEAT_PERCENT * w.counts)
        kept = ~failed & (100 * lines[:, 1] <= LINE_PERCENT * lines[:, 2])
        for n, percent in GRAM_PERCENT.items():
            kept &= 100 * dup[n] <= percent * word_chars
        arrays = [
            batch.column("doc_id"),
            *(pa.array(x, pa.int64()) for x in (w.counts, word_chars, symbols, lines[:, 0], repeat_words)),
            pa.array(failed),
            pa.array(kept),
            *(pa.array(x, pa.int64()) for x in (lines[:, 2], lines[:, 1], *dup.values())),
        ]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): counts and verdict.

    ``kept`` is false where the base rule fails (fewer than 10 words, or more
    than 20 % of the words in repeated 5-word windows) or the characters in
    repeated n-grams or lines pass ``GRAM_PERCENT`` / ``LINE_PERCENT``.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return bounded_batches(rows).mapInArrow(_measure, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows the rules reject; all columns stay.

    The texts are judged where they are read: the rows travel through the
    same pass, so nothing is joined back.
    """
    flag = "kept"
    while flag in docs.columns:
        flag = "_" + flag
    names = docs.columns

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            part = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text")], names=["doc_id", "text"])
            kept = [b.column("kept") for b in _measure(iter([part]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(kept)], names=[*names, flag])

    schema = T.StructType([*docs.schema.fields, T.StructField(flag, T.BooleanType())])
    return bounded_batches(docs).mapInArrow(judged, schema).where(flag).drop(flag)
