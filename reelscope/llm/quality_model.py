"""Quality classifier: histogram gradient-boosted trees over text statistics.

Statistics of a whole text (character classes, word lengths, repetition,
lines) are computed in numpy for a slice of rows at a time.  Trees are grown
level by level on histograms of binned statistics for the logistic loss, and
flattened into one heap-shaped array each for split feature, threshold and
leaf value, so scoring walks all rows down all trees with a few gathers a
level.

The model is fitted on a bounded sample of the labelled rows
(``SAMPLE_ROWS``, the smallest by a hash of the id, so the choice is the same
in every run); binning and growing happen in numpy on the driver, on at most
``SAMPLE_ROWS`` rows of some twenty numbers.  Scoring covers all rows without
a shuffle; the broadcast model has a fixed size.

Defined cases: a null, empty or blank text has the statistics of no words and
is scored like any other; labels that are null or of an unknown document are
ignored, several labels of one document count as their mean, rounded up at a
half; with no usable label the score is 0.5, with one class it is that
class's smoothed share.  Repeated rows are scored alike; a row without
``doc_id`` is scored and never held out.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import bounded_batches
from reelscope.llm.textgrams import slices, words

SAMPLE_ROWS = 20_000
HELD_OUT_OF = 5
THRESHOLD = 0.3
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
L2 = 1.0
LEAST_HESSIAN = 1.0

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"

_CLASSES = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "symbol": list(b"#*$%&|<>"),
    "stop": list(b".!?"),
    "exclaim": list(b"!"),
    "bar": list(b"|"),
    "other": list(b"\"'()-/:;@[\\]^_`{}~+="),
    "beyond_ascii": [*range(128, 256)],
    "line_end": [10],
}
_LOOKUP = np.zeros((len(_CLASSES), 256))
for _i, _members in enumerate(_CLASSES.values()):
    _LOOKUP[_i, _members] = 1
FEATURES = [
    "log_words",
    "mean_word",
    "sd_word",
    *(f"{c}_share" for c in _CLASSES),
    "distinct_share",
    "top_word_share",
    "repeated_gram_share",
    "words_per_line",
    "shouted_share",
    "marked_share",
]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.r_[0.0, np.cumsum(values, dtype=float)]
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    w = words(texts)
    n = np.maximum(w.counts, 1)
    size = (w.ends - w.starts).astype(float)
    chars = np.maximum(np.diff(w.rows), 1)
    row = w.row_of_word()
    mean = _sums(size, w.first) / n
    spread = np.sqrt(np.maximum(_sums(size * size, w.first) / n - mean * mean, 0))
    shares = [_sums(table[w.data], w.rows) / chars for table in _LOOKUP]

    def counts(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((hashes, rows))
        h, r = hashes[order], rows[order]
        edge = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]) if len(h) else np.zeros(0, int)
        return r[edge], np.diff(np.r_[edge, len(h)])

    rows = len(w.counts)
    owner, times = counts(w.hashes, row)
    distinct = np.bincount(owner, minlength=rows) / n
    top = np.zeros(rows)
    np.maximum.at(top, owner, times)
    at, grams = w.gram(3)
    owner, times = counts(grams, row[at])
    repeated = np.bincount(owner, weights=times * (times > 1), minlength=rows) / n
    upper = np.r_[0, np.cumsum(_LOOKUP[0][w.data])]
    symbol = np.r_[0, np.cumsum(_LOOKUP[3][w.data])]
    shouted = (upper[w.ends] - upper[w.starts] > 1).astype(float)
    marked = (symbol[w.ends] - symbol[w.starts] > 0).astype(float)
    lines = shares[-1] * chars + 1
    return np.column_stack(
        [
            np.log1p(w.counts),
            mean,
            spread,
            *shares,
            distinct,
            top / n,
            repeated,
            w.counts / lines,
            _sums(shouted, w.first) / n,
            _sums(marked, w.first) / n,
        ]
    )


@dataclass
class Trees:
    """Complete binary trees in heap order: node ``i`` has children ``2i+1`` and ``2i+2``."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            margin += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-margin))


def _bin_edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.arange(1, BINS) / BINS)) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Boost ``trees`` trees on the logistic loss."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if not len(y):
        base = 0.0
    else:
        share = (y.sum() + 1) / (len(y) + 2)
        base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        empty = np.zeros((0, inner))
        return Trees(base, empty.astype(np.int64), empty, np.zeros((0, leaves)))
    edges = _bin_edges(x)
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    features = binned.shape[1]
    margin = np.full(len(y), base)
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            count, first = 2**level, 2**level - 1
            cell = ((node - first)[:, None] * features + np.arange(features)) * BINS + binned
            shape = (count, features, BINS)
            g = np.bincount(cell.ravel(), np.repeat(gradient, features), count * features * BINS).reshape(shape).cumsum(2)
            h = np.bincount(cell.ravel(), np.repeat(hessian, features), count * features * BINS).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + L2) + (all_g - g) ** 2 / (all_h - h + L2) - all_g**2 / (all_h + L2)
            gain[(h < LEAST_HESSIAN) | (all_h - h < LEAST_HESSIAN)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for i in range(count):
                f, b = divmod(int(best[i]), BINS)
                if gain[i, f, b] > 1e-9 and b < len(edges[f]):
                    out.feature[t, first + i], out.threshold[t, first + i] = f, edges[f][b]
            chosen = out.feature[t, node]
            node = 2 * node + 1 + (x[np.arange(len(y)), chosen] > out.threshold[t, node])
        leaf = node - inner
        g = np.bincount(leaf, gradient, leaves)
        h = np.bincount(leaf, hessian, leaves)
        out.value[t] = -RATE * g / (h + L2)
        margin += out.value[t, leaf]
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        x = statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), pa.list_(pa.float64())), batch.column("label"), batch.column("draw")], names=["x", "label", "draw"]
        )


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on at most ``sample_rows`` labelled documents that are not held out."""
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("q"))
        .where(F.col("q").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("q") >= 0.5).cast("double").alias("label"))
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = bounded_batches(docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text"))
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")  # at most sample_rows rows of two numbers
        .select("text", "label", F.xxhash64("doc_id", "text").alias("draw"))
        .mapInArrow(_statistics_rows, "x array<double>, label double, draw bigint")
        .orderBy("draw", "x", "label")
        .limit(sample_rows)  # repeated ids in docs do not lift the bound
        .collect()
    )
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.label for r in rows]))


def _scored(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = model.value.scores(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score_quality(docs: DataFrame, model: Trees) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return bounded_batches(rows).mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), SCHEMA)
