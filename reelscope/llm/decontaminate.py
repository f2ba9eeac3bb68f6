"""Benchmark decontamination: short test items found inside long documents.

Method: a size-partitioned MinHash containment search.  Items are partitioned
by the size of their shingle set (powers of two).  For a partition of items
of up to ``2^c`` shingles a document is read as overlapping windows of
``2^(c+1)`` shingles, each starting ``2^c`` after the one before, so that any
run as long as an item lies whole in one window and the sizes compared stay
within a factor of four.  Window and item are candidates when any of
``HASHES`` MinHash values agree; with an item's 0.8 in the window that is
missed less than twice in a million.  Windows without any shingle of the
partition cannot agree with an item and are not hashed.  Each candidate is
verified by the exact containment of the item's shingle set in the set of the
whole document: ``100 * shared >= 80 * size``.

The benchmark is read in blocks of bounded size, hashed once and broadcast
(``BLOCK_CHARS`` characters of items a block, so about 16 MB of hashes); an item
that is repeated is there once, with its count.  The documents make one pass a
block without any shuffle, however the copies are distributed.

Defined cases: a null, empty or blank text or item has no shingles and takes
part in no pair; a text or item of fewer than five words is its whole
sequence, so such an item is found in an equally short document only.
Repeated rows of documents or items give repeated pairs; rows without an id
keep a null id.  Case of A-Z does not count.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import bounded_batches
from reelscope.llm.textgrams import mix, sequences, shingles, slices, words

SHINGLE = 5
PERCENT = 80
HASHES = 64
BLOCK_CHARS = 8 << 20
SCHEMA = "doc_id bigint, item_id bigint, n_item_shingles bigint, n_shared bigint"

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))


def _minhash(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens[:, None] ^ _SEEDS[None, :]).min(axis=0)


@dataclass
class Partition:
    """Items of one size class: ``keys[k]`` sorted, ``items[k]`` the item of each."""

    size: int
    vocabulary: np.ndarray
    keys: np.ndarray
    items: np.ndarray


@dataclass
class Index:
    item_ids: list
    times: list[int]
    sets: list[np.ndarray]
    partitions: list[Partition]


def build_index(item_ids: list, times: list[int], sets: list[np.ndarray]) -> Index:
    """MinHash index of one block of distinct items, each with the number of its rows."""
    size_class = [(len(s) - 1).bit_length() if len(s) else -1 for s in sets]
    partitions = []
    for c in sorted({c for c in size_class if c >= 0}):
        members = np.array([i for i, x in enumerate(size_class) if x == c])
        hashes = np.array([_minhash(sets[i]) for i in members])
        order = np.argsort(hashes, axis=0, kind="stable")
        partitions.append(
            Partition(
                1 << c,
                np.unique(np.concatenate([sets[i] for i in members])),
                np.take_along_axis(hashes, order, axis=0).T.copy(),
                members[order].T.copy(),
            )
        )
    return Index(item_ids, times, sets, partitions)


def _candidates(tokens: np.ndarray, part: Partition) -> set[int]:
    """Items of ``part`` that agree with a window of the document in a MinHash value."""
    at = np.searchsorted(part.vocabulary, tokens)
    hit = part.vocabulary[np.minimum(at, len(part.vocabulary) - 1)] == tokens
    block = np.unique(np.flatnonzero(hit) // part.size)
    found: set[int] = set()
    for b in np.union1d(block, block - 1):
        window = tokens[max(b, 0) * part.size : (b + 2) * part.size]
        for k, value in enumerate(_minhash(window)):
            lo, hi = (np.searchsorted(part.keys[k], value, side) for side in ("left", "right"))
            found.update(part.items[k, lo:hi].tolist())
    return found


def contained(texts: pa.Array, index: Index) -> list[tuple[int, int, int]]:
    """``(row, item, shared)`` of every item contained in a text of ``texts``."""
    tokens, first = sequences(words(texts, lower=True), SHINGLE)
    out = []
    near = np.zeros(len(first) - 1, dtype=bool)
    for part in index.partitions:  # texts without any shingle of the benchmark need no further look
        at = np.searchsorted(part.vocabulary, tokens)
        hit = part.vocabulary[np.minimum(at, len(part.vocabulary) - 1)] == tokens
        total = np.r_[0, np.cumsum(hit)]
        near |= total[first[1:]] > total[first[:-1]]
    for row in np.flatnonzero(near):
        own = tokens[first[row] : first[row + 1]]
        whole = np.unique(own)
        for part in index.partitions:
            for item in sorted(_candidates(own, part)):
                s = index.sets[item]
                shared = int(np.isin(s, whole, assume_unique=True).sum())
                if 100 * shared >= PERCENT * len(s):
                    out.append((int(row), item, shared))
    return out


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = shingles(words(batch.column("text"), lower=True), SHINGLE)
        flat = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("times"), flat], names=["item_id", "times", "shingles"]
        )


def indexes(items: DataFrame) -> Iterator[Index]:
    """One index for each block of the distinct ``items`` (``item_id``, ``text``), bounded in size."""
    items = (
        items.selectExpr("cast(item_id as bigint) as item_id", "cast(text as string) as text")
        .where("text is not null")
        .groupBy("item_id", "text")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = own.mapInArrow(_item_sets, "item_id bigint, times bigint, shingles array<bigint>").collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.shingles))
        sets = [np.array(r.shingles, np.int64).view(np.uint64) for r in rows]
        yield build_index([r.item_id for r in rows], [r.times for r in rows], sets)


def _pairs(index) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = contained(batch.column("text"), index.value)
            ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
            columns = [
                ids,
                pa.array([index.value.item_ids[f[1]] for f in found], pa.int64()),
                pa.array([len(index.value.sets[f[1]]) for f in found], pa.int64()),
                pa.array([f[2] for f in found], pa.int64()),
                pa.array([index.value.times[f[1]] for f in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "n_item_shingles", "n_shared", "times"])

    return run


def contaminated_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared``: every item that a document contains."""
    spark = docs.sparkSession
    docs = bounded_batches(docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text"))
    out = None
    for index in indexes(items):
        found = docs.mapInArrow(_pairs(spark.sparkContext.broadcast(index)), f"{SCHEMA}, times bigint")
        # a repeated item's pairs, one row for each of its rows
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("times", "copy")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns stay, nothing is shuffled."""

    def clean(index) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[f[0] for f in contained(batch.column("text"), index.value)]] = False
                yield batch.filter(pa.array(keep))

        return run

    bounded_batches(docs)
    for index in indexes(items):
        docs = docs.mapInArrow(clean(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs
