"""Best-fit packing of token sequences under several capacities at once.

Texts are tokenised with a public tokenizer file and end with an end-of-text
id; only documents longer than a sequence are cut, into pieces of the full
length and a rest.  Each piece then asks for three things of a sequence:
tokens, one document place, and attention cost (its length squared).

Method: vector best-fit.  Pieces are taken by decreasing length; among the
open sequences in which a piece fits under every constraint, the one is
chosen whose residual after placing it has the least weighted norm (or, with
``rule="dot"``, the largest weighted dot product of the piece's demands and
the residual).  Pieces are dealt at random into groups of about
``GROUP_PIECES``, each packed on its own, so at most one sequence a group is
poorly filled (about one in two thousand) and no group grows with the input.

The units of a slice of texts (words, and the punctuation behind them) are
tokenised once each and the ids gathered by numpy: with a tokenizer that drops
white space, lower-cases, and splits letters and digits from punctuation, the
ids of a text are those of its units in order.  Units are told apart by a
64-bit hash of lower-cased bytes and length.

Defined cases: a null text is empty, an empty or blank one is the end id
alone; repeated rows are packed as often as they occur; rows without
``doc_id`` are packed too; other columns are not read.  An empty table gives
no sequences.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging, bounded_batches
from reelscope.llm.textgrams import mix, slices, span_hashes, words

MAX_TOKENS = 4096
END_ID = 1
GROUP_PIECES = 8192
# Tokens decide; places and attention cost order sequences of equal fill.
WEIGHTS = (1.0, 1e-3, 1e-3)
_CACHE_UNITS = 1 << 19

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"
PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


_TRAILING = np.zeros(256, dtype=bool)
_TRAILING[list(b".,;:!?%&*$#|")] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = "\x01"  # a character that is a token of its own; stands between units


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends, hashes and each text's first of its units in order.

    A unit is a word, or a word's letters or digits and the short run of
    punctuation behind them as two.
    """
    w = words(texts, hashed=False)
    data, starts, ends = w.data, w.starts, w.ends
    cut = ends.copy()
    for _ in range(4):
        cut -= (cut > starts) & _TRAILING[data[np.maximum(cut - 1, 0)]] if len(cut) else 0
    split = (cut < ends) & (cut > starts)
    if len(cut):
        last = data[np.maximum(cut - 1, 0)]
        accented = (data[np.maximum(cut - 2, 0)] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
        split &= _ALNUM[last] | accented  # U+00C0 to U+00FF but for the two signs are letters
    parts = 1 + split
    at = np.r_[0, np.cumsum(parts)]
    unit_starts, unit_ends = np.repeat(starts, parts), np.repeat(ends, parts)
    unit_ends[at[:-1][split]] = cut[split]
    unit_starts[at[:-1][split] + 1] = cut[split]
    hashes = span_hashes(data, unit_starts, unit_ends, lower=True)
    # control strings such as <|endoftext|> are told by case
    special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) else np.zeros(0, int)
    if len(special):
        own = np.unique(np.searchsorted(unit_starts, special, side="right") - 1)
        hashes[own] = mix(span_hashes(data, unit_starts[own], unit_ends[own]))
    return data, unit_starts, unit_ends, hashes, at[w.first]


class UnitIds:
    """Ids of units by the tokenizer, each unit encoded once."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        mark = self._ids(_MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has; many texts in one call, marks between them."""
        flat, size = [], []
        for a in range(0, len(texts), 2000):
            part = texts[a : a + 2000]
            ids = self._ids(f" {_MARK} ".join(part))
            ends = np.flatnonzero(ids == self.mark) if self.mark is not None else ids
            if len(ends) == len(part) - 1:
                bounds = np.r_[-1, ends, len(ids)]
                size.append(np.diff(bounds) - 1)
                flat.append(ids[ids != self.mark])
            else:  # a text holds the mark itself
                each = [self._ids(t) for t in part]
                size.append(np.array([len(x) for x in each]))
                flat += each
        return np.concatenate(flat), np.concatenate(size)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of each unit's ids in ``self.flat``."""
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > _CACHE_UNITS:
            self._clear()
        place = np.searchsorted(self.known, unique)
        fresh = np.ones(len(unique), dtype=bool)
        inside = place < len(self.known)
        fresh[inside] = self.known[place[inside]] != unique[inside]
        if fresh.any():
            spans = zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())
            whole = data.tobytes()
            flat, size = self._encoded([whole[a:b].decode() for a, b in spans])
            start = len(self.flat) + np.r_[0, np.cumsum(size)[:-1]]
            self.flat = np.r_[self.flat, flat]
            self.known = np.insert(self.known, place[fresh], unique[fresh])
            self.start = np.insert(self.start, place[fresh], start)
            self.size = np.insert(self.size, place[fresh], size)
        at = np.searchsorted(self.known, unique)[back]
        return self.start[at], self.size[at]


@functools.cache
def unit_ids(tokenizer_path: str) -> UnitIds:
    """One per worker process, so that its later tasks find the units of the earlier ones."""
    return UnitIds(tokenizer_path)


def document_ids(texts: pa.Array, coder: UnitIds, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts end to end, each text closed by ``end_id``, and each text's bounds."""
    data, starts, ends, hashes, first = units(texts)
    start, size = coder(data, starts, ends, hashes)
    before = np.r_[0, np.cumsum(size)]
    total = int(before[-1])
    source = np.repeat(start - before[:-1], size) + np.arange(total)
    closing = before[first[1:]]
    ids = np.insert(coder.flat[source], closing, np.uint32(end_id))
    return ids, np.r_[0, closing + np.arange(1, len(closing) + 1)]


def _pieces(tokenizer_path: str, max_tokens: int, end_id: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = unit_ids(tokenizer_path)
        for batch in slices(batches, "text"):
            ids, bounds = document_ids(batch.column("text"), coder, end_id)
            ids = ids.astype("<u4")
            rows, starts, ends = [], [], []
            for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                for s in range(a, b, max_tokens):
                    rows.append(row)
                    starts.append(s)
                    ends.append(min(s + max_tokens, b))
            rows, starts, ends = (np.array(x, dtype=np.int64) for x in (rows, starts, ends))
            within = starts - bounds[rows]
            columns = [
                batch.column("doc_id").take(pa.array(rows)),
                pa.array((within // max_tokens).astype(np.int32)),
                pa.array(within),
                pa.array(ends - starts),
                pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([ids[a:b].astype(np.int32) for a, b in zip(starts, ends)], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece of each row of ``docs`` (``doc_id``, ``text``); with ``with_ids`` its ids too."""
    schema = PIECES if with_ids else PIECES.rpartition(", ")[0]
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return bounded_batches(rows).mapInArrow(_pieces(tokenizer_path, max_tokens, end_id, with_ids), schema)


def best_fit(
    lengths: np.ndarray,
    max_tokens: int,
    max_documents: int,
    max_attention: int,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece of one group, taken by decreasing length."""
    capacity = np.array([max_tokens, max_documents, max_attention], dtype=float)
    weight = np.array(weights)
    order = np.argsort(-lengths, kind="stable")
    residual = np.zeros((len(lengths), 3))
    used = 0
    sequence = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    shortest = lengths.min(initial=max_tokens)
    open_ = np.zeros(0, dtype=np.int64)  # sequences that the shortest piece may still fit in
    for item in order:
        demand = np.array([lengths[item], 1, float(lengths[item]) ** 2])
        if (demand > capacity).any():
            raise ValueError(f"a piece of {lengths[item]} tokens fits in no sequence")
        left = residual[open_]
        fits = np.flatnonzero((left >= demand).all(axis=1))
        if len(fits):
            if rule == "norm":
                rest = (left[fits] - demand) / capacity
                best = fits[np.argmin((weight * rest * rest).sum(axis=1))]
            else:
                best = fits[np.argmax((weight * (left[fits] / capacity) * (demand / capacity)).sum(axis=1))]
            target = open_[best]
        else:
            target = used
            residual[target] = capacity
            used += 1
            open_ = np.r_[open_, target]
        sequence[item] = target
        offset[item] = max_tokens - residual[target, 0]
        residual[target] -= demand
        if (residual[target] < [shortest, 1, float(shortest) ** 2]).any():
            open_ = open_[open_ != target]
    return sequence, offset


def pack_pieces(
    pieces: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
) -> DataFrame:
    """``pieces`` (columns of ``tokenized_pieces``, read twice) with ``sequence_id`` and ``offset``.

    Without limits of their own, documents and attention cost get those that
    ``max_tokens`` implies: as many documents as tokens, the cost of one
    document of full length.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule must be 'norm' or 'dot', not {rule!r}")
    documents = max_documents or max_tokens
    attention = max_attention or max_tokens * max_tokens
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    shard = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in columns])
        sequence, offset = best_fit(group["length"].to_numpy(), max_tokens, documents, attention, weights, rule)
        sequence += group["shard"].to_numpy() << 32
        out = group.select(columns).append_column("sequence_id", pa.array(sequence))
        return out.append_column("offset", pa.array(offset))

    return pieces.select(*columns, shard.alias("shard")).groupBy("shard").applyInArrow(pack, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, **limits) -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece with its place."""
    stage = Staging(docs.sparkSession, "packing")
    max_tokens = limits.get("max_tokens", MAX_TOKENS)
    return pack_pieces(stage.write(tokenized_pieces(docs, tokenizer_path, max_tokens), "pieces"), **limits)


def sequence_rows(packed: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: the packed sequences themselves.

    A sequence is bounded by its token capacity, so its pieces fit one row.
    ``doc_id`` and ``piece`` must identify a piece here.
    """
    ids = pieces_with_ids.select("doc_id", "piece", "ids")
    at = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    rows = packed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(at.alias("at"))
    return rows.select(
        "sequence_id",
        F.flatten(F.transform("at", lambda p: p["ids"])).alias("ids"),
        F.transform("at", lambda p: p["doc_id"]).alias("doc_ids"),
        F.transform("at", lambda p: p["offset"]).alias("starts"),
    )
