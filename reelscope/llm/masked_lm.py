"""Language-model scoring by masked pseudo-likelihood.

Every word of a text is predicted from the ``WINDOW`` words on either side of
it by a small network; the sum of the log-probabilities of all its words is
the text's pseudo-log-likelihood.

Vocabulary: word counts over the whole corpus; the most frequent words (by
count, then hash) have an id of their own, ``FREQUENT`` of them and more with
the square root of the number of distinct words (``own_ids``).  Every other
word shares one of ``SHARED`` ids chosen by its hash; its probability is that
of the id times the word's part of the id's count in the corpus, so the
probabilities of all words add up to 1.  Two ids mark a text's edges.

Network: position-weighted sum of the neighbours' embeddings, tanh, and a
softmax in two steps, over blocks of ids and within the block, both with
biases that start at the corpus' log frequencies.  Own ids are dealt to the
blocks so that these hold about equal numbers of words.  Training is local SGD
in numpy, with Adagrad's step sizes by parameter row: every task trains on the
words of its own texts at positions ``epoch modulo STRIDE``; ``EPOCHS`` is
``STRIDE``, so every word of every text is a target once.  The tasks'
parameters are averaged with the number of their words as weights, and the
next epoch starts from there (one average alone fits held-out text worse).
Parameters travel in pieces of 32 KB and are averaged in two levels, so no
group takes in the pieces of all tasks.

Texts are encoded once: each row's word ids, and the hashes of its words of
shared ids, are written as bytes under a row number of its own, and training
and scoring read that table.  Scoring is one pass over it with the network
broadcast (some 1.1 MB and 260 bytes an id beyond ``FREQUENT``).  The counts of
all words stay in a written table.  What the words of shared ids add is summed
by row: from the vocabulary for the ``KNOWN`` most frequent words (1 MB), and
for all others from that table, joined by word in buckets of their hashes.

Defined cases: a null, empty or blank text has no words, a sum of 0 and a
null mean; an empty table gives no rows; repeated rows count as often as they
occur and are scored alike; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging, bounded_batches
from reelscope.llm.textgrams import slices, words

WINDOW = 2
FREQUENT = 3072
SHARED = 1024
BLOCK = 64
WIDTH = 32
EPOCHS = 2
STRIDE = EPOCHS
BATCH = 4096
FIRST_BATCH = 512  # batches grow to BATCH with the words a task has seen
SCORED = 32768  # words scored together
NEAR = 1024  # of them, or of a batch, taken through the softmax over blocks together, near the processor
RATE = 0.2
KNOWN = 65536  # most frequent words whose counts travel with the vocabulary, so their rows need no join
COUNT_BYTES = 8 << 20  # text counted together, at most
COUNTED = 1 << 20  # distinct words of a task counted together before their counts travel
BUCKET = 32768  # distinct words whose counts meet the texts' words in one group
_PIECE = 8192  # parameters in one row of the averaging
FAN = 1024  # groups of tasks averaged first, so the second average has at most so many inputs

SIZE = FREQUENT + SHARED  # ids at least
LEFT_EDGE, RIGHT_EDGE = SIZE, SIZE + 1  # ids of the edges in that case

SCHEMA = "doc_id bigint, n_words bigint, log_likelihood double, mean_log_likelihood double"


def own_ids(distinct: int) -> int:
    """Words with an id of their own, of so many distinct ones."""
    return FREQUENT + BLOCK * int(2 * math.sqrt(distinct) / BLOCK)


def edges(own: int) -> tuple[int, int]:
    """The ids before and after a text."""
    return own + SHARED, own + SHARED + 1


class Lookup:
    """Places of hashes in ``keys``, sorted hashes: each key's high bits lead to the first of its like."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = min((4 * len(keys)).bit_length(), 24)
        self.shift = np.uint64(64 - bits)
        self.first = np.zeros(1, np.int32)
        if len(keys):
            starts = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
            self.first = np.minimum(starts[:-1], len(keys) - 1).astype(np.int32)
            self.crowded = np.diff(starts) > 1

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash, and whether it is a key (any place otherwise)."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int32), np.zeros(len(hashes), bool)
        slot = (hashes >> self.shift).astype(np.int64)
        at = self.first[slot]
        found = self.keys[at] == hashes
        more = np.flatnonzero(self.crowded[slot] & ~found)
        at[more] = np.minimum(np.searchsorted(self.keys, hashes[more]), len(self.keys) - 1)
        found[more] = self.keys[at[more]] == hashes[more]
        return at, found


def word_ids(hashes: np.ndarray, frequent: Lookup, ids: np.ndarray, own: int) -> np.ndarray:
    """Ids of word hashes; ``frequent``: finds the words with ids of their own, ``own`` at most."""
    shared = own + (hashes & np.uint64(SHARED - 1)).astype(np.int64)
    if not len(ids):
        return shared
    at, found = frequent(hashes)
    return np.where(found, ids[at], shared)


@dataclass
class Encoded:
    """Word ids of some texts: ``padded`` holds each text between edge ids, ``place`` its words there."""

    padded: np.ndarray
    place: np.ndarray
    first: np.ndarray  # each text's first word, and the number of words

    @classmethod
    def of(cls, ids: np.ndarray, first: np.ndarray, own: int) -> Encoded:
        rows = len(first) - 1
        left, right = edges(own)
        padded = np.full(len(ids) + 2 * WINDOW * rows, left, dtype=np.int32)
        place = np.arange(len(ids)) + 2 * WINDOW * np.repeat(np.arange(rows), np.diff(first)) + WINDOW
        padded[place] = ids
        ends = first[1:] + 2 * WINDOW * np.arange(rows) + WINDOW
        for k in range(WINDOW):
            padded[ends + k] = right
        return cls(padded, place, first)

    @property
    def ids(self) -> np.ndarray:
        return self.padded[self.place]

    def context(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The ids on either side of the words ``rows``, one line for each."""
        around = np.array([d for d in range(-WINDOW, WINDOW + 1) if d])
        return self.padded[self.place[rows][:, None] + around]


@dataclass
class Vocabulary:
    frequent: np.ndarray
    ids: np.ndarray
    own: int = FREQUENT
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes of words of shared ids
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))  # and the logarithms of their counts

    @cached_property
    def _lookups(self) -> tuple[Lookup, Lookup]:
        return Lookup(self.frequent), Lookup(self.known)

    def logs_of(self, hashes: np.ndarray) -> np.ndarray:
        """Logarithms of the counts of words of shared ids, NaN of those that are not known."""
        if not len(self.known):
            return np.full(len(hashes), np.nan)
        at, found = self._lookups[1](hashes)
        return np.where(found, self.logs[at], np.nan)

    def ids_of(self, hashes: np.ndarray) -> np.ndarray:
        return word_ids(hashes, self._lookups[0], self.ids, self.own)

    def encode(self, texts: pa.Array) -> Encoded:
        w = words(texts)
        return Encoded.of(self.ids_of(w.hashes), w.first, self.own)


class Network:
    """All parameters for ``size`` ids in one float32 vector, with views by name."""

    def __init__(self, flat: np.ndarray, size: int):
        self.flat, self.size, self.blocks = flat, size, size // BLOCK
        self.squares: dict[str, np.ndarray] = {}  # sums of squared gradients, by row
        self.held: dict[str, np.ndarray] = {}  # memory that every batch uses anew
        shapes = {
            "embed": (size + 2, WIDTH),
            "position": (2 * WINDOW, WIDTH),
            "block": (self.blocks, WIDTH),
            "block_bias": (self.blocks,),
            "word": (size, WIDTH),
            "word_bias": (size,),
        }
        at = 0
        for name, shape in shapes.items():
            setattr(self, name, flat[at : at + math.prod(shape)].reshape(shape))
            at += math.prod(shape)

    @staticmethod
    def length(size: int) -> int:
        return (size + 2) * WIDTH + 2 * WINDOW * WIDTH + (size // BLOCK + size) * (WIDTH + 1)

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        size = len(counts)
        net = cls(np.zeros(cls.length(size), dtype=np.float32), size)
        rng = np.random.default_rng(0)
        net.embed[:] = rng.normal(0, 0.1, net.embed.shape)
        net.position[:] = 1
        share = (counts + 0.5) / (counts.sum() + 0.5 * size)
        blocks = share.reshape(net.blocks, BLOCK).sum(1)
        net.block_bias[:] = np.log(blocks)
        net.word_bias[:] = np.log(share / np.repeat(blocks, BLOCK))
        return net

    def _space(self, name: str, *shape: int, kind: type | np.dtype | None = None) -> np.ndarray:
        """An array of this shape, not cleared, in memory kept under ``name``."""
        n, kind = math.prod(shape), np.dtype(kind or self.flat.dtype)
        kept = self.held.get(name)
        if kept is None or len(kept) < n:
            kept = self.held[name] = np.empty(n, dtype=kind)
        return kept[:n].reshape(shape)

    @staticmethod
    def _tame(z: np.ndarray, most: float = 60) -> None:
        if not max(z.max(), -z.min()) <= most:  # exp cannot overflow otherwise
            z -= z.max(axis=1, keepdims=True)

    def _log_share(self, z: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Logarithm of the softmax of ``z`` at one column of each row."""
        self._tame(z)
        own = z[np.arange(len(z)), column]
        np.exp(z, out=z)
        return own - np.log(_row_sums(z))

    def _block_spans(self, block: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """The blocks in sorted ``block``, and each with its targets."""
        bounds = np.searchsorted(block, np.arange(self.blocks + 1))
        used, at = np.flatnonzero(np.diff(bounds)), bounds.tolist()
        return used, [(b, slice(at[b], at[b + 1])) for b in used.tolist()]

    def _block_factors(self) -> tuple[np.ndarray, np.ndarray, float]:
        """The part of the blocks' biases that sums take as factors of exponentials, which saves a pass over
        the logits: all of it, or 0 where they lie far apart; the factors; and the largest logit they allow."""
        bias = self.block_bias if np.abs(self.block_bias).max() <= 20 else np.zeros_like(self.block_bias)
        return bias, np.exp(bias), 60 - 2 * float(np.abs(bias).max())

    def _by_blocks(self, h: np.ndarray, bias: np.ndarray, most: float) -> np.ndarray:
        """Logits of the blocks but for ``bias``."""
        z = np.matmul(h, self.block.T, out=self._space("z", len(h), self.blocks))
        if bias is not self.block_bias:
            z += self.block_bias
        self._tame(z, most)
        return z

    def _words_of_blocks(self) -> list[tuple[np.ndarray, ...]]:
        """Each block's rows of ``word``, these transposed, and its biases."""
        weights, biases = self.word.reshape(-1, BLOCK, WIDTH), self.word_bias.reshape(-1, BLOCK)
        return [(w, w.T, b) for w, b in zip(weights, biases)]

    def log_probabilities(self, text: Encoded) -> np.ndarray:
        """log p(word | words on both sides) of each word."""
        ids = text.ids
        out = np.empty(len(ids))
        at_place = [self.embed * p for p in self.position]
        of_blocks, (bias, factors, most) = self._words_of_blocks(), self._block_factors()
        for at in range(0, len(ids), SCORED):
            own = ids[at : at + SCORED]
            block = own // BLOCK
            order = np.argsort(_narrow(block, self.blocks), kind="stable")  # a block's words side by side
            block, place = block[order], (own % BLOCK)[order]
            context = np.ascontiguousarray(text.context(at + order).T)
            h, p = self._space("h", len(own), WIDTH), np.empty(len(own))
            for a in range(0, len(own), NEAR):
                some = slice(a, a + NEAR)
                near = at_place[0].take(context[0, some], axis=0, out=h[some], mode="clip")
                for k in range(1, 2 * WINDOW):
                    near += at_place[k].take(context[k, some], axis=0, out=self._space("near", len(near), WIDTH), mode="clip")
                np.tanh(near, out=near)
                z = self._by_blocks(near, bias, most)
                p[some] = z[np.arange(len(z)), block[some]] + bias[block[some]]
                p[some] -= np.log(np.exp(z, out=z) @ factors)
            for b, some in self._block_spans(block)[1]:
                _, weights, biases = of_blocks[b]
                z = np.dot(h[some], weights, out=self._space("z", some.stop - some.start, BLOCK))
                z += biases
                p[some] += self._log_share(z, place[some])
            out[at + order] = p
        return out

    def gradients(self, context: np.ndarray, target: np.ndarray) -> list[tuple]:
        """``name, rows, gradient of weights, of biases`` of a batch's summed loss."""
        kind = self.flat.dtype
        block = target // BLOCK
        order = np.argsort(_narrow(block, self.blocks), kind="stable")  # a block's targets side by side
        target, block, context = target[order], block[order], np.ascontiguousarray(context[order].T)
        n = len(target)
        rows, ones = np.arange(n), np.ones(n, dtype=kind)
        near = self._space("near", 2 * WINDOW, n, WIDTH)
        h, part = self._space("h", n, WIDTH), self._space("part", n, WIDTH)
        back, share = self._space("back", n, WIDTH), self._space("share", n, WIDTH)
        of_block, of_bias = np.zeros_like(self.block), np.zeros_like(self.block_bias)
        bias, factors, most = self._block_factors()
        weighted = self.block * factors[:, None]
        for at in range(0, n, NEAR):
            some = slice(at, at + NEAR)
            own = h[some]
            for k in range(2 * WINDOW):
                self.embed.take(context[k, some], axis=0, out=near[k, some], mode="clip")  # all ids are in range
                np.multiply(near[k, some], self.position[k], out=part[some] if k else own)
                if k:
                    own += part[some]
            np.tanh(own, out=own)
            error = self._by_blocks(own, bias, most)
            sums = np.exp(error, out=error) @ factors
            # times the factors and over the sums, this is the softmax less 1 at the target
            error[rows[: len(error)], block[some]] -= sums / factors[block[some]]
            np.divide(1, sums, out=sums)
            np.matmul(error, weighted, out=back[some])
            back[some] *= sums[:, None]
            of_block += error.T @ np.multiply(own, sums[:, None], out=share[some])
            of_bias += sums @ error
        of_block *= factors[:, None]
        of_bias *= factors
        by_block = ("block", slice(None), of_block, of_bias)

        used, spans = self._block_spans(block)
        of_blocks = self._words_of_blocks()
        error = self._space("z", n, BLOCK)
        for b, at in spans:
            _, weights, biases = of_blocks[b]
            own = np.dot(h[at], weights, out=error[at])
            own += biases
        self._tame(error)
        sums = _row_sums(np.exp(error, out=error))
        error[rows, target % BLOCK] -= sums
        np.divide(1, sums, out=sums)
        np.multiply(h, sums[:, None], out=share)
        by_word = self._space("by_word", len(used), BLOCK, WIDTH)
        by_bias = np.empty((len(used), BLOCK), dtype=kind)
        for (b, at), weights, biases in zip(spans, by_word, by_bias):
            own = error[at]
            np.dot(own, of_blocks[b][0], out=part[at])
            np.dot(own.T, share[at], out=weights)
            np.dot(sums[at], own, out=biases)
        ids = slice(None) if len(used) == self.blocks else (used[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        by_word = ("word", ids, by_word.reshape(-1, WIDTH), by_bias.ravel())

        by_position = np.zeros_like(self.position)
        for at in range(0, n, NEAR):
            some = slice(at, at + NEAR)
            own, slope = back[some], h[some]
            own += np.multiply(part[some], sums[some, None], out=part[some])
            slope *= slope
            own *= np.subtract(1, slope, out=slope)
            for k in range(2 * WINDOW):
                by_position[k] += ones[some] @ np.multiply(near[k, some], own, out=part[some])
        ids, by_embed = self._sums_by_id(context, back)
        return [by_block, by_word, ("position", slice(None), by_position, None), ("embed", ids, by_embed, None)]

    def _sums_by_id(self, context: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in ``context`` (a line for each place), and what ``back`` adds to the embedding of each."""
        held = np.zeros(self.size + 2, dtype=bool)
        held[context] = True
        ids = np.flatnonzero(held)
        slot = (np.cumsum(held) - 1)[context].ravel()
        sums = np.empty((WIDTH, len(ids)), dtype=back.dtype)
        columns = self._space("columns", *back.T.shape, kind=float)
        columns[:] = back.T
        position = self.position.astype(float)
        change = np.empty(context.shape)
        for d in range(WIDTH):  # a count by slot with weights is several times faster than sums of sorted rows
            np.multiply(position[:, d, None], columns[d], out=change)
            sums[d] = np.bincount(slot, weights=change.ravel(), minlength=len(ids))
        return ids, np.ascontiguousarray(sums.T)

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One step of Adagrad on a batch, with a step size for each row of parameters."""
        for name, rows, weights, biases in self.gradients(context, target):
            if name not in self.squares:
                self.squares[name] = np.full(len(getattr(self, name)), 1e-3, dtype=self.flat.dtype)
            for at in range(0, len(weights), NEAR):
                some = slice(at, at + NEAR)
                self._step(name, some if isinstance(rows, slice) else rows[some], weights[some], None if biases is None else biases[some])

    def _step(self, name: str, rows: np.ndarray | slice, weights: np.ndarray, biases: np.ndarray | None) -> None:
        squares = np.einsum("ij,ij->i", weights, weights)
        if biases is not None:
            squares += biases * biases
        squares /= WIDTH
        squares += self.squares[name][rows]
        self.squares[name][rows] = squares
        rate = np.float32(RATE) / np.sqrt(squares)
        weights *= rate[:, None]
        getattr(self, name)[rows] -= weights
        if biases is not None:
            getattr(self, name + "_bias")[rows] -= biases * rate


def _row_sums(z: np.ndarray) -> np.ndarray:
    return z @ np.ones(z.shape[1], dtype=z.dtype)


def _narrow(ids: np.ndarray, below: int) -> np.ndarray:
    """``ids`` in 16 bits where they fit, which sort by radix."""
    return ids.astype(np.uint16) if below <= 1 << 16 else ids


def train_in_batches(net: Network, context: np.ndarray, target: np.ndarray, seen: int = 0) -> None:
    """Steps over all of ``target``, in batches that grow with the words ``seen`` so far."""
    at = 0
    while at < len(target):
        size = min(BATCH, max(FIRST_BATCH, (seen + at) // 16))
        net.train(context[at : at + size], target[at : at + size])
        at += size


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in slices(batches, "text", COUNT_BYTES):
        parts.append(np.unique(words(batch.column("text")).hashes, return_counts=True))
        if sum(len(hashes) for hashes, _ in parts[1:]) > len(parts[0][0]):  # so each word is merged few times
            parts = [_summed(parts)]
            if len(parts[0][0]) > COUNTED:
                yield _as_counts(*parts.pop())
    if parts:
        yield _as_counts(*_summed(parts))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of ``parts``, and the sum of the counts of each."""
    hashes, counts = (np.concatenate(column) for column in zip(*parts))
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _as_counts(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["word", "n"])


def word_counts(docs: DataFrame, stage: Staging) -> DataFrame:
    """``word, n`` of every distinct word in all rows of ``docs`` (``text``), by hash."""
    counted = docs.select("text").mapInArrow(_counted, "word bigint, n bigint")
    return stage.write(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


def dealt(counts: list[int], blocks: int) -> np.ndarray:
    """Ids for words of these counts, largest first, in ``blocks`` blocks of about equal sums."""
    ids = np.empty(len(counts), dtype=np.int64)
    open_blocks = [(0, b, 0) for b in range(blocks)]  # sum, block, words in it; in order, thus a heap
    for i, n in enumerate(counts):
        total, b, held = heapq.heappop(open_blocks)
        ids[i] = b * BLOCK + held
        if held + 1 < BLOCK:
            heapq.heappush(open_blocks, (total + n, b, held + 1))
    return ids


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary and the count of each id, from the counts of all words."""
    own = own_ids(counts.count())
    top = counts.orderBy(F.desc("n"), "word").limit(max(own, KNOWN)).collect()
    top, known = top[:own], sorted(top[own:], key=lambda r: r.word & (2**64 - 1))
    slot = dict(zip((r.word for r in top), dealt([r.n for r in top], own // BLOCK).tolist()))
    frequent = np.array(sorted(slot, key=lambda w: w & (2**64 - 1)), dtype=np.int64)
    ids = np.array([slot[w] for w in frequent.tolist()], dtype=np.int64)
    # ids of shared words: the hash's low bits, as in word_ids
    shared = F.pmod(F.col("word").bitwiseAND(F.lit(SHARED - 1)), F.lit(SHARED))
    rest = counts.groupBy(shared.alias("id")).agg(F.sum("n").alias("n")).collect()
    total = np.zeros(own + SHARED)
    for r in rest:
        total[own + r.id] += r.n
    for r in top:
        total[slot[r.word]] = r.n
        total[own + (r.word & (SHARED - 1))] -= r.n
    hashes, logs = np.array([r.word for r in known], dtype=np.int64), np.log([float(r.n) for r in known])
    return Vocabulary(frequent.view(np.uint64), ids, own, hashes.view(np.uint64), logs), total


def corpus_vocabulary(docs: DataFrame, stage: Staging) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary and the count of each id, over all rows of ``docs`` (``text``)."""
    return vocabulary_of(word_counts(docs, stage))


def _ids(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of their bytes end to end, and each row's first one."""
    column = column.cast(pa.large_binary())
    size = np.dtype(kind).itemsize
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, kind), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind), (offsets - offsets[0]) // size


def _bytes(numbers: np.ndarray, first: np.ndarray) -> pa.Array:
    offsets = first.astype(np.int64) * numbers.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers))]
    ).cast(pa.binary())


def _encoding(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in slices(batches, "text"):
            w = words(batch.column("text"))
            ids = vocabulary.ids_of(w.hashes).astype(np.int32)
            alike = np.flatnonzero(ids >= vocabulary.own)
            logs = vocabulary.logs_of(w.hashes[alike])
            row = w.row_of_word()[alike]
            rare = np.isnan(logs)
            first = np.searchsorted(alike[rare], w.first)
            sums = np.bincount(row[~rare], weights=logs[~rare], minlength=batch.num_rows).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _bytes(ids, w.first), _bytes(w.hashes[alike[rare]], first), pa.array(sums, pa.float64())],
                names=["doc_id", "ids", "shared", "known"],
            )

    return run


def encoded_documents(docs: DataFrame, vocabulary: Vocabulary, stage: Staging) -> DataFrame:
    """``row, doc_id, ids, shared, known`` of each row of ``docs`` (``doc_id``, ``text``): the ids of its
    words (32 bits each), the hashes of those that share one (64 bits each), except those whose counts
    the vocabulary knows, and the sum of the logarithms of these counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    found = rows.mapInArrow(_encoding(shared), "doc_id bigint, ids binary, shared binary, known double")
    return stage.write(found.select(F.monotonically_increasing_id().alias("row"), *found.columns), "encoded")


def _sharing(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "shared"):
            hashes, first = _ids(batch.column("shared"), np.uint64)
            rows = np.repeat(batch.column("row").to_numpy(), np.diff(first))
            bucket = ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(_narrow(bucket, buckets), kind="stable")
            used, at = np.unique(bucket[order], return_index=True)
            at = np.r_[at, len(order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), _bytes(rows[order], at), _bytes(hashes[order], at)], names=["bucket", "rows", "words"]
            )

    return run


def _joined(shared: pa.Table, counts: pa.Table) -> pa.Table:
    """``row, log_counts`` of a bucket's words."""
    words_of = counts["word"].to_numpy().view(np.uint64)
    order = np.argsort(words_of)
    logs = np.log(counts["n"].to_numpy()[order].astype(float))
    hashes = _ids(shared["words"].combine_chunks(), np.uint64)[0]
    at, found = Lookup(words_of[order])(hashes)
    rows, slot = np.unique(_ids(shared["rows"].combine_chunks(), np.int64)[0][found], return_inverse=True)
    sums = np.bincount(slot, weights=logs[at[found]], minlength=len(rows))
    return pa.table({"row": pa.array(rows, pa.int64()), "log_counts": pa.array(sums, pa.float64())})


def shared_words(encoded: DataFrame, counts: DataFrame, stage: Staging) -> DataFrame:
    """``row, log_counts`` of ``encoded``: the sum of the logarithms of the counts of a row's ``shared``
    words; those that occur once have none to add.  Words and counts meet in buckets of the words'
    hashes, in groups of about ``BUCKET`` distinct words."""
    buckets = counts.count() // BUCKET + 1
    found = encoded.select("row", "shared").mapInArrow(_sharing(buckets), "bucket bigint, rows binary, words binary")
    bucket = F.shiftrightunsigned("word", 33) % buckets  # as in _sharing
    dealt_counts = counts.where("n > 1").select(bucket.alias("bucket"), "word", "n")
    joined = found.groupBy("bucket").cogroup(dealt_counts.groupBy("bucket")).applyInArrow(_joined, "row bigint, log_counts double")
    return stage.write(joined.groupBy("row").agg(F.sum("log_counts").alias("log_counts")), "shared")


def targets(text: Encoded, epoch: int, stride: int = STRIDE) -> np.ndarray:
    """The words an epoch trains on, mixed; each word is one in one of ``stride`` epochs."""
    within = np.arange(len(text.place)) - np.repeat(text.first[:-1], np.diff(text.first))
    chosen = np.flatnonzero(within % stride == epoch % stride)
    return np.random.default_rng(len(within)).permutation(chosen)


def _texts(batch: pa.RecordBatch, own: int) -> Encoded:
    return Encoded.of(*_ids(batch.column("ids"), np.int32), own)


def _trained(shared, epoch: int, stride: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, flat = shared.value
        net = Network(flat.copy(), own + SHARED)
        seen = 0
        for batch in slices(batches, "ids"):
            text = _texts(batch, own)
            chosen = targets(text, epoch, stride)
            train_in_batches(net, text.context(chosen), text.ids[chosen], seen)
            seen += len(chosen)
        if seen:
            task = TaskContext.get().partitionId()
            pieces = [net.flat[a : a + _PIECE].tobytes() for a in range(0, len(net.flat), _PIECE)]
            n = len(pieces)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(n), pa.int32()),
                    pa.array([task] * n, pa.int64()),
                    pa.array([float(seen)] * n),
                    pa.array(pieces, pa.binary()),
                ],
                names=["piece", "task", "weight", "data"],
            )

    return run


_AVERAGED = "piece int, task bigint, weight double, data binary"


def _average(group: pa.Table) -> pa.Table:
    group = group.sort_by("task")
    weights = group["weight"].to_numpy()
    total = np.zeros(len(group["data"][0].as_py()) // 4)
    for weight, data in zip(weights, group["data"]):
        total += weight * np.frombuffer(data.as_py(), np.float32)
    mean = (total / weights.sum()).astype(np.float32)
    return pa.table(
        {
            "piece": pa.array([group["piece"][0].as_py()], pa.int32()),
            "task": pa.array([group["task"][0].as_py()], pa.int64()),
            "weight": pa.array([float(weights.sum())]),
            "data": pa.array([mean.tobytes()], pa.binary()),
        }
    )


def train_encoded(
    encoded: DataFrame, own: int, counts: np.ndarray, epochs: int = EPOCHS, stride: int = STRIDE
) -> Network:
    """A network trained on all rows of ``encoded`` (``ids``)."""
    spark = encoded.sparkSession
    net = Network.start(counts)
    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast((own, net.flat))
        parts = encoded.select("ids").mapInArrow(_trained(shared, epoch, stride), _AVERAGED)
        some = parts.groupBy("piece", (F.col("task") % FAN).alias("part")).applyInArrow(_average, _AVERAGED)
        rows = some.groupBy("piece").applyInArrow(_average, _AVERAGED).collect()  # the network itself
        flat = net.flat.copy()
        for r in rows:
            flat[r.piece * _PIECE : r.piece * _PIECE + len(r.data) // 4] = np.frombuffer(r.data, np.float32)
        net = Network(flat, net.size)
    return net


def train_network(
    docs: DataFrame, vocabulary: Vocabulary, counts: np.ndarray, epochs: int = EPOCHS, stride: int = STRIDE
) -> Network:
    """A network trained on all rows of ``docs`` (``doc_id``, ``text``)."""
    stage = Staging(docs.sparkSession, "masked-lm")
    return train_encoded(encoded_documents(docs, vocabulary, stage), vocabulary.own, counts, epochs, stride)


def _scored(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, flat, counts = shared.value
        net = Network(flat, own + SHARED)
        # what the count of a shared id takes from the logarithm of a word's count
        less = np.log(np.maximum(counts, 1))
        less[:own] = 0
        for batch in slices(batches, "ids"):
            text = _texts(batch, own)
            total = np.r_[0.0, np.cumsum(net.log_probabilities(text) - less[text.ids])]
            score = total[text.first[1:]] - total[text.first[:-1]] + batch.column("known").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(np.diff(text.first), pa.int64()), pa.array(score)],
                names=["row", "doc_id", "n_words", "score"],
            )

    return run


_SCORED = "row bigint, doc_id bigint, n_words bigint, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on ``docs`` (``doc_id``, ``text``) and score every row of it."""
    spark = docs.sparkSession
    stage = Staging(spark, "masked-lm")
    docs = bounded_batches(docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text"))
    words_of = word_counts(docs, stage)
    vocabulary, counts = vocabulary_of(words_of)
    encoded = encoded_documents(docs, vocabulary, stage)
    net = train_encoded(encoded, vocabulary.own, counts)
    sums = shared_words(encoded, words_of, stage)
    stage.drop("words")
    network = spark.sparkContext.broadcast((vocabulary.own, net.flat, counts))
    scored = encoded.select("row", "doc_id", "ids", "known").mapInArrow(_scored(network), _SCORED)
    score = F.when(F.col("n_words") > 0, F.col("score") + F.coalesce("log_counts", F.lit(0.0))).otherwise(0.0)
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "n_words",
        score.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_likelihood"),
    )
