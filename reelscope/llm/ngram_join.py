"""N-gram Jaccard self-join of documents and the components of its links.

A document is its set of distinct 5-word shingles (lower-cased A-Z); two
documents link when ``100 * intersection >= 80 * union``.

Method: prefix filtering under several global token orders.  Under any total
order of the shingles, two sets of Jaccard t share a token among each one's
first ``n - ceil(t n) + 1`` tokens.  Candidates must pass that test under
three orders before their sets are compared exactly.  All orders put tokens
that many prefixes hold last and are otherwise independent hash orders:

1. Every text is hashed; documents with equal sets collapse into one
   representative (the smallest id).
2. Prefix tokens are counted over all documents.  Those in two or more
   prefixes, in eight or more and so on are laid into one Bloom filter a step;
   the number of filters that hold a token is its level, and every order goes
   by level first, so that a token's position tells how much of a document
   few others share.  A filter has at most ``BLOOM_BITS`` bits (16 MB) however
   many tokens there are; where that is too few, the first steps are left
   out.  A false positive moves a token alike in every document, so results
   never depend on the filters.  Documents whose prefix is rich in shared
   tokens, possible near copies, have all their tokens counted among
   themselves for it.
3. Prefix tokens under the final order are counted again; those in two
   prefixes are posted (a second bounded filter keeps most others from
   travelling, an equi-join makes it exact).
4. Within a posting list every document is first paired with one only, the
   one with the fewest tokens of its own, such as the original of a group of
   near copies.  Pairs that share enough of their prefixes are verified, which
   joins such groups at linear cost.
5. Exact completion: lists whose documents lie in one component are done.  In
   the others all pairs from different components are formed, except among
   the list's largest component, under the size and position bounds.  Sizes
   are bands in the join's key, and the smaller set of a pair takes part with
   its shorter index prefix only, ``n - ceil(2t / (1 + t) n) + 1`` tokens, so
   texts that share a template but no more never meet.  Pairs that share
   prefix tokens under the other orders too are verified.
6. Components of all links and copies.

Pairs inside a component known by step 4 are never formed: they cannot change
a component.  Shingles are compared by their 64-bit hashes.  No list, group
or component is collected anywhere; the joins are plain equi-joins of written
tables, which adaptive execution splits at a hot key.

Defined cases: a null, empty or blank text has no shingles and links with
nothing; a text of fewer than five words has one shingle, its whole sequence.
Rows that repeat a ``doc_id`` are one document: a link of any of its rows is
its link, and every row is returned.  A row without ``doc_id`` is returned
with a null component.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.components import connected_components
from reelscope.llm.staging import Staging, bounded_batches
from reelscope.llm.textgrams import mix, shingles, slices, words
from reelscope.operators.positions import with_positions

SHINGLE = 5
PERCENT = 80
# Counts at which a token's level rises.
LEVELS = tuple(2 * 4**k for k in range(10))
# Size bound of a broadcast filter of shared tokens, and the bits it spends on each.
BLOOM_BITS = 1 << 27
BITS_PER_TOKEN = 16
# Share of the first prefix, in percent, that makes a document a possible near copy.
RICH_PERCENT = 30
# Share of the shorter prefix, in percent, that a first-round pair must hold in common.
PIVOT_PERCENT = 30
# Ratio of the size bands that join the sets of a list; over 1 / 0.8, so that a pair lies in one band or two
# neighbouring ones whatever the rounding of logarithms.
SIZE_BAND = 1.26
# Ids are broadcast up to this many (32 MB at most as a hash table of longs); beyond, a shuffle join.
BROADCAST_IDS = 1_000_000
_ORDER_SEEDS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def _prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _in_bloom(tokens: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    if not len(bloom):
        return np.zeros(len(tokens), dtype=bool)
    mask = np.uint64(len(bloom) * 8 - 1)
    found = np.ones(len(tokens), dtype=bool)
    for shift in (np.uint64(0), np.uint64(32)):
        bit = (tokens >> shift) & mask
        found &= (bloom[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _level(tokens: np.ndarray, blooms: list[np.ndarray]) -> np.ndarray:
    """How many of the filters hold each token."""
    level = np.zeros(len(tokens), dtype=np.int64)
    for bloom in blooms:
        level += _in_bloom(tokens, bloom)
    return level


def _prefix(tokens: np.ndarray, level: np.ndarray, seed: np.uint64 | None = None) -> np.ndarray:
    """The first tokens by level, then in hash order (of ``seed``; None: their own)."""
    key = tokens if seed is None else mix(tokens ^ seed)
    return tokens[np.lexsort((key, level))[: _prefix_length(len(tokens))]]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _signature(s: np.ndarray) -> tuple[int, int]:
    a = mix(s).sum(dtype=np.uint64)
    b = mix(s ^ _ORDER_SEEDS[0]).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, set size, 128-bit signature of the set, prefix in plain hash order."""
    for batch in slices(batches, "text"):
        sets = shingles(words(batch.column("text"), lower=True), SHINGLE)
        sign = np.array([_signature(s) for s in sets], dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(sign[:, 0]),
                pa.array(sign[:, 1]),
                _lists([s[: _prefix_length(len(s))] if len(s) else s for s in sets]),
            ],
            names=["doc_id", "n", "s1", "s2", "prefix"],
        )


def _rich(bloom):
    """Ids of documents whose first prefix holds many shared tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, rows, _ = _flat(batch.column("prefix"))
            shared = np.bincount(rows[_in_bloom(tokens.view(np.uint64), bloom.value)], minlength=batch.num_rows)
            size = np.bincount(rows, minlength=batch.num_rows)
            keep = (size > 0) & (100 * shared >= RICH_PERCENT * size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(pa.array(keep))], names=["doc_id"])

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = shingles(words(batch.column("text"), lower=True), SHINGLE)
        yield pa.RecordBatch.from_arrays([_lists(sets)], names=["tokens"])


def _prefixes(blooms):
    """doc_id, set size, half of the set's signature, number of tokens nobody else is known to
    hold, and prefix under the final order, once per distinct set of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(words(batch.column("text"), lower=True), SHINGLE)
            once = {_signature(s): r for r, s in reversed(list(enumerate(sets))) if len(s)}
            signs, rows = zip(*sorted(once.items(), key=lambda x: x[1])) if once else ((), ())
            levels = [_level(sets[r], blooms.value) for r in rows]
            found = [_prefix(sets[r], level) for r, level in zip(rows, levels)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array([len(sets[r]) for r in rows], pa.int64()),
                    pa.array([sign[0] for sign in signs], pa.int64()),
                    pa.array([int((level == 0).sum()) for level in levels], pa.int64()),
                    _lists(found),
                ],
                names=["doc_id", "n", "s1", "own", "prefix"],
            )

    return run


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values of a list column, and each one's row and place in its list."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    rows = np.repeat(np.arange(len(lists)), np.diff(offsets))
    return values, rows, np.arange(len(values)) + offsets[0] - offsets[rows]


def _postings(bloom):
    """One row per prefix token that the filter of shared tokens does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, rows, places = _flat(batch.column("prefix"))
            found = np.flatnonzero(_in_bloom(tokens.view(np.uint64), bloom.value))
            row = pa.array(rows[found])
            columns = [*(batch.column(c).take(row) for c in ("doc_id", "n", "s1", "own")), pa.array(places[found].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens[found])], names=["doc_id", "n", "s1", "own", "pos", "token"])

    return run


def _full(blooms):
    """doc_id, set size, prefixes under the other orders, and the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(words(batch.column("text"), lower=True), SHINGLE)
            levels = [_level(s, blooms.value) for s in sets]
            other = [_lists([_prefix(s, x, seed) if len(s) else s for s, x in zip(sets, levels)]) for seed in _ORDER_SEEDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *other, _lists(sets)],
                names=["doc_id", "n", "second", "third", "tokens"],
            )

    return run


def _bloom(tokens: DataFrame) -> np.ndarray:
    """A Bloom filter over ``tokens.token``, of at most ``BLOOM_BITS`` bits however many they are."""
    count = tokens.count()
    if not count:
        return np.zeros(0, dtype=np.uint8)
    bits = min(BLOOM_BITS, max(1 << 16, 1 << (BITS_PER_TOKEN * count - 1).bit_length()))
    places = F.array(*(F.shiftrightunsigned("token", shift).bitwiseAND(F.lit(bits - 1)) for shift in (0, 32)))
    rows = (
        tokens.select(F.explode(places).alias("bit"))
        .select((F.col("bit") + 1).alias("bit"))  # the bitmap functions count from 1
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:  # at most BLOOM_BITS / 32768 rows of 4 KB
        at = (row.bucket - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def _blooms(counts: DataFrame) -> list[np.ndarray]:
    """One filter for each of ``LEVELS``, over the tokens of ``counts`` that are as frequent."""
    at = [F.sum((F.col("count") >= k).cast("bigint")) for k in LEVELS]
    held = counts.agg(*at).first()
    out = []
    for k, tokens in zip(LEVELS, held):
        if tokens and tokens * BITS_PER_TOKEN <= BLOOM_BITS:
            out.append(_bloom(counts.where(F.col("count") >= k)))
    return out


def _bounded(ids: DataFrame) -> DataFrame:
    """A small table of ids, broadcast to the texts while their number is bounded."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _verified(pairs: DataFrame, docs: DataFrame, blooms, stage: Staging, label: str) -> DataFrame:
    """Links among ``pairs`` (a, na, b, nb): the other orders' prefixes first, then the sets."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    full = stage.write(
        docs.join(_bounded(ids), "doc_id", "left_semi").mapInArrow(
            _full(blooms),
            "doc_id bigint, n bigint, second array<bigint>, third array<bigint>, tokens array<bigint>",
        ),
        f"{label}-sets",
    )

    def both(pairs: DataFrame, *cols: str) -> DataFrame:
        for side in "ab":
            own = full.select(F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"), *(F.col(c).alias(f"{c}_{side}") for c in cols))
            pairs = pairs.join(own, [side, f"n{side}"])
        return pairs

    survivors = (
        both(pairs, "second", "third")
        .where("arrays_overlap(second_a, second_b) and arrays_overlap(third_a, third_b)")
        .select("a", "na", "b", "nb")
        .distinct()
    )
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    linked = both(survivors, "tokens").where(100 * shared >= PERCENT * (F.col("na") + F.col("nb") - shared))
    links = stage.write(linked.select("a", "b").distinct(), f"{label}-links")
    stage.drop(f"{label}-sets")
    return links


def _larger(x: str, y: str) -> str:
    return f"100 * least({x}, {y}) >= {PERCENT} * greatest({x}, {y})"


def similar_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    stage = Staging(spark, "ngram-join")
    docs = bounded_batches(docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text"))
    sets = stage.write(docs.mapInArrow(_sets, "doc_id bigint, n bigint, s1 bigint, s2 bigint, prefix array<bigint>"), "hashed")
    # documents with equal sets
    first = stage.write(
        sets.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "first"
    )
    copies = stage.write(
        sets.where("n > 0").select("doc_id", "n", "s1", "s2").join(first, ["n", "s1", "s2"])
        .where("doc_id <> rep").select("doc_id", "n", "s1", "rep").distinct(),
        "copies",
    )
    stage.drop("first")

    # tokens that several documents hold
    known = docs.where("doc_id is not null")
    counts = stage.write(
        sets.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1"), "counts"
    )
    bloom = spark.sparkContext.broadcast(_bloom(counts))
    rich = sets.select("doc_id", "prefix").where("doc_id is not null").mapInArrow(_rich(bloom), "doc_id bigint")
    rich = stage.write(rich.join(copies.select("doc_id"), "doc_id", "left_anti").distinct(), "rich")
    bloom.unpersist()
    among = (
        known.join(_bounded(rich), "doc_id", "left_semi")
        .mapInArrow(_tokens, "tokens array<bigint>")
        .select(F.explode("tokens").alias("token"))
        .groupBy("token")
        .count()
        .where("count > 1")
    )
    counts = stage.write(counts.unionByName(among), "every-count")
    stage.drop("counts")
    stage.drop("rich")
    blooms = spark.sparkContext.broadcast(_blooms(counts))
    stage.drop("every-count")
    sets = stage.write(sets.select("doc_id", "n"), "sizes")
    stage.drop("hashed")

    # posting lists of tokens that two documents hold
    prefixes = stage.write(
        known.mapInArrow(_prefixes(blooms), "doc_id bigint, n bigint, s1 bigint, own bigint, prefix array<bigint>"), "prefixes"
    )
    shared = stage.write(
        prefixes.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token"), "shared"
    )
    listed = spark.sparkContext.broadcast(_bloom(shared))
    postings = prefixes.mapInArrow(_postings(listed), "doc_id bigint, n bigint, s1 bigint, own bigint, pos int, token bigint")
    alive = stage.write(
        postings.join(shared, "token")
        .join(copies, ["doc_id", "n", "s1"], "left")  # of a doc_id's rows only those with the representative's set
        .select("token", F.coalesce("rep", "doc_id").alias("id"), "n", "own", "pos")
        .distinct(),
        "alive",
    )
    listed.unpersist()
    stage.drop("prefixes")
    stage.drop("shared")

    # first round: each list's documents against the one with the fewest tokens of its own
    lists = stage.write(
        alive.groupBy("token")
        .agg(F.min(F.struct("own", "id", "n")).alias("least"), F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first <> last")
        .select("token", F.col("least.id").alias("a"), F.col("least.n").alias("na")),
        "lists",
    )
    prefix = "(least(na, nb) - ceil(0.8 * least(na, nb)) + 1)"
    near = (
        alive.select("token", F.col("id").alias("b"), F.col("n").alias("nb"))
        .join(lists, "token")
        .where("a <> b")
        .where(_larger("na", "nb"))
        .groupBy("a", "na", "b", "nb")
        .agg(F.count(F.lit(1)).alias("common"))
        .where(f"100 * common >= {PIVOT_PERCENT} * {prefix}")
        .drop("common")
    )
    links = _verified(stage.write(near, "near"), known, blooms, stage, "near")
    stage.drop("near")
    component = connected_components(links, stage, "near")

    # completion: pairs across components
    placed = stage.write(
        alive.join(lists.select("token"), "token")
        .join(component.withColumnRenamed("node", "id"), "id", "left")
        .select("token", "id", "n", "pos", F.coalesce("component", "id").alias("component")),
        "placed",
    )
    stage.drop("alive")
    stage.drop("lists")
    parts = placed.groupBy("token", "component").count()
    open_lists = stage.write(
        parts.groupBy("token")
        .agg(F.max(F.struct("count", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("token", F.col("most.component").alias("most")),
        "open",
    )
    across = stage.write(placed.join(open_lists, "token"), "across")
    stage.drop("placed")
    stage.drop("open")
    # Of a linked pair the smaller set has a shared token among its first tokens that leave
    # 2t / (1 + t) of it, and sizes lie within 1 / t: both bounds come before the match.
    band = F.floor(F.log("n") / F.log(F.lit(SIZE_BAND))).cast("int")
    columns = ("id", "n", "pos", "component")
    sides = across.select(
        "token", *(F.col(c).alias(f"x{c}") for c in columns), (F.col("component") == F.col("most")).alias("xmost"), band.alias("band")
    )
    smaller = sides.where(f"{100 + PERCENT} * (xn - xpos) >= {2 * PERCENT} * xn").withColumn(
        "band", F.explode(F.array("band", F.col("band") + 1))
    )
    larger = sides.withColumnsRenamed({f"x{c}": f"y{c}" for c in (*columns, "most")})

    def met(smaller: DataFrame, larger: DataFrame) -> DataFrame:
        return (
            smaller.join(larger, ["token", "band"])
            .where("xcomponent <> ycomponent and (xn < yn or xn = yn and xid < yid)")
            .where(_larger("xn", "yn"))
            .where(f"{100 + PERCENT} * least(xn - xpos, yn - ypos) >= {PERCENT} * (xn + yn)")
            .selectExpr(
                "least(xid, yid) as a", "if(xid < yid, xn, yn) as na", "greatest(xid, yid) as b", "if(xid < yid, yn, xn) as nb"
            )
        )

    # a list's largest component never meets itself
    pairs = met(smaller.where("not xmost"), larger).union(met(smaller.where("xmost"), larger.where("not ymost"))).distinct()
    pairs = stage.write(pairs, "pairs")
    stage.drop("across")
    rest = _verified(pairs, known, blooms, stage, "rest")
    stage.drop("pairs")
    blooms.unpersist()

    every = links.union(rest).union(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    component = connected_components(every, stage, "all").withColumnRenamed("node", "doc_id")
    return sets.join(component, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of linked texts, that of the smallest ``doc_id``.

    All columns stay.  Different texts under one ``doc_id`` are judged apart: each
    stays unless it is itself a copy (of texts of one id the one with the least
    hash stays); of equal rows one does.  Rows without ``doc_id`` stay.
    """
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        placed = Staging(docs.sparkSession, "ngram-groups").write(similar_components(docs), "components")
        copies = placed.where("component_id < doc_id").select("doc_id")
        return docs.join(_bounded(copies), "doc_id", "left_anti").select(*docs.columns)
    return _one_of_each_text(docs)


def _one_of_each_text(docs: DataFrame) -> DataFrame:
    """``one_of_each_group`` where ids repeat: every text of an id is numbered as a document of its own."""
    stage = Staging(docs.sparkSession, "ngram-texts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = ["id", "t1", "t2"]
    whole = F.struct(*(F.col(c) for c in docs.columns))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"),
        text.alias("text"), whole.alias("whole"),
    )
    known = rows.where("id is not null")
    numbers = stage.write(with_positions(known.select(*key).distinct(), *key, name="number"), "numbers")
    numbered = stage.write(known.select(*key, "text").join(numbers, key).select(F.col("number").alias("doc_id"), "text"), "texts")
    placed = stage.write(similar_components(numbered), "components")
    first = placed.where("component_id = doc_id").select(F.col("doc_id").alias("number")).distinct()
    stay = numbers.join(first, "number", "left_semi")
    # equal rows are combined before they are shuffled, so a row that is often repeated meets in no task
    once = known.join(stay, key, "left_semi").groupBy(*key).agg(F.min_by("whole", F.xxhash64("whole")).alias("whole"))
    return once.select("whole.*").unionByName(rows.where("id is null").select("whole.*"))
