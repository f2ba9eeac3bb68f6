"""Top-k of sums by thresholds: only keys that can still win are shuffled whole.

The plain plan shuffles one partial sum of every key from every task and drops
all but k of the results.  Here the partial sums stay where they were made, in
a table written without any shuffle, and are read in three phases:

1. *Local tops.*  Every node (a task's rows) sends its k largest partial sums.
   The k-th largest of their sums by key bounds the k-th result from below.
2. *Bound.*  Every node sends the partial sums that reach that bound's m-th
   part, m being the number of nodes.  What a node has not sent is smaller, so
   each key's sum now has a lower and an upper bound; keys whose upper bound
   falls short of the k-th lower bound are out.
3. *Candidates.*  The partial sums of the keys left are added up exactly.

Bounds hold for negative sums too.  A key that no row has in a node counts 0
there.  Ties at the k-th place are decided by the smallest key.  Sums are of
doubles, as in the plain plan: exact for whole numbers (see ``exact`` for others).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.operators.joins import bounded_broadcast
from reelscope.sources.kept import kept

# Distinct keys a node holds before it is written and the next one begun: bounds a task's memory.
NODE_KEYS = 1_000_000
# A node's number: the partition above this bit, the place among its nodes below.
_NODE_BITS = 32
# Rows a task gathers before it adds them up.
MERGE_ROWS = 1 << 17
CANDIDATE_BYTES = 32 << 20
# Bounds leave this much room for the rounding of sums that are not whole numbers.
SLACK = 1e-9


def _merged(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("key").aggregate([("part", "sum")]).rename_columns(["key", "part"])


def _local_sums(node_keys: int) -> Callable:
    """A partition's partial sums, largest first: node, place in it (from 1), key, part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() << _NODE_BITS

        def sent(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.sort_by([("part", "descending"), ("key", "ascending")])
            place = np.arange(1, table.num_rows + 1)
            table = table.append_column("place", pa.array(place)).append_column("node", pa.array(np.full(len(place), node)))
            yield from table.select(["node", "place", "key", "part"]).combine_chunks().to_batches(max_chunksize=1 << 16)

        held, fresh = pa.schema([("key", pa.int64()), ("part", pa.float64())]).empty_table(), []
        for batch in batches:
            fresh.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in fresh) < max(held.num_rows, min(MERGE_ROWS, node_keys)):
                continue
            held, fresh = _merged([held, *fresh]), []
            if held.num_rows >= node_keys:
                yield from sent(held)
                node, held = node + 1, held.slice(0, 0)
        held = _merged([held, *fresh])
        if held.num_rows:
            yield from sent(held)

    return run


def partial_sums(df: DataFrame, key: str, value: str, node_keys: int = NODE_KEYS) -> DataFrame:
    """``node, place, key, part``: each node's sums by key, largest first.  Nothing is shuffled.

    Rows without a key or a value (null or NaN) do not count."""
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(value).cast("double").alias("part")).na.drop()  # NaN too
    return rows.mapInArrow(_local_sums(node_keys), "node bigint, place bigint, key bigint, part double")


def threshold_candidates(parts: DataFrame, k: int) -> DataFrame:
    """``key``: the keys that can be among the ``k`` with the largest sums of ``parts``."""
    nodes, least = parts.where("place = 1").select("node").distinct().count(), parts.agg(F.min("part")).first()[0]
    if not nodes or k < 1:
        return parts.select("key").limit(0)
    floor = min(0.0, least)  # what a node has at least where it has not sent a key

    def kth(sums: DataFrame) -> float | None:
        low = (F.col("seen") + (nodes - F.col("n")) * floor).alias("low")
        top = [r.low for r in sums.select(low).orderBy(F.desc("low")).limit(k).collect()]  # k numbers
        return top[-1] if len(top) == k else None

    def by_key(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.sum("part").alias("seen"), F.count(F.lit(1)).alias("n"))

    first = kth(by_key(parts.where(F.col("place") <= k)))
    if first is None:  # fewer than k keys in all local tops: there are no others
        return parts.select("key").distinct()
    share = first / nodes
    share -= abs(share) * SLACK
    seen = kept(by_key(parts.where(F.col("part") >= share)), "threshold")
    bound = kth(seen)
    if bound is None or bound < first:
        bound = first
    # A key that no node sent stays below `share` in each, so below the bound in all.
    unseen = max(share, 0.0)
    if unseen * nodes >= bound and share <= 0:
        return parts.select("key").distinct()
    return seen.where(F.col("seen") + (nodes - F.col("n")) * unseen >= bound - abs(bound) * SLACK).select("key")


def top_k_sums(df: DataFrame, key: str, value: str, k: int, total: str = "total", node_keys: int = NODE_KEYS) -> DataFrame:
    """``total, key``: the ``k`` keys with the largest sums of ``value``, largest
    first, then the smallest key.  Equal to summing everything and taking ``k``."""
    if k < 0:
        raise ValueError("k must be >= 0")
    parts = kept(partial_sums(df, key, value, node_keys), "partial-sums")
    candidates = kept(threshold_candidates(parts, k), "candidates")
    sums = parts.join(bounded_broadcast(candidates, CANDIDATE_BYTES), "key", "left_semi").groupBy("key").agg(F.sum("part").alias(total))
    return sums.select(total, F.col("key").alias(key)).orderBy(F.desc(total), F.asc(key)).limit(k)
