"""Sharding by Karmarkar-Karp differencing (operator 8), law `bytes`.

Rows with equal texts form one indivisible group. A partial partition is a list
of parts with byte sums; each group starts as one with a single filled part.
Differencing takes the two with the largest spread and joins them, the fullest
part of one with the emptiest of the other, until one is left.

It runs as a tree: groups are dealt into buckets of bounded size, each bucket is
differenced in a task of its own, and what is left of the buckets (one partial
partition each, with a number of sums equal to the shards) is differenced again
up the tree. Each task holds at most `FAN_IN` partial partitions.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslake.llm.common import materialize
from accesslake.operators.joins import lookup_join

# Groups that one task differences, and partial partitions that one task joins
# further up. Each holds as many sums as there are shards.
GROUPS_PER_BUCKET = 20_000
FAN_IN = 2_000
# Rows that one task numbers: a shard is numbered in pieces.
ROWS_PER_PIECE = 200_000
# Groups and their shards are broadcast up to this size (checked).
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
OVERHEAD_BYTES = 16


def difference(sums: list[np.ndarray], shards: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Joins partial partitions until one is left.

    `sums` holds an array of `shards` part sums for each. Returns, for each, the
    part of the result that each of its parts went to, and the result's sums in
    ascending order.
    """
    n = len(sums)
    sums = [np.asarray(s, dtype=np.int64) for s in sums]
    orders = [np.argsort(s, kind="stable") for s in sums]
    # A tree of joins; `take` maps a node's ascending parts to the parent's.
    state = {i: s[o] for i, (s, o) in enumerate(zip(sums, orders))}
    heap = [(-int(s[-1] - s[0]), i) for i, s in state.items()]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, np.ndarray]] = {}
    new = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        left, right = state.pop(a), state.pop(b)
        joined = left + right[::-1]
        order = np.argsort(joined, kind="stable")
        to = np.empty(shards, dtype=np.int64)
        to[order] = np.arange(shards)
        parent[a], parent[b] = (new, to), (new, to[::-1])
        state[new] = joined[order]
        heapq.heappush(heap, (-int(state[new][-1] - state[new][0]), new))
        new += 1
    # From the root down: where each node's parts end up.
    root = heap[0][1]
    final = {root: np.arange(shards)}
    for node in sorted(parent, reverse=True):
        up, to = parent[node]
        final[node] = final[up][to]
    placed = []
    for i in range(n):
        to = np.empty(shards, dtype=np.int64)
        to[orders[i]] = final[i]
        placed.append(to)
    return placed, state[root]


def place_groups(sizes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each group, and the part sums; equal to `difference` of
    partial partitions that hold one group each, without their empty parts.

    While only single groups are joined, a partial partition is kept as its
    filled parts: joining the fullest with the emptiest leaves them apart as
    long as there are empty parts.
    """
    n = len(sizes)
    parent = np.full(2 * n, -1, dtype=np.int64)
    moved: list[np.ndarray | None] = [None] * (2 * n)
    state: dict[int, np.ndarray] = {i: np.array([s], dtype=np.int64) for i, s in enumerate(sizes)}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    new = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        left, right = state.pop(a), state.pop(b)
        # Aligned to the full length, left ascending and right descending.
        size = min(shards, len(left) + len(right))
        joined = np.zeros(size, dtype=np.int64)
        at_left = np.arange(size - len(left), size)
        at_right = np.arange(len(right) - 1, -1, -1)
        joined[at_left] += left
        joined[at_right] += right
        order = np.argsort(joined, kind="stable")
        to = np.empty(size, dtype=np.int64)
        to[order] = np.arange(size)
        parent[a] = parent[b] = new
        moved[a], moved[b] = to[at_left], to[at_right]
        s = state[new] = joined[order]
        heapq.heappush(heap, (-int(s[-1] - (s[0] if size == shards else 0)), new))
        new += 1
    root = heap[0][1]
    size = len(state[root])
    final: dict[int, np.ndarray] = {root: np.arange(shards - size, shards)}
    place = np.empty(n, dtype=np.int64)
    for node in range(root, -1, -1):
        if node != root:
            final[node] = final[int(parent[node])][moved[node]]
    for i in range(n):
        place[i] = final[i][0]
    sums = np.zeros(shards, dtype=np.int64)
    sums[shards - size :] = state[root]
    return place, sums


def _bucket(pdf: pd.DataFrame, shards: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True])
    place, _ = place_groups(pdf["bytes"].to_numpy(), shards)
    return pd.DataFrame({"node": pdf["bucket"], "key": pdf["key"], "part": place})


def _join(pdf: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Rows (node, part, bytes) of the nodes below one parent: where each part goes."""
    table = pdf.pivot_table(index="node", columns="part", values="bytes", aggfunc="sum").reindex(columns=range(shards)).fillna(0).sort_index()
    placed, _ = difference([r for r in table.to_numpy().astype(np.int64)], shards)
    return pd.DataFrame({
        "node": np.repeat(table.index.to_numpy(), shards), "part": np.tile(np.arange(shards), len(table)),
        "up": np.int64(pdf["up"].iloc[0]), "up_part": np.concatenate(placed),
    })


def shard(docs: DataFrame, shards: int = 40, *, groups_per_bucket: int = GROUPS_PER_BUCKET, fan_in: int = FAN_IN, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """One row per input row: doc_id, size (UTF-8 bytes plus 16), text_crc32, shard and slot
    (0 to the shard's rows less one, each once).

    Equal texts go to one shard, so a group larger than the mean shard fixes the
    fullest one. Null texts have no bytes and form a group with the empty ones.
    Repeated rows are rows like any other, each with a slot of its own. Slots
    follow hashed pieces, then doc_id (nulls first). Columns besides doc_id and
    text are not looked at. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = materialize(
        docs.select("doc_id", (F.octet_length(text) + OVERHEAD_BYTES).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("key")),
        "sizes",
    )
    by_text = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    n_groups, n_rows = by_text.agg(F.count("*")).first()[0], rows.count()
    n_buckets = -(-n_groups // groups_per_bucket) or 1
    dealt = by_text.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n_buckets)))
    placed = materialize(
        dealt.groupBy("bucket").applyInPandas(lambda pdf: _bucket(pdf, shards), "node long, key string, part long").join(by_text, "key"), "placed"
    )
    # Up the tree: `where` maps each bucket's parts to those of the level reached.
    where = sums = None
    nodes = n_buckets
    while True:
        below = placed.groupBy("node", "part").agg(F.sum("bytes").alias("bytes")) if sums is None else sums
        below = below.withColumn("up", F.expr(f"node div {fan_in}"))
        moves = materialize(below.groupBy("up").applyInPandas(lambda pdf: _join(pdf, shards), "node long, part long, up long, up_part long"), "moves")
        if where is None:
            where = moves.select(F.col("node").alias("bucket"), F.col("part").alias("start"), F.col("up").alias("node"), F.col("up_part").alias("part"))
        else:
            where = where.join(moves, ["node", "part"]).select("bucket", "start", F.col("up").alias("node"), F.col("up_part").alias("part"))
        nodes = -(-nodes // fan_in)
        if nodes <= 1:
            break
        sums = below.join(moves.drop("up"), ["node", "part"]).groupBy(F.col("up").alias("node"), F.col("up_part").alias("part")).agg(F.sum("bytes").alias("bytes"))
    groups = placed.select("key", F.col("node").alias("bucket"), F.col("part").alias("start")).join(
        where.select("bucket", "start", F.col("part").alias("shard")), ["bucket", "start"]
    )
    pieces = max(1, -(-n_rows // (rows_per_piece * shards)) * 4)
    # Rows that repeat an id and text are one row with its copies from here on: a sum, not
    # a hot group. A hot text's rows find their shard by a broadcast or a salted join.
    distinct = rows.groupBy("doc_id", "size", "text_crc32", "key").agg(F.count(F.lit(1)).alias("copies"))
    shard_of = groups.select("key", F.col("shard").cast("int").alias("shard"))
    found = lookup_join(distinct, shard_of, "key", "inner", max_broadcast_rows=MAX_BROADCAST_ROWS, max_broadcast_bytes=MAX_BROADCAST_BYTES)
    located = materialize(found.withColumn("piece", F.pmod(F.xxhash64("doc_id", "key"), F.lit(pieces))), "located")
    sizes = located.groupBy("shard", "piece").agg(F.sum("copies").alias("n"))
    before = sizes.select("shard", "piece", (F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")).alias("before"))
    inside = F.sum("copies").over(Window.partitionBy("shard", "piece").orderBy("doc_id", "key")) - F.col("copies")
    placed_rows = located.withColumn("inside", inside).join(before, ["shard", "piece"]).withColumn("first", F.col("before") + F.col("inside"))
    # Many copies are laid out in parts, each of which any task may take.
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(rows_per_piece).cast("bigint")))
    parts = placed_rows.select("doc_id", "size", "text_crc32", "shard", "first", "copies", part.alias("from"))
    if not located.where(F.col("copies") > rows_per_piece).isEmpty():
        parts = parts.repartition("shard", "first", "from")
    slot = F.explode(F.sequence(F.col("first") + F.col("from"), F.col("first") + F.least(F.col("from") + rows_per_piece, F.col("copies")) - 1))
    return parts.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
