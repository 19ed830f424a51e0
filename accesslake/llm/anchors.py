"""SimHash near-duplicates by anchor-point covering (operator 11).

1. A text's fingerprint is the 64-bit SimHash of its four-word shingles, repeats
   included. Equal fingerprints are one node from here on.
2. The 64 bits are cut into blocks: two fingerprints that differ in `threshold`
   bits differ in `threshold // blocks` bits of some block at most. The anchors of
   a block are the words of a covering code: a Hamming code on its first
   2^m - 1 bits, any values on the rest, so that every block value has one anchor
   within the covering radius of 1, its home.
3. A fingerprint is sent to every anchor within the covering radius plus the
   block's threshold. Where one of two close fingerprints is at home, the other
   has been sent: comparing the ones at home with all others, anchor by anchor,
   finds every link. Which anchors those are depends on the block's syndrome
   alone, so they come from a small table of bit patterns.
4. An anchor with more than `max_members` members is worked again over the bits
   outside its block, cut into blocks of their own with anchors of their own; an
   anchor that stays larger is dealt in parts. Every anchor returns a spanning
   forest of its links, never its pairs.
5. Components of the forests' links (alternating stars) give the result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, materialize, restored, text_or_empty
from accesslake.llm.graph import components
from accesslake.operators.joins import lookup_join

SHINGLE_WORDS = 4
SEED = 42
THRESHOLD = 4
BLOCKS = 3
COVERING_RADIUS = 1
# Members of an anchor that are compared as one group, and how often larger ones
# are worked again over the bits left.
MAX_MEMBERS = 4_000
MAX_LEVELS = 3
# Fingerprints and their components are broadcast up to this size (checked).
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 48 << 20
# Pairs compared at a time.
_PAIRS_AT_ONCE = 1 << 21


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles (fewer words: all of them; none: 0)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends - 1)[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: the id under its name and fp, the fingerprint as a signed 64-bit value."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            fps = np.array([fingerprint(t, size) for t in text_or_empty(pdf["text"])], dtype=np.uint64)
            yield pd.DataFrame({"id": pdf["id"], "fp": fps.view(np.int64)})

    out = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(run, "id string, fp long")
    return restored(out, id_col, docs)


# --------------------------------------------------------------------- anchors
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cut(positions: list[int], blocks: int) -> list[list[int]]:
    """Bit positions in `blocks` runs of nearly equal length."""
    sizes = [len(positions) // blocks + (i < len(positions) % blocks) for i in range(blocks)]
    ends = np.cumsum(sizes)
    return [positions[e - s : e] for s, e in zip(sizes, ends)]


class Code:
    """Covering code on some bits of a fingerprint: Hamming on the first 2^m - 1, any values on the rest."""

    def __init__(self, positions: list[int], reach: int):
        self.positions = positions
        self.m = 1
        while (1 << (self.m + 1)) - 1 <= len(positions):
            self.m += 1
        coded = (1 << self.m) - 1
        # The j-th coded bit has the syndrome j + 1, the free ones have none.
        own = [j + 1 if j < coded else 0 for j in range(len(positions))]
        self.mask = sum(1 << p for p in positions)
        self.checks = [sum(1 << positions[j] for j in range(coded) if (j + 1) >> b & 1) for b in range(self.m)]
        # Per syndrome: the bit patterns that lead from a value to an anchor within
        # `reach`, the way home (at most one bit, a coded one) first.
        self.ways: list[list[int]] = [[] for _ in range(1 << self.m)]
        for weight in range(reach + 1):
            for bits in combinations(range(len(positions)), weight):
                syndrome = reduce(lambda a, b: a ^ b, (own[j] for j in bits), 0)
                self.ways[syndrome].append(sum(1 << positions[j] for j in bits))

    def syndrome(self, fp: Column) -> Column:
        bits = [F.shiftleft(F.bit_count(fp.bitwiseAND(F.lit(_signed(c)))).bitwiseAND(F.lit(1)), b) for b, c in enumerate(self.checks)]
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    def table(self) -> Column:
        """The ways by syndrome, a constant of one value."""
        return F.from_json(F.lit(json.dumps([[_signed(w) for w in ways] for ways in self.ways])), "array<array<bigint>>")


def send(df: DataFrame, path: str, positions: list[int], threshold: int, blocks: int) -> DataFrame:
    """Rows of `df` (fp, and key and home where a larger anchor is split) sent to the
    anchors of each block of `positions`: key, path, fp, home."""
    parent = F.col("key") if "key" in df.columns else F.lit(0).cast("bigint")
    parent_home = F.col("home") if "home" in df.columns else F.lit(True)
    out = []
    for b, own in enumerate(cut(positions, blocks)):
        code = Code(own, COVERING_RADIUS + threshold // blocks)
        ways = df.select(parent.alias("parent"), "fp", parent_home.alias("at_home"), F.posexplode(F.get(code.table(), code.syndrome(F.col("fp")))).alias("i", "way"))
        anchor = F.col("fp").bitwiseXOR(F.col("way")).bitwiseAND(F.lit(_signed(code.mask)))
        key = F.xxhash64("parent", F.lit(b), anchor)
        out.append(ways.select(key.alias("key"), F.lit(f"{path}{b}").alias("path"), "fp", (F.col("at_home") & (F.col("i") == 0)).alias("home")))
    return reduce(DataFrame.unionByName, out)


def positions_of(path: str, blocks: int) -> list[int]:
    """Bits outside the blocks that a path of block numbers has used."""
    left = list(range(64))
    for b in path:
        used = set(cut(left, blocks)[int(b)])
        left = [p for p in left if p not in used]
    return left


def gathered(fps: DataFrame, threshold: int, blocks: int, max_members: int, max_levels: int) -> DataFrame:
    """key, fp, home: the groups to compare, none of them far beyond max_members."""
    now = send(fps, "", list(range(64)), threshold, blocks)
    ready = []
    for level in range(1, max_levels + 1):
        counts = now.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("path").alias("at"))
        hot = materialize(counts.where(F.col("n") > max_members), "hot_anchors")
        paths = sorted(r["at"] for r in hot.select("at").distinct().collect())  # at most blocks ** level
        if not paths:
            return reduce(DataFrame.unionByName, [*ready, now.select("key", "fp", "home")])
        ready.append(now.join(hot, "key", "left_anti").select("key", "fp", "home"))
        large = materialize(lookup_join(now, hot.select("key", "n"), "key", "inner", max_broadcast_rows=MAX_BROADCAST_ROWS), "large_anchors")
        if level == max_levels:
            break
        now = reduce(DataFrame.unionByName, [send(large.where(F.col("path") == p), p, positions_of(p, blocks), threshold, blocks) for p in paths])
    # What is still larger: the ones at home are dealt over parts, all others go to each.
    parts = F.ceil(F.col("n") / max_members)
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda p: F.struct(p.alias("part"), (F.col("home") & (F.pmod(F.xxhash64("fp"), parts) == p)).alias("home")))
    dealt = large.select("key", "fp", F.inline(every))
    return reduce(DataFrame.unionByName, [*ready, dealt.select(F.xxhash64("key", "part").alias("key"), "fp", "home")])


# --------------------------------------------------------------------- compare
def _least_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Component labels after links u-v between positions, each the least position."""
    while True:
        low = np.minimum(labels[u], labels[v])
        after = labels.copy()
        np.minimum.at(after, labels[u], low)
        np.minimum.at(after, labels[v], low)
        np.minimum.at(after, u, low)
        np.minimum.at(after, v, low)
        after = after[after]
        if np.array_equal(after, labels):
            return labels
        labels = after


def forest(key: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least of its component here) of whole groups, sorted by key."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    length = np.diff(np.concatenate((first, [len(key)])))
    begin, size = np.repeat(first, length), np.repeat(length, length)
    at_home = np.flatnonzero(home)
    labels = np.arange(len(key))
    total = np.cumsum(size[at_home])
    done = 0
    while done < len(at_home):
        upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + _PAIRS_AT_ONCE, side="right")))
        mine = at_home[done:upto]
        done = upto
        u = np.repeat(mine, size[mine])
        offset = np.arange(len(u)) - np.repeat(np.cumsum(size[mine]) - size[mine], size[mine])
        v = begin[u] + offset
        near = (np.bitwise_count(fp[u] ^ fp[v]) <= threshold) & (fp[u] != fp[v])
        if near.any():
            labels = _least_labels(labels, u[near], v[near])
    moved = np.flatnonzero(labels != np.arange(len(key)))
    return fp[moved], fp[labels[moved]]


def links(groups: DataFrame, threshold: int) -> DataFrame:
    """u, v: links that connect what is within `threshold` bits in some group."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def compare(pdf: pd.DataFrame) -> pd.DataFrame:
            u, v = forest(pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy(), threshold)
            return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)}).drop_duplicates()

        # The rows come sorted by key: all groups of a batch but its last are whole.
        for pdf in it:
            if not len(pdf):
                continue
            last = int(np.searchsorted(pdf["key"].to_numpy(), pdf["key"].iat[-1]))
            if last:
                yield compare(pd.concat([*held, pdf.iloc[:last]]))
                held = []
            elif held and held[-1]["key"].iat[-1] != pdf["key"].iat[0]:
                yield compare(pd.concat(held))
                held = []
            held.append(pdf.iloc[last:])
        if held:
            yield compare(pd.concat(held))

    return groups.repartition("key").sortWithinPartitions("key").mapInPandas(run, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    *,
    threshold: int = THRESHOLD,
    shingle_words: int = SHINGLE_WORDS,
    blocks: int = BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_members: int = MAX_MEMBERS,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """One row per input row: the id, fingerprint (16 lowercase hex digits) and
    component_id, the smallest id reachable over links of fingerprints that differ
    in `threshold` bits at most, itself included.

    Null, empty and blank texts have the fingerprint zero, and are linked like any
    other; a text with fewer words than a shingle is one shingle. Repeated rows
    give repeated result rows. A null id belongs to its component but never names
    one; a component without ids has a null component_id. Columns besides the two
    named are not looked at. An empty table gives an empty result.
    """
    found = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, size=shingle_words).withColumnRenamed(id_col, "doc_id"), "fingerprints")
    nodes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = gathered(nodes.select("fp"), threshold, blocks, max_members, max_levels)
    reached = components(links(groups, threshold), "anchor_links").withColumnRenamed("node", "fp")
    sized = {"max_broadcast_rows": MAX_BROADCAST_ROWS, "max_broadcast_bytes": MAX_BROADCAST_BYTES}
    # The least fingerprint of a component is among its nodes but not among the keys of `reached`.
    placed = materialize(nodes.join(reached, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "placed")
    linked = reached.select("component").distinct()
    names = placed.join(linked, "component", "left_semi").groupBy("component").agg(F.min("least").alias("name"))
    named = lookup_join(placed.select("component", "fp", "least"), names, "component", "left", **sized)
    named = named.select("fp", F.coalesce("name", "least").alias("component_id"))
    out = lookup_join(found, materialize(named, "named"), "fp", "left", **sized)
    return out.select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
