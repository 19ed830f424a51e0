"""Benchmark decontamination (operator 4), DataFrame functions only.

A document leaks a benchmark item when some run of words, as long as the item,
has a weighted (multiset) Jaccard similarity of at least 0.8 with it over
five-word shingles.

1. Documents become arrays of shingle hashes. A bitmap of the benchmark's
   shingles marks the places that any window could match on; a second one, of
   shingles with the length of their item, marks them per item length. Windows
   with too few marked shingles to reach the threshold are passed over; as the
   bitmaps have false marks but never miss one, no window that could match is.
2. Every other window, sized as the items of that length, gets a 64-bit SimHash
   of its shingles, each repeat told apart by its number: weighted similarity is
   then plain similarity, and one repeated shingle cannot swing many bits.
   Fingerprints are cut into radius + 1 blocks: two within the radius agree on
   some block, so an equi-join on length, block and value finds every item
   fingerprint within the radius.
3. The pairs' similarity is computed on their full shingle multisets.

No document is shuffled: only windows found near the benchmark are.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.operators.joins import fits_broadcast

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# At a similarity of 0.8 two fingerprints differ in 10 bits on average (standard
# deviation 2.9): beyond 19 bits with probability 3e-4, and less for closer texts.
RADIUS = 19
# Bitmap bits for each benchmark shingle (each sets two in one word), and the most
# bits (a fuller bitmap lets more windows through and never loses one).
BITS_PER_SHINGLE = 32
MAX_BITS = 1 << 18
# Item fingerprint blocks, and item shingles, are broadcast up to these sizes.
MAX_BROADCAST_BLOCKS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20
# Three counters of 22 bits (the last of 20) share a 64-bit sum up to so many hashes, two of 32 beyond.
SHORT_MOST = (1 << 20) - 1


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(w: str, k: int) -> Column:
    """64-bit hashes of the runs of k words of the array column `w`, in order."""
    word = F.col(w)

    def one(i: Column) -> Column:
        return F.xxhash64(*[F.get(word, i + j) for j in range(k)])

    return F.when(F.size(word) >= k, F.transform(F.sequence(F.lit(0), F.size(word) - k), one)).otherwise(F.array().cast("array<bigint>"))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row, however often it is read.

    A generator keeps the optimizer from copying its expression into the
    lambdas that use it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def numbered(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """Adds the hashes with each repeat hashed once more with its number: all distinct."""
    h = F.col(hashes)
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    df = _once(df, "ordered", F.when(repeats, F.sort_array(h)))
    number = lambda x, i: i + 1 - F.array_position("ordered", x)
    apart = F.transform("ordered", lambda x, i: F.when(number(x, i) == 0, x).otherwise(F.xxhash64(x, number(x, i))))
    return _once(df, name, F.when(F.col("ordered").isNull(), h).otherwise(apart)).drop("ordered")


def counters(hashes: Column, width: int) -> Column:
    """How many hashes have each bit, counters of `width` bits side by side in 64-bit sums."""
    mask = sum(1 << f for f in range(0, 64, width))

    def total(g: Column) -> Column:
        one = lambda acc, h: acc + F.call_function("shiftrightunsigned", h, g).bitwiseAND(F.lit(mask))
        return F.aggregate(hashes, F.lit(0).cast("bigint"), one)

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), total)


def fingerprint(totals: Column, n: Column, width: int) -> Column:
    """64-bit SimHash of n hashes: a bit is set when more than half of them have it."""

    def with_bit(acc: Column, b: Column) -> Column:
        sum_of = F.get(totals, b % width)
        count = F.call_function("shiftrightunsigned", sum_of, (b - b % width).cast("int")).bitwiseAND(F.lit((1 << width) - 1))
        return acc.bitwiseOR(F.when(count * 2 > n, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), with_bit)


def with_fingerprint(df: DataFrame, hashes: str, name: str, most: int) -> DataFrame:
    """Adds the SimHash of a column of `most` hashes at most."""
    width = 22 if most <= SHORT_MOST else 32
    counted = _once(numbered(df, hashes, "apart"), "totals", counters(F.col("apart"), width))
    return counted.withColumn(name, fingerprint(F.col("totals"), F.size(hashes), width)).drop("totals", "apart")


def block_layout(radius: int) -> list[tuple[int, int]]:
    """(offset, width) of radius + 1 blocks of a 64-bit fingerprint."""
    n = radius + 1
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def block_values(fp: Column, radius: int) -> list[Column]:
    return [F.shiftrightunsigned(fp, o).bitwiseAND(F.lit((1 << w) - 1)) for o, w in block_layout(radius)]


def _word_and_bits(h: Column, bits: int) -> tuple[Column, Column]:
    """Place of a hash's 64-bit word in a bitmap, and the two bits that it sets there."""

    def bit(at: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int"))

    return h.bitwiseAND(F.lit(bits // 64 - 1)).cast("int"), bit(40).bitwiseOR(bit(52))


def _bitmap(hashes: DataFrame, bits: int) -> Column:
    """`bits` bits (at most MAX_BITS) in which column `h` of `hashes` is marked, as one
    constant: an expression that the optimizer folds to a single value."""
    word, mask = _word_and_bits(F.col("h"), bits)
    rows = hashes.select(word.alias("at"), mask.alias("mask")).groupBy("at").agg(F.bit_or("mask").alias("mask")).collect()
    masks = [0] * (bits // 64)
    for r in rows:
        masks[r["at"]] = r["mask"]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def _marked(bitmap: Column, h: Column, bits: int) -> Column:
    word, mask = _word_and_bits(h, bits)
    return mask.bitwiseAND(F.bitwise_not(F.get(bitmap, word))) == 0


def _bits_for(n: int) -> int:
    bits = 1 << 12
    while bits < min(n * BITS_PER_SHINGLE, MAX_BITS):
        bits *= 2
    return bits


def _with_size(documents: DataFrame, items: DataFrame, k: int, n_items: int, n_shingles: int, lengths: list[int], threshold: float, radius: int) -> DataFrame:
    """Leaks of the items whose shingles have k words."""
    of_items = items.select(F.explode("hashes").alias("h"), "m")
    bits = _bits_for(n_shingles)
    any_item = _bitmap(of_items.select("h"), bits)
    by_length = _bitmap(of_items.select(F.xxhash64("h", "m").alias("h")), bits)
    share = threshold / (1 + threshold)

    docs = _once(documents, "hashes", shingles("words", k)).drop("words")
    n = F.size("hashes")
    marks = F.filter(F.sequence(F.lit(0), n - 1), lambda i: _marked(any_item, F.get(F.col("hashes"), i), bits))
    docs = _once(docs, "marks", F.when(n > 0, marks).otherwise(F.array().cast("array<int>")))
    # A window of s shingles matches an item of m with share * (m + s) common ones
    # at least, so with `few` at least, and some `few` marks in a row lie within
    # `span`: s is at most need / (2 share), and holds (need - 1) div (few - 1) such
    # rows side by side.
    few = max(1, math.ceil(threshold * min(lengths) - 1e-9))
    span = math.ceil((2 * few - 1) / (2 * share))
    docs = docs.where(F.size("marks") >= few)
    dense = F.exists(F.sequence(F.lit(0), F.size("marks") - few), lambda a: F.get(F.col("marks"), a + (few - 1)) - F.get(F.col("marks"), a) <= span)
    docs = docs.where(F.when(F.size("marks") >= few, dense))

    per_length = docs.select("*", F.explode(F.array(*[F.lit(m) for m in lengths])).alias("m"))
    per_length = per_length.where(F.size("marks") >= F.ceil(threshold * F.col("m") - 1e-9))
    own = F.filter("marks", lambda p: _marked(by_length, F.xxhash64(F.get(F.col("hashes"), p), F.col("m")), bits))
    per_length = _once(per_length, "own", own)
    size = F.least(F.col("m"), F.size("hashes"))
    per_length = per_length.select("*", size.alias("size"), F.ceil(share * (F.col("m") + size) - 1e-9).cast("int").alias("need"))
    per_length = per_length.where(F.size("own") >= F.col("need"))
    # The a-th marked place is the first in the window, the (a + need - 1)-th is in it too.
    runs = per_length.select("*", F.posexplode("own").alias("a", "first"))
    last = F.get("own", F.col("a") + F.col("need") - 1)
    before = F.when(F.col("a") > 0, F.get("own", F.col("a") - 1)).otherwise(F.lit(-1))
    low = F.greatest(before + 1, last - F.col("size") + 1, F.lit(0))
    high = F.least(F.col("first"), F.size("hashes") - F.col("size"))
    runs = runs.select("doc_id", "row_key", "m", "size", "hashes", low.alias("low"), high.alias("high")).where("low <= high")
    windows = runs.select("doc_id", "row_key", "m", "size", "hashes", F.explode(F.sequence("low", "high")).alias("start"))
    windows = windows.select("doc_id", "row_key", "m", "start", F.slice("hashes", F.col("start") + 1, F.col("size")).alias("window"))
    windows = with_fingerprint(windows, "window", "fp", max(lengths))

    def blocks(df: DataFrame, fp: str) -> DataFrame:
        values = [F.struct(F.lit(b).alias("block"), v.alias("value")) for b, v in enumerate(block_values(F.col(fp), radius))]
        return df.select("*", F.inline(F.array(*values)))

    item_key = F.xxhash64("item_id", "hashes").alias("item_key")
    keyed = items.select("item_id", "m", "hashes", item_key)
    item_blocks = blocks(with_fingerprint(keyed, "hashes", "item_fp", max(lengths)).drop("hashes"), "item_fp")
    if fits_broadcast(item_blocks, MAX_BROADCAST_BLOCKS, MAX_BROADCAST_BYTES)[0]:
        item_blocks = F.broadcast(item_blocks)
    pairs = blocks(windows, "fp").join(item_blocks, ["m", "block", "value"])
    pairs = pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    # A pair that agrees on several blocks is taken at the first of them.
    same = [x == y for x, y in zip(block_values(F.col("fp"), radius), block_values(F.col("item_fp"), radius))]
    first_same = F.coalesce(*[F.when(s, F.lit(b)) for b, s in enumerate(same)])
    pairs = pairs.where(F.col("block") == first_same)

    item_hashes = keyed.select("item_key", F.col("hashes").alias("item_hashes"))
    if 8 * n_shingles + 256 * n_items <= MAX_BROADCAST_BYTES:
        item_hashes = F.broadcast(item_hashes)
    counted = pairs.join(item_hashes, "item_key").select(
        "doc_id", "row_key", "start", "item_id", "item_key", F.size("window").alias("n_window"),
        F.explode(F.concat(
            F.transform("window", lambda h: F.struct(h.alias("h"), F.lit(1).alias("w"), F.lit(0).alias("i"))),
            F.transform("item_hashes", lambda h: F.struct(h.alias("h"), F.lit(0).alias("w"), F.lit(1).alias("i"))),
        )).alias("x"),
    )
    window_key = ["doc_id", "row_key", "start", "item_id", "item_key", "n_window"]
    weights = counted.groupBy(*window_key, "x.h").agg(F.sum("x.w").alias("w"), F.sum("x.i").alias("i"))
    similar = weights.groupBy(*window_key).agg((F.sum(F.least("w", "i")) / F.sum(F.greatest("w", "i"))).alias("similarity"))
    return similar.where(F.col("similarity") >= threshold).select(
        "doc_id", "row_key", "item_id", "similarity", F.col("start").cast("bigint").alias("start_word"), (F.col("n_window") + k - 1).cast("bigint").alias("n_words")
    )


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    threshold: float = THRESHOLD,
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    by_text: bool = False,
) -> DataFrame:
    """One row for each document and benchmark item it holds: doc_id, item_id,
    similarity and place (start_word, n_words; the first among the best windows).
    With `by_text`, one row for each document id, text and item: column row_hash,
    the text's xxhash64, follows doc_id.

    Null and blank texts, of documents or items, match nothing. An item of
    fewer words than a shingle is one shingle of its own length. A document
    shorter than an item is one window. Repeated rows give one result row; rows
    with a null id are matched under the null id. Columns besides the ids and
    texts are not looked at; empty tables give an empty result.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    items = items.withColumn("k", F.least(F.size("words"), F.lit(shingle_words)))
    docs = documents.select("doc_id", F.xxhash64("text").alias("row_key"), F.explode(F.array(words(F.col("text")))).alias("words"))
    lengths = items.groupBy("k", (F.size("words") - F.col("k") + 1).alias("m")).agg(F.count("*").alias("n")).collect()
    found = []
    for k in sorted({r["k"] for r in lengths}):
        own = [r for r in lengths if r["k"] == k]
        of_k = _once(items.where(F.col("k") == k), "hashes", shingles("words", k)).select("item_id", "hashes", F.size("hashes").alias("m"))
        found.append(_with_size(docs, of_k, k, sum(r["n"] for r in own), sum(r["n"] * r["m"] for r in own), sorted(r["m"] for r in own), threshold, radius))
    if not found:
        doc, item = (f"{c} {df.schema[c].dataType.simpleString()}" for c, df in (("doc_id", documents), ("item_id", benchmark)))
        return documents.sparkSession.createDataFrame([], f"{doc}, {'row_hash long, ' if by_text else ''}{item}, similarity double, start_word long, n_words long")
    every = reduce(DataFrame.unionByName, found)
    best = F.max_by(F.struct("similarity", "start_word", "n_words"), F.struct("similarity", -F.col("start_word")))
    key = ["doc_id", *(["row_hash"] if by_text else []), "item_id"]
    return every.withColumnRenamed("row_key", "row_hash").groupBy(*key).agg(best.alias("best")).select(*key, "best.*")


# DuckDB: every window of each document that shares a shingle with an item,
# compared in full (items here have at least five words).
ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM benchmark),
ds AS (SELECT doc_id, len(ws) - 4 AS n, p, array_to_string(ws[p + 1 : p + 5], ' ') AS s
       FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 4)) AS p FROM dw WHERE len(ws) >= 5)),
its AS (SELECT item_id, len(ws) - 4 AS m, array_to_string(ws[p + 1 : p + 5], ' ') AS s
       FROM (SELECT item_id, ws, unnest(range(0, len(ws) - 4)) AS p FROM iw WHERE len(ws) >= 5)),
ic AS (SELECT item_id, m, s, count(*) AS c FROM its GROUP BY ALL),
near AS (SELECT DISTINCT ds.doc_id, ds.n, ic.item_id, ic.m FROM ds JOIN ic USING (s)),
win AS (SELECT doc_id, item_id, m, least(m, n) AS size, unnest(range(0, n - least(m, n) + 1)) AS start FROM near),
wc AS (SELECT w.doc_id, w.item_id, w.m, w.size, w.start, ds.s, count(*) AS c
       FROM win w JOIN ds ON ds.doc_id = w.doc_id AND ds.p >= w.start AND ds.p < w.start + w.size GROUP BY ALL),
sim AS (SELECT wc.doc_id, wc.item_id, wc.start, wc.size, wc.m, sum(least(wc.c, coalesce(ic.c, 0))) AS common
        FROM wc LEFT JOIN ic ON ic.item_id = wc.item_id AND ic.s = wc.s GROUP BY ALL),
ok AS (SELECT doc_id, item_id, common / (m + size - common) AS similarity, start, size FROM sim
       WHERE common / (m + size - common) >= 0.8)
SELECT doc_id, item_id, similarity, CAST(start AS BIGINT) AS start_word, CAST(size + 4 AS BIGINT) AS n_words FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS rn FROM ok) WHERE rn = 1
"""
