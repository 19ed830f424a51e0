"""Filter interaction audit (operator 13): five filters in all 120 orders.

1. Each document gets the mask of the filters that it fails, and documents are
   counted by part and mask, with those labelled good and toxic.
2. In the lexicographic order of the permutations, those that share a prefix are
   one interval, which starts at the prefix's Lehmer rank. A document is removed at
   step s under the permutations whose first s - 1 filters it passes and whose s-th
   it fails: its mask's intervals of that step. Each mask adds its counts at the
   start of its intervals and takes them off at the end, and a running sum over the
   120 ranks gives what every order removes at every step.
3. What is kept, redundant and lost, and the total over all orders, follows from
   these sums and from the counts by mask.

Only counts by part and mask reach step 2: 32 rows a part, whatever the input.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslake.operators.joins import lookup_join

FILTERS = "ABCDE"
N = len(FILTERS)
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
SYMBOLS = r"[#$%&*|]"
WORD_GAP = r"[\x20\x09-\x0D]+"
# First copies and labels are broadcast up to this size (checked), joined by salted shuffles beyond.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 48 << 20
COUNTS = ("n", "good", "toxic")


def lehmer_rank(prefix: tuple[int, ...], n: int = N) -> int:
    """Rank of the first permutation of 0..n-1, in lexicographic order, that starts with `prefix`."""
    return sum(sum(y < x and y not in prefix[:i] for y in range(n)) * factorial(n - 1 - i) for i, x in enumerate(prefix))


def intervals(n: int = N) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, end): the ranks start <= r < end whose permutation removes, at
    that step, documents that fail just the filters of the mask."""
    out = []
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            start = lehmer_rank(prefix, n)
            passed = sum(1 << x for x in prefix[:-1])
            for mask in range(1 << n):
                if mask >> prefix[-1] & 1 and not mask & passed:
                    out.append((mask, step, start, start + factorial(n - step)))
    return out


def mask_of_text(text: Column) -> Column:
    """Bits 0 to 3 for the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, WORD_GAP), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        100 * capitals.cast("bigint") > MAX_CAPITALS_PERCENT * F.length(text).cast("bigint"),
        text.rlike(SYMBOLS),
    ]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failed)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: documents counted by the filters that they fail."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        mask_of_text(text).alias("mask"), F.sha2(text, 256).alias("same"),
    )
    sized = {"max_broadcast_rows": MAX_BROADCAST_ROWS, "max_broadcast_bytes": MAX_BROADCAST_BYTES}
    # The least id of each text that more than one row has: a partial and a final sum.
    keys = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("same"))
    firsts = keys.groupBy("same").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("same", "first")
    marked = lookup_join(rows, firsts, "same", "left", **sized)
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    marked = marked.select("doc_id", "part", (F.col("mask") + copy * (1 << FILTERS.index("E"))).alias("mask"))
    marks = labels.groupBy("doc_id").agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic")
    ).where("doc_id is not null and (good = 1 or toxic = 1)").withColumn("doc_id", F.col("doc_id").cast(marked.schema["doc_id"].dataType))
    labelled = lookup_join(marked, marks, "doc_id", "left", **sized)
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0).cast("bigint")).alias(c)
    return labelled.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("good"), total("toxic"))


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """600 rows a part: filter_order (120 permutations), step (1 to 5) and the counts of
    documents kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    Null texts are empty texts; a null part is the part ''. A row with a null id fails
    E never and makes no other row fail it; rows that repeat an id and text pass or
    fail E together. Repeated label rows of an id count once, as good or toxic when any
    of them is; null labels are no labels. Columns besides the three named are not
    looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    by_mask = masks(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)

    # Counts at the ends of the intervals of each mask (a fixed table of 840 rows).
    ends = spark.createDataFrame(intervals(), "mask int, step int, start int, end int")
    at_ends = by_mask.join(F.broadcast(ends), "mask").select(
        "part", "step",
        F.inline(F.array(
            F.struct(F.col("start").alias("rank"), *[F.col(c) for c in COUNTS]),
            F.struct(F.col("end").alias("rank"), *[(-F.col(c)).alias(c) for c in COUNTS]),
        )),
    ).where(F.col("rank") < factorial(N))

    # Every part with every rank and step, zeros included, and what each needs of the masks.
    letters = range(N)
    facts = by_mask.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col("n"))), F.lit(0)) for i in letters]).alias("fails"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == 1 << i, F.col("n"))), F.lit(0)) for i in letters]).alias("alone"),
    )
    steps = F.sequence(F.lit(1), F.lit(N))
    grid = facts.select("part", F.explode(F.sequence(F.lit(0), F.lit(factorial(N) - 1))).alias("rank")).select("part", "rank", F.explode(steps).alias("step"))
    zeros = grid.select("part", "step", "rank", *[F.lit(0).cast("bigint").alias(c) for c in COUNTS])
    differences = at_ends.unionByName(zeros).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = differences.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])

    orders = ["".join(p) for p in permutations(FILTERS)]
    order = F.get(F.from_json(F.lit(json.dumps(orders)), "array<string>"), F.col("rank"))
    named = removed.withColumn("filter_order", order).withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    whole = named.join(facts, "part").select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.get("fails", F.instr(F.lit(FILTERS), F.col("letter")) - 1) - F.col("n")).alias("redundant"),
        F.get("alone", F.instr(F.lit(FILTERS), F.col("letter")) - 1).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"),
    )
    return whole


# DuckDB: the masks of all documents, and every order worked step by step on them.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT
             + 16 * coalesce((doc_id > min(doc_id) OVER (PARTITION BY t))::INT, 0) AS mask FROM d),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step - 1]) AS earlier FROM p, range(1, 6) r(step)),
s2 AS (SELECT filter_order, step, own, coalesce(earlier, 0)::INT AS earlier FROM s),
c AS (SELECT part, filter_order, step, own,
        sum(CASE WHEN mask & (earlier | own) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM m, s2 GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM c
"""
