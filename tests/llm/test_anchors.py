"""SimHash near-duplicates by anchors, against all pairs by brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from accesslake.llm import anchors


def plain_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, threshold=4):
    """{row number: least id reachable} by all pairs of fingerprints."""
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= threshold:
            group[root(a)] = root(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        ids = [j for j in (least.get(root(x)), i) if j is not None]
        least[root(x)] = min(ids, default=None)
    return [(i, f"{fps[x]:016x}", least[root(x)]) for x, (i, _) in enumerate(rows)]


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.6:
            w = rng.choice(out)[1].split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 999)}"
        else:
            w = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([1, 3, 4, 40, 150]))]
        out.append((i, " ".join(w)))
    rng.shuffle(out)
    return out


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("blocks", [2, 3, 5])
def test_same_as_all_pairs(spark, blocks):
    rows = texts(400, blocks)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(anchors.near_duplicates(df, blocks=blocks)) == sorted(plain_components(rows), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_large_anchors_are_worked_again(spark, levels):
    rows = texts(300, 9) + [(1000 + i, " ".join(["same text"] * 60 + [f"end{i}"])) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(anchors.near_duplicates(df, max_members=3, max_levels=levels)) == sorted(plain_components(rows), key=str)


def test_every_close_pair_meets_at_an_anchor(spark):
    """Random fingerprints and ones up to four bits away, all links against brute force."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 150, dtype=np.int64)
    flip = [int(b) ^ sum(1 << int(p) for p in rng.choice(63, k, replace=False)) for k, b in enumerate(np.resize(base, 600) * 1) for k in [k % 6]]
    fps = sorted({int(x) for x in base} | set(flip))
    expected = {(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for blocks in (1, 2, 3, 4):
        if blocks == 1:
            continue
        groups = anchors.gathered(df, 4, blocks, 1_000_000, 1)
        met = groups.where("home").alias("a").join(groups.alias("b"), "key").where("a.fp != b.fp and bit_count(a.fp ^ b.fp) <= 4")
        got = {tuple(sorted(r)) for r in met.select("a.fp", "b.fp").collect()}
        assert got == expected and expected


def test_the_code_covers():
    for positions, reach in (([1, 2, 3], 2), (list(range(10, 31)), 2), (list(range(22)), 2)):
        code = anchors.Code(positions, reach)
        assert all(ways and ways[0].bit_count() <= anchors.COVERING_RADIUS for ways in code.ways)
        assert sum(map(len, code.ways)) == sum(1 for k in range(reach + 1) for _ in combinations(positions, k))


def test_blocks_and_paths():
    assert sorted(sum(anchors.cut(list(range(64)), 3), [])) == list(range(64))
    left = anchors.positions_of("10", 3)
    assert len(left) == 64 - 21 - 15 and not set(left) & set(range(22, 43))


def test_forest_connects_groups_cut_by_batches(spark):
    rows = [(k, 16 * k + j, j == 0) for k in range(300) for j in range(3)]
    df = spark.createDataFrame(rows, "key long, fp long, home boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {tuple(r) for r in anchors.links(df, 2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(16 * k + j, 16 * k) for k in range(300) for j in (1, 2)}


def test_fingerprint_is_sparks_xxhash64(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("ünï cödé x y"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest("ünï cödé x y".encode(), 42)
    for t in (None, "", "  \t\n", "One", "a b c d e", "x " * 70_000, "A\x0bB\x0cc d e"):
        assert anchors.fingerprint(t or "") == plain_fingerprint(t)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(5, None), (3, ""), (9, " \n"), (None, ""), (7, long), (2, long + " tail"), (2, long + " tail"), (None, "alone in null land"), (1, "Case CASE case one"), (8, "case case case one")]
    df = spark.createDataFrame([(t, 1, 2, i, 3) for i, t in rows], "text string, fp int, least int, doc_id int, component_id int")
    out = anchors.near_duplicates(df)
    assert dict(out.dtypes)["doc_id"] == "int" and result(out) == sorted(plain_components(rows), key=str)


def test_empty_table(spark):
    out = anchors.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.collect() == []
