"""Near-duplicates against brute force over all pairs."""

import random
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from accesslake.llm import graph, minhash


def sets_of(text, size):
    words = [w for w in (text or "").encode().lower().split()]
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_force(rows, size, percent):
    sets = {i: sets_of(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def drifting(rng, n):
    """Copies of copies: neighbours are close, the ends of a chain are not."""
    out = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(120))]
    for _ in range(n - 1):
        words = rng.choice(out[-6:]).split()
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9999)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [t for n in (90, 25, 2, 3) for t in drifting(rng, n)]
    texts += [texts[3]] * 30 + ["One two", "one  TWO", "one", "", None, "  \n", "a b c", "a b c d"]
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


def check(spark, rows, **limits):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = minhash.near_duplicates(df, shingle_size=3, percent=85, **limits).collect()
    expected = brute_force(rows, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected
    assert len(out) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_same_as_all_pairs(spark, rows):
    check(spark, rows)


def test_units_worked_in_blocks(spark, rows):
    check(spark, rows, max_unit_classes=8)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, shingle_size=3, percent=85).collect()}
    assert out == brute_force([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], 3, 85)
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert {i: (n, c) for i, n, c, _ in con.execute(minhash.ORACLE_SQL).fetchall()} == out


def test_odd_rows(spark):
    rows = [(None, "a b c", 1), (7, "A B\tc", 2), (7, "A B\tc", 2), (3, "x", 0), (None, "q", 0), (9, None, 5), (4, "z " * 20000, 1)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, kept int"), shingle_size=3, percent=85).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=str)
    assert got == sorted([(None, 1, 7, False), (7, 1, 7, True), (7, 1, 7, True), (3, 1, 3, True), (None, 1, None, True), (9, 0, 9, True), (4, 1, 4, True)], key=str)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60, 1)] + [(100 + i, 100) for i in range(1, 40)] + [(5, 5), (200, 201), (201, 200), (None, 3)]
    out = graph.components(spark.createDataFrame(chain, "u long, v long"))
    assert out.groupBy("component").agg(F.count("*").alias("n")).orderBy("component").collect() == [(0, 60), (100, 39), (200, 1)]
