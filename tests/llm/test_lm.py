"""Interpolated scores against the same model computed by hand."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from accesslake.llm import lm


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def by_hand(rows):
    fold = lambda i, r: i is not None and zlib.crc32(str(i).encode()) % 7 == r
    uni, bi = Counter(), Counter()
    for i, t in rows:
        if not fold(i, 2):
            w = tokens(t)
            uni.update(w)
            bi.update(zip([b"\n", *w], w))
    n, v = sum(uni.values()), len(uni)
    cell = lambda p: round(math.log2(p) * lm.STEPS) if p > 0 else 1
    cells = Counter()
    for i, t in rows:
        if fold(i, 3):
            w = tokens(t)
            for a, b in zip([b"\n", *w], w):
                c = uni[a] - 1
                cells[int(lm.bucket_of(np.array([c]))[0]), cell((bi[a, b] - 1) / c if c else 0), cell((uni[b] - 1) / max(n - 1, 1))] += 1
    weights = lm.learn_weights(pd.DataFrame([(*k, x) for k, x in sorted(cells.items())], columns=["bucket", "q2", "q1", "n"]), v)
    out = []
    for i, t in rows:
        w = tokens(t)
        score = 0.0
        for a, b in zip([b"\n", *w], w):
            l2, l1, l0 = weights[int(lm.bucket_of(np.array([uni[a]]))[0])]
            score += math.log10(l2 * bi[a, b] / max(uni[a], 1) + l1 * uni[b] / max(n, 1) + l0 / (v + 1))
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        out.append((i, fold(i, 2), len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def check(spark, rows, **limits):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int").repartition(3)
    got = sorted(map(tuple, lm.score(df, **limits).collect()), key=str)
    expected = sorted(by_hand(rows), key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5:] for g in got] == [pytest.approx(e[5:]) for e in expected]


def test_same_as_by_hand(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["The", "cat", "sat", f"w{rng.randint(0, 60)}", "é\xa0x"]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "THE the " * 3000), (203, "a"), (203, "a"), (None, "the cat")]
    check(spark, rows)
    check(spark, rows, chunk_bytes=1500)


def test_little_or_nothing(spark):
    check(spark, [(1, "a b"), (2, None)])
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_probabilities_sum_to_one():
    weights = lm.learn_weights(pd.DataFrame({"bucket": [3, 3, 0], "q2": [-4, 1, 1], "q1": [-8, -10, 1], "n": [5, 2, 1]}), 100)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and (weights >= 0).all()


def test_better_than_unigrams_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = [r for r in lm.score(df).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_without_training_text_probabilities_are_one(spark):
    import zlib

    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    got = lm.score(spark.createDataFrame([(i, "a b c") for i in held], "doc_id long, text string")).collect()
    assert [(r.held_out, r.n_tokens, r.train_tokens, r.base_score, r.score) for r in got] == [(True, 4, 0, 0.0, 0.0)] * 5


def test_rows_repeated_very_often(spark):
    """One row 30,000 times is scored once a batch, and counted as often as it occurs."""
    many = spark.range(30_000).selectExpr("cast(null as long) as doc_id", "'a b a' as text")
    rest = spark.createDataFrame([(i, f"a c{i}") for i in range(1, 60)], "doc_id long, text string")
    df = many.unionByName(rest).repartition(4)
    got = lm.score(df, chunk_bytes=20_000)
    rows = got.groupBy("doc_id", "n_tokens", "train_tokens", "score").count().collect()
    repeated = [r for r in rows if r.doc_id is None]
    held = sum(r.held_out for r in got.where("doc_id is not null").collect())
    assert len(repeated) == 1 and repeated[0]["count"] == 30_000 and len(rows) == 60
    assert {r.train_tokens for r in rows} == {30_000 * 4 + (59 - held) * 3}
