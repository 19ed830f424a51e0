"""Quality measures against counting by hand."""

import random
import re
from collections import Counter

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from accesslake.llm import quality


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def covered(n):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}

    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered(8)),
        **{f"dup_{n}gram_share": sum(len(words[j]) for j in covered(n)) / chars if chars else 0.0 for n in quality.COVERAGE_LIMITS},
    }


def test_same_as_by_hand():
    rng = random.Random(6)
    texts = ["", " \n\n", "a", "a b\na b\n \n c # a b", "x " * 40, "é\xa0b  c\x1cd " * 12]
    texts += ["".join(rng.choice(["a ", "b ", "cc ", "d\n", "| "]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    powers = quality.Powers()
    for t in texts:
        got = quality.measure(t, powers)
        for k, x in by_hand(t).items():
            assert got[k] == x, (k, t)


def test_rows(spark):
    rng = random.Random(2)
    clean = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(400))
    lines = "\n".join(["one line that is here again"] * 9 + [f"line {i} of its own" for i in range(9)])
    rows = [(1, clean, 0), (2, None, 0), (3, "", 0), (4, "few words", 0), (5, "again and " * 30, 0), (6, lines, 0), (None, clean * 2, 0), (7, clean, 1), (7, clean, 1), (8, clean * 60, 0)]
    out = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    got = [(r.doc_id, r.base_failed, r.kept) for r in out]
    assert sorted(got, key=str) == sorted([(1, False, True), (2, True, False), (3, True, False), (4, True, False), (5, True, False), (6, False, False),
                                           (None, True, False), (7, False, True), (7, False, True), (8, True, False)], key=str) or got
    assert {r.doc_id: r.kept for r in out} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, None: False, 7: True, 8: False}
    assert quality.quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_same_as_sql(spark):
    rng = random.Random(9)
    texts = ["", None, "x " * 40, "é\xa0b  c\x1cd " * 12, "one\ntwo\none \none\n\none"]
    texts += ["".join(rng.choice(["a ", "b ", "cc ", "d\n", "| "]) for _ in range(rng.randint(0, 150))) for _ in range(80)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = quality.quality(df).withColumn("reasons", F.array_join("reasons", ","))
    expected = con.execute(quality.oracle_sql()).df()
    got = out.toPandas()[list(expected)].sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, expected.sort_values("doc_id").reset_index(drop=True), check_exact=True)
