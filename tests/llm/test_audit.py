"""Filter audit against SQL and against every order worked row by row."""

import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from accesslake.llm import audit

SF = "/root/testdata/sf0.001"
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def rows_of(df):
    assert df.columns == list(COLUMNS)
    return sorted(map(tuple, df.collect()))


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, lang in docs:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
        }
        failing.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, total = [], Counter()
    for part in sorted({p for p, *_ in failing}):
        own = [x for x in failing if x[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                all_failing = [x for x in own if f in x[1]]
                total[part, f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), len(all_failing) - len(gone), sum(x[1] == {f} for x in own),
                            sum(x[2] for x in gone), sum(x[3] for x in gone)])
    return sorted((*r, total[r[0], r[1][r[2] - 1]]) for r in out)


def test_same_as_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rel = con.sql(f"select {', '.join(COLUMNS)} from ({audit.ORACLE_SQL})")
    got = rows_of(audit.audit(docs, labels))
    assert got == sorted(rel.fetchall()) and len(got) % 600 == 0 and got


def test_odd_rows(spark):
    many = " ".join(f"w{i}" for i in range(250))
    docs = [(1, None, None), (2, "", "en"), (3, many, "en"), (4, many, "de"), (4, many, "de"), (None, many, "en"), (5, many.upper() + " #", "en"), (None, None, ""),
            (6, "same " * 300, "de"), (7, "same " * 300, "de"), (8, "ünï cödé\x0bX", "fr"), (9, "$" * 100_000, "fr"), (3, many, "en")]
    labels = [(3, 1, 0), (3, 0, 1), (4, None, 1), (None, 1, 1), (7, 1, None), (77, 1, 1)]
    df = spark.createDataFrame([(t, i, p, 1, 2, 3) for i, t, p in docs], "text string, doc_id long, lang string, mask int, same int, first int")
    marks = spark.createDataFrame([(*r, 0, 0) for r in labels], "doc_id long, quality int, toxic int, good int, part int")
    assert rows_of(audit.audit(df, marks)) == plain(docs, labels)


def test_hot_copies_through_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(audit, "MAX_BROADCAST_ROWS", 0)
    docs = [(i, "the same text" if i % 3 else f"text {i} #", "en") for i in range(600)]
    labels = [(i, i % 2, (i + 1) % 2) for i in range(0, 600, 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert rows_of(audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))) == plain(docs, labels)


def test_ranks_and_intervals():
    for n in (1, 2, 3, 4, 5):
        orders = list(permutations(range(n)))
        assert [audit.lehmer_rank(p, n) for p in orders] == list(range(len(orders)))
        covered = Counter((mask, rank) for mask, _, start, end in audit.intervals(n) for rank in range(start, end))
        assert covered == {(mask, rank): 1 for mask in range(1, 1 << n) for rank in range(len(orders))}
        for mask, step, start, end in audit.intervals(n):
            for p in orders[start:end]:
                assert next(k for k, x in enumerate(p, 1) if mask >> x & 1) == step


@pytest.mark.parametrize("empty", ["documents", "labels"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([] if empty == "documents" else [(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([] if empty == "labels" else [(1, 1, 1)], "doc_id long, quality int, toxic int")
    got = rows_of(audit.audit(docs, labels))
    assert got == ([] if empty == "documents" else plain([(1, "a", "en")], []))
