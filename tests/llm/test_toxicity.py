"""Toxicity: held-out accuracy, places of sentences, odd rows."""

import random

import pytest

from accesslake.llm import toxicity

BAD = ["scumbag", "vilewretch", "nastyfool"]


def make(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = [" ".join(f"word{rng.randint(0, 300)}" for _ in range(8)) for _ in range(rng.randint(1, 12))]
        bad = rng.random() < 0.3
        if bad:
            k = rng.randrange(len(s))
            s[k] += " " + rng.choice(BAD) + rng.choice(["", "s", "xy"])
        rows.append((i, ". ".join(s) + ".", int(bad)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make(600, 3)


@pytest.fixture(scope="module")
def model(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))


def test_held_out_accuracy(model):
    fresh = make(300, 99)
    assert sum((model.text_score(t) >= 0.5) == bool(y) for _, t, y in fresh) >= 290


def test_offending_sentences(spark, model):
    docs = spark.createDataFrame([(1, "Nice word1 here. You scumbag word2! Good word3."), (2, "word4 word5.")], "doc_id long, text string")
    out = toxicity.offending(docs, model).collect()
    assert [(r.doc_id, r.sentence.strip(), r.start) for r in out] == [(1, "You scumbag word2!", 16)]


def test_noisy_or():
    import numpy as np

    assert toxicity.noisy_or(np.array([0.5, 0.5])) == pytest.approx(0.75) and toxicity.noisy_or(np.array([])) == 0


def test_odd_rows(spark, model):
    rows = [(1, None, 1.0), (2, "", 0.0), (None, "word1", 0.0), (3, "!!! ...", 0.0), (4, "word1 " * 40000, 0.0), (4, "word1", 0.0), (4, "word1", 0.0)]
    out = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score double"), model).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id: (r.score, r.n_sentences) for r in out if r.doc_id in (1, 2, 3)} == {1: (0, 0), 2: (0, 0), 3: (0, 0)}
    assert toxicity.score(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_training_without_labels_and_odd_labels(spark):
    docs = spark.createDataFrame([(1, "a b."), (None, "c"), (3, None), (4, "bad words.")], "doc_id long, text string")
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.text_score("a b.") < 0.01
    odd = spark.createDataFrame([(1, None), (None, 1), (3, 1), (4, 0), (4, 1)], "doc_id long, toxic int")
    assert 0 <= toxicity.train(docs, odd).text_score("x") <= 1


def test_length_alone_is_not_toxic(model):
    clean = " ".join(t for _, t, y in make(12000, 7) if not y)
    spans, p = model.sentence_scores(clean)
    assert len(spans) > 40000 and model.text_score(clean) < 0.1
    at = spans[len(spans) // 2][0]
    assert model.text_score(clean[:at] + "you scumbag word2. " + clean[at:]) >= 0.5
    assert model.text_score("Nothing to say. " * 100000) == 0


def test_clean_given_texts_joined_stay_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    given = toxicity.train(docs, labels)
    texts = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").where("text is not null").orderBy("doc_id", "text").collect()]
    joined = "\n".join(t for t in texts if given.text_score(t) < 0.02) * 5
    assert len(toxicity.sentences(joined)) > 20000 and given.text_score(joined) < 0.5


def test_long_texts_are_trained_on(spark):
    # "odd" stands in every toxic text, but the long clean ones say that it is harmless.
    rows = [(i, "odd scumbag here.", 1) for i in range(60)] + [(100 + i, "odd word here. " * 20000, 0) for i in range(10)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.text_score("odd scumbag here.") >= 0.5 and model.text_score("odd here.") < 0.01
    few = toxicity.train(docs, labels, max_chars=1_000_000)  # fewer rows, not shorter ones
    assert few.text_score("odd here.") < 0.01


def test_the_driver_gets_a_bounded_sample(spark, monkeypatch):
    """However often rows repeat, and whatever their length."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, weights: seen.append((texts, labels, weights)) or toxicity.Model({}, -6.0))
    base = spark.createDataFrame([(i, f"word{i} text", i % 2) for i in range(1, 60) if i % 5], "doc_id long, text string, toxic int")
    ids = base.select("doc_id", "text")
    many = ids.where("doc_id = 1").crossJoin(spark.range(20_000)).select("doc_id", "text")
    long = spark.range(1).selectExpr("1001L as doc_id", "repeat('long ', 5000) as text")
    docs = ids.unionByName(many).unionByName(long)
    labels = base.select("doc_id", "toxic").unionByName(spark.createDataFrame([(1001, 1)], "doc_id long, toxic int"))
    toxicity.train(docs, labels, max_rows=7, max_chars=20_000)
    texts, marks, weights = seen[0]
    assert len(texts) == len(set(texts)) == 14 and marks.count(1) == 7 and all(len(t) < 100 for t in texts)
    assert all(w > 1 for w in weights)
    toxicity.train(docs, labels, max_rows=100, max_chars=600)
    texts, marks, _ = seen[1]
    assert sum(map(len, texts)) <= 600 and sum(len(t) for t, y in zip(texts, marks) if y) <= 300
