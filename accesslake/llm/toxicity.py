"""Toxicity by multiple-instance learning (operator 3).

Only documents have labels; their sentences are scored. A sentence's
probability p is logistic in its words and their beginnings, with weights that
are never negative (harmless words do not make up for others), and taken above a
base rate: p = (s(z) - s(base)) / (1 - s(base)). In training that is a sentence
without any weighted feature (base = bias); scores take one half-way from there
to an even chance (bias / 2), so that words that merely begin like a toxic one
add up to nothing in long texts. A sentence below the base has p = 0. A
document's is the noisy-or of its sentences, 1 - prod(1 - p), whatever its
length. Training on document labels thus finds the sentences that explain them,
and `offending` returns those. Toxic labels that no sentence explains go to a leak, one
probability for each document whatever its length, which scores leave out.

Training takes a bounded sample of the different labelled texts, the first by hash:
MAX_TRAIN_ROWS of each label, and fewer if they hold more than half of MAX_TRAIN_CHARS;
it weighs them back to the labels' true shares. A text that alone holds more is not
learned from.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, in_fold, materialize, restored, text_or_empty
from accesslake.operators.joins import lookup_join

HELD_OUT = (5, 0)
# Labelled rows of each label that are trained on (chosen by a hash of the row),
# and the most characters that their texts hold together, whole texts.
MAX_TRAIN_ROWS = 1_500
MAX_TRAIN_CHARS = 20_000_000
# Labels are broadcast up to so many (and 256 MB, checked), and joined by a salted shuffle beyond.
MAX_BROADCAST_LABELS = 500_000
# A feature in fewer sampled texts than this says nothing.
MIN_TEXTS = 4
PREFIXES = (3, 4, 5)
ROUNDS, RATE, RIDGE = 120, 0.15, 2e-5
START_BIAS = START_LEAK = -6.0
# What a weight of 1 costs, in log-likelihood of one toxic row: words that stand
# in a toxic text or two by chance get no weight, and so add nothing to long texts.
SPARSITY = 1.0
# Sentence features whose gradient is worked at once.
FEATURES_AT_ONCE = 4_000_000
KEPT_WORDS = 300_000
ROWS_AT_ONCE = 500

_SENTENCE = re.compile(r"[^.!?\n]+(?:[.!?]+|\n|$)")
_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A word itself and its beginnings."""
    return ["=" + word] + ["^" + word[:n] for n in PREFIXES if len(word) > n]


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the runs between sentence ends or line ends that hold a word."""
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(text, *m.span())]


def words(sentence: str) -> list[str]:
    return _WORD.findall(sentence.lower())


class Model:
    """Weights of the features that training kept, and the bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "known": {}}

    def word(self, w: str) -> float:
        z = self.known.get(w)
        if z is None:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            z = self.known[w] = sum(self.weights.get(f, 0.0) for f in features(w))
        return z

    def sentence_scores(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        spans = sentences(text)
        above = np.array([sum(map(self.word, words(text[a:b]))) for a, b in spans], dtype=np.float64)
        base = max(self.bias, self.bias / 2)
        above = np.maximum(above + self.bias - base, 0)
        return spans, -np.expm1(-above) / (1 + np.exp(-np.clip(above + base, -50, 50)))

    def text_score(self, text: str) -> float:
        _, p = self.sentence_scores(text)
        return noisy_or(p)


def noisy_or(p: np.ndarray) -> float:
    """1 - prod(1 - p); 0 without sentences."""
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-15)).sum())) + 0.0 if len(p) else 0.0


def common_features(texts: list[str]) -> dict[str, int]:
    """Features of at least MIN_TEXTS texts, numbered; counted by hash first, so
    that the many rare ones are never held as strings."""
    slots = 1 << 22
    rough = np.zeros(slots, dtype=np.int32)
    for text in texts:
        rough[np.unique(np.array([xxhash.xxh3_64_intdigest(f) % slots for w in set(words(text)) for f in features(w)], dtype=np.int64))] += 1
    exact: Counter[str] = Counter()
    for text in texts:
        exact.update({f for w in set(words(text)) for f in features(w) if rough[xxhash.xxh3_64_intdigest(f) % slots] >= MIN_TEXTS})
    return {f: i for i, f in enumerate(sorted(f for f, n in exact.items() if n >= MIN_TEXTS))}


def fit(texts: list[str], labels: list[int], weights: list[float]) -> Model:
    """Full-batch Adam on the noisy-or likelihood of the document labels."""
    index = common_features(texts)
    cache: dict[str, list[int]] = {}
    feats = array("i")
    sentence_sizes: list[int] = []
    doc_sizes: list[int] = []
    for text in texts:
        spans = sentences(text)
        for a, b in spans:
            before = len(feats)
            for w in dict.fromkeys(words(text[a:b])):
                f = cache.get(w)
                if f is None:
                    f = cache[w] = [index[x] for x in features(w) if x in index]
                feats.extend(f)
            sentence_sizes.append(len(feats) - before)
        doc_sizes.append(len(spans))
    f = np.frombuffer(feats, dtype=np.int32) if feats else np.zeros(0, dtype=np.int32)
    sizes, per_doc = np.array(sentence_sizes, dtype=np.int64), np.array(doc_sizes, dtype=np.int64)
    of_doc = np.repeat(np.arange(len(per_doc)), per_doc)
    # Runs of whole sentences, worked one after another: (sentences, features).
    ends = np.cumsum(sizes)
    cuts = [0, *(np.nonzero(np.diff(ends // FEATURES_AT_ONCE))[0] + 1).tolist(), len(sizes)]
    runs = [(slice(a, b), slice(int(ends[a] - sizes[a]), int(ends[b - 1]))) for a, b in zip(cuts, cuts[1:]) if b > a]
    y, n = np.array(labels, dtype=float), np.array(weights, dtype=float)
    cost = SPARSITY * float(n[y > 0].mean()) if y.any() else 0.0
    theta = np.zeros(len(index) + 2)  # features, bias, leak
    theta[-2:] = START_BIAS, START_LEAK
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1 if len(sizes) else 1):
        bias, leak = 1 / (1 + np.exp(-np.clip(theta[-2:], -30, 30)))
        z = np.full(len(sizes), theta[-2])
        for of, own in runs:
            here = np.repeat(np.arange(of.stop - of.start), sizes[of])
            z[of] += np.bincount(here, weights=theta[f[own]], minlength=of.stop - of.start)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # The logarithms of 1 - p above the bias's, and of no leak.
        clean = (1 - leak) * np.exp(np.bincount(of_doc, weights=np.log1p(-p) - np.log1p(-bias), minlength=len(y)))
        slope = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0) * n
        dz = slope[of_doc] * p
        grad = np.zeros_like(theta)
        for of, own in runs:
            grad[:-2] += np.bincount(f[own], weights=np.repeat(dz[of], sizes[of]), minlength=len(index))
        grad[-2:] = (dz - slope[of_doc] * bias).sum(), slope.sum() * leak
        grad[:-2] += cost
        grad /= n.sum()
        grad[:-2] += RIDGE * theta[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        np.maximum(theta[:-2], 0, out=theta[:-2])
    return Model({x: float(theta[i]) for x, i in index.items() if theta[i]}, float(theta[-2]))


def train(documents: DataFrame, labels: DataFrame, *, held_out: tuple[int, int] = HELD_OUT, max_rows: int = MAX_TRAIN_ROWS, max_chars: int = MAX_TRAIN_CHARS) -> Model:
    """Learns from labelled documents outside the held-out fold, whole texts.

    A document with several labels is toxic if one says so; null labels, ids
    and texts teach nothing. Rows that repeat an id and text teach once. Without any
    label every sentence scores 0. The driver gets at most `max_rows` rows of each
    label and `max_chars` characters, however often rows repeat.
    """
    given = labels.where("doc_id is not null and toxic is not null").where(~in_fold(F.col("doc_id"), *held_out))
    given = given.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    hashed = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row")).where(F.length("text") > 0)
    labelled = lookup_join(hashed, given, "doc_id", "inner", max_broadcast_rows=MAX_BROADCAST_LABELS)
    # A row for each different labelled text, by a hash of it; only ids, hashes and lengths.
    distinct = materialize(labelled.groupBy("row", "toxic").agg(F.min(F.length("text")).alias("chars")), "labelled")
    counts = {r["toxic"]: r["n"] for r in distinct.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen: list[int] = []
    weight = {}
    for label, n in sorted(counts.items()):
        fits = distinct.where((F.col("toxic") == label) & (F.col("chars") <= max_chars // 2))
        # The first rows by hash: at most max_rows of them, and of max_chars / 2 characters.
        first = fits.orderBy(F.xxhash64("row"), "row").limit(max_rows).collect()
        ends = np.cumsum([r["chars"] for r in first])
        own = [r["row"] for r, end in zip(first, ends) if end <= max_chars // 2]
        chosen += own
        weight[label] = n / max(1, len(own))
    if not chosen:
        return fit([], [], [])
    names = F.broadcast(documents.sparkSession.createDataFrame([(r,) for r in chosen], "row long"))
    texts = labelled.join(names, "row").groupBy("row", "toxic").agg(F.min("text").alias("text"))
    rows = texts.orderBy("row").collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], [weight[r["toxic"]] for r in rows])


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, score (0 to 1), n_sentences, and the place and score of
    the worst sentence (worst_start, worst_end: characters; worst_score).

    A null or wordless text has no sentence and score 0. Of equally bad
    sentences the first is named. Rows are independent, repeated ones give repeated
    result rows; columns besides the two named are not looked at. An empty table gives
    an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in it:
            out = []
            for t in text_or_empty(pdf["text"]):
                spans, p = m.sentence_scores(t)
                k = int(np.argmax(p)) if len(p) else 0
                out.append((noisy_or(p), len(p), *(spans[k] if len(p) else (None, None)), float(p[k]) if len(p) else None))
            found = pd.DataFrame(out, columns=["score", "n_sentences", "worst_start", "worst_end", "worst_score"])
            found = found.astype({"worst_start": "Int64", "worst_end": "Int64"})
            found.insert(0, "id", pdf["id"].to_numpy())
            yield found

    out = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(
        run, "id string, score double, n_sentences long, worst_start long, worst_end long, worst_score double"
    )
    return restored(out, id_col, docs)


def offending(docs: DataFrame, model: Model, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sentence whose own probability reaches `threshold`: the id,
    start, end (characters), sentence and score. Rows as in `score`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in it:
            out = []
            for i, t in zip(pdf["id"], text_or_empty(pdf["text"])):
                spans, p = m.sentence_scores(t)
                out += [(i, a, b, t[a:b], float(x)) for (a, b), x in zip(spans, p) if x >= threshold]
            if out:
                yield pd.DataFrame(out, columns=["id", "start", "end", "sentence", "score"])

    out = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(run, "id string, start long, end long, sentence string, score double")
    return restored(out, id_col, docs)
