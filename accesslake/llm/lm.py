"""Bigram scoring by deleted interpolation (operator 9).

P(w | v) = l2 c(v w) / c(v) + l1 c(w) / N + l0 / (V + 1), with weights by the
bucket (power of two) of the context's frequency c(v). They are learned by
expectation-maximisation on a deleted part of the training documents, each
event counted with itself taken out of the corpus.

Counts are gathered over the whole corpus in chunks of documents (dealt by a
hash of the row, of about CHUNK_BYTES of text). Rows that repeat an id and text are
one row with a number from the first task on, so copies fill no chunk. Each chunk
asks for the distinct
words and word pairs it holds, as sorted 64-bit keys cut into key ranges; a
task per range adds up all chunks' training counts and answers each chunk with
the totals in the order it asked. Keys of a frequent word or pair come once for
each chunk, however often it occurs, so no range is hot. A chunk then scores
its documents on its own. Nothing but the weights' histogram (bounded by its
cells) and the corpus totals reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, in_fold, materialize, restored, text_or_empty
from accesslake.llm.minhash import mixed

HELD_OUT = (7, 2)
# The part of the training documents that the weights are learned on.
DELETED = (7, 3)
CHUNK_BYTES = 6 << 20
EM_ROUNDS = 40
MAX_BUCKET = 48
# Histogram cells: steps of log2 of the two probabilities.
STEPS = 2
# The end of a text, and the context of its first word: no word is white space.
END = xxhash.xxh3_64_intdigest(b"\n")


class Tables:
    """Words and word pairs of some texts: sorted keys, and each token's place among them."""

    def __init__(self, texts: list[str]):
        index: dict[bytes, int] = {b"\n": 0}
        each = [np.array([index.setdefault(w, len(index)) for w in t.encode().lower().split()] + [0], dtype=np.int32) for t in texts]
        w = np.concatenate(each).astype(np.int64) if each else np.zeros(0, np.int64)
        self.ends = np.cumsum([len(x) for x in each], dtype=np.int64)
        del each
        v = np.concatenate([np.zeros(1, np.int64), w[:-1]]) if len(w) else w
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in index), dtype=np.uint64, count=len(index))
        order = np.argsort(hashes, kind="stable")
        self.word_keys = hashes[order]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.w, self.v = place[w], place[v]
        pairs, inverse = np.unique(v * len(index) + w, return_inverse=True)
        keys = mixed(hashes[pairs // len(index)] * np.uint64(0x9E3779B97F4A7C15) + hashes[pairs % len(index)])
        order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[order]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.pair = place[inverse]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a per-token array over each text."""
        return np.add.reduceat(values, self.ends - np.diff(self.ends, prepend=0)) if len(self.ends) else values[:0]


def planes(values: np.ndarray) -> bytes:
    """Bytes of an integer array, all first bytes first: long runs of zeros for small values."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(blob: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _bounds(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)


def _requests(chunk: int, deleted: bool, tables: Tables, copies: np.ndarray, parts: int) -> Iterator[tuple]:
    """`copies`: how often each text counts."""
    weights = np.repeat(copies.astype(np.float64), np.diff(tables.ends, prepend=0))
    bounds = _bounds(parts)
    for kind, keys, places in ((0, tables.word_keys, tables.w), (1, tables.pair_keys, tables.pair)):
        counts = np.bincount(places, weights=weights, minlength=len(keys)).astype(np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(keys, bounds, side="left"), [len(keys)]])
        for part in np.nonzero(np.diff(cuts))[0]:
            a, b = cuts[part], cuts[part + 1]
            steps = np.diff(keys[a:b], prepend=np.uint64(0))
            yield chunk, deleted, kind, int(part), planes(steps), planes(counts[a:b]) if counts[a:b].any() else None


def _ask(parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = _unpacked(pdf["packed"])
        chunk = int(pdf["chunk"].iloc[0])
        rows = list(_requests(chunk, False, Tables(texts), np.where(pdf["held_out"].to_numpy(bool), 0, pdf["copies"].to_numpy()), parts))
        some = pdf["deleted"].to_numpy(bool)
        if some.any():
            texts = [t for t, d in zip(texts, some) if d]
            rows += _requests(chunk, True, Tables(texts), np.zeros(len(texts)), parts)
        return pd.DataFrame(rows, columns=["chunk", "deleted", "kind", "part", "keys", "counts"])

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = [np.cumsum(from_planes(k, "<u8"), dtype=np.uint64) for k in pdf["keys"]]
    counts = [np.zeros(len(k)) if c is None else from_planes(c, "<u8").astype(np.float64) for k, c in zip(keys, pdf["counts"])]
    _, places = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(places, weights=np.concatenate(counts)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    kind, part = int(pdf["kind"].iloc[0]), int(pdf["part"].iloc[0])
    rows = [(int(c), bool(d), kind, part, planes(totals[places[e - len(k) : e]]), None, None) for c, d, k, e in zip(pdf["chunk"], pdf["deleted"], keys, ends)]
    rows.append((None, False, kind, part, None, int(np.count_nonzero(totals)), int(totals.sum())))
    return pd.DataFrame(rows, columns=["chunk", "deleted", "kind", "part", "totals", "types", "tokens"])


def _totals(answers: pd.DataFrame, kind: int, expected: int) -> np.ndarray:
    own = answers[answers["kind"] == kind].sort_values("part")
    found = np.concatenate([from_planes(b, "<i8") for b in own["totals"]]) if len(own) else np.zeros(0, np.int64)
    if len(found) != expected:
        raise RuntimeError("a chunk was not answered in full")
    return found.astype(np.float64)


def _pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pack = zstandard.ZstdCompressor(level=3)
    for pdf in it:
        pdf["text"] = text_or_empty(pdf["text"])
        copies = pdf.groupby(["id", "text"], dropna=False, sort=False)["chunk"].transform("size").astype(np.int64)
        pdf = pdf.assign(copies=copies).drop_duplicates(["id", "text"])
        yield pdf.drop(columns="text").assign(packed=[pack.compress(t.encode()) for t in pdf["text"]])


def _unpacked(blobs: pd.Series) -> list[str]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(b).decode() for b in blobs]


def bucket_of(c: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2(frequency))."""
    return np.minimum(np.where(c > 0, np.floor(np.log2(np.maximum(c, 1))) + 1, 0), MAX_BUCKET).astype(np.int64)


def _events(n_tokens: int, n_types: int):
    """Histogram of a chunk's deleted events: context bucket and both probabilities."""

    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["bucket", "q2", "q1", "n"])
        t = Tables(_unpacked(docs["packed"]))
        words, pairs = _totals(answers, 0, len(t.word_keys)), _totals(answers, 1, len(t.pair_keys))
        context = words[t.v] - 1
        p2 = np.where(context > 0, (pairs[t.pair] - 1) / np.maximum(context, 1), 0)
        p1 = (words[t.w] - 1) / max(n_tokens - 1, 1)
        cell = lambda p: np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300)) * STEPS), 1).astype(np.int64)
        n = np.repeat(docs["copies"].to_numpy(), np.diff(t.ends, prepend=0))
        out = pd.DataFrame({"bucket": bucket_of(context), "q2": cell(p2), "q1": cell(p1), "n": n})
        return out.groupby(["bucket", "q2", "q1"])["n"].sum().reset_index()

    return run


def learn_weights(cells: pd.DataFrame, n_types: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """(l2, l1, l0) by bucket, by expectation-maximisation on a histogram of
    events (bucket, q2, q1, n); q > 0 stands for a probability of zero.

    A bucket without events takes the weights of all events together, and
    without any events the three weights are equal. A context never seen has
    no l2. Without any training word only l0 is left.
    """
    if not n_types:
        return np.tile([0.0, 0.0, 1.0], (MAX_BUCKET + 1, 1))
    p = np.stack([np.where(cells[q] > 0, 0.0, np.exp2(cells[q] / STEPS)) for q in ("q2", "q1")] + [np.full(len(cells), 1 / (n_types + 1))], axis=1)
    n, bucket = cells["n"].to_numpy(np.float64), cells["bucket"].to_numpy()

    def fit(start: np.ndarray, some: np.ndarray) -> np.ndarray:
        weights = start
        for _ in range(rounds if some.any() else 0):
            share = p[some] * weights
            gained = (share / share.sum(axis=1, keepdims=True) * n[some, None]).sum(axis=0)
            weights = gained / gained.sum()
        return weights

    every = fit(np.full(3, 1 / 3), np.ones(len(cells), bool))
    out = np.stack([fit(every, bucket == b) for b in range(MAX_BUCKET + 1)])
    out[0, 0] = 0
    if out[0].sum() == 0:
        out[0] = (0, 0, 1)
    out[0] /= out[0].sum()
    return out


def _scores(weights: np.ndarray, n_tokens: int, n_types: int):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "held_out", "copies", "n_tokens", "n_known", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame(columns=columns)
        t = Tables(_unpacked(docs["packed"]))
        words, pairs = _totals(answers, 0, len(t.word_keys)), _totals(answers, 1, len(t.pair_keys))
        base = np.log10((words + 1) / (n_tokens + n_types + 1))
        context = words[t.v]
        w2, w1, w0 = weights[bucket_of(context)].T
        p = w2 * pairs[t.pair] / np.maximum(context, 1) + w1 * words[t.w] / max(n_tokens, 1) + w0 / (n_types + 1)
        return pd.DataFrame({
            "id": docs["id"], "held_out": docs["held_out"], "copies": docs["copies"], "n_tokens": np.diff(t.ends, prepend=0),
            "n_known": t.per_text((words[t.w] > 0).astype(np.int64)), "base_score": t.per_text(base[t.w]), "score": t.per_text(np.log10(p)),
        })[columns]

    return run


def score(docs: DataFrame, *, held_out: tuple[int, int] = HELD_OUT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams) and score (interpolated bigrams), log10.

    Words are cut at ASCII white space, A-Z lower-cased, and every text ends
    with one end token. A null text counts as empty: its end token only. A null
    doc_id is in no fold, so its text is learned from. Repeated rows are
    counted and scored as rows of their own. Without any training text all
    probabilities are one. Columns besides doc_id and text are not looked at;
    an empty table gives an empty result.
    """
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-n_bytes // chunk_bytes))
    dealt = docs.select(
        carried("doc_id"), in_fold(F.col("doc_id"), *held_out).alias("held_out"), in_fold(F.col("doc_id"), *DELETED).alias("deleted"),
        F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(chunks)).alias("chunk"), "text",
    )
    packed = dealt.mapInPandas(_pack, "id string, held_out boolean, deleted boolean, chunk long, copies long, packed binary")
    asked = packed.groupBy("chunk").applyInPandas(_ask(chunks), "chunk long, deleted boolean, kind int, part int, keys binary, counts binary")
    answered = asked.groupBy("kind", "part").applyInPandas(_answer, "chunk long, deleted boolean, kind int, part int, totals binary, types long, tokens long")
    answers = materialize(answered, "counts")
    row = answers.where("chunk is null and kind = 0").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    n_types, n_tokens = row["types"] or 0, row["tokens"] or 0
    answers = answers.where("chunk is not null").select("chunk", "deleted", "kind", "part", "totals")

    def with_answers(texts: DataFrame, deleted: bool, fn, schema: str) -> DataFrame:
        own = answers.where(F.col("deleted") == deleted)
        return texts.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInPandas(fn, schema)

    events = with_answers(packed.where("deleted"), True, _events(n_tokens, n_types), "bucket long, q2 long, q1 long, n long")
    cells = events.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).orderBy("bucket", "q2", "q1").toPandas()
    weights = learn_weights(cells, n_types)
    scored = with_answers(
        packed, False, _scores(weights, n_tokens, n_types),
        "id string, held_out boolean, copies long, n_tokens long, n_known long, base_score double, score double",
    )
    scored = scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return restored(scored, "doc_id", docs).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
