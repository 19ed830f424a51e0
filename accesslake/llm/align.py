"""Cross-tokenizer alignment (operator 12).

A text is encoded by a byte-level BPE (A) and a piece BPE (B). Both token
sequences spell the same bytes, and the byte offsets where a token of each ends
cut them into groups.

1. The cuts are found by divide and conquer: in an open interval of A's tokens the
   ends are probed from the middle outwards, each bisected among B's ends; the
   first that is shared is a cut, and both halves are worked alike. An interval
   without a shared end is a group. All intervals of a batch are worked side by
   side, one probe of each at a time.
2. Every cut links the tokens that end there. Links are counted by pair of ids over
   all documents: arrays per task, then partial sums.
3. The pairs that most links have are broadcast, as many as `MAX_BROADCAST_PAIRS`;
   the links of all others, which are rare and so make no hot keys, are joined with
   their counts. Both add up to the same per-document sums.

Texts are encoded once; ids of links are written to the shared folder for step 3.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from accesslake.llm.common import carried, materialize, restored, small_batches, text_or_empty

# Pairs of ids whose counts every task holds (17 bytes each).
MAX_BROADCAST_PAIRS = 500_000
# Texts are worked together up to so many characters (one text at least): their arrays
# stay in a core's cache and a worker small.
BATCH_CHARS = 200_000
_PAIR = 1 << 32
# Fixed pattern of the byte-level pre-tokenizer that `tokenizers` names "ByteLevel".
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves, all others as characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids of texts without special tokens, and the bytes of each id."""

    def __init__(self, spec: str):
        self.spec = spec
        parsed = json.loads(spec)
        alphabet = byte_level_alphabet()
        vocab = parsed["model"]["vocab"] if parsed["model"]["type"] == "BPE" else self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in alphabet for c in token):
                self.bytes[i] = bytes(alphabet[c] for c in token)
        self.sizes = np.array([len(x) for x in self.bytes], dtype=np.int64)
        self.ranked = self._ranked(parsed)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """Made when a text first needs it: it takes several times the memory of the ranks."""
        tokenizer = Tokenizer.from_str(self.spec)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def _ranked(self, spec: dict) -> tiktoken.Encoding | None:
        """The same encoder over ranks, several times faster, if ids follow the order of the merges."""
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        if ids != list(range(256, 256 + len(ids))):
            return None
        ranks = {self.bytes[i]: i for i in range(256 + len(ids))}
        return tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(ids) else None

    def encode(self, text: str) -> list[int]:
        if self.ranked is not None:
            try:
                return self.ranked.encode_ordinary(text)
            except ValueError:  # the pattern's limits; the tokenizer itself has none
                pass
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: likewise for a sentencepiece model, which adds the leading space itself."""

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.sizes = np.array([len(x) for x in self.bytes], dtype=np.int64)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


# -------------------------------------------------------------- divide and conquer
def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a_ends and b_ends, in order, of the ends that both have.

    Ends rise strictly; intervals first[i]..last[i] of a_ends, one a text, close with
    an end that both are known to share.
    """
    found = [last]
    tried = np.zeros(len(first), dtype=np.int64)
    while True:
        # An interval whose inner ends were all probed in vain is a group.
        inner = last - first
        open_ = tried < inner
        first, last, tried, inner = first[open_], last[open_], tried[open_], inner[open_]
        if not len(first):
            break
        step = (tried + 1) // 2
        probe = first + inner // 2 + np.where(tried % 2 == 1, -step, step)
        end = a_ends[probe]
        hit = b_ends[np.searchsorted(b_ends, end)] == end
        found.append(probe[hit])
        # The two halves of an interval that was cut, and the next probe in the others.
        miss = ~hit
        halves = int(hit.sum())
        first, last, tried = (
            np.concatenate((first[hit], probe[hit] + 1, first[miss])),
            np.concatenate((probe[hit], last[hit], last[miss])),
            np.concatenate((np.zeros(2 * halves, dtype=np.int64), tried[miss] + 1)),
        )
    a_cuts = np.sort(np.concatenate(found))
    return a_cuts, np.searchsorted(b_ends, a_ends[a_cuts])


# ------------------------------------------------------------------------ batches
@dataclass
class Aligned:
    """Tokens of several texts, side by side: bounds[i]..bounds[i + 1] are those of text i."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_cuts: np.ndarray  # last token of each group
    b_cuts: np.ndarray
    cut_bounds: np.ndarray

    def group_texts(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        n_a, n_b = len(self.a), len(self.b)
        out_ids = np.empty(n_a + n_b, dtype=np.int64)
        closes = np.full(n_a + n_b, ord(","), dtype=np.uint8)
        groups = len(self.a_cuts)
        a_sizes = np.diff(self.a_cuts, prepend=-1)
        b_sizes = np.diff(self.b_cuts, prepend=-1)
        # In the output a group's A tokens stand before its B tokens.
        at_a = np.arange(n_a) + np.repeat(np.concatenate(([0], self.b_cuts[:-1] + 1))[:groups], a_sizes)
        at_b = np.arange(n_b) + np.repeat(self.a_cuts + 1, b_sizes)
        out_ids[at_a], out_ids[at_b] = self.a, self.b
        closes[at_a[self.a_cuts]] = ord("|")
        closes[at_b[self.b_cuts]] = ord(";")
        digits = np.ones(len(out_ids), dtype=np.int64)
        for power in range(1, len(str(out_ids.max(initial=0)))):
            digits += out_ids >= 10**power
        ends = np.cumsum(digits + 1)
        chars = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
        chars[ends - 1] = closes
        rest = out_ids.copy()
        for k in range(int(digits.max(initial=0))):
            has = digits > k
            chars[ends[has] - 2 - k] = rest[has] % 10 + ord("0")
            rest //= 10
        stops = np.concatenate(([0], ends))[self.a_bounds + self.b_bounds]
        whole = chars.tobytes()
        return [whole[x : max(x, y - 1)] for x, y in zip(stops[:-1], stops[1:])]


def align_texts(texts: list[str], a: ByteLevel, b: Pieces) -> Aligned:
    """Tokens and cuts of texts; those that both don't spell alike have no tokens."""
    a_ids, b_ids, n_a, n_b = [], [], [], []
    for text in texts:
        x, y = [], []
        if text:
            spelled = (" " + text).encode()
            x = a.encode(" " + text)
            if b"".join([a.bytes[i] for i in x]) == spelled:
                y = b.encode(text)
            if not y or b"".join([b.bytes[i] for i in y]) != spelled:
                x, y = [], []
        a_ids.append(np.array(array("q", x)))
        b_ids.append(np.array(array("q", y)))
        n_a.append(len(x))
        n_b.append(len(y))
    ids_a, ids_b = np.concatenate(a_ids), np.concatenate(b_ids)
    a_bounds, b_bounds = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
    # The texts' bytes lie one after another, so ends rise over the whole batch.
    a_ends = np.cumsum(a.sizes[ids_a]) if len(ids_a) else np.empty(0, dtype=np.int64)
    b_ends = np.cumsum(b.sizes[ids_b]) if len(ids_b) else np.empty(0, dtype=np.int64)
    own = np.flatnonzero(np.diff(a_bounds))
    a_cuts, b_cuts = shared_cuts(a_ends, b_ends, a_bounds[own], a_bounds[own + 1] - 1)
    return Aligned(ids_a, ids_b, a_bounds, b_bounds, a_cuts, b_cuts, np.searchsorted(a_cuts, a_bounds))


def text_parts(texts: list[str]) -> Iterator[np.ndarray]:
    """Positions of texts that are worked together, in order."""
    part = np.cumsum([len(t) for t in texts], dtype=np.int64) // BATCH_CHARS
    yield from np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1) if texts else ()


@lru_cache(maxsize=2)
def tokenizers_of(a_spec: str, b_spec: bytes) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, made once a Python worker."""
    return ByteLevel(a_spec), Pieces(b_spec)


def _packed(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    little = values.astype("<u4")
    return [little[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]


SPANS = "a_ids binary, b_ids binary, a_ends binary, b_ends binary"
SUMS = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary, times binary"


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """Per row: the id, n_a, n_b, n_groups, groups_sha256, its linked id pairs (pairs:
    a << 32 | b, ascending and distinct, and times, both 64-bit) and, with `spans`,
    the ids of both sides and the number of tokens up to the end of each group, all
    packed as little-endian unsigned 32-bit integers.

    Null and empty texts, and texts whose tokens of A or B do not spell a space and the
    text, have no tokens: zeros, an empty groups_sha256 and empty arrays. Repeated rows
    give repeated result rows. Columns besides the two named are not looked at. An
    empty table gives an empty result. A text is worked whole, whatever its length.
    """
    small_batches(docs.sparkSession)
    with open(a_path, encoding="utf-8") as f:
        a_spec = f.read()
    with open(b_path, "rb") as f:
        b_spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((a_spec, b_spec))

    def rows(ids: pd.Series, texts: list[str], a: ByteLevel, b: Pieces) -> pd.DataFrame:
        x = align_texts(texts, a, b)
        pair = x.a[x.a_cuts] * _PAIR + x.b[x.b_cuts]
        pairs, times = [], []
        for i, j in zip(x.cut_bounds[:-1], x.cut_bounds[1:]):
            found, n = np.unique(pair[i:j], return_counts=True)
            pairs.append(found.astype("<i8").tobytes())
            times.append(n.astype("<i8").tobytes())
        out = {
            "id": ids, "n_a": np.diff(x.a_bounds), "n_b": np.diff(x.b_bounds), "n_groups": np.diff(x.cut_bounds),
            "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in x.group_texts()], "pairs": pairs, "times": times,
        }
        if spans:
            starts_a, starts_b = (np.repeat(s[:-1], np.diff(x.cut_bounds)) for s in (x.a_bounds, x.b_bounds))
            out |= {"a_ids": _packed(x.a, x.a_bounds), "b_ids": _packed(x.b, x.b_bounds)}
            out |= {"a_ends": _packed(x.a_cuts + 1 - starts_a, x.cut_bounds), "b_ends": _packed(x.b_cuts + 1 - starts_b, x.cut_bounds)}
        return pd.DataFrame(out)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = tokenizers_of(*shared.value)
        for pdf in it:
            texts = text_or_empty(pdf["text"])
            for own in text_parts(texts):
                yield rows(pdf["id"].iloc[own].reset_index(drop=True), [texts[i] for i in own], a, b)

    out = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(run, f"id string, {SUMS}{', ' + SPANS if spans else ''}")
    return restored(out, id_col, docs)


# -------------------------------------------------------------------- link counts
def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links of all rows that hold it), best (n is the highest of its B id)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            pair, n = (np.frombuffer(b"".join(pdf[c]), dtype="<i8") for c in ("pairs", "times"))
            found, at = np.unique(pair, return_inverse=True)
            sums = np.zeros(len(found), dtype=np.int64)
            np.add.at(sums, at, n)
            yield pd.DataFrame({"pair": found, "n": sums})

    counts = materialize(aligned.select("pairs", "times").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(_PAIR - 1)))
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row an id of B's vocabulary
    return counts.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_count(counts: DataFrame, max_pairs: int) -> int:
    """The least power of two such that at most `max_pairs` pairs have that count or more."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()  # at most 64 rows
    total, least = 0, 63
    for power, size in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        total += size
        if total > max_pairs:
            break
        least = power
    else:
        least = 0
    return 1 << min(least, 62)


def link_sums(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """Per row: the id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the
    highest count of its B id over all rows, ties included), count_sum (the counts of
    its links added up) and groups_sha256.

    Rows as for `align`; repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    aligned = align(docs, a_path, b_path, id_col=id_col, text_col=text_col, spans=False)
    aligned = materialize(aligned.withColumnRenamed(id_col, "doc_id").withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialize(pair_counts(aligned), "pair_counts")
    least = _least_count(counts, max_broadcast_pairs)
    held = counts.where(F.col("n") >= least).toPandas().sort_values("pair")
    shared = spark.sparkContext.broadcast((held["pair"].to_numpy(np.int64), held["n"].to_numpy(np.int64), held["best"].to_numpy(bool)))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, n, best = shared.value
        for pdf in it:
            links, most, total, rare, rare_times = [], [], [], [], []
            for p, t in zip(pdf["pairs"], pdf["times"]):
                pair, times = np.frombuffer(p, dtype="<i8"), np.frombuffer(t, dtype="<i8")
                at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                hit = known[at] == pair if len(known) else np.zeros(len(pair), dtype=bool)
                links.append(int(times.sum()))
                most.append(int(times[hit][best[at[hit]]].sum()))
                total.append(int((times[hit] * n[at[hit]]).sum()))
                rare.append(pair[~hit])
                rare_times.append(times[~hit])
            out = pdf.drop(columns=["pairs", "times"])
            yield out.assign(n_links=links, n_best=most, count_sum=total, rare=rare, rare_times=rare_times)

    kept = "doc_id string, row long, n_a long, n_b long, n_groups long, groups_sha256 string"
    ready = aligned.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        run, f"{kept}, n_links long, n_best long, count_sum long, rare array<long>, rare_times array<long>"
    )
    if least > 1:
        ready = materialize(ready, "known_links")
        rest = ready.select("row", F.inline(F.arrays_zip(F.col("rare").alias("pair"), F.col("rare_times").alias("times"))))
        priced = rest.join(counts.where(F.col("n") < least), "pair")
        more = priced.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
        ready = ready.join(more, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
        })
    return ready.select(
        F.col("doc_id").cast(docs.schema[id_col].dataType).alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
