"""BPE encoding and decoding (operator 6).

Encoding is exact without running the merges. A word is covered by vocabulary
tokens found in one Aho-Corasick pass; the longest token at a position is taken
when it may follow the token before it, else a shorter one, else the last token
is taken back and its end is marked dead. Two tokens may stand side by side
when merging their joint text would never merge across the place where they
meet; the answers are kept in a table. Each position is left at most once per
token that starts there, so the work is linear in the word.

Decoding copies slices of one byte buffer, by a table of offsets per id.

Normalising and cutting a text into words are those the tokenizer file
declares. A vocabulary must be one whose merge ranks grow with what they build
on, as training gives it; `Vocabulary` refuses any other.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from accesslake.llm.common import carried, restored, text_or_empty

# A tokenizer file is broadcast; larger ones are refused.
MAX_TOKENIZER_BYTES = 64 << 20
# Words whose ids a worker keeps, and pairs whose answer it keeps. Full tables
# are emptied: they change the speed and nothing else.
KEPT_WORDS = 300_000
KEPT_PAIRS = 1_000_000
ROWS_AT_ONCE = 1_000
# Fixed value: the public pattern by which word vocabularies of this kind cut a
# text, and what it comes to for printable ASCII without an apostrophe.
_KNOWN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_WORDS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9 ]+").findall
# Stands for the end-of-word mark as one character (private use area).
END = ""


class Vocabulary:
    """Tokens, merges and tables of one tokenizer file (text of its JSON)."""

    def __init__(self, spec: str):
        self.spec = spec
        self._ready = False

    def __getstate__(self):
        return {"spec": self.spec, "_ready": False}

    def prepare(self) -> Vocabulary:
        if not self._ready:
            self._build()
            self._ready = True
        return self

    def _build(self) -> None:
        spec = json.loads(self.spec)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError("a plain BPE model is needed")
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = {left + right for left, right in merges}
        self.inner: dict[int, str] = {}
        for text, i in vocab.items():
            if text not in made:
                ends = bool(self.suffix) and text.endswith(self.suffix) and len(text) > len(self.suffix)
                self.inner[i] = text[: -len(self.suffix)] + END if ends else text
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for r, (left, right) in enumerate(merges):
            a, b, new = vocab[left], vocab[right], vocab[left + right]
            if new in self.rank or a not in self.inner or b not in self.inner:
                raise ValueError("merges must build on earlier merges, each token once")
            self.inner[new] = self.inner[a] + self.inner[b]
            self.parts[new], self.rank[new], self.merged[a, b] = (a, b), r, new
        if len(set(self.inner.values())) != len(self.inner):
            raise ValueError("two tokens have the same text")

        self.length = [0] * (max(self.inner, default=-1) + 1)
        for i, t in self.inner.items():
            self.length[i] = len(t)
        own: dict[int, bool] = {}
        for i in sorted(self.inner, key=lambda i: self.rank.get(i, -1)):
            a_b = self.parts.get(i)
            own[i] = a_b is None or (own[a_b[0]] and own[a_b[1]] and self._meet(*a_b, final=i))
        self.matcher = ahocorasick.Automaton()
        for i, t in self.inner.items():
            if own[i]:
                self.matcher.add_word(t, i)
        self.matcher.make_automaton()
        self.alone = {t: i for i, t in self.inner.items() if own[i]}
        # For each token, the longest token that it starts with (-1: none).
        self.shorter = [-1] * len(self.length)
        for t, i in self.alone.items():
            self.shorter[i] = next((self.alone[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.alone), -1)

        self.tokenizer = Tokenizer.from_str(self.spec)
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must match as they stand")
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        # Words never reach over white space when the file's pattern is one that
        # drops it; then a text can be looked up piece by piece.
        pre = json.dumps(spec.get("pre_tokenizer") or {})
        self.plain_cut = '"Regex": ' + json.dumps(_KNOWN_CUT) in pre and '"use_regex": true' not in pre
        self.by_space = '"behavior": "Removed", "invert": true' in pre and "add_prefix_space\": true" not in pre and '[^\\\\s' in pre

        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        size = max(names, default=-1) + 1
        blobs = [names.get(i, "").encode() + b" " for i in range(size)]
        self.known = np.array([i in names for i in range(size)], dtype=bool)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)
        self.buffer = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}

    def _meet(self, left: int, right: int, final: int | None = None) -> bool:
        """Whether merging the joint text of two tokens never merges across their border.

        Follows both tokens from their border symbols up, in the order in which
        merging would build them. `final` is the merge that may join the two at
        the very end (to learn whether a token is built from its own text).
        """
        ups, rights = [left], [right]
        while ups[-1] in self.parts:
            ups.append(self.parts[ups[-1]][1])
        while rights[-1] in self.parts:
            rights.append(self.parts[rights[-1]][0])
        never = len(self.rank)
        while True:
            a, b = ups[-1], rights[-1]
            next_a = self.rank[ups[-2]] if len(ups) > 1 else never
            next_b = self.rank[rights[-2]] if len(rights) > 1 else never
            across = self.merged.get((a, b))
            if across is not None and (len(ups) > 1 or len(rights) > 1 or across != final):
                r = self.rank[across]
                if r < next_a and r <= next_b:  # equal ranks merge from the left
                    return False
            if next_a == next_b == never:
                return True
            (ups if next_a <= next_b else rights).pop()

    def may_follow(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._meet(left, right)
        return known

    def cover(self, word: str) -> list[int]:
        """Token ids of one word, given in the vocabulary's inner form."""
        whole = self.alone.get(word)
        if whole is not None:
            return [whole]
        length, shorter, known_pair = self.length, self.shorter, self.pairs.get
        n = len(word)
        # The token to try next at each place: the longest, then those before it.
        here = [-1] * (n + 1)
        for end, i in self.matcher.iter(word):
            here[end + 1 - length[i]] = i
        dead: set[int] = set()
        ids: list[int] = []
        p, last = 0, -1
        while p < n:
            i = here[p]
            while i >= 0:
                if p + length[i] not in dead:
                    fits = last < 0 or known_pair((last, i))
                    if fits or (fits is None and self.may_follow(last, i)):
                        break
                i = shorter[i]
            if i >= 0:
                here[p] = shorter[i]  # a token tried at a place is never tried there again
                ids.append(i)
                p += length[i]
                last = i
            else:
                dead.add(p)
                if not ids:
                    raise ValueError("a word has characters that the vocabulary lacks")
                p -= length[ids.pop()]
                last = ids[-1] if ids else -1
        return ids

    def _cut(self, text: str) -> tuple[str, list]:
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normal.normalize_str(text) if normal else text
        return text, cut.pre_tokenize_str(text) if cut else [(text, (0, len(text)))]

    def _words(self, pieces: list[str]) -> list[list[str]]:
        """The words of each piece, as the file normalises and cuts them.

        Pieces go through the tokenizer's own steps joined by spaces, in two
        calls. Those with white space of their own go one by one.
        """
        found: dict[str, list[str]] = {}
        joined = []
        for p in pieces:
            if self.plain_cut and p.isascii() and p.isprintable() and "'" not in p:
                found[p] = _PLAIN_WORDS(p.lower())
            elif p.split() == [p]:
                joined.append(p)
            else:
                found[p] = [w for w, _ in self._cut(p)[1]]
        text, words = self._cut(" ".join(joined))
        ends, at = [], -1
        for part in text.split(" "):
            at += len(part) + 1
            ends.append(at)
        lists: list[list[str]] = [[] for _ in joined]
        k = 0
        for word, (_, end) in words:
            while end > ends[k]:
                k += 1
            lists[k].append(word)
        found.update(zip(joined, lists))
        return [found[p] for p in pieces]

    def _look_up(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each new piece, kept for the texts that follow."""
        mark = END if self.suffix else ""
        if len(self.words) + len(pieces) > KEPT_WORDS:
            self.words.clear()
        found = {}
        for piece, words in zip(pieces, self._words(pieces)):
            ids: list[int] = []
            for word in words:
                ids += self.cover(word + mark)
            packed = array("I", ids)
            if sys.byteorder != "little":
                packed.byteswap()
            found[piece] = packed.tobytes()
        self.words.update(found)
        return found

    def _plain(self, text: str) -> bytes:
        pieces = text.replace("\n", " ").split(" ") if self.by_space else [text]
        words = self.words
        new = [p for p in dict.fromkeys(pieces) if p not in words]
        if new:
            kept = {p: words[p] for p in pieces if p in words} if len(words) + len(new) > KEPT_WORDS else words
            words = kept | self._look_up(new) if kept is not words else (self._look_up(new), words)[1]
        return b"".join([words[p] for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit integers."""
        if self.added_pattern is None or not any(t in text for t in self.added):
            return self._plain(text)
        out = []
        for k, part in enumerate(self.added_pattern.split(text)):
            out.append(np.array([self.added[part]], dtype="<u4").tobytes() if k % 2 else self._plain(part))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """Token texts joined by one space; unknown ids are left out."""
        ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
        ids = ids[ids < len(self.known)]
        ids = ids[self.known[ids]]
        if not len(ids):
            return ""
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        return self.buffer[np.arange(len(shift)) + shift][:-1].tobytes().decode()


def load(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(spec) > MAX_TOKENIZER_BYTES:
        raise ValueError("the tokenizer file is too large to send to every worker")
    vocabulary = Vocabulary(spec)
    declared = json.loads(spec)
    if declared.get("decoder") is not None:
        raise ValueError("only files without a decoder are read")
    return vocabulary


def encode(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, `ids_le` (binary, the token ids as little-endian
    unsigned 32-bit integers; `unpack` turns them into an array) and `decoded`
    (the text the ids decode to).

    A null text counts as empty; an empty text has no ids and decodes to the
    empty string. Rows are independent, so ties, repeated rows and null ids
    give a row each; other columns of the input are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value.prepare()
        for pdf in it:
            for at in range(0, len(pdf), ROWS_AT_ONCE):
                part = pdf.iloc[at : at + ROWS_AT_ONCE]
                ids = [v.encode(t) for t in text_or_empty(part["text"])]
                yield pd.DataFrame({"id": part["id"], "ids_le": ids, "decoded": [v.decode(x) for x in ids]})

    out = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(run, "id string, ids_le binary, decoded string")
    return restored(out, id_col, docs)


def unpack(packed):
    """Column of token ids (array<bigint>) from a column of `ids_le`."""
    n = F.length(packed) / 4

    def one(i):
        hexed = F.hex(F.substring(packed, (i * 4 + 1).cast("int"), 4))
        return F.conv(F.concat(*[F.substring(hexed, 7 - 2 * k, 2) for k in range(4)]), 16, 10).cast("bigint")

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), one)).otherwise(F.array().cast("array<bigint>"))


def digests(encoded: DataFrame, *, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """n_tokens and the SHA-256 of the ids and of the decoded text, and the columns `keep`."""
    return encoded.select(
        id_col,
        F.expr("length(ids_le) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *keep,
    )
