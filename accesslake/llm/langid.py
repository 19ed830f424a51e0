"""Language identification by segmentation-marginalised unigrams (operator 5).

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. The language with
the highest posterior (equal priors) is predicted.

Piece probabilities are learned by expectation-maximisation: forward-backward
gives expected piece counts per language on training texts, summed by Spark.
Training takes a bounded sample of labelled rows, MAX_TRAIN_ROWS per language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, in_fold, restored, text_or_empty

HELD_OUT = (4, 2)
UNDETERMINED = "und"
# Labelled rows per language that are trained on (chosen by a hash of the row).
MAX_TRAIN_ROWS = 2_000
EM_ROUNDS = 2
# Added to every expected count.
SMOOTHING = 0.01
# Longer words are worked apart, by logarithms, this many characters of so many
# words (or of so many characters in all, when every place is kept) at once.
MAX_WORD_CHARS = 32
CHARS_AT_ONCE = 512
LONG_WORDS_AT_ONCE, LONG_CHARS_AT_ONCE = 500, 4_000_000
KEPT_WORDS = 800_000
WORDS_AT_ONCE = 16_000
# Probabilities are multiplied by this for each character, so that a word's stay
# far from the ends of the floating-point range; it is divided out at the end.
SCALE = 64.0
ROWS_AT_ONCE = 500
WORD_START = "▁"


def public_pieces(model_file: str) -> list[str]:
    """The plain pieces of a sentencepiece model file that can occur inside a lower-case word."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return [p for p in pieces if p == p.lower() and WORD_START not in p[1:]]


class Lattice:
    """All segmentations of words into vocabulary pieces; an unknown character
    is one piece, the last of the table."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.unknown = len(pieces)
        self.lengths = np.array([len(p) for p in pieces] + [1], dtype=np.int64)
        self._matcher = None

    def __getstate__(self):
        return {"pieces": self.pieces, "unknown": self.unknown, "lengths": self.lengths, "_matcher": None}

    @property
    def matcher(self):
        if self._matcher is None:
            self._matcher = ahocorasick.Automaton()
            for i, p in enumerate(self.pieces):
                self._matcher.add_word(p, i)
            self._matcher.make_automaton()
            self.single = {p for p in self.pieces if len(p) == 1}
        return self._matcher

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(word, start, end, piece) of every match, grouped by end, then by length."""
        matcher = self.matcher
        joined = "\n".join(words) + "\n"
        found = np.fromiter(chain.from_iterable(matcher.iter(joined)), dtype=np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        strange = [i for i, c in enumerate(joined) if c != "\n" and c not in self.single] if not set(joined) <= self.single | {"\n"} else []
        if strange:
            end = np.concatenate([end, np.array(strange) + 1])
            piece = np.concatenate([piece, np.full(len(strange), self.unknown)])
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        word = np.repeat(np.arange(len(words)), sizes + 1)[end - 1]
        end = end - starts[word]
        length = self.lengths[piece]
        base = int(self.lengths.max()) + 1
        key = end * base + length
        order = np.argsort(key.astype(np.int16) if (max(map(len, words), default=0) + 1) * base < 1 << 15 else key, kind="stable")
        return word[order], (end - length)[order], end[order], piece[order]

    @staticmethod
    def _steps(start: np.ndarray, end: np.ndarray) -> list[slice]:
        """Runs of edges with the same start and end: at most one per word each."""
        cuts = np.nonzero((np.diff(end) != 0) | (np.diff(start) != 0))[0] + 1
        cuts = [0, *cuts.tolist(), len(end)]
        return [slice(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]

    def scaled(self, logp: np.ndarray) -> np.ndarray:
        """Piece probabilities, times SCALE for each character."""
        return np.exp(logp + self.lengths[:, None] * np.log(SCALE))

    def forward(self, words: list[str], p: np.ndarray, edges=None) -> np.ndarray:
        """Scaled sums over segmentations up to each place: (place, word, language)."""
        word, start, end, piece = edges or self.edges(words)
        alpha = np.zeros((max(map(len, words), default=0) + 1, len(words), p.shape[1]))
        alpha[0] = 1
        for s in self._steps(start, end):
            w = word[s]
            alpha[end[s.start]][w] += alpha[start[s.start]][w] * p[piece[s]]
        return alpha

    def _long(self, words: list[str], limit: int) -> Iterator[tuple[list[int], np.ndarray]]:
        """Numbers and sizes of the words over MAX_WORD_CHARS, longest first, some at a time."""
        left = sorted((i for i, w in enumerate(words) if len(w) > MAX_WORD_CHARS), key=lambda i: -len(words[i]))
        while left:
            n = max(1, min(LONG_WORDS_AT_ONCE, limit // len(words[left[0]])))
            yield left[:n], np.array([len(words[i]) for i in left[:n]])
            left = left[n:]

    def _edges_from(self, words: list[str], at: int) -> tuple[np.ndarray, ...]:
        """Edges that end at the next CHARS_AT_ONCE places after `at`; words come longest first."""
        low = max(0, at - int(self.lengths.max()))
        some = [w[low : at + CHARS_AT_ONCE] for w in words if len(w) > at]
        word, start, end, piece = self.edges(some)
        own = end + low > at
        return word[own], start[own] + low, end[own] + low, piece[own]

    def _logs(self, p: np.ndarray) -> np.ndarray:
        return np.log(p) - self.lengths[:, None] * np.log(SCALE)

    def _long_log_probability(self, words: list[str], sizes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """As `log_probability` for long words: only the places that a piece reaches back to are kept."""
        back = int(self.lengths.max())
        out = np.zeros((len(words), logp.shape[1]))
        alpha = np.full((back + CHARS_AT_ONCE + 1, len(words), logp.shape[1]), -np.inf)
        alpha[back] = 0
        for at in range(0, int(sizes[0]), CHARS_AT_ONCE):  # row `back` is place `at`
            word, start, end, piece = self._edges_from(words, at)
            start, end = start - at + back, end - at + back
            for s in self._steps(start, end):
                w = word[s]
                alpha[end[s.start]][w] = np.logaddexp(alpha[end[s.start]][w], alpha[start[s.start]][w] + logp[piece[s]])
            done = np.nonzero((sizes > at) & (sizes <= at + CHARS_AT_ONCE))[0]
            out[done] = alpha[sizes[done] - at + back, done]
            alpha[: back + 1] = alpha[CHARS_AT_ONCE:].copy()
            alpha[back + 1 :] = -np.inf
        return out

    def _long_expected(self, words: list[str], sizes: np.ndarray, weights: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """As `expected` for long words."""
        alpha = np.full((int(sizes[0]) + 1, len(words)), -np.inf)
        beta = alpha.copy()
        alpha[0] = 0
        beta[sizes, np.arange(len(words))] = 0
        places = range(0, int(sizes[0]), CHARS_AT_ONCE)
        for at in places:
            word, start, end, piece = self._edges_from(words, at)
            for s in self._steps(start, end):
                w = word[s]
                alpha[end[s.start]][w] = np.logaddexp(alpha[end[s.start]][w], alpha[start[s.start]][w] + logp[piece[s]])
        total = alpha[sizes, np.arange(len(words))]
        out = np.zeros(len(self.lengths))
        for at in reversed(places):
            word, start, end, piece = self._edges_from(words, at)
            for s in reversed(self._steps(start, end)):
                w = word[s]
                beta[start[s.start]][w] = np.logaddexp(beta[start[s.start]][w], beta[end[s.start]][w] + logp[piece[s]])
            share = np.exp(alpha[start, word] + logp[piece] + beta[end, word] - total[word]) * weights[word]
            out += np.bincount(piece, weights=share, minlength=len(out))
        return out

    def log_probability(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Logarithm of the sum over all segmentations of each word: (word, language)."""
        if any(len(w) > MAX_WORD_CHARS for w in words):
            out = np.zeros((len(words), p.shape[1]))
            short = [i for i, w in enumerate(words) if len(w) <= MAX_WORD_CHARS]
            if short:
                out[short] = self.log_probability([words[i] for i in short], p)
            logp = self._logs(p)
            for some, sizes in self._long(words, 1 << 62):
                out[some] = self._long_log_probability([words[i] for i in some], sizes, logp)
            return out
        sizes = np.array([len(w) for w in words])
        return np.log(self.forward(words, p)[sizes, np.arange(len(words))]) - sizes[:, None] * np.log(SCALE)

    def expected(self, words: list[str], weights: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected count of each piece in one language (`p`: one column)."""
        if any(len(w) > MAX_WORD_CHARS for w in words):
            short = [i for i, w in enumerate(words) if len(w) <= MAX_WORD_CHARS]
            out = self.expected([words[i] for i in short], weights[short], p) if short else np.zeros(len(self.lengths))
            logp = self._logs(p)[:, 0]
            for some, sizes in self._long(words, LONG_CHARS_AT_ONCE):
                out = out + self._long_expected([words[i] for i in some], sizes, weights[some], logp)
            return out
        edges = self.edges(words)
        word, start, end, piece = edges
        alpha = self.forward(words, p, edges)[:, :, 0]
        sizes = np.array([len(w) for w in words])
        beta = np.zeros(alpha.shape)
        beta[sizes, np.arange(len(words))] = 1
        for s in reversed(self._steps(start, end)):
            w = word[s]
            beta[start[s.start]][w] += beta[end[s.start]][w] * p[piece[s], 0]
        total = alpha[sizes, np.arange(len(words))]
        share = alpha[start, word] * p[piece, 0] * beta[end, word] / total[word] * weights[word]
        return np.bincount(piece, weights=share, minlength=len(self.lengths))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _bounded_sample(labelled: DataFrame, limit: int) -> DataFrame:
    """About `limit` rows of each language at most, chosen by a hash of the row."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rate = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, limit / n)))]) if counts else None
    if rate is None:
        return labelled
    return labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.element_at(rate, F.col("lang")) * 1_000_000)


class Model:
    def __init__(self, lattice: Lattice, languages: list[str], logp: np.ndarray):
        self.lattice, self.languages, self.scaled = lattice, languages, lattice.scaled(logp)


def train(documents: DataFrame, pieces: list[str], *, held_out: tuple[int, int] = HELD_OUT, max_rows: int = MAX_TRAIN_ROWS, rounds: int = EM_ROUNDS) -> Model:
    """Learns from the rows outside the held-out fold that have a language.

    A null text or one without a letter teaches nothing, and a language all of whose
    texts are such is not learned. Repeated rows teach as often as they occur in the
    sample; an empty table teaches no language.
    """
    rows = documents.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold(F.col("doc_id"), *held_out))
    rows = _bounded_sample(rows, max_rows)
    lattice = Lattice(pieces)
    languages: list[str] = []
    logp = np.full((len(pieces) + 1, 1), -np.log(len(pieces) + 1))
    for _ in range(rounds):
        shared = documents.sparkSession.sparkContext.broadcast((lattice, languages, lattice.scaled(logp)))

        def count(it: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            lattice, languages, p = shared.value
            totals: dict[str, np.ndarray] = {}
            for pdf in it:
                for lang, part in pdf.groupby("lang"):
                    if languages and lang not in languages:  # no text of it has a letter
                        continue
                    table = p[:, [languages.index(lang)]] if languages else p
                    words: Counter[str] = Counter()
                    for t in part["text"]:
                        if has_letter(t):
                            words.update(words_of(t))
                    found = sorted(words)
                    for at in range(0, len(found), WORDS_AT_ONCE):
                        some = found[at : at + WORDS_AT_ONCE]
                        got = lattice.expected([WORD_START + w for w in some], np.array([words[w] for w in some], dtype=float), table)
                        totals[lang] = totals.get(lang, 0) + got
            for lang, got in totals.items():
                seen = np.nonzero(got)[0]
                yield pd.DataFrame({"lang": lang, "piece": seen, "n": got[seen]})

        summed = rows.select("text", "lang").mapInPandas(count, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        languages = sorted(summed["lang"].unique())
        counts = np.full((len(pieces) + 1, max(1, len(languages))), SMOOTHING)
        for k, lang in enumerate(languages):
            own = summed[summed["lang"] == lang].sort_values("piece")
            counts[own["piece"].to_numpy(dtype=np.int64), k] += own["n"].to_numpy(dtype=float)
        logp = np.log(counts / counts.sum(axis=0))
        if not languages:
            break
    return Model(lattice, languages, logp)


class Identifier:
    """A model with the words scored so far, for one task."""

    def __init__(self, model: Model):
        self.model = model
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and posterior of each text."""
        langs, scores = [], []
        for at in range(0, len(texts), ROWS_AT_ONCE):
            self._predict(texts[at : at + ROWS_AT_ONCE], langs, scores)
        return langs, scores

    def _predict(self, texts: list[str], langs: list[str], scores: list[float]) -> None:
        m = self.model
        known = [t if m.languages and has_letter(t) else None for t in texts]
        words = [words_of(t) if t else [] for t in known]
        if len(self.index) > KEPT_WORDS:
            self.index, self.table = {}, self.table[:0]
        new = list(set().union(*words).difference(self.index))
        found = [self.table]
        for k in range(0, len(new), WORDS_AT_ONCE):
            found.append(m.lattice.log_probability([WORD_START + w for w in new[k : k + WORDS_AT_ONCE]], m.scaled))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.table = np.concatenate(found)
        for t, ws in zip(known, words):
            if t is None:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            total = self.table[np.fromiter(map(self.index.__getitem__, ws), dtype=np.int64, count=len(ws))].sum(axis=0)
            best = int(np.argmax(total))
            langs.append(m.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, lang_pred and score (posterior of the prediction).

    A null text, one without a letter, and any text when no language was
    learned are `und` with score 0. Equal posteriors go to the language that
    sorts first. Rows are independent, repeated ones give repeated result rows;
    columns besides the two named are not looked at. An empty table gives an empty
    result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Identifier(shared.value)
        for pdf in it:
            for at in range(0, len(pdf), ROWS_AT_ONCE):
                part = pdf.iloc[at : at + ROWS_AT_ONCE]
                langs, scores = found.predict(text_or_empty(part["text"]))
                yield pd.DataFrame({"id": part["id"].to_numpy(), "lang_pred": langs, "score": scores})

    out = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(run, "id string, lang_pred string, score double")
    return restored(out, id_col, docs)
