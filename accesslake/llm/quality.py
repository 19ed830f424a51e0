"""Quality rules by repetition coverage (operator 7).

Rolling hashes of word n-grams of several lengths (numpy, one pass per length)
mark the characters inside n-grams that occur more than once in the text, and
whole lines equal to an earlier line; their share of the text's characters is
its repetition coverage. A text is kept when it passes the base rules and no
coverage is beyond its limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, restored, text_or_empty

MIN_WORDS = 20
BASE_WINDOW, BASE_PERCENT = 8, 30
# Largest share of word characters inside repeated n-grams, by n. Shorter
# n-grams recur in any long text, so their limits are looser.
COVERAGE_LIMITS = {4: 0.60, 6: 0.45, 10: 0.30}
LINE_COVERAGE_LIMIT = 0.30
ROWS_AT_ONCE = 500

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
# Rolling hash of 64 bits: an odd base has an inverse, so that hashes of windows
# come from prefix sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse, modulo 2^64, as long as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_INVERSE, k, 1 << 64))])
        return self.up[:n], self.down[:n]


def repeated_words(values: np.ndarray, n: int, powers: Powers) -> np.ndarray:
    """Marks the words inside n-word windows that occur twice or more.

    `values` are 64-bit values, equal for equal words.
    """
    count = len(values) - n + 1
    covered = np.zeros(len(values) + 1, dtype=np.int64)
    if count < 2:
        return covered[:-1].astype(bool)
    up, down = powers.get(len(values))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up)])
    windows = (sums[n:] - sums[:-n]) * down[:count]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(count, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = np.nonzero(twice)[0]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + n, -1)
    return np.cumsum(covered[:-1]) > 0


def spread(ids: np.ndarray) -> np.ndarray:
    """Distinct well-mixed 64-bit values for distinct small integers."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def measure(text: str, powers: Powers) -> dict:
    """All measures of one text."""
    words = _WORD.findall(text)
    n = len(words)
    index: dict[str, int] = {}
    values = spread(np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=n))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    chars = int(sizes.sum())
    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            if line in seen:
                dup_lines += 1
                dup_line_chars += sum(map(len, _WORD.findall(line)))
            else:
                seen.add(line)
    out = {
        "n_words": n, "word_chars": chars, "n_symbols": len(_SYMBOLS.findall(text)), "n_dup_lines": dup_lines,
        "n_repeat_words": int(repeated_words(values, BASE_WINDOW, powers).sum()),
        "dup_line_share": dup_line_chars / chars if chars else 0.0,
    }
    for size in COVERAGE_LIMITS:
        out[f"dup_{size}gram_share"] = float(sizes[repeated_words(values, size, powers)].sum() / chars) if chars else 0.0
    return out


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the base counts, `base_failed`, the coverages (`dup_line_share`,
    `dup_4gram_share`, ...), `reasons` (limits that were exceeded) and `kept`.

    A null text counts as empty: no words, so the base fails. Rows are
    independent; repeated rows and null ids give a row each, and columns
    besides the two named are not looked at.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for pdf in it:
            for at in range(0, len(pdf), ROWS_AT_ONCE):
                part = pdf.iloc[at : at + ROWS_AT_ONCE]
                out = pd.DataFrame([measure(t, powers) for t in text_or_empty(part["text"])])
                out.insert(0, "id", part["id"].to_numpy())
                yield out

    shares = ["dup_line_share"] + [f"dup_{n}gram_share" for n in COVERAGE_LIMITS]
    measured = docs.select(carried(id_col), F.col(text_col).alias("text")).mapInPandas(
        run,
        "id string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"{s} double" for s in shares),
    )
    limits = dict(zip(shares, [LINE_COVERAGE_LIMIT, *COVERAGE_LIMITS.values()]))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    reasons = F.array_compact(F.array(F.when(base, F.lit("base")), *[F.when(F.col(s) > x, F.lit(s)) for s, x in limits.items()]))
    judged = measured.withColumn("base_failed", base).withColumn("reasons", reasons).withColumn("kept", F.size("reasons") == 0)
    return restored(judged, id_col, docs)


def oracle_sql() -> str:
    """The query's rows in DuckDB (reasons joined by commas)."""
    sizes = sorted({BASE_WINDOW, *COVERAGE_LIMITS})
    leads = {k: f"lead(word, {k}) OVER (PARTITION BY rid ORDER BY i)" for k in range(1, max(sizes))}
    grams = ", ".join(f"CASE WHEN i + {n - 1} <= n THEN concat_ws(' ', word, {', '.join(f'l{k}' for k in range(1, n))}) END AS g{n}" for n in sizes)
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY rid, g{n}) > 1 AS d{n}" for n in sizes)
    covered = ", ".join(f"coalesce(bool_or(d{n}) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), false) AS c{n}" for n in sizes)
    chars = ", ".join(f"sum(CASE WHEN c{n} THEN length(word) ELSE 0 END) AS ch{n}" for n in sizes)
    shares = {"dup_line_share": "CASE WHEN word_chars > 0 THEN dup_line_chars / word_chars ELSE 0 END"} | {
        f"dup_{n}gram_share": f"CASE WHEN word_chars > 0 THEN ch{n} / word_chars ELSE 0 END" for n in COVERAGE_LIMITS}
    limits = dict(zip(shares, [LINE_COVERAGE_LIMIT, *COVERAGE_LIMITS.values()]))
    base = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words)"
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
ws AS (SELECT rid, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
ls AS (SELECT *, {', '.join(f'{x} AS l{k}' for k, x in leads.items())} FROM ws),
gs AS (SELECT rid, i, word, {grams} FROM ls),
ts AS (SELECT rid, i, word, {twice} FROM gs),
cs AS (SELECT rid, word, {covered} FROM ts),
per AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (WHERE c{BASE_WINDOW}) AS n_repeat_words, {chars} FROM cs GROUP BY rid),
li AS (SELECT rid, line, row_number() OVER (PARTITION BY rid, line) AS k FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT rid, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '{blank}', '', 'g'))) AS dup_line_chars FROM li WHERE k > 1 GROUP BY rid),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {', '.join(f'coalesce(ch{n}, 0) AS ch{n}' for n in sizes)}
      FROM d LEFT JOIN per USING (rid) LEFT JOIN dl USING (rid)),
s AS (SELECT *, {', '.join(f'CAST({x} AS DOUBLE) AS {k}' for k, x in shares.items())}, {base} AS base_failed FROM m),
r AS (SELECT *, concat_ws(',', CASE WHEN base_failed THEN 'base' END, {', '.join(f"CASE WHEN {k} > {x} THEN '{k}' END" for k, x in limits.items())}) AS reasons FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, {', '.join(shares)}, base_failed, reasons, reasons = '' AS kept FROM r
"""
