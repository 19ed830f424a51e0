"""MinHash near-duplicates (operator 10).

1. Each document's set of word shingles is hashed to 64 bits; documents with
   equal sets form one class, and only classes go on. Minima of many
   multiply-add-shift functions form the signature; 36 bands of them name 36
   buckets (7 minima each for a threshold of 0.85, 5 for 0.8). A pair at the
   threshold misses every bucket with a probability of at most 2e-6.
2. Each bucket ties its members to its least member, and components of these
   ties (alternating large-star and small-star) gather everything that could be
   linked, directly or not. No pairs are listed.
3. Inside one such unit, classes of different components so far are compared:
   sizes, then signatures, then the full sets. A link merges two components,
   and pairs within a component need no more comparing, so a unit returns a
   spanning forest of its exact links: fewer rows than it has members.
   A unit beyond `MAX_UNIT_CLASSES` or `MAX_UNIT_SHINGLES` is worked bucket by
   bucket instead, and a bucket beyond them in pairs of blocks, each a task of
   its own: nothing is dropped and no task holds more than two blocks.
4. Components of the forest's links give the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, materialize, restored, text_or_empty
from accesslake.llm.graph import components

BANDS = 36
# A pair at the threshold shares no bucket with at most this probability.
MAX_MISS = 2e-6
# Members and hashed shingles that one task compares at a time.
MAX_UNIT_CLASSES = 4096
MAX_UNIT_SHINGLES = 8_000_000
# A pair is compared in full unless its share of equal signature bytes lies this
# many standard deviations below what the threshold gives (probability 1e-9).
SIGNATURE_DEVIATIONS = 6
SEED = 20_011
KEPT_WORDS = 300_000
_HASHES_AT_ONCE = 1 << 10


def rows_per_band(similarity: float, bands: int) -> int:
    """The most minima per band that keep a pair at the threshold within MAX_MISS."""
    rows = 1
    while (1 - similarity ** (rows + 1)) ** bands <= MAX_MISS:
        rows += 1
    return rows


class Shingler:
    """Sets of hashed word shingles; words are cut at ASCII white space, A-Z lower-cased."""

    def __init__(self, size: int):
        self.size = size
        self.words: dict[bytes, int] = {}

    def word_hashes(self, text: str) -> np.ndarray:
        found, words = [], self.words
        for w in text.encode().lower().split():
            h = words.get(w)
            if h is None:
                if len(words) >= KEPT_WORDS:
                    words.clear()
                h = words[w] = xxhash.xxh3_64_intdigest(w)
            found.append(h)
        return np.array(found, dtype=np.uint64)

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes; a text of fewer words is one shingle."""
        w = self.word_hashes(text)
        k = min(self.size, len(w))
        if not k:
            return w
        n = len(w) - k + 1
        h = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[j : j + n])
        return np.unique(h)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """High 32 bits of the least a*x+b over the set, for each function."""
    x = shingles >> np.uint64(32)
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(x), _HASHES_AT_ONCE):
        part = np.multiply.outer(a, x[at : at + _HASHES_AT_ONCE])
        part += b[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least >> np.uint64(32)


def signatures(docs: DataFrame, shingle_size: int, *, id_col: str = "doc_id", text_col: str = "text", bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, row_hash (xxhash64 of the text), n_shingles, and unless the set is empty its digest
    (equal for equal sets), signature (one byte per minimum) and bucket keys."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(shingle_size)
        a, b = hash_family(bands * rows)
        band_no = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for pdf in it:
            out = []
            for t in text_or_empty(pdf["text"]):
                s = shingler.shingles(t)
                if not len(s):
                    out.append((0, None, None, None))
                    continue
                m = minima(s, a, b)
                keys = band_no.copy()
                for column in m.reshape(bands, rows).T:
                    keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
                out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), m.astype(np.uint8).tobytes(), keys.view(np.int64)))
            n, digest, sig, keys = zip(*out) if out else ((), (), (), ())
            yield pd.DataFrame({"id": pdf["id"], "row_hash": pdf["row_hash"], "n_shingles": n, "digest": digest, "signature": sig, "buckets": keys})

    out = docs.select(carried(id_col), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text")).mapInPandas(
        run, "id string, row_hash long, n_shingles long, digest binary, signature binary, buckets array<long>"
    )
    return restored(out, id_col, docs).withColumnRenamed(id_col, "doc_id")


def forest(pdf: pd.DataFrame, percent: int, slack: float) -> pd.DataFrame:
    """Spanning forest (u, v) of the exact links among the rows' sets.

    Rows: node, signature, shingles. A pair counts as linked when
    100 * intersection >= percent * union. Rows of one node count as linked.
    """
    pdf = pdf.drop_duplicates(["node", "shingles"]).sort_values("node")
    nodes = pdf["node"].to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in pdf["shingles"]]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    sig = np.frombuffer(b"".join(pdf["signature"]), dtype=np.uint8).reshape(len(pdf), -1)
    least_equal = (percent / 100 - slack) * sig.shape[1]
    group = pd.factorize(nodes)[0]
    links = []
    for x in range(1, len(pdf)):
        near = np.nonzero((group[:x] != group[x]) & (100 * np.minimum(size[:x], size[x]) >= percent * np.maximum(size[:x], size[x])))[0]
        if not len(near):
            continue
        equal = np.count_nonzero(sig[near] == sig[x], axis=1)
        order = np.argsort(-equal, kind="stable")
        for y in near[order[: np.count_nonzero(equal >= least_equal)]]:
            if group[y] == group[x]:
                continue
            at = np.searchsorted(sets[x], sets[y])
            at[at == len(sets[x])] = 0
            common = int(np.count_nonzero(sets[x][at] == sets[y]))
            if 100 * common >= percent * (size[x] + size[y] - common):
                links.append((nodes[x], nodes[y]))
                group[group == group[x]] = group[y]
    return pd.DataFrame(links, columns=["u", "v"])


def _units(buckets: DataFrame, ties: DataFrame, classes: DataFrame, max_classes: int, max_shingles: int) -> DataFrame:
    """(unit, node): which classes are compared together."""
    grown = components(ties, "ties")
    rooted = grown.select("node", F.col("component").alias("root")).unionByName(
        grown.select(F.col("component").alias("node"), F.col("component").alias("root")).distinct()
    )
    sized = materialize(rooted.join(classes.select("node", "n_shingles"), "node"), "rooted")
    whole = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    whole = whole.select("root", ((F.col("n") <= max_classes) & (F.col("s") <= max_shingles)).alias("fits"))
    placed = sized.join(whole, "root")
    units = placed.where("fits").select(F.xxhash64(F.lit("root"), "root").alias("unit"), "node")
    large = placed.where(~F.col("fits")).select("node", "n_shingles")
    if large.isEmpty():
        return units
    inside = buckets.join(large, "node")
    sizes = inside.groupBy("bucket").agg(
        F.greatest(F.ceil(F.count("*") * 2 / max_classes), F.ceil(F.sum("n_shingles") * 2 / max_shingles)).alias("blocks")
    )
    inside = inside.join(sizes.withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks"))), "bucket")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    both = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda other: F.struct(F.least(other, block).alias("i"), F.greatest(other, block).alias("j")))
    split = inside.select("bucket", "node", F.explode(both).alias("pair"))
    return units.unionByName(split.select(F.xxhash64(F.lit("blocks"), "bucket", "pair.i", "pair.j").alias("unit"), "node"))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    max_unit_classes: int = MAX_UNIT_CLASSES,
    max_unit_shingles: int = MAX_UNIT_SHINGLES,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest
    doc_id reachable over links of at least `percent`, itself included), kept
    (doc_id is component_id) and row_hash (xxhash64 of the text).

    A null or blank text has the empty set: no shingles, no links, its own
    component. A text with fewer words than a shingle is one shingle. Repeated
    rows give repeated result rows. A null doc_id joins the component of the
    documents with an equal set but never names one; without such, its
    component is null and it is kept. Columns besides the two named are not
    looked at. An empty table gives an empty result.
    """
    rows = rows_per_band(percent / 100, bands)
    found = materialize(signatures(docs, shingle_size, id_col=id_col, text_col=text_col, bands=bands, rows=rows), "signatures")
    by_set = found.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("buckets").alias("buckets")
    )
    classes = materialize(by_set, "classes")
    buckets = classes.select("node", F.explode("buckets").alias("bucket"))
    least = buckets.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = materialize(buckets.join(least.select("bucket", "first"), "bucket"), "shared")
    ties = shared.where("node != first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    units = materialize(_units(shared.select("node", "bucket"), ties, classes, max_unit_classes, max_unit_shingles), "units")

    members = units.select("node").distinct()
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).join(members, "node", "left_semi")

    def sets(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(shingle_size)
        for pdf in it:
            s = [shingler.shingles(t) for t in text_or_empty(pdf["text"])]
            yield pd.DataFrame({"digest": [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in s], "shingles": [x.tobytes() for x in s]})

    whole = texts.mapInPandas(sets, "digest binary, shingles binary").join(classes.select("digest", "node", "signature"), "digest")
    s = percent / 100
    slack = SIGNATURE_DEVIATIONS * (s * (1 - s) / (bands * rows)) ** 0.5
    node_kind = classes.schema["node"].dataType.simpleString()
    links = (
        units.join(whole, "node")
        .select("unit", "node", "signature", "shingles")
        .groupBy("unit")
        .applyInPandas(lambda pdf: forest(pdf, percent, slack), f"u {node_kind}, v {node_kind}")
    )
    reached = components(links, "links")

    classed = found.select("doc_id", "row_hash", "n_shingles", "digest").join(classes.select("digest", "node"), "digest", "left")
    named = classed.join(reached, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return named.select(
        F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "row_hash"
    )


# DuckDB: all pairs that share a shingle, and what each document reaches.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x20\x09-\x0D]+') AS w FROM documents),
ws AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
ls AS (SELECT doc_id, n, i, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3 FROM ws WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
sh AS (SELECT DISTINCT doc_id, concat_ws(' ', word, w2, w3) AS s FROM ls WHERE i + 2 <= n OR (n < 3 AND i = 1)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
ends AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, ends.v FROM reach JOIN ends ON ends.u = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN size USING (doc_id) JOIN least USING (doc_id)
"""
