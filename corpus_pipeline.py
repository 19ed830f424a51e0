"""Corpus pipeline: documents in, token ids of the clean ones out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
rows they keep, with all columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.llm import bpe, decontam, langid, minhash, toxicity
from accesslake.llm.common import materialize, small_batches, table

TOXIC_FROM = 0.5
LANGUAGE_FROM = 0.5
# Texts that a filtering stage holds as strings at a time.
ROWS_AT_ONCE = 500


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _minus(docs: DataFrame, dropped: DataFrame, on: dict) -> DataFrame:
    """Rows of docs without a row in `dropped` that has the same values, nulls included."""
    names = [_fresh(docs, f"_dropped_{i}") for i in range(len(on))]
    right = dropped.select(*[F.col(c).alias(name) for c, name in zip(on, names)])
    same = [expr.eqNullSafe(F.col(name)) for expr, name in zip(on.values(), names)]
    return docs.join(right, same, "left_anti")


def _kept(docs: DataFrame, judge: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """Rows whose text is judged to stay, with all their columns; null texts are judged
    as empty ones. `judge` is called once a task, its result on the texts of a batch."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays = judge()
        for batch in it:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield part.filter(pa.array(stays([t or "" for t in part.column("text").to_pylist()]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below TOXIC_FROM.

    Null and empty texts stay, as does everything without labels to learn from.
    Repeated rows and rows with a null id are judged one by one; an empty table gives
    an empty one. All columns stay, whatever their names.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(toxicity.train(docs, table(spark, sf_dir, "labels")))
    return _kept(docs, lambda: lambda texts: [shared.value.text_score(t) < TOXIC_FROM for t in texts])


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a learned language, by a posterior of LANGUAGE_FROM at least.

    Null and empty texts and texts without a letter go, as do all when no language can
    be learned. Repeated rows and rows with a null id are judged one by one; an empty
    table gives an empty one. All columns stay, whatever their names.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(langid.train(docs, langid.public_pieces(public_tokenizers.path("piece_bpe_32k.model"))))

    def judge() -> Callable[[list[str]], list[bool]]:
        found = langid.Identifier(shared.value)
        return lambda texts: [score >= LANGUAGE_FROM for score in found.predict(texts)[1]]

    return _kept(docs, judge)


def _of_repeated(rows: DataFrame) -> DataFrame:
    """One of the rows that repeat an id and text: the one with the least hash of all its columns."""
    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()])
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy("doc_id", F.xxhash64("text").alias("_text")).agg(F.min_by(whole, order).alias("_row")).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8): the one
    with the smallest doc_id, and one of the rows that repeat it.

    Null and blank texts are near nothing and stay; rows with a null id stay unless
    they are near a row with one. An empty table gives an empty one. All columns stay,
    whatever their names.
    """
    small_batches(spark)
    found = materialize(minhash.near_duplicates(docs).select("doc_id", "row_hash", "kept"), "near")
    key = {"doc_id": F.col("doc_id"), "row_hash": F.xxhash64("text")}
    kept = _minus(docs, found.where("not kept").distinct(), key)
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id", "row_hash").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    single = _minus(kept, repeated, key)
    i, h = _fresh(docs, "_id"), _fresh(docs, "_hash")
    right = repeated.select(F.col("doc_id").alias(i), F.col("row_hash").alias(h))
    again = kept.join(right, (F.col("doc_id") == F.col(i)) & (F.xxhash64("text") == F.col(h)), "left_semi")
    return single.unionByName(_of_repeated(again))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark.

    Null and empty texts stay; a leak takes the rows with its id (null included) and
    text. Empty tables drop nothing. All columns stay, whatever their names.
    """
    leaks = decontam.leaks(docs, table(spark, sf_dir, "benchmark"), by_text=True).select("doc_id", "row_hash").distinct()
    return _minus(docs, leaks, {"doc_id": F.col("doc_id"), "row_hash": F.xxhash64("text")})


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, and the packed ids: a row
    for each row, null texts as empty ones."""
    small_batches(spark)
    encoded = bpe.encode(docs, bpe.load(public_tokenizers.path("word_bpe_49k.json")))
    return bpe.digests(encoded, keep=("ids_le",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

# The stages learn models and follow links: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
