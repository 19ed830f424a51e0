"""Queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.llm import align, anchors, audit, bpe, decontam, html, langid, licenses, lm, minhash, quality, sharding, toxicity
from accesslake.llm.common import in_fold, table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", in_fold(F.col("doc_id"), *toxicity.HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences", "worst_start", "worst_end", "worst_score",
    )


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, langid.public_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    return langid.identify(docs, model).select("doc_id", in_fold(F.col("doc_id"), *langid.HELD_OUT).alias("held_out"), "lang_pred", "score")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), vocabulary))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).withColumn("reasons", F.array_join("reasons", ","))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_size=3, percent=85).drop("row_hash")


def op11_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.near_duplicates(table(spark, sf_dir, "documents"))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.link_sums(table(spark, sf_dir, "documents"), *paths)


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_html": op2_html,
    "op3_toxicity": op3_toxicity,
    "op4_decontam": op4_decontam,
    "op5_langid": op5_langid,
    "op6_bpe": op6_bpe,
    "op7_quality": op7_quality,
    "op8_sharding": op8_sharding,
    "op9_lm": op9_lm,
    "op10_minhash": op10_minhash,
    "op11_anchors": op11_anchors,
    "op12_align": op12_align,
    "op13_audit": op13_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op1_licenses": licenses.oracle_sql(),
    "op4_decontam": decontam.ORACLE_SQL,
    "op7_quality": quality.oracle_sql(),
    "op10_minhash": minhash.ORACLE_SQL,
    "op13_audit": audit.ORACLE_SQL,
}
