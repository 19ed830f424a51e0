"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.sources.io import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARROW_BATCH, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ARROW_ROWS rows in this session, unless it has a size of its own.

    Spark's default of 10,000 whole documents a batch is tens of MB on either side of
    each Python worker, and what the batches took stays with the executor.
    """
    if spark.conf.get(ARROW_BATCH) == "10000":
        spark.conf.set(ARROW_BATCH, str(ARROW_ROWS))


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod `modulus` is `remainder`; a null doc_id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back.

    Cuts lineage with files that every executor reaches, so a lost executor
    costs only its own running tasks.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(fn: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """`mapInPandas` function that applies `fn` to each non-empty Arrow batch."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf):
                yield fn(pdf)

    return run


def carried(name: str) -> Column:
    """An id column as text: pandas would round large integers beside nulls."""
    return F.col(name).cast("string").alias("id")


def restored(df: DataFrame, name: str, like: DataFrame) -> DataFrame:
    """`df` with its carried id back under its name and type."""
    return df.withColumn("id", F.col("id").cast(like.schema[name].dataType)).withColumnRenamed("id", name)


def text_or_empty(texts: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in texts]
