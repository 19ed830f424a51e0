"""Versioned days of catalog tables: an atomic day swap.

A day is written whole into a folder of its own under the table's location,
`_versions/d=<day>/<version>/`, and one catalog statement then points the day's
partition there. Until that statement a reader sees the whole old day, after it
the whole new one; a job that fails before it leaves the old day as it was. The
old version's files stay for readers that listed them before the swap, until
`drop_old_versions` removes them.

An empty result is a version like any other, so a re-run without rows empties its
day in the same step. Days published this way are replaced by `publish_day` (or
`publish_kinds`) only: `insert_day` would overwrite the current version in place.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslake.schemas import DAY, KIND
from accesslake.sources.io import DEFAULT_ROWS_PER_FILE, add_day_partition, names_in, remove_folder

VERSIONS = "_versions"


@dataclass(frozen=True)
class Version:
    """A day's folder and the rows in its committed files."""

    path: str
    rows: int


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def _data_schema(spark: SparkSession, table: str) -> T.StructType:
    return T.StructType([f for f in spark.table(table).schema.fields if f.name != DAY])


def day_location(spark: SparkSession, table: str, d: str) -> str | None:
    """Folder that the day's partition points at (None without such a partition)."""
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({DAY}='{d}')").isEmpty():
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({DAY}='{d}')").collect()
    # The partition's own location comes before the table's.
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def new_version(spark: SparkSession, table: str, d: str) -> str:
    """Path of a version that does not exist yet; later ones sort after earlier ones."""
    now = datetime.datetime.now(datetime.timezone.utc)
    return f"{table_location(spark, table)}/{VERSIONS}/{DAY}={d}/{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def committed_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rows in the files of a folder: read from their footers, so retried or speculative
    tasks count once, as their files are committed once."""
    return spark.read.schema(schema).parquet(path).count()


def write_version(df: DataFrame, table: str, d: str, *, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> Version:
    """Write a new version of day `d` without showing it: no reader of the table sees it."""
    spark = df.sparkSession
    schema = _data_schema(spark, table)
    path = new_version(spark, table, d)
    df.select(*schema.fieldNames()).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return Version(path, committed_rows(spark, path, schema))


def swap_day(spark: SparkSession, table: str, d: str, path: str) -> None:
    """Point day `d` at a folder, in one catalog statement."""
    if day_location(spark, table, d) is None:
        add_day_partition(spark, table, d, path)
    else:
        spark.sql(f"ALTER TABLE {table} PARTITION ({DAY}='{d}') SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def publish_day(df: DataFrame, table: str, d: str, *, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> Version:
    """Replace day `d` of a catalog table atomically; its other days stay as they are."""
    version = write_version(df, table, d, rows_per_file=rows_per_file)
    swap_day(df.sparkSession, table, d, version.path)
    return version


def publish_kinds(df: DataFrame, kind_col: str, tables: dict[str, str], d: str, *, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> dict[str, Version]:
    """Replace day `d` of several tables from one write of `df`, split by `kind_col`.

    `tables` names the table of each kind; each takes the columns it has. The rows are
    computed and written once, into a version of the first table with a folder a kind,
    and each table's day is swapped to its own folder. A kind without rows gets an
    empty day; rows of a kind without a table are refused by the write.
    """
    spark = df.sparkSession
    known = F.col(kind_col).isin(*tables)
    checked = df.withColumn(KIND, F.when(known, F.col(kind_col)).otherwise(F.raise_error(F.concat(F.lit("no table for kind "), F.coalesce(kind_col, F.lit("null"))))))
    schemas = {kind: _data_schema(spark, table) for kind, table in tables.items()}
    columns = list(dict.fromkeys(name for s in schemas.values() for name in s.fieldNames()))
    path = new_version(spark, next(iter(tables.values())), d)
    checked.select(*columns, KIND).write.partitionBy(KIND).option("maxRecordsPerFile", rows_per_file).parquet(path)
    written = {r[KIND] for r in spark.read.parquet(path).select(KIND).distinct().collect()} if any(n.startswith(f"{KIND}=") for n in names_in(spark, path)) else set()
    out = {}
    for kind, schema in schemas.items():
        folder = f"{path}/{KIND}={kind}"
        if kind not in written:
            spark.createDataFrame([], schema).write.parquet(folder)
        out[kind] = Version(folder, committed_rows(spark, folder, schema))
    for kind, table in tables.items():
        swap_day(spark, table, d, out[kind].path)
    return out


# ------------------------------------------------------------------------- clean up
def versions_of(spark: SparkSession, table: str, d: str) -> list[str]:
    """Paths of the versions of a day in the table's own folder, oldest first."""
    base = f"{table_location(spark, table)}/{VERSIONS}/{DAY}={d}"
    return [f"{base}/{name}" for name in names_in(spark, base)]


def drop_old_versions(spark: SparkSession, table: str, d: str, *, keep: int = 1) -> list[str]:
    """Remove versions of a day older than the current one but the `keep` newest of them.

    Run it when no reader can still hold a plan over them. Versions newer than the
    current one (a writer at work, or one that failed before its swap) are left alone,
    as is everything if the day's partition points elsewhere.
    """
    current = day_location(spark, table, d)
    every = versions_of(spark, table, d)
    at = [i for i, v in enumerate(every) if current is not None and (current == v or current.startswith(v + "/"))]
    if not at:
        return []
    old = every[: at[0]]
    gone = old[: max(0, len(old) - keep)]
    for path in gone:
        remove_folder(spark, path)
    return gone
