"""Readers and writers of every layer.

Tables are parquet, partitioned by the string day column `d`
(`<root>/d=YYYYMMDD/`). A day is always replaced on its own: writes use
dynamic partition overwrite, so re-running a day replaces it and leaves every
other day as it was.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslake.functions.parse import day_of_file
from accesslake.schemas import ADS_SCHEMA, DAY, DWD_SCHEMA, KIND, ODS_SCHEMA, ddl, with_day

# Rows per output file by default (5,000,000 is the other usual setting).
DEFAULT_ROWS_PER_FILE = 2_500_000
# Rows are merged into fewer files when a day has at least so many files, and so many
# times more than its rows fill.
MERGE_MIN_FILES = 32
MERGE_FACTOR = 4
# The day folder, with a glob of part files after it or none.
_DAY_DIR = re.compile(r"(?:^|/)d=([^/]+)(?:/part[^/]*|/?)$")


# --------------------------------------------------------------------- paths
def day_of_path(path: str) -> str:
    """`YYYYMMDD` from a path whose last segment, but for part files, is `d=YYYYMMDD`."""
    m = _DAY_DIR.search(path)
    if not m:
        raise ValueError(f"no d=<day> segment at the end of {path!r}")
    return m.group(1)


def day_path(root: str, d: str) -> str:
    return f"{root.rstrip('/')}/{DAY}={d}"


def kind_root(root: str, kind: str) -> str:
    """Root of the days of one kind of rows below `root` (see `write_kinds`)."""
    return f"{root.rstrip('/')}/{KIND}={kind}"


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The location comes from `spark.checkpoint.dir` (or the context's
    checkpoint folder). On a cluster it must be set: a machine-local temp
    folder would not be seen by the executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/accesslake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch folders (results that read them must be done with)."""
    remove_folder(spark, scratch_dir(spark).rsplit("/", 1)[0])


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> int:
    """Data files directly in a folder (0 if it does not exist)."""
    return sum(not name.startswith(("_", ".")) for name in names_in(spark, path))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


# ------------------------------------------------------------------- readers
def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, one row per line in column `value` (raw logs, IP library, V1 TSV)."""
    return spark.read.text(path)


def read_day(spark: SparkSession, root: str, schema: T.StructType, d: str) -> DataFrame:
    """One day of a `d`-partitioned parquet table.

    Only that day's folder is listed (a table root with years of days would
    otherwise be listed whole); `d` comes back as a string column.
    """
    return spark.read.schema(with_day(schema)).option("basePath", root).parquet(day_path(root, d))


def read_days(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All days of a `d`-partitioned table; filter on `d` prunes folders."""
    return spark.read.schema(with_day(schema)).parquet(root)


def _heavy_path(root: str, d: str) -> str:
    return f"{root.rstrip('/')}/_heavy/{DAY}={d}"


def write_heavy_keys(spark: SparkSession, root: str, d: str, keys: list[tuple[str, int]], total: int) -> None:
    """Keep a day's heaviest keys and its row count (a row without a key) beside the day."""
    rows = [(None, total), *((k, n) for k, n in keys if k is not None)]
    spark.createDataFrame(rows, "key string, rows bigint").coalesce(1).write.mode("overwrite").parquet(_heavy_path(root, d))


def read_heavy_keys(spark: SparkSession, root: str, *days: str) -> tuple[list[tuple[str, int]], int] | None:
    """The heaviest keys of some days and their row count, days added up; None if one
    of them has no list. A list holds a few hundred keys, whatever the day's size."""
    paths = [_heavy_path(root, d) for d in days]
    if not days or not all(names_in(spark, p) for p in paths):
        return None
    sums = spark.read.parquet(*paths).groupBy("key").agg(F.sum("rows").alias("rows")).collect()
    return sorted(((r["key"], r["rows"]) for r in sums if r["key"] is not None), key=lambda x: (-x[1], x[0])), next(r["rows"] for r in sums if r["key"] is None)


def read_part_files(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """Parquet files by glob (`<root>/d=2024*/part*`), of one day or of many.

    Only the files that match are listed. The day is taken from each file's own
    path, in the hidden file-path column, so it needs no partition discovery; a file
    outside a day folder has the day ''.
    """
    rows = spark.read.schema(schema).parquet(pattern)
    return rows.select("*", day_of_file(F.col("_metadata.file_path")).alias(DAY))


# ------------------------------------------------------------------- writers
def files_for(rows: int, rows_per_file: int) -> int:
    """Files that so many rows fill."""
    return max(1, -(-rows // rows_per_file))


def too_many_files(files: int, rows: int, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> bool:
    """Whether counted rows lie in far more files than they fill."""
    return files >= MERGE_MIN_FILES and files > MERGE_FACTOR * files_for(rows, rows_per_file)


def write_day(
    df: DataFrame,
    root: str,
    d: str,
    *,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    fmt: str = "parquet",
) -> None:
    """Replace day `d` of the table at `root` with `df` (other days untouched).

    No repartition: files come out of the tasks that produce the rows, each
    capped at `rows_per_file` rows, so the write adds no shuffle. `merge_day` joins
    the files of a day that got few rows from many tasks.
    """
    (
        df.withColumn(DAY, F.lit(d))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(DAY)
        .format(fmt)
        .save(root)
    )


def write_kinds(df: DataFrame, kind_col: str, root: str, d: str, *, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> None:
    """Replace day `d` below `<root>/kind=<kind>/` for every kind that `df` has rows of.

    One pass over `df` fills all of them: the rows are computed once and dealt by kind
    into a folder a kind and day. `kind_root` names a kind's own table root, which
    `read_day` takes. A kind without rows keeps its old day; `clear_day` empties it.
    """
    (
        df.withColumnRenamed(kind_col, KIND).withColumn(DAY, F.lit(d))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(KIND, DAY)
        .parquet(root)
    )


def merge_day(spark: SparkSession, root: str, schema: T.StructType, d: str, rows: int, *, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> bool:
    """Merge the files of day `d` if its counted rows lie in far more files than they fill.

    A filter that leaves few rows of many tasks leaves as many small files. The day's
    rows (few, or there would be no need) are rebalanced into partitions of AQE's
    advisory size, written aside and then put in the day's place by the same dynamic
    overwrite as any day, so a failure leaves a whole day. Returns whether it merged.
    """
    if not too_many_files(data_files(spark, day_path(root, d)), rows, rows_per_file):
        return False
    aside = f"{root.rstrip('/')}/_merged/{DAY}={d}-{uuid.uuid4().hex[:8]}"
    try:
        small = read_day(spark, root, schema, d).drop(DAY).hint("rebalance")
        small.write.option("maxRecordsPerFile", rows_per_file).parquet(aside)
        write_day(spark.read.schema(schema).parquet(aside), root, d, rows_per_file=rows_per_file)
    finally:
        remove_folder(spark, aside)
    return True


def clear_day(spark: SparkSession, root: str, schema: T.StructType, d: str) -> None:
    """Make day `d` of the table at `root` empty (other days untouched).

    Dynamic overwrite only replaces days that receive rows, so a re-run whose
    result is empty must empty the day itself.
    """
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(day_path(root, d))


def write_text(
    lines: DataFrame,
    path: str,
    *,
    compression: str | None = "gzip",
) -> None:
    """Write a one-column string DataFrame as text lines (overwrite).

    Every task writes its own part, so no task holds the whole output; parts of
    an aggregated result are few, as AQE joins small shuffle partitions.
    """
    w = lines.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


# -------------------------------------------------------------------- tables
def create_day_table(
    spark: SparkSession, table: str, schema: T.StructType, location: str, *, if_not_exists: bool = True,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
) -> None:
    """External parquet table partitioned by string `d` at `location`.

    Files written into it hold `rows_per_file` rows at most: insertInto heeds
    the table's options, not the writer's, so the limit is one of them.

    The table carries the option `partitionOverwriteMode=dynamic`, so every
    overwrite into it (insertInto or SQL `INSERT OVERWRITE`) replaces only the
    days it writes, whatever the session setting.
    """
    guard = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(
        f"CREATE TABLE {guard}{table} ({ddl(with_day(schema))}) USING parquet "
        f"OPTIONS ('{_OVERWRITE_MODE}'='dynamic', 'maxRecordsPerFile'='{rows_per_file}') PARTITIONED BY ({DAY}) LOCATION '{location}'"
    )


_OVERWRITE_MODE = "partitionOverwriteMode"


def overwrites_by_day(spark: SparkSession, table: str) -> bool:
    """Whether the table itself asks for dynamic partition overwrite."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    props = next((r["data_type"] for r in rows if r["col_name"] == "Storage Properties"), "")
    options = dict(x.strip().split("=", 1) for x in props.strip("[]").split(",") if "=" in x)
    return options.get(_OVERWRITE_MODE, "").lower() == "dynamic"


# The three warehouse tables and their schemas (without `d`).
WAREHOUSE_TABLES = {"ods_access": ODS_SCHEMA, "dwd_access": DWD_SCHEMA, "ads_areatrafstat": ADS_SCHEMA}


def create_warehouse_tables(spark: SparkSession, locations: dict[str, str], database: str | None = None) -> None:
    """CREATE the ODS, DWD and ADS tables (`name -> location`) if missing."""
    for name, location in locations.items():
        full = f"{database}.{name}" if database else name
        create_day_table(spark, full, WAREHOUSE_TABLES[name], location)


def register_day_views(spark: SparkSession, roots: dict[str, str], d: str) -> None:
    """Temp views `ods_access`, `dwd_access`, `ads_areatrafstat` over day `d`.

    For SQL over one day, e.g.
    `SELECT city, host, count(1) AS count FROM dwd_access GROUP BY city, host`.
    """
    for name, root in roots.items():
        read_day(spark, root, WAREHOUSE_TABLES[name], d).createOrReplaceTempView(name)


def add_day_partition(spark: SparkSession, table: str, d: str, location: str | None = None) -> None:
    """Register day `d` of `table` (files already in place)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({DAY}='{d}'){loc}")


def insert_day(df: DataFrame, table: str, d: str) -> None:
    """Overwrite day `d` of a catalog table, leaving its other days.

    insertInto is positional, so the columns are put in table order. The table
    must carry `partitionOverwriteMode=dynamic`, as those of `create_day_table`
    do: the write then replaces only day `d` and touches no session setting.
    Without that option an overwrite would obey the session setting and could
    replace every day, so such a table is refused.
    """
    spark = df.sparkSession
    if not overwrites_by_day(spark, table):
        raise ValueError(
            f"set the option first: ALTER TABLE {table} SET SERDEPROPERTIES ('{_OVERWRITE_MODE}'='dynamic')"
        )
    cols = spark.table(table).columns
    df.withColumn(DAY, F.lit(d)).select(*cols).write.insertInto(table, overwrite=True)


def clear_table_day(spark: SparkSession, table: str, d: str) -> None:
    """Make day `d` of a catalog table empty: a static-partition overwrite with no rows."""
    cols = [c for c in spark.table(table).columns if c != DAY]
    types = dict(spark.table(table).dtypes)
    nulls = ", ".join(f"CAST(NULL AS {types[c]})" for c in cols)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY}='{d}') SELECT {nulls} WHERE 1 = 0")


# ---------------------------------------------------------------------- jdbc
def write_jdbc(
    df: DataFrame,
    *,
    url: str,
    dbtable: str,
    user: str | None = None,
    password: str | None = None,
    mode: str = "overwrite",
    truncate: bool = True,
    num_partitions: int | None = None,
    **options: str,
) -> None:
    """Export a table over JDBC; one connection per task, opened by executors.

    `mode="overwrite"` with `truncate=True` empties the target table and keeps
    its definition, so a re-run replaces the rows. With `num_partitions`, Spark
    coalesces the rows to at most that many tasks, and the database sees at most
    that many connections; without it every partition of the table writes on its
    own. Other writer options
    (batchsize, createTableOptions, createTableColumnTypes, isolationLevel,
    ...) pass through. There is no default password.
    """
    w = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", dbtable)
        .mode(mode)
    )
    if num_partitions is not None:
        w = w.option("numPartitions", str(num_partitions))
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    if mode == "overwrite":
        w = w.option("truncate", str(truncate).lower())
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
