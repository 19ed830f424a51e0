"""The daily jobs: raw -> ODS -> DWD -> ADS -> report / table / JDBC.

One parameter `d` drives input, output and partition of every job. Each job
is one Spark job over its input (plus a small probe of the IP library for the
join choice): row counts are taken with `Observation` in the same pass as the
write, not with extra `count()` actions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from accesslake.operators import ads, dwd, ods
from accesslake.operators.joins import heavy_keys_metric
from accesslake.schemas import ADS_SCHEMA, DWD_SCHEMA, GOOD, KIND, ODS_SCHEMA, REJECTED, REJECTS_SCHEMA
from accesslake.sources import io, versions


@dataclass
class JobReport:
    """Row counts of one job run (input and output rows, as the jobs log them).

    Counts are observed in the writing stage, where every task that commits counts
    once, or read from the footers of committed files: both are exact under retries.
    """

    job: str
    d: str
    counts: dict = field(default_factory=dict)
    joins: list = field(default_factory=list)


def _observed(df: DataFrame, name: str, *aggs) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *aggs), obs


def _metrics(obs: Observation, observed: DataFrame, *names: str) -> dict:
    """The observed counts of a frame that was just written.

    The optimizer drops the observation of a plan it proves empty (an empty day
    folder), and then no metrics arrive. Lost metrics are never read as zero:
    the frame itself says whether it is empty, and if it is not, the counts are
    unknown and the job fails, leaving what it wrote as it is.
    """
    try:
        return dict(obs.get)
    except Exception as e:  # py4j raises a generic error here
        if not observed.isEmpty():
            raise RuntimeError(f"the row counts {', '.join(names)} were lost; the rows are written") from e
        return dict.fromkeys(names, 0)


def ods_job(
    spark: SparkSession,
    raw_path: str,
    ods_root: str,
    d: str,
    *,
    rejects_root: str | None = None,
    heavy_keys: bool = False,
    rows_per_file: int = io.DEFAULT_ROWS_PER_FILE,
) -> JobReport:
    """Raw lines of day `d` -> ODS day partition.

    Counts (total, good, short, dirty_size) come from the same pass as the
    write. With `rejects_root`, the rejected lines are written as well. If the two
    roots are those of one split folder (`io.kind_root(root, GOOD)` and
    `io.kind_root(root, REJECTED)`), both come out of the same pass; for other roots
    the lines are a second scan of the raw text, made only if the counts show any.

    A day whose rows come out in many small files is merged (`io.merge_day`). With
    `heavy_keys`, the ips with the most good rows are found in the same pass and kept
    with the day, for the join of the DWD job.
    """
    tagged = ods.tag(io.read_lines(spark, raw_path))
    heavy = [heavy_keys_metric(F.when(F.col(ods.REASON).isNull(), F.col("ip"))).alias("heavy")] if heavy_keys else []
    observed, obs = _observed(tagged, f"ods_{d}", *ods.count_columns(), *heavy)
    split = ods_root.removesuffix(f"/{KIND}={GOOD}")
    together = rejects_root is not None and (ods_root, rejects_root) == (io.kind_root(split, GOOD), io.kind_root(split, REJECTED))
    if together:
        io.write_kinds(ods.by_kind(observed), KIND, split, d, rows_per_file=rows_per_file)
    else:
        io.write_day(ods.good(observed), ods_root, d, rows_per_file=rows_per_file)
    report = JobReport("ods", d, _metrics(obs, tagged, "total", "good", "short", "dirty_size"))
    top = report.counts.pop("heavy", 0) or []
    if heavy_keys:
        io.write_heavy_keys(spark, ods_root, d, [(r["item"], r["count"]) for r in top], report.counts["good"])
    rejected = report.counts["total"] - report.counts["good"]
    if report.counts["good"] == 0:
        io.clear_day(spark, ods_root, ODS_SCHEMA, d)
    else:
        io.merge_day(spark, ods_root, ODS_SCHEMA, d, report.counts["good"], rows_per_file=rows_per_file)
    if rejects_root:
        if rejected and not together:
            io.write_day(ods.rejects(tagged), rejects_root, d, rows_per_file=rows_per_file)
        if rejected:
            io.merge_day(spark, rejects_root, REJECTS_SCHEMA, d, rejected, rows_per_file=rows_per_file)
        else:  # nothing rejected: no second scan, just an empty day
            io.clear_day(spark, rejects_root, REJECTS_SCHEMA, d)
    return report


def ods_table_job(spark: SparkSession, raw_path: str, table: str, rejects_table: str, d: str, *, rows_per_file: int = io.DEFAULT_ROWS_PER_FILE) -> JobReport:
    """Raw lines of day `d` -> the day of the ODS table and of the rejects table.

    One scan and one write; each table's day is swapped atomically, so readers see the
    whole old day until then, and a failure leaves it. `good` and the rows rejected are
    checked against the files written.
    """
    tagged = ods.tag(io.read_lines(spark, raw_path))
    observed, obs = _observed(tagged, f"ods_{d}", *ods.count_columns())
    written = versions.publish_kinds(ods.by_kind(observed), KIND, {GOOD: table, REJECTED: rejects_table}, d, rows_per_file=rows_per_file)
    counts = _metrics(obs, tagged, "total", "good", "short", "dirty_size")
    if (written[GOOD].rows, written[REJECTED].rows) != (counts["good"], counts["total"] - counts["good"]):
        raise RuntimeError(f"counted {counts}, but the files hold {written[GOOD].rows} and {written[REJECTED].rows} rows")
    return JobReport("ods", d, counts)


def dwd_job(
    spark: SparkSession,
    ip_path: str,
    ods_root: str,
    dwd_root: str,
    d: str,
    *,
    lookup: str = "join",
    rows_per_file: int = io.DEFAULT_ROWS_PER_FILE,
    **join_opts,
) -> JobReport:
    """ODS day -> DWD day: typed, parsed and enriched with the IP library.

    `lookup="join"` is the V2 rule (NULL on a miss, duplicates fan out);
    `lookup="default"` the V1 rule (one row per ip, '-' on a miss). If the ODS day has a
    list of its heavy ips, a shuffle join goes by that and does not sample the day.
    """
    join_opts.setdefault("known_heavy", io.read_heavy_keys(spark, ods_root, d))
    dim = dwd.ip_dim(io.read_lines(spark, ip_path))
    day = io.read_day(spark, ods_root, ODS_SCHEMA, d).drop("d")
    pre = dwd.widen(day)
    read, obs_in = _observed(pre, f"dwd_in_{d}", F.count(F.lit(1)).alias("input"))
    plan: list = []
    if lookup == "join":
        wide = dwd.enrich(read, dim, plan=plan, **join_opts)
    elif lookup == "default":
        wide = dwd.enrich_lookup(read, dim, plan=plan, **join_opts)
    else:
        raise ValueError(f"lookup must be 'join' or 'default', not {lookup!r}")
    observed, obs = _observed(wide, f"dwd_{d}", F.count(F.lit(1)).alias("rows"))
    io.write_day(observed, dwd_root, d, rows_per_file=rows_per_file)
    # A map stage before a shuffle may run twice (an executor lost), and would count its
    # rows twice: there the input is counted from the footers of the day's files.
    shuffled = plan and plan[-1].strategy == "shuffle"
    read_rows = {"input": day.count()} if shuffled else _metrics(obs_in, pre, "input")
    report = JobReport("dwd", d, {**read_rows, **_metrics(obs, wide, "rows")}, plan)
    if report.counts["rows"] == 0:
        io.clear_day(spark, dwd_root, DWD_SCHEMA, d)
    else:
        io.merge_day(spark, dwd_root, DWD_SCHEMA, d, report.counts["rows"], rows_per_file=rows_per_file)
    return report


def area_traffic_day(spark: SparkSession, dwd_root: str, d: str) -> DataFrame:
    """ADS rows of day `d` (reads only `city` and `host` of that day)."""
    return ads.area_traffic(io.read_day(spark, dwd_root, DWD_SCHEMA, d))


def ads_job(
    spark: SparkSession,
    dwd_root: str,
    d: str,
    *,
    ads_root: str | None = None,
    table: str | None = None,
    swap: bool = False,
    persist: str | None = None,
    register_in: str | None = None,
    rows_per_file: int = io.DEFAULT_ROWS_PER_FILE,
) -> JobReport:
    """DWD day -> ADS day, to a parquet folder (`ads_root`), a catalog table, or both.

    With `swap`, the table's day is published as a version and swapped atomically
    (`versions.publish_day`). With `register_in`, a catalog table over the folder, the
    day is added to it. The file size of a catalog table that is inserted into is the
    table's own option (`io.create_day_table`), so `rows_per_file` goes with a folder or
    a swap only.

    Both targets take `persist`, a storage level such as MEMORY_AND_DISK: the result is
    computed once, kept at that level for the second write, and released whether the job
    succeeds or fails.
    """
    if ads_root is None and table is None:
        raise ValueError("give ads_root, table or both")
    if ads_root and table and not persist:
        raise ValueError("two targets need persist, a storage level")
    if register_in and not ads_root:
        raise ValueError("register_in goes with ads_root")
    if not ads_root and not swap and rows_per_file != io.DEFAULT_ROWS_PER_FILE:
        raise ValueError("rows_per_file goes with ads_root or swap; a table has its own rows_per_file")
    # Both counts are taken in the writing stage: the DWD rows read are the
    # sum of the group counts.
    traffic = area_traffic_day(spark, dwd_root, d)
    kept = traffic.persist(storage_level(persist)) if persist else None
    try:
        result, obs = _observed(
            traffic if kept is None else kept,
            f"ads_{d}",
            F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("input"),
            F.count(F.lit(1)).alias("groups"),
        )
        targets = []
        if ads_root:
            targets.append(lambda df: io.write_day(df, ads_root, d, rows_per_file=rows_per_file))
        if table and swap:
            targets.append(lambda df: versions.publish_day(df, table, d, rows_per_file=rows_per_file))
        elif table:
            targets.append(lambda df: io.insert_day(df, table, d))
        targets[0](result)
        for write in targets[1:]:
            write(kept)
        report = JobReport("ads", d, _metrics(obs, traffic, "input", "groups"))
    finally:
        if kept is not None:
            kept.unpersist()
    if report.counts["groups"] == 0:
        if ads_root:
            io.clear_day(spark, ads_root, ADS_SCHEMA, d)
        if table and not swap:
            io.clear_table_day(spark, table, d)
    if register_in:
        io.add_day_partition(spark, register_in, d, io.day_path(ads_root, d))
    return report


def storage_level(name: str) -> StorageLevel:
    """A storage level by its name, such as MEMORY_AND_DISK or DISK_ONLY_2."""
    level = getattr(StorageLevel, name.upper(), None)
    if not isinstance(level, StorageLevel) or name.upper() == "NONE":
        raise ValueError(f"unknown storage level {name!r}")
    return level


def report_job(spark: SparkSession, dwd_lines_path: str, out_path: str) -> JobReport:
    """V1 text report: DWD text lines -> `host<TAB>area<TAB>count` gzip text parts."""
    # Both counts are taken in the writing stage.
    counted = ads.area_report(ads.tsv_city_host(io.read_lines(spark, dwd_lines_path)))
    report, obs = _observed(
        counted, "report", F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("input"), F.count(F.lit(1)).alias("rows")
    )
    io.write_text(ads.report_lines(report), out_path, compression="gzip")
    return JobReport("report", "", _metrics(obs, counted, "input", "rows"))


def export_job(spark: SparkSession, table: str, **jdbc) -> None:
    """Catalog table -> JDBC table (re-runnable: overwrite with truncate)."""
    io.write_jdbc(spark.table(table), **jdbc)


# ------------------------------------------------------------------ V1 text chain
def ods_text_job(spark: SparkSession, raw_path: str, out_path: str) -> JobReport:
    """V1 ODS: raw lines -> cleaned ODS rows as text lines (overwrite the folder)."""
    tagged = ods.tag(io.read_lines(spark, raw_path))
    observed, obs = _observed(tagged, "ods_text", *ods.count_columns())
    io.write_text(ods.text_lines(ods.good(observed)), out_path, compression=None)
    return JobReport("ods_text", "", _metrics(obs, tagged, "total", "good", "short", "dirty_size"))


def dwd_text_job(spark: SparkSession, ip_path: str, ods_text_path: str, out_path: str, **join_opts) -> JobReport:
    """V1 DWD: ODS text lines -> DWD text lines, one IP row per ip, '-' on a miss."""
    pre = dwd.widen(ods.good(ods.tag(io.read_lines(spark, ods_text_path))))
    plan: list = []
    wide = dwd.enrich_lookup(pre, dwd.ip_dim(io.read_lines(spark, ip_path)), plan=plan, **join_opts)
    observed, obs = _observed(wide, "dwd_text", F.count(F.lit(1)).alias("rows"))
    io.write_text(ads.dwd_lines(observed), out_path, compression=None)
    return JobReport("dwd_text", "", _metrics(obs, wide, "rows"), plan)


def ads_from_text_job(spark: SparkSession, dwd_text_path: str, ads_root: str, d: str) -> JobReport:
    """V1 ADS: DWD text lines (city field 11, host field 14) -> ADS day, parquet."""
    result = ads.area_traffic_from_lines(io.read_lines(spark, dwd_text_path))
    observed, obs = _observed(
        result,
        f"ads_text_{d}",
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("input"),
        F.count(F.lit(1)).alias("groups"),
    )
    io.write_day(observed, ads_root, d)
    report = JobReport("ads_text", d, _metrics(obs, result, "input", "groups"))
    if report.counts["groups"] == 0:
        io.clear_day(spark, ads_root, ADS_SCHEMA, d)
    return report
