"""Command-line entry for spark-submit, configured with `spark.app.*` settings.

    spark-submit accesslake/plans/submit.py ods \\
        --conf spark.app.inputPath=hdfs:///dw/raw/access/d=20240101 \\
        --conf spark.app.outputPath=hdfs:///dw/ods/access/d=20240101

Paths that end in `d=YYYYMMDD` give the day and the table root; otherwise set
`spark.app.day`. Jobs:

* `ods`:   inputPath (raw text) -> outputPath (ODS day); optional spark.app.rejectsPath (root;
  with outputPath <root>/kind=good/d=<day> and rejectsPath <root>/kind=rejected both come from
  one scan;. spark.app.heavyKeys=true keeps the day's heavy ips
  for the DWD join). Or spark.app.table and spark.app.rejectsTable (catalog tables, swapped atomically)
* `dwd`:   ipResourcePath, inputPath (ODS day) -> outputPath (DWD day); spark.app.lookup=join|default
* `ads`:   inputPath (DWD day) -> outputPath (ADS day; with spark.app.registerIn the
  day is added to that catalog table), spark.app.table (catalog table; with
  spark.app.swap=true its day is swapped atomically), or both, which needs
  spark.app.storageLevel (the result is computed once and kept at that level)
* `drop_versions`: old versions of a swapped day (spark.app.table, day, keep=1)
* `report`: inputPath (V1 DWD text) -> outputPath (gzip text report)
* `export`: spark.app.table -> JDBC (spark.app.url, dbtable, user, password, mode,
  truncate, numPartitions, batchsize, isolationLevel, createTableOptions,
  createTableColumnTypes, customSchema)
* V1 text chain: `ods_text` (inputPath -> outputPath), `dwd_text` (ipResourcePath,
  inputPath -> outputPath), `ads_text` (inputPath -> outputPath, an ADS day)

`spark.app.perBlockRowsForSnappy` sets the rows per output file of a folder;
`spark.app.printSchema=true` prints the output's schema and one row (the busiest
55 groups for ADS).
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from accesslake.operators import ads
from accesslake.plans import jobs
from accesslake.schemas import ADS_SCHEMA, DWD_SCHEMA, ODS_SCHEMA
from accesslake.session import apply_cluster_conf
from accesslake.sources import io, versions

PREFIX = "spark.app."
JOBS = ("ods", "dwd", "ads", "report", "export", "ods_text", "dwd_text", "ads_text", "drop_versions")
OUTPUT_SCHEMAS = {"ods": ODS_SCHEMA, "dwd": DWD_SCHEMA, "ads": ADS_SCHEMA, "ads_text": ADS_SCHEMA}
ADS_PREVIEW_ROWS = 55
# JDBC writer options by the name of their setting.
JDBC_OPTIONS = ("batchsize", "isolationLevel", "createTableOptions", "createTableColumnTypes", "customSchema")


def _conf(spark: SparkSession, name: str, default: str | None = None) -> str | None:
    return spark.conf.get(PREFIX + name, default)


def _need(spark: SparkSession, name: str) -> str:
    v = _conf(spark, name)
    if not v:
        raise ValueError(f"set --conf {PREFIX}{name}")
    return v


def _root_and_day(spark: SparkSession, path: str) -> tuple[str, str]:
    """(table root, day) from `<root>/d=<day>` or from `<root>` plus spark.app.day."""
    try:
        d = io.day_of_path(path)
        return path.rstrip("/").rsplit("/", 1)[0], d
    except ValueError:
        return path, _need(spark, "day")


def _show_output(spark: SparkSession, path: str, schema) -> None:
    """printSchema and a preview of the day just written."""
    root, d = _root_and_day(spark, path)
    _show(io.read_day(spark, root, schema, d), schema)


def _show(out, schema) -> None:
    out.printSchema()
    if schema is ADS_SCHEMA:
        ads.preview(out, ADS_PREVIEW_ROWS).show(ADS_PREVIEW_ROWS, truncate=False)
    else:
        out.show(1, truncate=False)


def run(spark: SparkSession, job: str) -> jobs.JobReport | None:
    report = _run(spark, job)
    if _conf(spark, "printSchema", "false").lower() == "true" and job in OUTPUT_SCHEMAS:
        if job == "ods" and _conf(spark, "table"):
            _show(spark.table(_need(spark, "table")).where(F.col("d") == _need(spark, "day")), ODS_SCHEMA)
        elif job == "ads" and _conf(spark, "table") and not _conf(spark, "outputPath"):
            _, d = _root_and_day(spark, _need(spark, "inputPath"))
            _show(spark.table(_need(spark, "table")).where(F.col("d") == d), ADS_SCHEMA)
        else:
            _show_output(spark, _need(spark, "outputPath"), OUTPUT_SCHEMAS[job])
    return report


def _run(spark: SparkSession, job: str) -> jobs.JobReport | None:
    rows = int(_conf(spark, "perBlockRowsForSnappy", str(io.DEFAULT_ROWS_PER_FILE)))
    if job == "drop_versions":
        versions.drop_old_versions(spark, _need(spark, "table"), _need(spark, "day"), keep=int(_conf(spark, "keep", "1")))
        return None
    if job == "ods" and _conf(spark, "table"):
        return jobs.ods_table_job(spark, _need(spark, "inputPath"), _need(spark, "table"), _need(spark, "rejectsTable"),
                                  _need(spark, "day"), rows_per_file=rows)
    if job == "ods":
        out_root, d = _root_and_day(spark, _need(spark, "outputPath"))
        return jobs.ods_job(spark, _need(spark, "inputPath"), out_root, d,
                            rejects_root=_conf(spark, "rejectsPath"), heavy_keys=_conf(spark, "heavyKeys", "false").lower() == "true",
                            rows_per_file=rows)
    if job == "dwd":
        in_root, d = _root_and_day(spark, _need(spark, "inputPath"))
        out_root, d_out = _root_and_day(spark, _need(spark, "outputPath"))
        if d_out != d:
            raise ValueError(f"input day {d} and output day {d_out} differ")
        return jobs.dwd_job(spark, _need(spark, "ipResourcePath"), in_root, out_root, d,
                            lookup=_conf(spark, "lookup", "join"), rows_per_file=rows)
    if job == "ads":
        in_root, d = _root_and_day(spark, _need(spark, "inputPath"))
        table = _conf(spark, "table")
        swap = _conf(spark, "swap", "false").lower() == "true"
        if table and not _conf(spark, "outputPath"):
            return jobs.ads_job(spark, in_root, d, table=table, swap=swap, **({"rows_per_file": rows} if swap else {}))
        out_root, d_out = _root_and_day(spark, _need(spark, "outputPath"))
        if d_out != d:
            raise ValueError(f"input day {d} and output day {d_out} differ")
        return jobs.ads_job(spark, in_root, d, ads_root=out_root, table=table, swap=swap, persist=_conf(spark, "storageLevel"),
                            register_in=_conf(spark, "registerIn"), rows_per_file=rows)
    if job == "ods_text":
        return jobs.ods_text_job(spark, _need(spark, "inputPath"), _need(spark, "outputPath"))
    if job == "dwd_text":
        return jobs.dwd_text_job(spark, _need(spark, "ipResourcePath"), _need(spark, "inputPath"), _need(spark, "outputPath"))
    if job == "ads_text":
        out_root, d = _root_and_day(spark, _need(spark, "outputPath"))
        return jobs.ads_from_text_job(spark, _need(spark, "inputPath"), out_root, d)
    if job == "report":
        return jobs.report_job(spark, _need(spark, "inputPath"), _need(spark, "outputPath"))
    if job == "export":
        parts = _conf(spark, "numPartitions")
        jobs.export_job(spark, _need(spark, "table"), url=_need(spark, "url"), dbtable=_need(spark, "dbtable"),
                        user=_conf(spark, "user"), password=_conf(spark, "password"), mode=_conf(spark, "mode", "overwrite"),
                        truncate=_conf(spark, "truncate", "true").lower() == "true",
                        num_partitions=int(parts) if parts else None,
                        **{o: v for o in JDBC_OPTIONS if (v := _conf(spark, o)) is not None})
        return None
    raise ValueError(f"unknown job {job!r}; use one of {', '.join(JOBS)}")


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    if len(argv) != 1:
        raise SystemExit(f"usage: submit.py {'|'.join(JOBS)}  (settings via --conf spark.app.*)")
    spark = SparkSession.builder.appName(f"accesslake-{argv[0]}").getOrCreate()
    apply_cluster_conf(spark, argv[0])
    report = run(spark, argv[0])
    if report is not None:
        print(report)


if __name__ == "__main__":
    main()
