"""


Every query starts from the driver's tables: the raw access-log lines and the
IP library lines are derived from `events`/`pages` and
`customer`/`nation`/`region` by Spark (``accesslake.sources.fixtures``), so
the work of every query grows with those tables.
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable

# Importable however this file is loaded (by path or as a module). Executors
# never import the package: every expression runs in the JVM.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.functions.parse import long_or
from accesslake.operators import ads, dwd, ods
from accesslake.plans import jobs
from accesslake.schemas import ADS_SCHEMA, GOOD, ODS_SCHEMA, REJECTED, REJECTS_SCHEMA
from accesslake.sources import fixtures, io, versions

FLAGSHIP_SF = "/root/testdata/sf0.001"
# Days used by the sink round trips.
DAY_1 = "20240101"
DAY_2 = "20240102"
PREVIEW_ROWS = 55
# An ip of no customer, for the join with a key hot on both sides.
BUSY_IP = "10.200.0.1"


# ----------------------------------------------------------------- building blocks
def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_access(spark, sf)


def _ods(spark: SparkSession, sf: str) -> DataFrame:
    return ods.clean(_raw(spark, sf))[0]


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    return dwd.ip_dim(fixtures.ip_lines(spark, sf))


def _pre(spark: SparkSession, sf: str) -> DataFrame:
    return dwd.widen(_ods(spark, sf))


def _dwd(spark: SparkSession, sf: str, **join_opts) -> DataFrame:
    return dwd.enrich(_pre(spark, sf), _dim(spark, sf), **join_opts)


def _dwd_v1(spark: SparkSession, sf: str) -> DataFrame:
    return dwd.enrich_lookup(_pre(spark, sf), _dim(spark, sf))


# ----------------------------------------------------------------------- queries
def q_raw_fields(spark, sf):
    return ods.raw_fields(_raw(spark, sf))


def q_ods_access(spark, sf):
    return _ods(spark, sf)


def q_ods_rejects(spark, sf):
    return ods.clean(_raw(spark, sf))[1]


def q_job_counts(spark, sf):
    return ods.counts(_raw(spark, sf))


def q_numeric_defaults(spark, sf):
    o = _ods(spark, sf)
    return o.select(
        F.col("responseTime").alias("responseTime_text"),
        long_or(F.col("responseTime"), 0).alias("responseTime"),
        F.col("requestSize").alias("requestSize_text"),
        long_or(F.col("requestSize"), 0).alias("requestSize"),
        F.coalesce(F.col("responseSize"), F.lit(-1).cast("bigint")).alias("responseSize"),
    )


def q_time_parts(spark, sf):
    return dwd.time_columns(_ods(spark, sf))


def q_url_parts(spark, sf):
    return dwd.url_columns(_ods(spark, sf))


def q_ip_dim(spark, sf):
    return _dim(spark, sf)


def q_dwd_access(spark, sf):
    return _dwd(spark, sf)


def q_dwd_access_shuffle(spark, sf):
    """J1 as planned when the IP library is too big to broadcast (salted shuffle).

    A low hot-key threshold makes the busiest ips of these small tables go
    through the salting, so the check covers that path end to end.
    """
    return _dwd(spark, sf, max_broadcast_rows=0, hot_share=0.005, sample_fraction=0.5)


def q_dwd_lookup_default(spark, sf):
    return _dwd_v1(spark, sf)


def q_ads_area_traffic(spark, sf):
    return ads.area_traffic(_dwd(spark, sf))


def q_ads_area_report(spark, sf):
    return ads.area_report(_dwd(spark, sf))


def q_ads_report_lines(spark, sf):
    """A2 + P14 + S9: gzip text report in parts, read back."""
    path = io.scratch_dir(spark, "report")
    io.write_text(ads.report_lines(ads.area_report(_dwd(spark, sf))), path, compression="gzip")
    return io.read_lines(spark, path)


def q_ads_report_from_tsv(spark, sf):
    """The report job over V1 DWD text, read back."""
    tsv, path = io.scratch_dir(spark, "dwd_tsv"), io.scratch_dir(spark, "report")
    io.write_text(ads.dwd_lines(_dwd_v1(spark, sf)), tsv, compression=None)
    jobs.report_job(spark, tsv, path)
    return io.read_lines(spark, path)


def q_ads_from_dwd_day(spark, sf):
    """A DWD day written, other rows first, and read by day and two columns."""
    root = io.scratch_dir(spark, "dwd")
    io.write_day(_dwd_v1(spark, sf).where("city = '-'"), root, DAY_1)
    io.write_day(_dwd(spark, sf), root, DAY_1)
    return jobs.area_traffic_day(spark, root, DAY_1)


def q_ads_from_day_view(spark, sf):
    """SQL over the view of a DWD day."""
    root = io.scratch_dir(spark, "dwd")
    io.write_day(_dwd_v1(spark, sf), root, DAY_1)
    io.register_day_views(spark, {"dwd_access": root}, DAY_1)
    return spark.sql("SELECT city, host, count(1) AS count FROM dwd_access GROUP BY city, host")


def q_ods_job_counts(spark, sf):
    """The counts that the ODS job reports for a day of raw text."""
    raw, root = io.scratch_dir(spark, "raw"), io.scratch_dir(spark, "ods")
    io.write_text(_raw(spark, sf), raw, compression=None)
    counts = jobs.ods_job(spark, raw, root, DAY_1).counts
    return spark.read.text(raw).limit(1).select(*[F.lit(counts[c]).cast("bigint").alias(c) for c in ("total", "good", "short", "dirty_size")])


def q_ods_split_day(spark, sf):
    """Good and rejected lines of a day from one scan, both read back; a first
    run over other lines is replaced."""
    raw, split = io.scratch_dir(spark, "raw"), io.scratch_dir(spark, "ods_split")
    roots = [io.kind_root(split, kind) for kind in (GOOD, REJECTED)]
    lines = _raw(spark, sf)
    for n, part in enumerate((lines.where("length(value) % 2 = 0"), lines)):
        io.write_text(part, f"{raw}/{n}", compression=None)
        jobs.ods_job(spark, f"{raw}/{n}", roots[0], DAY_1, rejects_root=roots[1])
    good, rejected = (io.read_day(spark, root, schema, DAY_1) for root, schema in zip(roots, (ODS_SCHEMA, REJECTS_SCHEMA)))
    return good.unionByName(rejected, allowMissingColumns=True)


def q_ods_table_day(spark, sf):
    """The days of the ODS and the rejects table, swapped after one scan."""
    raw, good, bad = io.scratch_dir(spark, "raw"), f"ods_{uuid.uuid4().hex[:8]}", f"rejects_{uuid.uuid4().hex[:8]}"
    io.write_text(_raw(spark, sf), raw, compression=None)
    io.create_day_table(spark, good, ODS_SCHEMA, io.scratch_dir(spark, "ods_table"))
    io.create_day_table(spark, bad, REJECTS_SCHEMA, io.scratch_dir(spark, "rejects_table"))
    jobs.ods_table_job(spark, raw, good, bad, DAY_1)
    return spark.table(good).unionByName(spark.table(bad), allowMissingColumns=True)


def q_ods_days_by_glob(spark, sf):
    """Two of three days by a glob over their part files, the day from each file's path."""
    root = io.scratch_dir(spark, "ods")
    good = _ods(spark, sf)
    for d, rows in ((DAY_1, good), (DAY_2, good.where("httpCode = '200'")), ("20240201", good.where("httpCode = '404'"))):
        io.write_day(rows, root, d)
    return io.read_part_files(spark, f"{root}/d=202401*/part*", ODS_SCHEMA)


def q_ads_partition_swap(spark, sf):
    """A day published and then replaced by an atomic swap; what a reader sees
    with the new version written but not yet shown, and after the swap."""
    table = f"ads_swap_{uuid.uuid4().hex[:8]}"
    io.create_day_table(spark, table, ADS_SCHEMA, io.scratch_dir(spark, "ads_swap"))
    result = ads.area_traffic(_dwd(spark, sf)).persist()
    try:
        old = versions.publish_day(result.where("count > 1"), table, DAY_1)
        new = versions.write_version(result, table, DAY_1)
    finally:
        result.unpersist()
    # The day's folder as the catalog names it before the swap: still the old version.
    before = spark.read.schema(ADS_SCHEMA).parquet(versions.day_location(spark, table, DAY_1))
    versions.swap_day(spark, table, DAY_1, new.path)
    versions.drop_old_versions(spark, table, DAY_1, keep=1)
    seen = [(F.lit("before"), before, old.rows), (F.lit("after"), spark.table(table).drop("d"), new.rows)]
    return seen[0][1].select("*", seen[0][0].alias("seen"), F.lit(seen[0][2]).cast("bigint").alias("n_rows")).unionByName(
        seen[1][1].select("*", seen[1][0].alias("seen"), F.lit(seen[1][2]).cast("bigint").alias("n_rows"))
    )


def q_dwd_access_grid(spark, sf):
    """J1 with an ip that many log lines and many library lines have (grid of salts)."""
    pre, dim = _pre(spark, sf), _dim(spark, sf)
    busy = dim.where("city = 'DUP'").select(F.lit(BUSY_IP).alias("ip"), F.col("ip").alias("province"), "city", "isp")
    busy_pre = pre.withColumn("ip", F.when(F.col("responseSize") % 50 == 0, F.lit(BUSY_IP)).otherwise(F.col("ip")))
    return dwd.enrich(busy_pre, dim.unionByName(busy), max_broadcast_rows=0, hot_share=0.01, sample_fraction=0.5)


def q_ads_from_tsv(spark, sf):
    """V1 DWD written as tab-separated text, read back, counted."""
    path = io.scratch_dir(spark, "dwd_tsv")
    io.write_text(ads.dwd_lines(_dwd_v1(spark, sf)), path, compression=None)
    return ads.area_traffic_from_lines(io.read_lines(spark, path))


def q_ads_preview(spark, sf):
    return ads.preview(ads.area_traffic(_dwd(spark, sf)), PREVIEW_ROWS)


def q_ods_parquet_roundtrip(spark, sf):
    """Some rows written to day 1, then all to day 2 and to day 1; all read back."""
    root = io.scratch_dir(spark, "ods")
    good = _ods(spark, sf)
    io.write_day(good.where("httpCode = '200'"), root, DAY_1)
    for d in (DAY_2, DAY_1):
        io.write_day(good, root, d)
    return io.read_days(spark, root, ODS_SCHEMA)


def q_ods_text_roundtrip(spark, sf):
    """ODS written as V1 text lines (trailing tab), read back and parsed."""
    path = io.scratch_dir(spark, "ods_text")
    io.write_text(ods.text_lines(_ods(spark, sf)), path, compression=None)
    return ods.clean(io.read_lines(spark, path))[0]


def q_ads_partition_rerun(spark, sf):
    """insertInto a table: other rows for day 1, then day 2 and day 1."""
    table = f"ads_areatrafstat_{uuid.uuid4().hex[:8]}"
    io.create_day_table(spark, table, ADS_SCHEMA, io.scratch_dir(spark, "ads_table"))
    # One aggregated result (one row per city and host) feeds three writes:
    # computed once and kept, instead of re-running the pipeline per write.
    result = ads.area_traffic(_dwd(spark, sf)).cache()
    try:
        io.insert_day(result.withColumn("count", -F.col("count")).where("count < -1"), table, DAY_1)
        for d in (DAY_2, DAY_1):
            io.insert_day(result, table, d)
    finally:
        result.unpersist()
    return spark.table(table)


def q_ads_partition_register(spark, sf):
    """Files written under a table's folder, then registered."""
    location = io.scratch_dir(spark, "ads_ext")
    table = f"ads_ext_{uuid.uuid4().hex[:8]}"
    io.create_day_table(spark, table, ADS_SCHEMA, location)
    io.write_day(ads.area_traffic(_dwd(spark, sf)), location, DAY_1)
    io.add_day_partition(spark, table, io.day_of_path(io.day_path(location, DAY_1)))
    return spark.table(table)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_fields": q_raw_fields,
    "ods_access": q_ods_access,
    "ods_rejects": q_ods_rejects,
    "job_counts": q_job_counts,
    "numeric_defaults": q_numeric_defaults,
    "time_parts": q_time_parts,
    "url_parts": q_url_parts,
    "ip_dim": q_ip_dim,
    "dwd_access": q_dwd_access,
    "dwd_access_shuffle": q_dwd_access_shuffle,
    "dwd_lookup_default": q_dwd_lookup_default,
    "ads_area_traffic": q_ads_area_traffic,
    "ads_area_report": q_ads_area_report,
    "ads_report_lines": q_ads_report_lines,
    "ads_report_from_tsv": q_ads_report_from_tsv,
    "ads_from_dwd_day": q_ads_from_dwd_day,
    "ads_from_day_view": q_ads_from_day_view,
    "ods_job_counts": q_ods_job_counts,
    "ods_split_day": q_ods_split_day,
    "ods_table_day": q_ods_table_day,
    "ods_days_by_glob": q_ods_days_by_glob,
    "ads_partition_swap": q_ads_partition_swap,
    "dwd_access_grid": q_dwd_access_grid,
    "ads_from_tsv": q_ads_from_tsv,
    "ads_preview": q_ads_preview,
    "ods_parquet_roundtrip": q_ods_parquet_roundtrip,
    "ods_text_roundtrip": q_ods_text_roundtrip,
    "ads_partition_rerun": q_ads_partition_rerun,
    "ads_partition_register": q_ads_partition_register,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: requests per city and host for the day (sf0.001)."""
    return q_ads_area_traffic(spark, FLAGSHIP_SF)


# The training-data operators and their pipeline are optional: their folders
# may be absent. Only their absence is excused; an import that fails inside
# them is raised.
_OPTIONAL = ("accesslake.llm", "accesslake.llm.entry", "corpus_pipeline")


def _optional(module: str):
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name not in _OPTIONAL:
            raise
        return None


_LLM = _optional("accesslake.llm.entry")
_PIPELINE = _optional("corpus_pipeline") if _LLM else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    if _LLM:
        found |= _LLM.QUERIES
    if _PIPELINE:
        found["pipeline"] = _PIPELINE.run
    return found


# -------------------------------------------------------------------- oracle SQL
# Long.parseLong (DuckDB's TRY_CAST alone would round '1.5' and read '1e3').

_NUM = "[+-]?[0-9]+"
_YMD = "^.[0-9]{4}/[0-9]{2}/[0-9]{2}"
_DMY = "^.[0-9]{2}/[0-9]{2}/[0-9]{4}"
_URL_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"
_URL_AUTHORITY = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_URL_HOSTPORT = "^(?:[^@]*@)?([^@]*)$"
_URL_PATH = "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)"
_URL_QUERY = "^[^?#]*[?]([^#]*)"
_URL_PROTOCOLS = "'http', 'https', 'ftp', 'file', 'jar', 'mailto', 'netdoc'"
_URL_UNC = "^[A-Za-z][A-Za-z0-9+.-]*:////"
_IPV6_FULL = "^\\[(0*[0-9A-Fa-f]{1,4}:){7}0*[0-9A-Fa-f]{1,4}\\]$"
_IPV6_SHORT = "^\\[(0*[0-9A-Fa-f]{1,4}(:0*[0-9A-Fa-f]{1,4})*)?::(0*[0-9A-Fa-f]{1,4}(:0*[0-9A-Fa-f]{1,4})*)?\\]$"
_OCTET = "(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_IPV6_IPV4 = ":" + "\\.".join([_OCTET] * 4) + "\\]$"
_NO_SPACE = "[^\\x09-\\x0D\\x1C-\\x20]"
_JAR_PORT = ("(:([+]?0*([0-9]{1,9}|1[0-9]{9}|20[0-9]{8}|21[0-3][0-9]{7}|214[0-6][0-9]{6}|2147[0-3][0-9]{5}|21474[0-7][0-9]{4}"
             "|214748[0-2][0-9]{3}|2147483[0-5][0-9]{2}|21474836[0-3][0-9]|214748364[0-7])|-0*[01])?)?")
_JAR_AUTHORITY = ("([^@/?]*@[^@/?]*@[^/?]*|([^@/?]*@)?(([^:@/?\\[][^:@/?]*)?|\\[[0-9A-Fa-f.]*:[0-9A-Fa-f.:]*(%[^\\]/?]+)?\\])"
                  + _JAR_PORT + ")")
_JAR_URL = ("(?i)^[\\x00-\\x20]*(url:)?(mailto:.*" + _NO_SPACE + "|(https?|ftp|file|netdoc):(/?$|/?[^/]|//" + _JAR_AUTHORITY + "([/?]|$)))")


def _url_sql(u: str) -> tuple[str, str, str, str]:
    """DuckDB: (protocol, host, path, params) of the URL text `u`."""
    scheme = f"regexp_extract({u}, '{_URL_SCHEME}', 1)"
    hp = f"regexp_extract(regexp_extract({u}, '{_URL_AUTHORITY}', 1), '{_URL_HOSTPORT}', 1)"
    colon = f"instr({hp}, ':')"
    v6, after = (f"regexp_extract({hp}, '^(\\[[^\\]]*\\])(.*)$', {g})" for g in (1, 2))
    addr = f"regexp_replace(regexp_replace({v6}, '%[^\\]]+\\]$', ']'), '{_IPV6_IPV4}', ':0:0]')"
    v6_ok = (f"(NOT starts_with({hp}, '[') OR ((regexp_matches({addr}, '{_IPV6_FULL}') OR (regexp_matches({addr}, '{_IPV6_SHORT}') "
             f"AND len(regexp_extract_all({addr}, '[0-9A-Fa-f]+')) <= 7)) AND ({after} = '' OR starts_with({after}, ':'))))")
    host = f"(CASE WHEN starts_with({hp}, '[') THEN {v6} WHEN {colon} > 0 THEN substr({hp}, 1, {colon} - 1) ELSE {hp} END)"
    port = f"(CASE WHEN starts_with({hp}, '[') THEN substr({after}, 2) WHEN {colon} > 0 THEN substr({hp}, {colon} + 1) ELSE '' END)"
    port_ok = (f"({port} = '' OR (regexp_full_match({port}, '{_NUM}') "
               f"AND coalesce(TRY_CAST({port} AS INTEGER), -2) >= -1))")
    opaque = f"lower({scheme}) IN ('mailto', 'jar')"
    rest = f"regexp_extract({u}, '^[A-Za-z]+:([^#]*)', 1)"
    ok = (f"coalesce(lower({scheme}) IN ({_URL_PROTOCOLS}) AND CASE lower({scheme}) "
          f"WHEN 'jar' THEN regexp_matches(regexp_extract({u}, '^[A-Za-z]+:([^#]*)!/', 1), '{_JAR_URL}') "
          f"WHEN 'mailto' THEN regexp_matches({rest}, '{_NO_SPACE}') ELSE {port_ok} AND {v6_ok} END, false)")
    path = f"regexp_extract({u}, '{_URL_PATH}', 1)"
    query = f"CASE WHEN {opaque} THEN regexp_extract({rest}, '[?]([^?]*)$', 1) ELSE regexp_extract({u}, '{_URL_QUERY}', 1) END"
    return (
        f"CASE WHEN {ok} THEN lower({scheme}) ELSE '-' END",
        f"CASE WHEN {ok} AND {opaque} THEN '' WHEN {ok} THEN {host} ELSE '-' END",
        f"CASE WHEN {ok} AND {opaque} THEN regexp_replace({rest}, '[?][^?]*$', '') WHEN {ok} AND regexp_matches({u}, '{_URL_UNC}') THEN '//' || {path} WHEN {ok} THEN {path} ELSE '-' END",
        f"CASE WHEN {ok} AND ({query}) <> '' THEN {query} ELSE '-' END",
    )


def _time_sql(t: str) -> tuple[str, str, str]:
    """DuckDB: (year, month, day) of the log time text `t`."""

    def part(ymd_pos: int, dmy_pos: int, width: int) -> str:
        return (f"CASE WHEN regexp_matches({t}, '{_YMD}') THEN substr({t}, {ymd_pos}, {width}) "
                f"WHEN regexp_matches({t}, '{_DMY}') THEN substr({t}, {dmy_pos}, {width}) ELSE '-' END")

    return part(2, 8, 4), part(7, 5, 2), part(10, 2, 2)


def _long(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '{_NUM}') THEN TRY_CAST({x} AS BIGINT) END)"


def _two(part: str) -> str:
    return f"lpad(CAST(extract({part} FROM ts) AS VARCHAR), 2, '0')"


_RAW_CTE = f"""
ev AS (
  SELECT e.event_id AS id, e.ts, e.user_id AS uid, e.event_type, p.url AS page_url
  FROM events e LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT max(page_id) + 1 FROM pages)
),
evp AS (
  SELECT *,
    CAST(extract(year FROM ts) AS VARCHAR) AS yyyy,
    {_two('month')} AS mm, {_two('day')} AS dd,
    concat_ws(':', {_two('hour')}, {_two('minute')},
              lpad(CAST(CAST(floor(extract(second FROM ts)) AS BIGINT) AS VARCHAR), 2, '0')) AS clock
  FROM ev
),
flds AS (
  SELECT id,
    '[' || CASE WHEN id % 97 = 5 THEN 'bad'
                WHEN id % 3 = 0 THEN dd || '/' || mm || '/' || yyyy || ':' || clock
                WHEN id % 3 = 1 THEN yyyy || '/' || mm || '/' || dd || ' ' || clock
                ELSE yyyy || '/' || mm || '/' || dd || '/:' || clock END || ' +0800]' AS f_time,
    '10.0.' || CAST(CAST(floor(uid / 256) AS BIGINT) AS VARCHAR) || '.' || CAST(uid % 256 AS VARCHAR) AS f_ip,
    CASE WHEN id % 10 = 5 THEN '10.1.0.' || CAST(uid % 256 AS VARCHAR) ELSE '-' END AS f_proxy,
    CASE WHEN id % 53 = 0 THEN 'n/a' ELSE CAST((id * 37) % 2500 AS VARCHAR) END AS f_rt,
    CAST(id % 500 AS VARCHAR) AS f_ref,
    CASE WHEN event_type IN ('click', 'view') THEN 'GET'
         WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'HEAD' END AS f_method,
    CASE WHEN id % 89 = 0 THEN 'not a url' WHEN id % 83 = 0 THEN 'http://a_b:8080/x y?'
         ELSE coalesce(page_url, 'https://plain.example.com') END AS f_url,
    CASE WHEN id % 4 = 0 THEN '200' WHEN id % 4 = 1 THEN '301' WHEN id % 4 = 2 THEN '404' ELSE '500' END AS f_code,
    CASE WHEN id % 59 = 0 THEN '' ELSE CAST((id * 7) % 500 AS VARCHAR) END AS f_rq,
    CASE WHEN id % 10 = 3 THEN '-' WHEN id % 101 = 0 THEN '-1' WHEN id % 103 = 0 THEN '1.5'
         ELSE CAST((id * 13) % 1000 AS VARCHAR) END AS f_rs,
    CASE WHEN id % 2 = 0 THEN 'HIT' ELSE 'MISS' END AS f_cache
  FROM evp
),
raw AS (
  SELECT CASE WHEN id % 211 = 7 THEN concat_ws(chr(9), f_time, f_ip, f_proxy)
              ELSE concat_ws(chr(9), f_time, f_ip, f_proxy, f_rt, f_ref, f_method, f_url, f_code, f_rq, f_rs, f_cache)
         END AS value
  FROM flds
),
split AS (SELECT value, string_split(value, chr(9)) AS f FROM raw),
tagged AS (
  SELECT value, len(f) AS n_fields,
    f[1] AS "time", f[2] AS ip, f[3] AS "proxyIp", f[4] AS "responseTime", f[5] AS referer,
    f[6] AS method, f[7] AS url, f[8] AS "httpCode", f[9] AS "requestSize",
    coalesce({_long('f[10]')}, -1) AS "responseSize", f[11] AS cache
  FROM split
),
tagged2 AS (
  SELECT *, CASE WHEN n_fields < 11 THEN 'short' WHEN "responseSize" = -1 THEN 'dirty_size' END AS reason
  FROM tagged
),
ods AS (
  SELECT "time", ip, "proxyIp", "responseTime", referer, method, url, "httpCode", "requestSize",
         "responseSize", cache
  FROM tagged2 WHERE reason IS NULL
)"""


_URL_COLS = _url_sql("regexp_replace(regexp_replace(url, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '^[uU][rR][lL]:', '')")

_PRE_CTE = f"""
pre AS (
  SELECT "time", ip, "proxyIp",
    coalesce({_long('"responseTime"')}, 0) AS "responseTime",
    referer, method, url, "httpCode",
    coalesce({_long('"requestSize"')}, 0) AS "requestSize",
    coalesce("responseSize", -1) AS "responseSize",
    cache,
    {_URL_COLS[0]} AS protocol,
    {_URL_COLS[1]} AS host,
    {_URL_COLS[2]} AS path,
    {_URL_COLS[3]} AS params,
    {_time_sql('"time"')[0]} AS year,
    {_time_sql('"time"')[1]} AS month,
    {_time_sql('"time"')[2]} AS day
  FROM ods
)"""

_DIM_CTE = """
cg AS (
  SELECT c.c_custkey AS k, c.c_mktsegment AS seg, n.n_name, r.r_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
cip AS (
  SELECT *, '10.0.' || CAST(CAST(floor(k / 256) AS BIGINT) AS VARCHAR) || '.' || CAST(k % 256 AS VARCHAR) AS ipt FROM cg
),
ip_lines AS (
  SELECT ipt || '||||||' || r_name || '|' || n_name || '||' || seg || '||||0|0' AS value FROM cip WHERE k % 5 <> 0
  UNION ALL
  SELECT ipt || '||||||DUP|DUP||DUP||||0|0' AS value FROM cip WHERE k % 7 = 1
),
ipdim AS (
  SELECT s[1] AS ip, s[7] AS province, s[8] AS city, s[10] AS isp
  FROM (SELECT string_split(value, '|') AS s FROM ip_lines)
),
ipdim1 AS (
  SELECT ip, province, city, isp FROM (
    SELECT *, row_number() OVER (PARTITION BY ip ORDER BY province DESC NULLS LAST,
                                 city DESC NULLS LAST, isp DESC NULLS LAST) AS rn
    FROM ipdim) WHERE rn = 1
)"""

_DWD_COLS_SQL = """a.ip, a."proxyIp", a."responseTime", a.referer, a.method, a.url, a."httpCode",
  a."requestSize", a."responseSize", a.cache, {prov}, {city}, {isp}, a.protocol, a.host, a.path,
  a.params, a.year, a.month, a.day"""

_DWD_CTE = """
dwd AS (
  SELECT """ + _DWD_COLS_SQL.format(prov="i.province", city="i.city", isp="i.isp") + """
  FROM pre a LEFT JOIN ipdim i ON a.ip = i.ip
),
dwd1 AS (
  SELECT """ + _DWD_COLS_SQL.format(
    prov="coalesce(i.province, '-') AS province",
    city="coalesce(i.city, '-') AS city",
    isp="coalesce(i.isp, '-') AS isp",
) + """
  FROM pre a LEFT JOIN ipdim1 i ON a.ip = i.ip
),
ads AS (SELECT city, host, count(*) AS "count" FROM dwd GROUP BY city, host),
report AS (SELECT host, city AS area, count(*) AS "count" FROM dwd GROUP BY host, city)"""

_ALL_CTES = "WITH " + ",".join([_RAW_CTE, _PRE_CTE, _DIM_CTE, _DWD_CTE]) + "\n"

_ODS_SEL = """"time", ip, "proxyIp", "responseTime", referer, method, url, "httpCode", "requestSize",
  "responseSize", cache"""

_SPLIT_SEL = ", ".join(f"""CASE WHEN reason IS NULL THEN {c.strip()} END AS {c.strip()}""" for c in _ODS_SEL.split(",")) + \
    ", CASE WHEN reason IS NOT NULL THEN value END AS value, reason"

_ORACLE_BODIES = {
    "raw_fields": """SELECT value, len(f) AS n_fields, f[1] AS "time", f[2] AS ip, f[3] AS "proxyIp",
  f[4] AS "responseTime", f[5] AS referer, f[6] AS method, f[7] AS url, f[8] AS "httpCode",
  f[9] AS "requestSize", f[10] AS "responseSize", f[11] AS cache FROM split""",
    "ods_access": "SELECT * FROM ods",
    "ods_rejects": "SELECT value, reason FROM tagged2 WHERE reason IS NOT NULL",
    "job_counts": """SELECT count(*) AS total, count(*) FILTER (WHERE reason IS NULL) AS good,
  count(*) FILTER (WHERE reason = 'short') AS short,
  count(*) FILTER (WHERE reason = 'dirty_size') AS dirty_size FROM tagged2""",
    "numeric_defaults": f"""SELECT "responseTime" AS "responseTime_text",
  coalesce({_long('"responseTime"')}, 0) AS "responseTime",
  "requestSize" AS "requestSize_text", coalesce({_long('"requestSize"')}, 0) AS "requestSize",
  coalesce("responseSize", -1) AS "responseSize" FROM ods""",
    "time_parts": 'SELECT "time", year, month, day FROM pre',
    "url_parts": "SELECT url, protocol, host, path, params FROM pre",
    "ip_dim": "SELECT * FROM ipdim",
    "dwd_access": "SELECT * FROM dwd",
    "dwd_access_shuffle": "SELECT * FROM dwd",
    "dwd_lookup_default": "SELECT * FROM dwd1",
    "ads_area_traffic": "SELECT * FROM ads",
    "ads_area_report": "SELECT * FROM report",
    "ads_report_lines": """SELECT concat_ws(chr(9), coalesce(host, 'null'), coalesce(area, 'null'),
  CAST("count" AS VARCHAR)) AS value FROM report""",
    "ads_report_from_tsv": """SELECT concat_ws(chr(9), coalesce(host, 'null'), city, CAST(count(*) AS VARCHAR)) AS value
  FROM dwd1 GROUP BY host, city""",
    "ads_from_dwd_day": "SELECT * FROM ads",
    "ads_from_day_view": """SELECT city, host, count(*) AS "count" FROM dwd1 GROUP BY city, host""",
    "ods_job_counts": """SELECT count(*) AS total, count(*) FILTER (WHERE reason IS NULL) AS good,
  count(*) FILTER (WHERE reason = 'short') AS short,
  count(*) FILTER (WHERE reason = 'dirty_size') AS dirty_size FROM tagged2""",
    "ods_split_day": f"SELECT {_SPLIT_SEL}, '{DAY_1}' AS d FROM tagged2",
    "ods_table_day": f"SELECT {_SPLIT_SEL}, '{DAY_1}' AS d FROM tagged2",
    "ods_days_by_glob": f"""SELECT {_ODS_SEL}, '{DAY_1}' AS d FROM ods
  UNION ALL SELECT {_ODS_SEL}, '{DAY_2}' AS d FROM ods WHERE "httpCode" = '200'""",
    "ads_partition_swap": """SELECT city, host, "count", 'before' AS seen, count(*) OVER () AS n_rows FROM ads WHERE "count" > 1
  UNION ALL SELECT city, host, "count", 'after' AS seen, count(*) OVER () AS n_rows FROM ads""",
    "dwd_access_grid": """SELECT """ + _DWD_COLS_SQL.format(prov="i.province", city="i.city", isp="i.isp").replace("a.ip", "a.busy_ip AS ip") + f"""
  FROM (SELECT *, CASE WHEN "responseSize" % 50 = 0 THEN '{BUSY_IP}' ELSE ip END AS busy_ip FROM pre) a LEFT JOIN (
    SELECT ip, province, city, isp FROM ipdim UNION ALL SELECT '{BUSY_IP}', ip, city, isp FROM ipdim WHERE city = 'DUP') i ON a.busy_ip = i.ip""",
    "ads_from_tsv": """SELECT city, host, count(*) AS "count" FROM dwd1 GROUP BY city, host""",
    "ads_preview": """SELECT * FROM ads ORDER BY "count" DESC, city ASC NULLS FIRST, host ASC NULLS FIRST
  LIMIT """ + str(PREVIEW_ROWS),
    "ods_parquet_roundtrip": f"""SELECT {_ODS_SEL}, '{DAY_1}' AS d FROM ods
  UNION ALL SELECT {_ODS_SEL}, '{DAY_2}' AS d FROM ods""",
    "ods_text_roundtrip": "SELECT * FROM ods",
    "ads_partition_rerun": f"""SELECT city, host, "count", '{DAY_1}' AS d FROM ads
  UNION ALL SELECT city, host, "count", '{DAY_2}' AS d FROM ads""",
    "ads_partition_register": f"""SELECT city, host, "count", '{DAY_1}' AS d FROM ads""",
}


def oracle_sql() -> dict[str, str]:
    found = {k: _ALL_CTES + v for k, v in _ORACLE_BODIES.items()}
    if _LLM:
        found |= _LLM.ORACLE_SQL
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        found["pipeline"] = _PIPELINE.ORACLE_SQL
    return found
