"""DWD layer: typed numbers, time and URL parts, and the IP lookup.

* ``ip_dim``: pipe-separated IP library lines -> ip, province, city, isp.
* ``widen``: ODS rows -> pre-DWD rows (18 columns, `time` still present).
* ``enrich``: the V2 rule. Left join on the exact ip string; a miss gives
  NULL province/city/isp, a duplicated ip in the library fans out.
* ``enrich_lookup``: the V1 rule. One library row per ip (value tie-break:
  greatest province, then city, then isp) and '-' for a miss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.functions.parse import (
    DIRTY_SIZE,
    IP_FIELD_POS,
    IP_SEP,
    MISSING,
    NUMBER_DEFAULT,
    field,
    long_or,
    split_fields,
    time_parts,
    url_parts,
)
from accesslake.operators.joins import lookup_join
from accesslake.schemas import DWD_COLS, IP_ATTRS, IP_DIM_COLS, PRE_DWD_COLS


def ip_dim(lines: DataFrame, value: str = "value") -> DataFrame:
    """IP library text lines -> (ip, province, city, isp); missing fields NULL."""
    fields = split_fields(F.col(value), IP_SEP)
    return lines.select(*[field(fields, IP_FIELD_POS[c]).alias(c) for c in IP_DIM_COLS])


def widen(ods: DataFrame) -> DataFrame:
    """ODS rows -> pre-DWD rows: typed numbers, URL parts, time parts."""
    protocol, host, path, params = url_parts(F.col("url"))
    year, month, day = time_parts(F.col("time"))
    return ods.select(
        "time",
        "ip",
        "proxyIp",
        long_or(F.col("responseTime"), NUMBER_DEFAULT).alias("responseTime"),
        "referer",
        "method",
        "url",
        "httpCode",
        long_or(F.col("requestSize"), NUMBER_DEFAULT).alias("requestSize"),
        F.coalesce(F.col("responseSize"), F.lit(DIRTY_SIZE).cast("bigint")).alias("responseSize"),
        "cache",
        protocol.alias("protocol"),
        host.alias("host"),
        path.alias("path"),
        params.alias("params"),
        year.alias("year"),
        month.alias("month"),
        day.alias("day"),
    ).select(*PRE_DWD_COLS)


def time_columns(ods: DataFrame) -> DataFrame:
    """time -> year, month, day."""
    year, month, day = time_parts(F.col("time"))
    return ods.select("time", year.alias("year"), month.alias("month"), day.alias("day"))


def url_columns(ods: DataFrame) -> DataFrame:
    """url -> protocol, host, path, params."""
    protocol, host, path, params = url_parts(F.col("url"))
    return ods.select(
        "url", protocol.alias("protocol"), host.alias("host"), path.alias("path"), params.alias("params")
    )


def enrich(pre: DataFrame, dim: DataFrame, **join_opts) -> DataFrame:
    """V2: `pre LEFT JOIN dim USING (ip)` -> the 20 DWD columns."""
    return lookup_join(pre, dim.select(*IP_DIM_COLS), "ip", "left", **join_opts).select(*DWD_COLS)


def dedupe_dim(dim: DataFrame) -> DataFrame:
    """One row per ip: the greatest (province, city, isp); NULL sorts lowest.

    An aggregate with a map-side partial step, so an ip repeated in a third of
    the library is combined per task and never lands whole in one task (Spark
    runs a maximum over strings as a sort-based aggregate).
    """
    best = F.max(F.struct(*[F.col(c) for c in IP_ATTRS])).alias("best")
    return dim.groupBy("ip").agg(best).select("ip", *[F.col(f"best.{c}").alias(c) for c in IP_ATTRS])


def enrich_lookup(pre: DataFrame, dim: DataFrame, **join_opts) -> DataFrame:
    """V1: one library row per ip, '-' when the ip is unknown."""
    lines = dim.select(*IP_DIM_COLS)
    # The lines bound the deduplicated rows, so the library is aggregated once.
    joined = lookup_join(pre, dedupe_dim(lines), "ip", "left", size_of=lines, **join_opts)
    return joined.select(
        *[F.coalesce(F.col(c), F.lit(MISSING)).alias(c) if c in IP_ATTRS else F.col(c) for c in DWD_COLS]
    )
