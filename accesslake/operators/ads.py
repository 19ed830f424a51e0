"""ADS layer: requests per city and host, and its text report forms.

The count is a plain hash aggregate: Spark combines it map-side (partial
aggregate) before the shuffle, so a hot (city, host) group sends one partial
row per task, never its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.functions.parse import TSV_CITY_POS, TSV_HOST_POS, field, split_fields, text_line
from accesslake.schemas import ADS_COLS, DWD_COLS


def area_traffic(dwd: DataFrame) -> DataFrame:
    """city, host, count (`count(1) GROUP BY city, host`; NULL city is a group)."""
    return dwd.groupBy("city", "host").agg(F.count(F.lit(1)).alias("count")).select(*ADS_COLS)


def area_report(dwd: DataFrame) -> DataFrame:
    """host, area, count: the text-report variant (`city AS area`)."""
    return (
        dwd.groupBy("host", "city")
        .agg(F.count(F.lit(1)).alias("count"))
        .select("host", F.col("city").alias("area"), "count")
    )


def report_lines(report: DataFrame) -> DataFrame:
    """`host<TAB>area<TAB>count` lines; a NULL area prints as 'null'."""
    return report.select(text_line("host", "area", "count").alias("value"))


def dwd_lines(dwd: DataFrame) -> DataFrame:
    """DWD rows as V1 tab-separated text lines (the 20 DWD columns in order)."""
    return dwd.select(text_line(*DWD_COLS).alias("value"))


def tsv_city_host(lines: DataFrame, value: str = "value") -> DataFrame:
    """city (field 11) and host (field 14) of V1 DWD text lines."""
    fields = split_fields(F.col(value))
    return lines.select(field(fields, TSV_CITY_POS).alias("city"), field(fields, TSV_HOST_POS).alias("host"))


def area_traffic_from_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """ADS count from V1 DWD text lines."""
    return area_traffic(tsv_city_host(lines, value))


def preview(ads: DataFrame, n: int) -> DataFrame:
    """The top `n` groups by count; ties by city then host, NULLs first.

    Planned as a per-task top-n merged once (TakeOrderedAndProject), not a
    full sort.
    """
    return ads.orderBy(F.desc("count"), F.asc_nulls_first("city"), F.asc_nulls_first("host")).limit(n)
