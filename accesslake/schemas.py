"""Column lists and StructTypes of every layer (the table contracts)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

# Positional fields of one raw log line, in file order.
RAW_FIELDS = [
    "time", "ip", "proxyIp", "responseTime", "referer", "method",
    "url", "httpCode", "requestSize", "responseSize", "cache",
]
N_RAW_FIELDS = len(RAW_FIELDS)

ODS_SCHEMA = T.StructType(
    [T.StructField(name, L if name == "responseSize" else S) for name in RAW_FIELDS]
)
ODS_COLS = ODS_SCHEMA.fieldNames()

# Rows between ODS and DWD: `time` is still present, numbers are typed and the
# time and URL parts are split out.
PRE_DWD_SCHEMA = T.StructType(
    [
        T.StructField("time", S),
        T.StructField("ip", S),
        T.StructField("proxyIp", S),
        T.StructField("responseTime", L),
        T.StructField("referer", S),
        T.StructField("method", S),
        T.StructField("url", S),
        T.StructField("httpCode", S),
        T.StructField("requestSize", L),
        T.StructField("responseSize", L),
        T.StructField("cache", S),
        T.StructField("protocol", S),
        T.StructField("host", S),
        T.StructField("path", S),
        T.StructField("params", S),
        T.StructField("year", S),
        T.StructField("month", S),
        T.StructField("day", S),
    ]
)
PRE_DWD_COLS = PRE_DWD_SCHEMA.fieldNames()

IP_DIM_SCHEMA = T.StructType(
    [T.StructField(name, S) for name in ("ip", "province", "city", "isp")]
)
IP_DIM_COLS = IP_DIM_SCHEMA.fieldNames()
IP_ATTRS = IP_DIM_COLS[1:]

# DWD column order is fixed (and is also the V1 tab-separated line layout).
DWD_COLS = [
    "ip", "proxyIp", "responseTime", "referer", "method", "url", "httpCode",
    "requestSize", "responseSize", "cache", "province", "city", "isp",
    "protocol", "host", "path", "params", "year", "month", "day",
]
_LONG_COLS = {"responseTime", "requestSize", "responseSize"}
DWD_SCHEMA = T.StructType(
    [T.StructField(name, L if name in _LONG_COLS else S) for name in DWD_COLS]
)

ADS_SCHEMA = T.StructType(
    [T.StructField("city", S), T.StructField("host", S), T.StructField("count", L)]
)
ADS_COLS = ADS_SCHEMA.fieldNames()

REJECTS_SCHEMA = T.StructType([T.StructField("value", S), T.StructField("reason", S)])

# The kinds of lines that one ODS write deals out.
KIND = "kind"
GOOD, REJECTED = "good", "rejected"

# The day partition column; always a string such as '20240101'.
DAY = "d"


def with_day(schema: T.StructType) -> T.StructType:
    """The schema plus the string day partition column (pins `d` to string)."""
    return T.StructType(list(schema.fields) + [T.StructField(DAY, S)])


def ddl(schema: T.StructType) -> str:
    """`name type, ...` for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
