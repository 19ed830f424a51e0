"""Access-log inputs derived from the driver's tables (see FIXTURES.md).

* ``raw_access``: one tab-separated log line per `events` row, its URL taken
  from `pages`, with dirty values planted by fixed rules on event_id.
* ``ip_lines``: one pipe-separated IP library line per customer (some left
  out, some duplicated with province/city/isp `DUP`).

These are Spark jobs over the given tables, so they grow with them; how to join
`pages`, `nation` and `region` is left to Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the fixture rules (FIXTURES.md section 3).
# ---------------------------------------------------------------------------
SHORT_LINE = (211, 7)      # id % 211 = 7 -> only the first 3 fields
BAD_TIME = (97, 5)         # id % 97 = 5 -> time text `bad`
PROXY = (10, 5)            # id % 10 = 5 -> proxy ip
BAD_RESPONSE_TIME = 53     # id % 53 = 0 -> `n/a`
NOT_A_URL = 89             # id % 89 = 0 -> `not a url`
ODD_URL = 83               # id % 83 = 0 -> the odd URL below
EMPTY_REQUEST_SIZE = 59    # id % 59 = 0 -> ''
DASH_SIZE = (10, 3)        # id % 10 = 3 -> `-`
MINUS_ONE_SIZE = 101       # id % 101 = 0 -> `-1`
DECIMAL_SIZE = 103         # id % 103 = 0 -> `1.5`
ODD_URL_TEXT = "http://a_b:8080/x y?"
NO_PAGE_URL = "https://plain.example.com"
HTTP_CODES = ["200", "301", "404", "500"]
GET_EVENTS = ["click", "view"]
POST_EVENTS = ["purchase", "signup"]
TZ_SUFFIX = " +0800]"
IP_SKIP_MOD = 5            # customers with c_custkey % 5 = 0 have no library line
IP_DUP = (7, 1)            # c_custkey % 7 = 1 gets a second line
DUP_TEXT = "DUP"
# ---------------------------------------------------------------------------


def _two(part: str, ts: Column) -> Column:
    return F.lpad(F.extract(F.lit(part), ts).cast("string"), 2, "0")


def _time_text(eid: Column, ts: Column) -> Column:
    yyyy = F.extract(F.lit("year"), ts).cast("string")
    mm, dd, hh, mi = (_two(p, ts) for p in ("month", "day", "hour", "minute"))
    ss = F.lpad(F.floor(F.extract(F.lit("second"), ts)).cast("bigint").cast("string"), 2, "0")
    clock = F.concat_ws(":", hh, mi, ss)
    body = (
        F.when(eid % BAD_TIME[0] == BAD_TIME[1], F.lit("bad"))
        .when(eid % 3 == 0, F.concat(dd, F.lit("/"), mm, F.lit("/"), yyyy, F.lit(":"), clock))
        .when(eid % 3 == 1, F.concat(yyyy, F.lit("/"), mm, F.lit("/"), dd, F.lit(" "), clock))
        .otherwise(F.concat(yyyy, F.lit("/"), mm, F.lit("/"), dd, F.lit("/:"), clock))
    )
    return F.concat(F.lit("["), body, F.lit(TZ_SUFFIX))


def _ip_text(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), F.floor(n / 256).cast("string"), F.lit("."), (n % 256).cast("string"))


def raw_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw log line (`value`) per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    # Events go round all pages, however many there are.
    n_pages = pages.agg((F.max("page_id") + 1).alias("n")).scalar()
    e = events.withColumn("_page", F.col("event_id") % n_pages)
    j = e.join(pages, F.col("_page") == F.col("page_id"), "left")

    eid, uid = F.col("event_id"), F.col("user_id")
    method = (
        F.when(F.col("event_type").isin(GET_EVENTS), F.lit("GET"))
        .when(F.col("event_type").isin(POST_EVENTS), F.lit("POST"))
        .otherwise(F.lit("HEAD"))
    )
    url = (
        F.when(eid % NOT_A_URL == 0, F.lit("not a url"))
        .when(eid % ODD_URL == 0, F.lit(ODD_URL_TEXT))
        .otherwise(F.coalesce(F.col("url"), F.lit(NO_PAGE_URL)))
    )
    response_size = (
        F.when(eid % DASH_SIZE[0] == DASH_SIZE[1], F.lit("-"))
        .when(eid % MINUS_ONE_SIZE == 0, F.lit("-1"))
        .when(eid % DECIMAL_SIZE == 0, F.lit("1.5"))
        .otherwise(((eid * 13) % 1000).cast("string"))
    )
    fields = [
        _time_text(eid, F.col("ts")),
        _ip_text("10.0.", uid),
        F.when(eid % PROXY[0] == PROXY[1], F.concat(F.lit("10.1.0."), (uid % 256).cast("string"))).otherwise(F.lit("-")),
        F.when(eid % BAD_RESPONSE_TIME == 0, F.lit("n/a")).otherwise(((eid * 37) % 2500).cast("string")),
        (eid % 500).cast("string"),
        method,
        url,
        F.when(eid % 4 == 0, F.lit(HTTP_CODES[0]))
        .when(eid % 4 == 1, F.lit(HTTP_CODES[1]))
        .when(eid % 4 == 2, F.lit(HTTP_CODES[2]))
        .otherwise(F.lit(HTTP_CODES[3])),
        F.when(eid % EMPTY_REQUEST_SIZE == 0, F.lit("")).otherwise(((eid * 7) % 500).cast("string")),
        response_size,
        F.when(eid % 2 == 0, F.lit("HIT")).otherwise(F.lit("MISS")),
    ]
    line = F.when(eid % SHORT_LINE[0] == SHORT_LINE[1], F.concat_ws("\t", *fields[:3])).otherwise(
        F.concat_ws("\t", *fields)
    )
    # The line comes out of a generator (one element per event). A filter on
    # parsed fields further down (the ODS reject rule) can then not be pushed
    # into the line-building expression, which would build every line twice.
    return j.select(F.explode(F.array(line)).alias("value"))


def ip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One IP library line (`value`) per customer, plus `DUP` duplicates."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")
    region = spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name")
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    ip = _ip_text("10.0.", F.col("c_custkey"))

    def line(province: Column, city: Column, isp: Column) -> Column:
        return F.concat(ip, F.lit("||||||"), province, F.lit("|"), city, F.lit("||"), isp, F.lit("||||0|0"))

    dup = F.lit(DUP_TEXT)
    key = F.col("c_custkey")
    # Both lines of a customer come from one scan: explode, then keep the flagged ones.
    both = F.array(
        F.struct((key % IP_SKIP_MOD != 0).alias("keep"),
                 line(F.col("r_name"), F.col("n_name"), F.col("c_mktsegment")).alias("value")),
        F.struct((key % IP_DUP[0] == IP_DUP[1]).alias("keep"), line(dup, dup, dup).alias("value")),
    )
    return c.select(F.inline(both)).where(F.col("keep")).select("value")
