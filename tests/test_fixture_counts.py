"""The expected row counts of FIXTURES.md section 4 at sf0.001."""

from pyspark.sql import functions as F

import __spark_entry__ as E

from sfdirs import SF_SMALL


def _q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_counts(spark):
    assert _q(spark, "raw_fields").count() == 1000
    counts = _q(spark, "job_counts").first().asDict()
    assert counts == {"total": 1000, "good": 878, "short": 5, "dirty_size": 117}
    dim = _q(spark, "ip_dim")
    assert dim.count() == 142 and dim.select("ip").distinct().count() == 124
    dwd = _q(spark, "dwd_access")
    assert dwd.count() == 981 and dwd.where(F.col("city").isNull()).count() == 177
    v1 = _q(spark, "dwd_lookup_default")
    assert v1.count() == 878 and v1.where(F.col("city") == "-").count() == 177
    assert _q(spark, "ads_area_traffic").count() == 278


def test_pages_used_grow_with_the_table(spark):
    used = {}
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        urls = E.queries()["ods_access"](spark, sf).select("url").distinct()
        pages = spark.read.parquet(f"{sf}/pages.parquet").select("url").distinct()
        used[sf] = (urls.join(pages, "url", "left_semi").count(), pages.count())
    (small, all_small), (large, all_large) = used.values()
    assert small >= 0.85 * all_small and large >= 0.85 * all_large > 3 * all_small


def test_bad_time_and_url_rows(spark):
    pre = E._pre(spark, SF_SMALL)
    assert pre.where(F.col("year") == "-").count() == 10
    bad_url = pre.where((F.col("protocol") == "-") & (F.col("host") == "-") & (F.col("path") == "-")
                        & (F.col("params") == "-"))
    assert bad_url.count() == 10
