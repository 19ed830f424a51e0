"""ADS: the count per city and host, the text report forms and the preview."""

from accesslake.operators import ads
from accesslake.schemas import ADS_COLS


def _dwd(spark, rows):
    return spark.createDataFrame(rows, "city string, host string")


def test_null_city_is_one_group(spark):
    df = _dwd(spark, [(None, "h"), (None, "h"), ("c", "h")])
    got = sorted(ads.area_traffic(df).collect(), key=lambda r: r["city"] or "")
    assert ads.area_traffic(df).columns == ADS_COLS
    assert [tuple(r) for r in got] == [(None, "h", 2), ("c", "h", 1)]


def test_report_and_lines(spark):
    df = _dwd(spark, [(None, "h"), (None, "h"), ("c", "h")])
    rep = ads.area_report(df)
    assert rep.columns == ["host", "area", "count"]
    assert sorted(r[0] for r in ads.report_lines(rep).collect()) == ["h\tc\t1", "h\tnull\t2"]


def test_lines_round_trip_fields(spark):
    from accesslake.schemas import DWD_COLS

    row = {c: f"v_{c}" for c in DWD_COLS}
    row.update(responseTime=1, requestSize=2, responseSize=3, city=None)
    from accesslake.schemas import DWD_SCHEMA

    df = spark.createDataFrame([tuple(row[c] for c in DWD_COLS)], DWD_SCHEMA)
    line = ads.dwd_lines(df).first()[0]
    assert line.split("\t")[11] == "null" and line.split("\t")[14] == "v_host"
    assert tuple(ads.tsv_city_host(ads.dwd_lines(df)).first()) == ("null", "v_host")


def test_preview_is_total_order(spark):
    df = spark.createDataFrame(
        [("b", "h", 5), (None, "h", 5), ("a", "z", 5), ("a", "h", 5), ("x", "y", 9)], "city string, host string, count bigint"
    )
    got = [tuple(r) for r in ads.preview(df, 3).collect()]
    assert got == [("x", "y", 9), (None, "h", 5), ("a", "h", 5)]
    plan = ads.preview(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
