"""spark-submit entry configured by spark.app.* settings; SQL over day views."""

import pytest

from accesslake.operators import ads
from accesslake.plans import submit
from accesslake.schemas import ADS_SCHEMA, DWD_SCHEMA
from accesslake.sources import fixtures, io

from sfdirs import SF_SMALL

D = "20240103"


@pytest.fixture
def app_conf(spark):
    keys = []

    def set_(**kv):
        for k, v in kv.items():
            spark.conf.set(submit.PREFIX + k, v)
            keys.append(submit.PREFIX + k)

    yield set_
    for k in keys:
        spark.conf.unset(k)


def test_submit_chain(spark, scratch, app_conf, capsys):
    raw, ip = f"{scratch}/raw/d={D}", f"{scratch}/ip"
    io.write_text(fixtures.raw_access(spark, SF_SMALL), raw, compression=None)
    io.write_text(fixtures.ip_lines(spark, SF_SMALL), ip, compression=None)
    ods, dwd, ads_root = (f"{scratch}/{x}/d={D}" for x in ("ods", "dwd", "ads"))

    app_conf(inputPath=raw, outputPath=ods, perBlockRowsForSnappy="5000000")
    assert submit.run(spark, "ods").counts["good"] == 878
    app_conf(inputPath=ods, outputPath=dwd, ipResourcePath=ip)
    assert submit.run(spark, "dwd").counts == {"input": 878, "rows": 981}
    app_conf(inputPath=dwd, outputPath=ads_root)
    assert submit.run(spark, "ads").counts == {"input": 981, "groups": 278}
    assert io.read_day(spark, f"{scratch}/ads", ADS_SCHEMA, D).count() == 278
    app_conf(printSchema="true")
    submit.run(spark, "ads")
    out = capsys.readouterr().out
    assert "|-- city: string" in out and "|-- count: long" in out
    app_conf(printSchema="false")

    app_conf(inputPath=dwd, outputPath=f"{scratch}/ads/d=20240109")
    with pytest.raises(ValueError):
        submit.run(spark, "ads")
    with pytest.raises(ValueError):
        submit.run(spark, "nope")


def test_submit_tables_swapped(spark, scratch, app_conf):
    import uuid

    from accesslake.schemas import ODS_SCHEMA, REJECTS_SCHEMA
    from accesslake.sources import versions

    raw, ip = f"{scratch}/raw", f"{scratch}/ip"
    io.write_text(fixtures.raw_access(spark, SF_SMALL), raw, compression=None)
    io.write_text(fixtures.ip_lines(spark, SF_SMALL), ip, compression=None)
    names = {k: f"{k}_{uuid.uuid4().hex[:8]}" for k in ("ods", "rejects", "ads")}
    for (k, name), schema in zip(names.items(), (ODS_SCHEMA, REJECTS_SCHEMA, ADS_SCHEMA)):
        io.create_day_table(spark, name, schema, f"{scratch}/{k}_table")
    app_conf(inputPath=raw, table=names["ods"], rejectsTable=names["rejects"], day=D, printSchema="true")
    assert submit.run(spark, "ods").counts["good"] == spark.table(names["ods"]).count() == 878
    assert spark.table(names["rejects"]).count() == 122
    app_conf(printSchema="false")
    spark.conf.unset(submit.PREFIX + "table")

    split = f"{scratch}/split"
    app_conf(inputPath=raw, outputPath=f"{split}/kind=good/d={D}", rejectsPath=f"{split}/kind=rejected")
    assert submit.run(spark, "ods").counts["good"] == 878
    app_conf(inputPath=f"{split}/kind=good/d={D}", outputPath=f"{scratch}/dwd/d={D}", ipResourcePath=ip)
    submit.run(spark, "dwd")
    app_conf(inputPath=f"{scratch}/dwd/d={D}", outputPath=f"{scratch}/ads/d={D}", table=names["ads"], swap="true", storageLevel="DISK_ONLY")
    for _ in range(3):
        assert submit.run(spark, "ads").counts["groups"] == spark.table(names["ads"]).count() == 278
    assert io.read_day(spark, f"{scratch}/ads", ADS_SCHEMA, D).count() == 278
    app_conf(keep="0")
    submit.run(spark, "drop_versions")
    assert len(versions.versions_of(spark, names["ads"], D)) == 1 and spark.table(names["ads"]).count() == 278


def test_sql_over_day_views_equals_dataframe(spark, scratch):
    rows = [tuple(f"v{i}" if c not in ("responseTime", "requestSize", "responseSize") else i
                  for c in DWD_SCHEMA.fieldNames()) for i in range(3)]
    df = spark.createDataFrame(rows + rows[:1], DWD_SCHEMA)
    io.write_day(df, f"{scratch}/dwd", D)
    io.register_day_views(spark, {"dwd_access": f"{scratch}/dwd"}, D)
    sql = spark.sql("SELECT city, host, count(1) AS count FROM dwd_access GROUP BY city, host")
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, ads.area_traffic(df).collect()))


def test_create_warehouse_tables(spark, scratch):
    locs = {name: f"{scratch}/{name}" for name in io.WAREHOUSE_TABLES}
    spark.sql("CREATE DATABASE IF NOT EXISTS wh_test")
    io.create_warehouse_tables(spark, locs, database="wh_test")
    io.create_warehouse_tables(spark, locs, database="wh_test")  # IF NOT EXISTS
    assert spark.table("wh_test.dwd_access").columns[-1] == "d"
    assert len(spark.table("wh_test.dwd_access").columns) == 21
    assert spark.table("wh_test.ads_areatrafstat").columns == ["city", "host", "count", "d"]


def test_submit_report_and_export(spark, scratch, app_conf):
    from accesslake.operators import dwd as dwd_ops
    from accesslake.operators import ods as ods_ops

    pre = dwd_ops.widen(ods_ops.clean(fixtures.raw_access(spark, SF_SMALL))[0])
    dwd_rows = dwd_ops.enrich_lookup(pre, dwd_ops.ip_dim(fixtures.ip_lines(spark, SF_SMALL)))
    io.write_text(ads.dwd_lines(dwd_rows), f"{scratch}/dwd_text", compression=None)
    app_conf(inputPath=f"{scratch}/dwd_text", outputPath=f"{scratch}/report")
    assert submit.run(spark, "report").counts == {"input": 878, "rows": 248}

    table = "submit_export_src"
    io.create_day_table(spark, table, ADS_SCHEMA, f"{scratch}/export_src")
    app_conf(table=table, url="jdbc:nothing-here://none/db", dbtable="t", user="u", password="p")
    with pytest.raises(Exception, match="(?i)suitable driver"):
        submit.run(spark, "export")


def test_cluster_conf_fills_only_missing_settings(spark):
    from accesslake.session import CLUSTER_CONF, apply_cluster_conf

    given = spark.sparkContext.getConf()
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        apply_cluster_conf(spark)
        for key, value in CLUSTER_CONF.items():
            expected = given.get(key) if given.contains(key) else value
            assert spark.conf.get(key) == expected, key
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_submit_v1_chain_registration_and_preview(spark, scratch, app_conf, capsys):
    raw, ip = f"{scratch}/raw", f"{scratch}/ip"
    io.write_text(fixtures.raw_access(spark, SF_SMALL), raw, compression=None)
    io.write_text(fixtures.ip_lines(spark, SF_SMALL), ip, compression=None)
    app_conf(inputPath=raw, outputPath=f"{scratch}/ods_text", ipResourcePath=ip)
    assert submit.run(spark, "ods_text").counts["good"] == 878
    app_conf(inputPath=f"{scratch}/ods_text", outputPath=f"{scratch}/dwd_text")
    assert submit.run(spark, "dwd_text").counts == {"rows": 878}
    app_conf(inputPath=f"{scratch}/dwd_text", outputPath=f"{scratch}/ads_text/d={D}", printSchema="true")
    assert submit.run(spark, "ads_text").counts == {"input": 878, "groups": 248}
    shown = capsys.readouterr().out
    assert "|-- host: string" in shown and shown.count("\n|") == 56  # the header and the 55 busiest groups
    app_conf(printSchema="false")

    wide = spark.createDataFrame([tuple("x" if f.dataType.simpleString() == "string" else 1 for f in DWD_SCHEMA.fields)], DWD_SCHEMA)
    io.write_day(wide, f"{scratch}/dwd", D)
    io.create_day_table(spark, "submit_registered", ADS_SCHEMA, f"{scratch}/table")
    app_conf(inputPath=f"{scratch}/dwd/d={D}", outputPath=f"{scratch}/ads/d={D}", registerIn="submit_registered")
    submit.run(spark, "ads")
    assert spark.table("submit_registered").where(f"d = '{D}'").count() == 1


def test_submit_passes_jdbc_options(spark, app_conf, monkeypatch):
    got = {}
    monkeypatch.setattr(submit.jobs, "export_job", lambda spark, table, **jdbc: got.update(table=table, **jdbc))
    app_conf(table="t", url="jdbc:any://h/db", dbtable="x", truncate="false", numPartitions="9", batchsize="500", createTableOptions="o",
             createTableColumnTypes="c string", customSchema="c string", isolationLevel="NONE", mode="append")
    submit.run(spark, "export")
    assert got == {"table": "t", "url": "jdbc:any://h/db", "dbtable": "x", "user": None, "password": None, "mode": "append", "truncate": False,
                   "num_partitions": 9, "batchsize": "500", "createTableOptions": "o", "createTableColumnTypes": "c string",
                   "customSchema": "c string", "isolationLevel": "NONE"}


def test_a_jobs_own_shuffle_size(spark):
    from accesslake.session import CLUSTER_CONF, apply_cluster_conf

    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        given = spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions")
        apply_cluster_conf(spark, "ads")
        assert given or spark.conf.get("spark.sql.shuffle.partitions") == "2000"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
