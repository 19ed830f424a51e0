"""Atomic day swaps, one-scan splits and merged files."""

import uuid

import pytest
from pyspark.sql import functions as F

from accesslake.operators import ods
from accesslake.plans import ads_job, dwd_job, ods_job, ods_table_job
from accesslake.schemas import ADS_SCHEMA, DWD_SCHEMA, GOOD, ODS_SCHEMA, REJECTED, REJECTS_SCHEMA
from accesslake.sources import fixtures, io, versions

from sfdirs import SF_SMALL
from test_jobs import _stages

D, D2 = "20240101", "20240102"


def _ads(spark, tag, n=2):
    return spark.range(n).select(F.lit("c").alias("city"), F.lit(f"h-{tag}").alias("host"), F.col("id").alias("count"))


@pytest.fixture
def table(spark, scratch):
    name = f"v_{uuid.uuid4().hex[:8]}"
    io.create_day_table(spark, name, ADS_SCHEMA, f"{scratch}/{name}")
    return name


@pytest.fixture(scope="module")
def raw(spark):
    path = f"{io.scratch_dir(spark, 'landing')}/raw"
    io.write_text(fixtures.raw_access(spark, SF_SMALL), path, compression=None)
    return path


def _rows(df):
    return sorted((r["d"], r["host"], r["count"]) for r in df.collect())


def test_readers_see_the_old_day_until_the_swap(spark, table):
    versions.publish_day(_ads(spark, "a"), table, D)
    versions.publish_day(_ads(spark, "b"), table, D2)
    old = [(D, "h-a", 0), (D, "h-a", 1), (D2, "h-b", 0), (D2, "h-b", 1)]
    listed = spark.read.schema(ADS_SCHEMA).parquet(versions.day_location(spark, table, D))
    version = versions.write_version(_ads(spark, "c", 3), table, D)
    assert version.rows == 3
    assert _rows(spark.table(table)) == old  # written, not yet swapped
    versions.swap_day(spark, table, D, version.path)
    assert listed.count() == 2  # a reader that listed the old version still has its files
    assert _rows(spark.table(table)) == [(D, "h-c", i) for i in range(3)] + old[2:]


def test_a_crash_before_the_swap_leaves_the_old_day(spark, table):
    versions.publish_day(_ads(spark, "a"), table, D)
    broken = _ads(spark, "x", 2000).repartition(4).withColumn("count", F.when(F.col("count") == 1999, F.raise_error(F.lit("boom"))).otherwise(F.col("count")))
    with pytest.raises(Exception, match="boom"):
        versions.publish_day(broken, table, D)
    assert _rows(spark.table(table)) == [(D, "h-a", 0), (D, "h-a", 1)]
    versions.publish_day(_ads(spark, "b", 1), table, D)
    assert _rows(spark.table(table)) == [(D, "h-b", 0)]


def test_an_empty_result_empties_its_day(spark, table):
    versions.publish_day(_ads(spark, "a"), table, D)
    versions.publish_day(_ads(spark, "b"), table, D2)
    assert versions.publish_day(_ads(spark, "a").where("1 = 0"), table, D).rows == 0
    assert _rows(spark.table(table)) == [(D2, "h-b", 0), (D2, "h-b", 1)]


def test_old_versions_go_when_asked(spark, table):
    for n in (1, 2, 3, 4):
        versions.publish_day(_ads(spark, "a", n), table, D)
    pending = versions.write_version(_ads(spark, "later", 9), table, D)
    every = versions.versions_of(spark, table, D)
    assert len(every) == 5 and every[-1] == pending.path.rstrip("/") and versions.day_location(spark, table, D) == every[3]
    assert versions.drop_old_versions(spark, table, D, keep=1) == every[:2]
    assert versions.versions_of(spark, table, D) == every[2:] and spark.table(table).count() == 4
    assert versions.drop_old_versions(spark, table, D2) == []
    assert spark.read.schema(ADS_SCHEMA).option("recursiveFileLookup", "false").parquet(versions.table_location(spark, table)).count() == 0


def test_a_swapped_table_prunes_and_keeps_its_file_size(spark, table):
    versions.publish_day(_ads(spark, "a", 10).coalesce(1), table, D, rows_per_file=3)
    assert io.data_files(spark, versions.day_location(spark, table, D)) == 4
    versions.publish_day(_ads(spark, "b"), table, D2)
    assert len(spark.table(table).where(f"d = '{D2}'").inputFiles()) < len(spark.table(table).inputFiles())


def test_good_and_rejected_lines_from_one_scan(spark, raw, scratch):
    split = f"{scratch}/split"
    roots = io.kind_root(split, GOOD), io.kind_root(split, REJECTED)
    assert _stages(spark, "t-split", lambda: ods_job(spark, raw, roots[0], D, rejects_root=roots[1])) == (1, 1)
    apart = ods_job(spark, raw, f"{scratch}/ods", D, rejects_root=f"{scratch}/rejects")
    assert apart.counts == {"total": 1000, "good": 878, "short": 5, "dirty_size": 117}
    for schema, one, two in ((ODS_SCHEMA, roots[0], f"{scratch}/ods"), (REJECTS_SCHEMA, roots[1], f"{scratch}/rejects")):
        rows = [sorted(map(str, io.read_day(spark, root, schema, D).collect())) for root in (one, two)]
        assert rows[0] == rows[1] and rows[0]
    assert dwd_job(spark, raw, roots[0], f"{scratch}/dwd", D).counts["input"] == 878  # the next layer reads the good part
    # A re-run without rejects empties their day.
    clean = f"{scratch}/clean"
    io.write_text(io.read_lines(spark, raw).where(F.size(F.split("value", "\t")) >= 11).where(F.col("value").rlike("\t[1-9][0-9]*\t[A-Z]+$")), clean, compression=None)
    report = ods_job(spark, clean, roots[0], D, rejects_root=roots[1])
    assert report.counts["good"] == report.counts["total"] > 0
    assert io.read_day(spark, roots[1], REJECTS_SCHEMA, D).count() == 0


def test_ods_tables_swap_together(spark, raw, scratch):
    good, bad = (f"{n}_{uuid.uuid4().hex[:8]}" for n in ("ods", "rejects"))
    io.create_day_table(spark, good, ODS_SCHEMA, f"{scratch}/good")
    io.create_day_table(spark, bad, REJECTS_SCHEMA, f"{scratch}/bad")
    for _ in range(2):
        assert ods_table_job(spark, raw, good, bad, D).counts == {"total": 1000, "good": 878, "short": 5, "dirty_size": 117}
        assert spark.table(good).count() == 878 and spark.table(bad).groupBy("reason").count().count() == 2
    expected = ods.clean(io.read_lines(spark, raw))
    assert sorted(map(str, spark.table(good).drop("d").collect())) == sorted(map(str, expected[0].collect()))
    assert sorted(map(str, spark.table(bad).drop("d").collect())) == sorted(map(str, expected[1].collect()))
    versions.publish_kinds(ods.by_kind(ods.tag(io.read_lines(spark, raw).where("1 = 0"))), "kind", {GOOD: good, REJECTED: bad}, D)
    assert spark.table(good).count() == spark.table(bad).count() == 0
    with pytest.raises(Exception, match="no table for kind"):
        versions.publish_kinds(ods.by_kind(ods.tag(io.read_lines(spark, raw))), "kind", {GOOD: good}, D)


def test_few_rows_of_many_tasks_are_merged(spark, scratch):
    many = spark.range(100_000).repartition(40).select(F.lit("c").alias("city"), F.col("id").cast("string").alias("host"), F.col("id").alias("count"))
    few = many.where("count % 100 = 0")
    io.write_day(few, scratch, D)
    io.write_day(few, scratch, D2)
    before = io.data_files(spark, io.day_path(scratch, D))
    assert before == 40
    assert io.merge_day(spark, scratch, ADS_SCHEMA, D, 1000)
    assert io.data_files(spark, io.day_path(scratch, D)) <= 2 and io.data_files(spark, io.day_path(scratch, D2)) == 40
    assert sorted(r["count"] for r in io.read_day(spark, scratch, ADS_SCHEMA, D).collect()) == list(range(0, 100_000, 100))
    assert not io.merge_day(spark, scratch, ADS_SCHEMA, D, 1000)  # nothing left to do
    assert not io.merge_day(spark, scratch, ADS_SCHEMA, D2, 1000, rows_per_file=25)  # as many files as its rows fill
    assert io.names_in(spark, f"{scratch}/_merged") == []


def test_ods_job_merges_a_day_of_many_small_files(spark, scratch):
    line = "\t".join(["[2022/04/22 10:11:12 +0800]", "1.2.3.4", "-", "1", "2", "GET", "http://h/p", "200", "3", "{}", "HIT"])
    rows = [(line.format(i if i % 10 == 0 else "-"),) for i in range(2000)]
    io.write_text(spark.createDataFrame(rows, "value string").repartition(40), f"{scratch}/raw", compression=None)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task a file, as with large files
    try:
        report = ods_job(spark, f"{scratch}/raw", f"{scratch}/ods", D)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    assert report.counts["good"] == 200 and io.data_files(spark, io.day_path(f"{scratch}/ods", D)) <= 2
    assert io.read_day(spark, f"{scratch}/ods", ODS_SCHEMA, D).count() == 200


def test_days_by_glob(spark, scratch):
    io.write_day(_ads(spark, "a"), scratch, D)
    io.write_day(_ads(spark, "b", 3), scratch, D2)
    io.write_day(_ads(spark, "c", 5), scratch, "20240201")
    both = io.read_part_files(spark, f"{scratch}/d=202401*/part*", ADS_SCHEMA)
    assert _rows(both) == _rows(io.read_days(spark, scratch, ADS_SCHEMA).where("d like '202401%'"))
    assert both.dtypes == io.read_days(spark, scratch, ADS_SCHEMA).dtypes
    assert len(both.inputFiles()) < len(io.read_days(spark, scratch, ADS_SCHEMA).inputFiles())
    assert io.day_of_path(f"{scratch}/d={D}/part*") == D


def test_folder_and_table_from_one_pass(spark, raw, scratch, table):
    ods_job(spark, raw, f"{scratch}/ods", D)
    dwd_job(spark, raw, f"{scratch}/ods", f"{scratch}/dwd", D)
    seen = []

    for swap in (False, True):
        report = ads_job(spark, f"{scratch}/dwd", D, ads_root=f"{scratch}/ads", table=table, swap=swap, persist="memory_and_disk")
        folder = io.read_day(spark, f"{scratch}/ads", ADS_SCHEMA, D)
        assert report.counts["groups"] == folder.count() == spark.table(table).count() > 0
        seen.append(sorted(map(str, folder.collect())) == sorted(map(str, spark.table(table).collect())))
    assert seen == [True, True]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0  # released
    with pytest.raises(ValueError, match="storage level"):
        ads_job(spark, f"{scratch}/dwd", D, ads_root=f"{scratch}/ads", table=table, persist="NOWHERE")
    with pytest.raises(ValueError, match="need persist"):
        ads_job(spark, f"{scratch}/dwd", D, ads_root=f"{scratch}/ads", table=table)
    with pytest.raises(Exception):
        ads_job(spark, f"{scratch}/dwd", D, ads_root=f"{scratch}/ads", table="no_such_table", persist="DISK_ONLY")
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0  # and after a failure


def test_heavy_keys_come_from_the_ods_pass(spark, scratch, monkeypatch):
    from accesslake.operators import joins

    line = "\t".join(["[2022/04/22 10:11:12 +0800]", "{}", "-", "1", "2", "GET", "http://h/p", "200", "3", "{}", "HIT"])
    rows = [(line.format("9.9.9.9" if i % 3 == 0 else f"10.0.{i // 256}.{i % 256}", "-" if i % 10 == 9 else i + 1),) for i in range(3000)]
    io.write_text(spark.createDataFrame(rows, "value string").repartition(4), f"{scratch}/raw", compression=None)
    io.write_text(spark.createDataFrame([("9.9.9.9||||||p|c||i",), ("10.0.0.1||||||q|c||i",)], "value string"), f"{scratch}/ip", compression=None)
    assert io.read_heavy_keys(spark, f"{scratch}/ods", D) is None
    for d in (D, D2):
        # Still one job for the day; the list is a second, small one.
        assert _stages(spark, f"t-heavy-{d}", lambda: ods_job(spark, f"{scratch}/raw", f"{scratch}/ods", d, heavy_keys=True))[0] == 2
    keys, total = io.read_heavy_keys(spark, f"{scratch}/ods", D)
    assert keys[0] == ("9.9.9.9", 900) and total == 2700
    assert io.read_heavy_keys(spark, f"{scratch}/ods", D, D2)[0][0] == ("9.9.9.9", 1800)
    assert io.read_days(spark, f"{scratch}/ods", ODS_SCHEMA).count() == 5400  # the lists are no days

    sampled = []
    plain = joins._sampled
    monkeypatch.setattr(joins, "_sampled", lambda df, *a, **k: sampled.append(df.columns) or plain(df, *a, **k))
    opts = {"max_broadcast_rows": 0, "hot_share": 0.1}
    report = dwd_job(spark, f"{scratch}/ip", f"{scratch}/ods", f"{scratch}/dwd", D, **opts)
    assert report.joins[0].hot_keys == ("9.9.9.9",) and report.counts == {"input": 2700, "rows": 2700}
    assert sampled == [["ip", "province", "city", "isp"]]  # the library only
    assert io.read_day(spark, f"{scratch}/dwd", DWD_SCHEMA, D).where("city = 'c'").count() == 901


def test_input_is_counted_from_the_files_on_the_shuffle_plan(spark, raw, scratch, monkeypatch):
    """An observation before the shuffle counts the rows of a repeated map stage twice."""
    from accesslake.plans import jobs

    ods_job(spark, raw, f"{scratch}/ods", D)
    plain = jobs._metrics
    monkeypatch.setattr(jobs, "_metrics", lambda obs, df, *names: {k: v * 2 if k == "input" else v for k, v in plain(obs, df, *names).items()})
    assert dwd_job(spark, raw, f"{scratch}/ods", f"{scratch}/dwd", D, max_broadcast_rows=0).counts["input"] == 878
