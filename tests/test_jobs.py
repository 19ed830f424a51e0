"""The day jobs end to end on files, plus plan checks."""

import os

import pytest

from accesslake.plans import ads_job, dwd_job, ods_job, report_job
from accesslake.schemas import ADS_SCHEMA, DWD_SCHEMA, ODS_SCHEMA, REJECTS_SCHEMA
from accesslake.sources import fixtures, io
from accesslake.operators import ads

from sfdirs import SF_SMALL

D = "20240101"


@pytest.fixture(scope="module")
def landed(spark):
    """Raw log and IP library text files derived from the sf0.001 tables."""
    base = io.scratch_dir(spark, "landing")
    raw, ip = f"{base}/raw/d={D}", f"{base}/ip"
    io.write_text(fixtures.raw_access(spark, SF_SMALL), raw, compression=None)
    io.write_text(fixtures.ip_lines(spark, SF_SMALL), ip, compression=None)
    return base, raw, ip


def test_pipeline_counts(spark, landed):
    base, raw, ip = landed
    ods_root, rej_root, dwd_root, ads_root = (f"{base}/{x}" for x in ("ods", "rejects", "dwd", "ads"))
    r1 = ods_job(spark, raw, ods_root, D, rejects_root=rej_root)
    assert r1.counts == {"total": 1000, "good": 878, "short": 5, "dirty_size": 117}
    assert io.read_day(spark, ods_root, ODS_SCHEMA, D).count() == 878
    assert io.read_day(spark, rej_root, REJECTS_SCHEMA, D).count() == 122

    r2 = dwd_job(spark, ip, ods_root, dwd_root, D)
    assert r2.counts == {"input": 878, "rows": 981} and r2.joins[0].strategy == "broadcast"
    dwd = io.read_day(spark, dwd_root, DWD_SCHEMA, D)
    assert dwd.where("city IS NULL").count() == 177

    r3 = ads_job(spark, dwd_root, D, ads_root=ads_root)
    assert r3.counts == {"input": 981, "groups": 278}
    assert io.read_day(spark, ads_root, ADS_SCHEMA, D).count() == 278

    # re-run of the same day: same rows, no duplicates
    ods_job(spark, raw, ods_root, D)
    dwd_job(spark, ip, ods_root, dwd_root, D)
    ads_job(spark, dwd_root, D, ads_root=ads_root)
    assert io.read_days(spark, ads_root, ADS_SCHEMA).count() == 278


def test_lookup_default_and_shuffle_plans(spark, landed):
    base, raw, ip = landed
    ods_root = f"{base}/ods2"
    ods_job(spark, raw, ods_root, D)
    r = dwd_job(spark, ip, ods_root, f"{base}/dwd_v1", D, lookup="default")
    assert r.counts == {"input": 878, "rows": 878}
    dwd = io.read_day(spark, f"{base}/dwd_v1", DWD_SCHEMA, D)
    assert dwd.where("city = '-'").count() == 177 and dwd.where("city IS NULL").count() == 0
    r = dwd_job(spark, ip, ods_root, f"{base}/dwd_s", D, max_broadcast_rows=0)
    assert r.joins[0].strategy == "shuffle" and r.counts == {"input": 878, "rows": 981}


def test_table_target_and_report(spark, landed):
    base, raw, ip = landed
    ods_root, dwd_root = f"{base}/ods3", f"{base}/dwd3"
    ods_job(spark, raw, ods_root, D)
    dwd_job(spark, ip, ods_root, dwd_root, D, lookup="default")
    table = "ads_job_test"
    io.create_day_table(spark, table, ADS_SCHEMA, f"{base}/ads_table")
    ads_job(spark, dwd_root, D, table=table)
    assert spark.table(table).where(f"d = '{D}'").count() == 248

    tsv = f"{base}/dwd_tsv"
    io.write_text(ads.dwd_lines(io.read_day(spark, dwd_root, DWD_SCHEMA, D).drop("d")), tsv, compression=None)
    assert report_job(spark, tsv, f"{base}/report").counts == {"input": 878, "rows": 248}
    lines = io.read_lines(spark, f"{base}/report").collect()
    assert len(lines) == 248 and all(len(r[0].split("\t")) == 3 for r in lines)


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ads_scan_is_pruned(spark, landed):
    base, raw, ip = landed
    ods_root, dwd_root = f"{base}/ods4", f"{base}/dwd4"
    ods_job(spark, raw, ods_root, D)
    dwd_job(spark, ip, ods_root, dwd_root, D)
    from accesslake.plans.jobs import area_traffic_day

    plan = area_traffic_day(spark, dwd_root, D)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<city:string,host:string>" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_no_python_in_any_query_plan(spark):
    import __spark_entry__ as E

    for name, query in E._QUERIES.items():
        plan = _executed(query(spark, SF_SMALL))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def _stages(spark, group, fn):
    """(jobs, stages) Spark ran for fn, from the status tracker (no UI)."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    jobs = tracker.getJobIdsForGroup(group)
    stages = set()
    for j in jobs:
        info = tracker.getJobInfo(j)
        if info:
            # a stage reused from an earlier job is listed again but skipped
            stages.update(s for s in info.stageIds
                          if (st := tracker.getStageInfo(s)) is not None and st.numCompletedTasks > 0)
    return len(jobs), len(stages)


def test_jobs_run_few_passes(spark, landed):
    base, raw, ip = landed
    ods_root, dwd_root, ads_root = (f"{base}/{x}5" for x in ("ods", "dwd", "ads"))
    # ODS: one job, one stage (scan -> parse -> filter -> write, counts observed)
    assert _stages(spark, "t-ods", lambda: ods_job(spark, raw, ods_root, D)) == (1, 1)
    # DWD: the size probe of the IP library (partial + final aggregate), the
    # broadcast build, then one map-only write; with AQE each stage is a job.
    n_jobs, n_stages = _stages(spark, "t-dwd", lambda: dwd_job(spark, ip, ods_root, dwd_root, D))
    assert n_jobs <= 4 and n_stages <= 4, (n_jobs, n_stages)
    # ADS: partial aggregate stage + final aggregate/write stage
    n_jobs, n_stages = _stages(spark, "t-ads", lambda: ads_job(spark, dwd_root, D, ads_root=ads_root))
    assert n_stages <= 2, (n_jobs, n_stages)


def test_v1_text_chain(spark, landed):
    from accesslake.plans import ads_from_text_job, dwd_text_job, ods_text_job

    base, raw, ip = landed
    r1 = ods_text_job(spark, raw, f"{base}/v1_ods")
    assert r1.counts["good"] == 878
    lines = io.read_lines(spark, f"{base}/v1_ods").collect()
    assert len(lines) == 878 and all(r[0].endswith("\t") and len(r[0].split("\t")) == 12 for r in lines)
    r2 = dwd_text_job(spark, ip, f"{base}/v1_ods", f"{base}/v1_dwd")
    assert r2.counts == {"rows": 878}
    r3 = ads_from_text_job(spark, f"{base}/v1_dwd", f"{base}/v1_ads", D)
    assert r3.counts == {"input": 878, "groups": 248}


def test_no_rejects_no_second_scan(spark, scratch):
    raw = f"{scratch}/raw"
    io.write_text(spark.createDataFrame(
        [("\t".join(["[2022/04/22 10:11:12 +0800]", "1.2.3.4", "-", "1", "2", "GET", "http://h/p", "200",
                     "3", "4", "HIT"]),)], "value string"), raw, compression=None)
    rej = f"{scratch}/rejects"
    io.write_day(spark.createDataFrame([("old line", "short")], REJECTS_SCHEMA), rej, D)
    n_jobs, _ = _stages(spark, "t-norej", lambda: ods_job(spark, raw, f"{scratch}/ods", D, rejects_root=rej))
    assert io.read_day(spark, rej, REJECTS_SCHEMA, D).count() == 0  # stale rejects of the day are gone
    assert n_jobs == 2  # the ODS pass and the empty rejects day; no scan for rejects


def test_crlf_raw_text_gives_the_same_rows(spark, scratch):
    line = "\t".join(["[2022/04/22 10:11:12 +0800]", "1.2.3.4", "-", "1", "2", "GET", "http://h/p?a=1", "200",
                      "3", "4", "HIT"])
    short = "\t".join(["[bad +0800]", "1.2.3.4", "-"])
    for name, eol in (("lf", "\n"), ("crlf", "\r\n")):
        folder = f"{scratch}/{name}"
        path = folder[len("file:"):] if folder.startswith("file:") else folder
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/part-0.txt", "w", newline="") as fh:
            fh.write(eol.join([line, short, line]) + eol)
    lf = ods_job(spark, f"{scratch}/lf", f"{scratch}/ods_lf", D)
    crlf = ods_job(spark, f"{scratch}/crlf", f"{scratch}/ods_crlf", D)
    assert lf.counts == crlf.counts == {"total": 3, "good": 2, "short": 1, "dirty_size": 0}
    rows = lambda root: sorted(map(tuple, io.read_day(spark, root, ODS_SCHEMA, D).drop("d").collect()))
    assert rows(f"{scratch}/ods_lf") == rows(f"{scratch}/ods_crlf")
    assert rows(f"{scratch}/ods_crlf")[0][-1] == "HIT"  # no trailing \r in the last field


def test_dwd_broadcast_plan_never_shuffles_the_logs(spark, landed):
    from accesslake.operators import dwd

    base, raw, ip = landed
    ods_root = f"{base}/ods6"
    ods_job(spark, raw, ods_root, D)
    pre = dwd.widen(io.read_day(spark, ods_root, ODS_SCHEMA, D).drop("d"))
    wide = dwd.enrich(pre, dwd.ip_dim(io.read_lines(spark, ip)))
    wide.collect()
    plan = _executed(wide)
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "hashpartitioning" not in plan  # no shuffle exchange anywhere


def _lost(monkeypatch):
    from pyspark.sql import Observation

    def get(self):
        raise RuntimeError("metrics lost")

    monkeypatch.setattr(Observation, "get", property(get))


def test_lost_metrics_leave_the_day_whole(spark, landed, scratch, monkeypatch):
    base, raw, ip = landed
    ods_root, dwd_root, ads_root, table = f"{scratch}/ods", f"{scratch}/dwd", f"{scratch}/ads", "lost_metrics"
    io.create_day_table(spark, table, ADS_SCHEMA, f"{scratch}/table")
    good = {"ods": ods_job(spark, raw, ods_root, D).counts["good"], "dwd": dwd_job(spark, ip, ods_root, dwd_root, D).counts["rows"]}
    with monkeypatch.context() as m:
        _lost(m)
        for job in (lambda: ods_job(spark, raw, ods_root, D), lambda: dwd_job(spark, ip, ods_root, dwd_root, D),
                    lambda: ads_job(spark, dwd_root, D, ads_root=ads_root), lambda: ads_job(spark, dwd_root, D, table=table)):
            with pytest.raises(RuntimeError, match="lost; the rows are written"):
                job()
    assert io.read_day(spark, ods_root, ODS_SCHEMA, D).count() == good["ods"]
    assert io.read_day(spark, dwd_root, DWD_SCHEMA, D).count() == good["dwd"]
    assert io.read_day(spark, ads_root, ADS_SCHEMA, D).count() == spark.table(table).count() > 0


def test_ads_job_registers_its_day(spark, landed, scratch):
    base, raw, ip = landed
    ods_job(spark, raw, f"{scratch}/ods", D)
    dwd_job(spark, ip, f"{scratch}/ods", f"{scratch}/dwd", D)
    io.create_day_table(spark, "registered_days", ADS_SCHEMA, f"{scratch}/other")
    report = ads_job(spark, f"{scratch}/dwd", D, ads_root=f"{scratch}/ads", register_in="registered_days")
    assert spark.table("registered_days").where(f"d = '{D}'").count() == report.counts["groups"] > 0
    with pytest.raises(ValueError, match="rows_per_file"):
        ads_job(spark, f"{scratch}/dwd", D, table="registered_days", rows_per_file=5)


def test_dwd_job_on_an_empty_ods_day(spark, landed, scratch):
    base, raw, ip = landed
    ods_root, dwd_root = f"{scratch}/ods", f"{scratch}/dwd"
    io.clear_day(spark, ods_root, ODS_SCHEMA, D)
    io.write_day(spark.createDataFrame([tuple("x" if f.dataType.simpleString() == "string" else 1
                                              for f in DWD_SCHEMA.fields)], DWD_SCHEMA), dwd_root, D)
    report = dwd_job(spark, ip, ods_root, dwd_root, D)
    assert report.counts == {"input": 0, "rows": 0}
    assert io.read_day(spark, dwd_root, DWD_SCHEMA, D).count() == 0  # the old day is gone
