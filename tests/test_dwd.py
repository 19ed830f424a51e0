"""DWD: IP library parsing, the V2 join and the V1 lookup, and both join plans."""

from collections import Counter

from pyspark.sql import functions as F

from accesslake.operators import dwd, joins
from accesslake.schemas import DWD_COLS, PRE_DWD_SCHEMA


def _pre(spark, ips):
    rows = []
    for i, ip in enumerate(ips):
        rows.append(("[2022/04/22 00:30:00 +0800]", ip, "-", i, "r", "GET", "http://h/p", "200", 1, 2, "HIT",
                     "http", "h", "/p", "-", "2022", "04", "22"))
    return spark.createDataFrame(rows, PRE_DWD_SCHEMA)


def _dim(spark, rows):
    lines = ["|".join([ip, "", "", "", "", "", prov, city, "", isp, "", "", "", "0", "0"]) for ip, prov, city, isp in rows]
    return dwd.ip_dim(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_ip_dim_fields(spark):
    lines = spark.createDataFrame([("10.0.0.1||||||ASIA|CHINA||BUILDING||||0|0",), ("10.0.0.2|x",)], "value string")
    got = [tuple(r) for r in dwd.ip_dim(lines).collect()]
    assert got == [("10.0.0.1", "ASIA", "CHINA", "BUILDING"), ("10.0.0.2", None, None, None)]


def test_unknown_and_duplicate_ip(spark):
    pre = _pre(spark, ["1.1.1.1", "2.2.2.2"])
    dim = _dim(spark, [("1.1.1.1", "P", "C", "I"), ("1.1.1.1", "DUP", "DUP", "DUP")])
    j1 = dwd.enrich(pre, dim)
    assert j1.columns == DWD_COLS
    got = Counter((r["ip"], r["city"]) for r in j1.collect())
    assert got == Counter({("1.1.1.1", "C"): 1, ("1.1.1.1", "DUP"): 1, ("2.2.2.2", None): 1})
    j2 = dwd.enrich_lookup(pre, dim)
    got2 = sorted((r["ip"], r["province"], r["city"], r["isp"]) for r in j2.collect())
    # one row per ip: greatest (province, city, isp); '-' when unknown
    assert got2 == [("1.1.1.1", "P", "C", "I"), ("2.2.2.2", "-", "-", "-")]


def test_dedupe_prefers_non_null(spark):
    dim = spark.createDataFrame([("a", None, None, None), ("a", "A", None, "x"), ("a", "A", "B", None)],
                                "ip string, province string, city string, isp string")
    assert tuple(dwd.dedupe_dim(dim).first()) == ("a", "A", "B", None)


def test_fits_broadcast_counts_exactly(spark):
    df = spark.createDataFrame([("ab", 1), ("c", 2), (None, 3)], "s string, n bigint")
    # two columns of 8 bytes, the text padded and once more as the key, the row's overhead
    built = 3 * (joins.ROW_OVERHEAD_BYTES + 16) + 2 * (3 + 3 * 7)
    ok, rows, size = joins.fits_broadcast(df, max_rows=3, max_bytes=built)
    assert ok and rows == 3 and size == built
    assert not joins.fits_broadcast(df, max_rows=2)[0]
    assert not joins.fits_broadcast(df, max_bytes=built - 1)[0]


def test_hot_keys_finds_the_heavy_key(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    got = joins.hot_keys(df, "k", share=0.05, fraction=0.2)
    assert [k for k, _ in got] == ["hot"] and abs(got[0][1] - 1 / 3) < 0.05


def test_salts_follow_the_key_share():
    assert joins.salts_for(1 / 3, 8000) == 2667
    assert joins.salts_for(0.001, 8000) == 8
    assert joins.salts_for(0.9, 8) == 8 and joins.salts_for(0.01, 8) == 2


def test_salted_join_equals_broadcast_join(spark):
    # a third of the fact rows on one ip, some NULL ips, a duplicated key in the dim
    n = 3000
    fact = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("9.9.9.9"))
        .when(F.col("id") % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("10.0.0."), (F.col("id") % 50).cast("string"))).alias("ip"),
        F.col("id"),
    )
    dim = spark.createDataFrame(
        [("9.9.9.9", "P", "C", "I"), ("9.9.9.9", "P2", "C2", "I2")]
        + [(f"10.0.0.{i}", f"p{i}", f"c{i}", "isp") for i in range(0, 40)],
        "ip string, province string, city string, isp string",
    )
    plan_b, plan_s = [], []
    b = joins.lookup_join(fact, dim, "ip", "left", plan=plan_b)
    s = joins.lookup_join(fact, dim, "ip", "left", max_broadcast_rows=0, hot_share=0.05,
                          sample_fraction=0.5, salt_buckets=8, plan=plan_s)
    assert plan_b[0].strategy == "broadcast"
    assert plan_s[0].strategy == "shuffle" and plan_s[0].hot_keys == ("9.9.9.9",)
    rows = lambda df: Counter(tuple(r) for r in df.select("id", "ip", "city").collect())
    assert rows(b) == rows(s)
    assert sum(rows(s).values()) == n + n // 3  # each hot row fans out to two dim rows
    # the hot key's rows are spread over several join tasks
    per_salt = (fact.where(F.col("ip") == "9.9.9.9")
                .select(F.pmod(F.xxhash64(F.spark_partition_id(), "ip", "id"), F.lit(8)).alias("s"))
                .distinct().count())
    assert per_salt == 8


def test_inner_lookup_join(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k bigint, v string")
    dim = spark.createDataFrame([(1, "x"), (1, "y")], "key bigint, w string")
    for opts in ({}, {"max_broadcast_rows": 0}):
        got = sorted(tuple(r) for r in joins.lookup_join(fact, dim, "k", "inner", dim_key="key", **opts).collect())
        assert got == [(1, "a", "x"), (1, "a", "y")]


def test_shuffle_plan_is_sort_merge_on_key_and_salt(spark):
    fact = spark.range(100).select(F.concat(F.lit("10.0.0."), (F.col("id") % 7).cast("string")).alias("ip"), "id")
    dim = spark.createDataFrame([(f"10.0.0.{i}", "p", "c", "i") for i in range(7)],
                                "ip string, province string, city string, isp string")
    df = joins.lookup_join(fact, dim, "ip", "left", max_broadcast_rows=0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "_salt" in plan
    assert df.count() == 100


def test_salts_derived_from_share(spark):
    fact = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("ip"), "id"
    )
    dim = spark.createDataFrame([("hot", "H")] + [(str(i), f"c{i}") for i in range(500)], "ip string, city string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # hot = 4/64 of the rows or more
    try:
        plan = []
        s = joins.lookup_join(fact, dim, "ip", "left", max_broadcast_rows=0, sample_fraction=0.5, plan=plan)
        assert plan[0].hot_keys == ("hot",) and 18 <= plan[0].salts[0] <= 25  # about a third of 64
        b = joins.lookup_join(fact, dim, "ip", "left")
        key = lambda df: sorted((r["id"], r["city"]) for r in df.collect())
        assert key(s) == key(b)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_key_spreads_over_reducers_at_run_time(spark):
    fact = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("ip"), "id"
    )
    dim = spark.createDataFrame([("hot", "H")] + [(str(i), f"c{i}") for i in range(997)], "ip string, city string")
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        j = joins.lookup_join(fact, dim, "ip", "left", max_broadcast_rows=0, sample_fraction=0.2)
        tasks = j.where(F.col("ip") == "hot").select(F.spark_partition_id().alias("p")).distinct().count()
        # ~22 salts hash into 64 reducers, some into the same one: ~19 expected
        assert tasks >= 12, tasks
        plain = fact.join(dim.hint("shuffle_merge"), "ip", "left")
        assert plain.where(F.col("ip") == "hot").select(F.spark_partition_id()).distinct().count() == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_join_edge_inputs(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "ip string, id long")
    dim = spark.createDataFrame([("a", "A")], "ip string, city string")
    empty_dim = spark.createDataFrame([], "ip string, city string")
    empty_fact = spark.createDataFrame([], "ip string, id long")
    nulls = spark.createDataFrame([(None, i) for i in range(50)], "ip string, id long")
    for opts in ({}, {"max_broadcast_rows": 0, "sample_fraction": 1.0}):
        got = sorted((r["id"], r["city"]) for r in joins.lookup_join(fact, empty_dim, "ip", **opts).collect())
        assert got == [(1, None), (2, None), (3, None)]
        assert joins.lookup_join(empty_fact, dim, "ip", **opts).count() == 0
        j = joins.lookup_join(nulls, dim, "ip", **opts)
        assert j.count() == 50 and j.where(F.col("city").isNotNull()).count() == 0
        assert joins.lookup_join(nulls, dim, "ip", "inner", **opts).count() == 0
    assert joins.hot_keys(empty_fact, "ip") == [] and joins.hot_keys(nulls, "ip", share=0.1, fraction=1.0) == []


def test_shuffle_partitions_follows_aqe_initial_number(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "123")
        assert joins.shuffle_partitions(spark) == 123
        spark.conf.unset(key)
        assert joins.shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def test_inner_join_with_hot_key_on_both_plans(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("ip"), "id"
    )
    dim = spark.createDataFrame([("hot", "H"), ("hot", "H2")] + [(str(i), f"c{i}") for i in range(0, 40, 2)],
                                "ip string, city string")
    key = lambda df: sorted((r["id"], r["city"]) for r in df.collect())
    plan = []
    salted = joins.lookup_join(fact, dim, "ip", "inner", max_broadcast_rows=0, hot_share=0.05,
                               sample_fraction=0.5, plan=plan)
    assert plan[0].hot_keys == ("hot",)
    assert key(salted) == key(joins.lookup_join(fact, dim, "ip", "inner"))


def test_every_hot_key_is_found(spark):
    df = spark.range(30000).select((F.col("id") % 3000).cast("string").alias("k"))
    assert len(joins.hot_keys(df, "k", share=1 / 4000, fraction=1.0)) == 3000


def test_hot_key_of_the_lookup_side_spreads_over_tasks(spark):
    dim = spark.range(100_000).select(
        F.when(F.col("id") < 99_000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ip"), F.col("id").alias("city"))
    fact = spark.createDataFrame([("hot", 1), ("hot", 2), ("99500", 3), ("none", 4), (None, 5)], "ip string, id bigint")
    for how in ("left", "inner"):
        plan = []
        j = joins.lookup_join(fact, dim, "ip", how, max_broadcast_rows=0, hot_share=0.3, sample_fraction=0.2, salt_buckets=6, plan=plan)
        assert plan[0].lookup_hot_keys == ("hot",) or plan[0].hot_keys == ("hot",)
        expected = fact.join(dim, "ip", how)
        rows = lambda df: sorted(map(tuple, df.groupBy("id").agg(F.count("city"), F.sum("city"), F.count("*")).collect()))
        assert rows(j) == rows(expected)
    cold = fact.where("id = 1").unionByName(spark.range(10, 500).select(F.col("id").cast("string").alias("ip"), "id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = []
        j = joins.lookup_join(cold, dim, "ip", "left", max_broadcast_rows=0, hot_share=0.3, sample_fraction=1.0, plan=plan)
        assert plan[0].lookup_hot_keys == ("hot",) and plan[0].hot_keys == ()
        hot = j.where("ip = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in hot) == 99_000 and len(hot) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_v1_lookup_on_the_shuffle_plan(spark):
    pre = _pre(spark, ["1.1.1.1"] * 30 + ["2.2.2.2", "3.3.3.3"])
    dim = _dim(spark, [("1.1.1.1", "P", "C", "I"), ("1.1.1.1", "DUP", "DUP", "DUP"), ("3.3.3.3", "Q", "D", "J")])
    rows = lambda df: sorted((r["ip"], r["province"], r["city"], r["isp"], r["responseTime"]) for r in df.collect())
    b = dwd.enrich_lookup(pre, dim)
    s = dwd.enrich_lookup(pre, dim, max_broadcast_rows=0, hot_share=0.05, sample_fraction=1.0)
    assert rows(b) == rows(s) and len(rows(s)) == 32
    assert {r[1] for r in rows(s) if r[0] == "2.2.2.2"} == {"-"}


def _spread(spark, fact, dim, **opts):
    """Rows that each task of the join makes, AQE's own merging and splitting off."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        plan = []
        j = joins.lookup_join(fact, dim, "ip", "left", max_broadcast_rows=0, plan=plan, **opts)
        per_task = [r["count"] for r in j.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        sums = j.agg(F.count("*"), F.sum("id"), F.sum("city"), F.count("city")).first()
        return plan[0], per_task, tuple(sums)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_key_hot_on_both_sides_is_dealt_over_a_grid(spark):
    fact = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("ip"), "id").repartition(4)
    dim = spark.range(1_500).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ip"), F.col("id").alias("city")).repartition(3)
    plan, per_task, sums = _spread(spark, fact, dim, sample_fraction=0.5)
    assert plan.lookup_hot_keys == ("hot",) and min(plan.grids[0]) > 1
    expected = fact.join(dim, "ip", "left").agg(F.count("*"), F.sum("id"), F.sum("city"), F.count("city")).first()
    assert sums == tuple(expected)
    mean = sum(per_task) / 16
    assert max(per_task) <= 2 * mean, (max(per_task), mean)


def test_a_few_lookup_rows_of_a_hot_key_make_a_grid(spark):
    """Not hot among the lookup rows, but many pairs together."""
    fact = spark.range(8_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ip"), "id").repartition(4)
    dim = spark.range(40_000).select(F.when(F.col("id") < 200, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ip"), F.col("id").alias("city"))
    plan, per_task, sums = _spread(spark, fact, dim, sample_fraction=0.5)
    assert plan.lookup_hot_keys == ("hot",)
    assert sums == tuple(fact.join(dim, "ip", "left").agg(F.count("*"), F.sum("id"), F.sum("city"), F.count("city")).first())
    assert max(per_task) <= 2 * sum(per_task) / 16


def test_grids_are_bounded():
    for f, d, nf, nd in ((3e9, 3e6, 1e10, 1e7), (1e9, 0, 1e10, 1e7), (0, 5e6, 1e10, 1e7), (4, 4, 10, 10), (1e9, 2, 1e10, 1e7)):
        for parts in (8, 200, 20_000):
            (r, c), = joins.grids({"k": (f, d)}, nf, nd, parts).values()
            assert r >= 1 and c >= 1 and r * c <= max(joins.CELLS_PER_TASK * parts, 1)
    (r, c), = joins.grids({"k": (3e6, 1e4)}, 1e7, 3e4, 200).values()
    assert 3e6 / r <= 1e7 / 200 * 2 and r * c >= 200


def test_grid_in_an_inner_join_with_typed_keys(spark):
    fact = spark.range(600).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    dim = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("w"))
    for how in ("left", "inner"):
        plan = []
        got = joins.lookup_join(fact, dim, "k", how, max_broadcast_rows=0, hot_share=0.2, sample_fraction=1.0, plan=plan)
        assert plan[0].grids and got.columns == ["k", "v", "w"]
        assert sorted(map(str, got.collect())) == sorted(map(str, fact.join(dim, "k", how).collect()))


def test_cells_of_a_grid_are_not_merged_into_few_tasks(spark):
    """A cell reads few rows and makes many: AQE, which goes by what is read, put all of them in one task."""
    fact = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ip"), "id")
    dim = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ip"), F.col("id").alias("city"))
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    plan = []
    got = joins.lookup_join(fact, dim, "ip", max_broadcast_rows=0, hot_share=0.1, sample_fraction=0.5, plan=plan)
    assert plan[0].grids
    per_task = [r["count"] for r in got.where("ip = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 1_000_000 and len(per_task) >= 8 and max(per_task) <= 200_000


def test_tasks_of_a_grid_are_bounded():
    assert joins.grid_tasks({"a": (3, 4), "b": (5, 2)}, 8) == 22
    assert joins.grid_tasks({"a": (3, 4)}, 200) == 200
    assert joins.grid_tasks({"a": (3_000, 400)}, 200) == joins.MAX_GRID_TASKS


def test_every_cell_of_a_grid_has_a_task_of_its_own(spark):
    """Dealt by hash, some tasks had several cells and a third had none."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("warm")).otherwise(F.col("id").cast("string"))
    fact, dim = spark.range(6_000).select(hot.alias("ip"), "id"), spark.range(3_000).select(hot.alias("ip"), F.col("id").alias("city"))
    plan = []
    got = joins.lookup_join(fact, dim, "ip", max_broadcast_rows=0, hot_share=0.1, sample_fraction=0.5, plan=plan)
    assert sorted(plan[0].lookup_hot_keys) == ["hot", "warm"]
    per_task = [r["count"] for r in got.where("ip IN ('hot', 'warm')").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2 * 2_000 * 1_000
    assert len(per_task) == sum(r * c for r, c in plan[0].grids)
    assert max(per_task) <= 2 * sum(per_task) / len(per_task)


def test_cells_of_many_pairs_are_cut_further():
    for f, d, parts in ((120_000, 128_000, 8), (3e9, 3e6, 8), (1e5, 20, 8), (3e9, 3e6, 20_000), (10, 10, 8)):
        total = (50 * f, 9 * d, parts)
        (r0, c0), = joins.grids({"k": (f, d)}, *total).values()
        (r, c), = joins.grids({"k": (f, d)}, *total, joins.MAX_CELL_PAIRS).values()
        assert r * c <= max(joins.CELLS_PER_TASK * parts, joins.MAX_GRID_TASKS)
        assert (r, c) == (r0, c0) or f * d / (r0 * c0) > joins.MAX_CELL_PAIRS
        assert f * d / (r * c) <= 1.1 * joins.MAX_CELL_PAIRS or r * c >= 0.8 * joins.MAX_GRID_TASKS
    # Of two keys, each by its share of the pairs.
    cells = joins.grids({"a": (120_000, 128_000), "b": (60_000, 64_000)}, 6e6, 1.2e6, 8, 1_000_000)
    assert 0.8 * joins.MAX_GRID_TASKS <= sum(r * c for r, c in cells.values()) <= joins.MAX_GRID_TASKS + 2
