"""Equi-joins of a large fact side with a lookup (dimension) side.

Two physical strategies, chosen per call:

* **Broadcast**, only after an exact check that the lookup side is within a
  row and byte budget (``fits_broadcast``). The fact side is then never
  shuffled, so its key skew does not matter.
* **Shuffle join** otherwise. Keys that hold a large share of the fact rows are
  found on a sample of the fact's key column. A key is hot when it holds a few
  times the share of an average shuffle partition; each hot key gets about
  `share x shuffle partitions` salts, so every salt of it is about one
  average partition, and its lookup rows are replicated once per salt. A key
  with a third of all rows thus spreads over a third of the reducers instead
  of landing in one. Fact rows with a NULL key (which can never match) are
  spread over all partitions instead of the single one NULL hashes to. AQE's
  skew-join split stays on for whatever skew is left.
* **Grid** for keys that many rows of *both* sides have, or that are hot on the
  lookup side: their fact rows are dealt over the grid's rows and their lookup
  rows over its columns, each copied along the other way, so every pair meets in
  one cell. Rows and columns follow from the key's rows on either side and from
  the pairs it makes, so no cell holds much more than an average task.

The salt is a hash of the row and of the input partition id. It is the same
when a task is re-run after an executor loss, so no row is lost or duplicated
on retry (``rand()`` would not be).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lookup sides up to this size are broadcast (after an exact check). Bytes are
# those of the relation as built on the driver: see _row_bytes.
DEFAULT_MAX_BROADCAST_ROWS = 5_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# A hashed relation holds, for each row, a hash slot and a pointer at half load,
# the row's header, and 8 bytes a column besides the padded text.
ROW_OVERHEAD_BYTES = 48
# Hot key: at least HOT_FACTOR times an average partition's share of the rows.
HOT_FACTOR = 4
# Grid cells of a key for each average task's worth of its pairs: cells are dealt to
# tasks by hash, and many small ones even out.
CELLS_PER_TASK = 16
# Tasks of a grid join: one a cell, up to so many, and a shuffle's usual number at least.
MAX_GRID_TASKS = 1_000
# Pairs of a cell before more cells are cut, up to one for each of MAX_GRID_TASKS tasks:
# a few seconds' rows.
MAX_CELL_PAIRS = 16_000_000
DEFAULT_SAMPLE_FRACTION = 0.01
# Keys of a day's heavy-key list, and keys that its sketch tracks in each task: a key is
# in the list if it has about 1 in HEAVY_TRACKED of the rows or more.
HEAVY_KEYS = 200
HEAVY_TRACKED = 1_000
SALT = "_salt"
NSALTS = "_nsalts"


@dataclass(frozen=True)
class JoinPlan:
    """What `lookup_join` decided; kept for tests and job reports."""

    strategy: str  # "broadcast" or "shuffle"
    lookup_rows: int | None = None
    lookup_bytes: int | None = None
    hot_keys: tuple = ()
    salts: tuple = ()
    lookup_hot_keys: tuple = ()
    grids: tuple = ()  # (rows, columns) of each key that is joined on a grid


def _row_bytes(df: DataFrame) -> Column:
    """Upper bound of a row's bytes in a built hash relation."""
    size = F.lit(ROW_OVERHEAD_BYTES)
    for f in df.schema.fields:
        size = size + F.lit(8)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            # padded to a word; once more for the copy that is the key
            size = size + 2 * (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 7)
    return size


def lookup_size(df: DataFrame) -> tuple[int, int]:
    """Exact row count and the bytes of its rows in a built hash relation, at most.

    One pass with partial aggregation: every task sends one row to the final
    aggregate, so this costs a scan of the lookup side and nothing more.
    """
    r = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
    ).first()
    return int(r["rows"]), int(r["bytes"])


def fits_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> tuple[bool, int, int]:
    """(fits, rows, bytes): whether `df` is proven small enough to broadcast."""
    rows, size = lookup_size(df)
    return rows <= max_rows and size <= max_bytes, rows, size


def shuffle_partitions(spark) -> int:
    """Reducers a shuffle starts with (AQE's initial number when it is set)."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if initial and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        return int(initial)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _sampled(fact: DataFrame, key: str, share: float | None, fraction: float, seed: int = 7, also: tuple = ()) -> tuple[list[tuple], dict, float]:
    """(key, share) of the hot keys, sampled shares of the keys in `also`, rows of the frame."""
    if share is None:
        share = HOT_FACTOR / shuffle_partitions(fact.sparkSession)
    max_keys = int(1 / share) + 1
    # rollup adds the grand total as one more row (grouping = 1), so the sample
    # size and the top keys come back from a single job.
    top = (
        fact.select(F.col(key).alias("k"))
        .sample(withReplacement=False, fraction=fraction, seed=seed)
        .rollup("k")
        .agg(F.count(F.lit(1)).alias("c"), F.grouping("k").alias("g"))
        .orderBy(F.desc(F.coalesce(F.col("k").isin(*also), F.lit(False)) if also else F.lit(False)), F.desc("c"))
        .limit(max_keys + 2 + len(also))  # bounds the candidate list sent to the driver; no join row is dropped
        .collect()
    )
    n = next((r["c"] for r in top if r["g"] == 1), 0)
    if n == 0:
        return [], {}, 0.0
    # With a tiny sample, a key needs a few hits before it counts as hot.
    need = max(share * n, 3)
    shares = {r["k"]: r["c"] / n for r in top if r["g"] == 0 and r["k"] is not None}
    return [(k, x) for k, x in shares.items() if x * n >= need], {k: shares.get(k, 0.0) for k in also}, n / fraction


def hot_keys(
    fact: DataFrame,
    key: str,
    *,
    share: float | None = None,
    fraction: float = DEFAULT_SAMPLE_FRACTION,
    seed: int = 7,
) -> list[tuple]:
    """(key, share of rows) of the keys holding at least `share` of the fact rows.

    `share` defaults to HOT_FACTOR / shuffle partitions. Estimated on a
    sample of the key column only. No more than 1 / share keys can each hold
    `share` of the sample, so the list that comes back to the driver is bounded
    whatever the data, and complete. The sample only decides the plan; every row
    still goes through the join.
    """
    return sorted(_sampled(fact, key, share, fraction, seed)[0], key=lambda x: -x[1])


def heavy_keys_metric(key: Column) -> Column:
    """Aggregate for an observation: the heaviest keys and their counts, from a sketch.

    Every task sends a sketch of HEAVY_TRACKED keys at most, and sketches merge, so a
    pass that reads the rows anyway finds them; no pass of its own is needed.
    """
    return F.call_function("approx_top_k", key, F.lit(HEAVY_KEYS), F.lit(HEAVY_TRACKED))


def salts_for(key_share: float, partitions: int) -> int:
    """Salts of a hot key: about one average partition of rows per salt."""
    return max(2, min(partitions, math.ceil(key_share * partitions)))


def _salted(fact: DataFrame, dim: DataFrame, key: str, how: str, salts: dict, null_salts: int) -> DataFrame:
    k = F.col(key)
    n = F.col(NSALTS)
    if salts:
        # (key, salt count) of the hot keys: bounded by their share, so it is
        # broadcast; each row then finds its count with one hash probe.
        counts = fact.sparkSession.createDataFrame(
            list(salts.items()),
            T.StructType([T.StructField(key, fact.schema[key].dataType), T.StructField(NSALTS, T.LongType())]),
        )
        fact_n = fact.join(F.broadcast(counts), on=key, how="left")
        dim_n = dim.join(F.broadcast(counts), on=key, how="left")
    else:
        fact_n = fact.withColumn(NSALTS, F.lit(None).cast("bigint"))
        dim_n = dim.withColumn(NSALTS, F.lit(None).cast("bigint"))
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in fact.columns])
    salt = (
        F.when(n.isNotNull(), F.pmod(row_hash, n))
        .when(k.isNull(), F.pmod(row_hash, F.lit(null_salts).cast("bigint")))
        .otherwise(F.lit(0).cast("bigint"))
    )
    fact_s = fact_n.withColumn(SALT, salt).drop(NSALTS)
    replicas = F.when(n.isNotNull(), F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(
        F.array(F.lit(0).cast("bigint"))
    )
    # The exact check already ruled out a broadcast: keep Spark's estimate-based
    # auto-broadcast from choosing one anyway. Sort-merge spills instead of
    # holding a lookup partition in memory.
    dim_s = dim_n.withColumn(SALT, F.explode(replicas)).drop(NSALTS).hint("shuffle_merge")
    return fact_s.join(dim_s, on=[key, SALT], how=how).drop(SALT)


def grids(rows_of: dict, fact_total: float, dim_total: float, partitions: int, cell_pairs: float = math.inf) -> dict:
    """{key: (rows, columns)} for keys with (fact rows, lookup rows) in `rows_of`.

    A side's rows are cut so that no part holds more than an average task reads, and
    cells are as many as `CELLS_PER_TASK` for each average task's worth of the key's
    pairs; copies stay within that many cells for each shuffle partition. Pairs grow with
    the product of both sides, so cells of more than `cell_pairs` are cut further, up to
    MAX_GRID_TASKS cells of all keys: such cells make far more pairs than they read copies.
    """
    load = max((fact_total + dim_total) / partitions, 1)
    pairs = {k: f * d for k, (f, d) in rows_of.items()}
    every = max(fact_total + sum(pairs.values()), 1)
    out = {}
    for k, (f, d) in rows_of.items():
        r, c = max(1, math.ceil(f / load)), max(1, math.ceil(d / load))
        by_pairs = math.ceil(min(pairs[k] / cell_pairs, MAX_GRID_TASKS * pairs[k] / every))
        most = max(CELLS_PER_TASK * partitions, by_pairs)
        cells = max(1, math.ceil(CELLS_PER_TASK * partitions * pairs[k] / every), by_pairs)
        if r * c < cells:
            # Cut the side with more rows first: its parts are what the other side's
            # rows are copied to.
            r = max(r, min(math.ceil(f) or 1, math.ceil(math.sqrt(cells * max(f, 1) / max(d, 1)))))
            c = max(c, min(math.ceil(d) or 1, math.ceil(cells / r)))
        if r * c > most:
            shrink = math.sqrt(most / (r * c))
            c = max(1, int(c * shrink))
            r = max(1, min(r, most // c))
        out[k] = (r, c)
    return out


def grid_tasks(cells: dict, partitions: int) -> int:
    """Tasks that the cells of all keys ({key: (rows, columns)}) are dealt to."""
    return max(partitions, min(sum(r * c for r, c in cells.values()), MAX_GRID_TASKS))


def _on_grid(fact: DataFrame, dim: DataFrame, key: str, cells: dict) -> DataFrame:
    """Inner join on the keys of `cells` ({key: (rows, columns)}).

    A fact row has one grid row and goes to each of its columns, a lookup row one
    column and goes to each of its rows. Every key here has lookup rows, so "left"
    and "inner" are the same.

    Cells have a number of tasks of their own: a cell reads few rows for the pairs it
    makes, and by what tasks read AQE would merge them all into a few. They are numbered
    through over all keys and dealt by number, so that no task has a second cell while
    another has none; by hash, a third of the tasks had none.
    """
    # The keys as values reach below the columns that the fact side computes, so those
    # are computed for the grid's rows alone.
    fact, dim = (df.where(F.col(key).isin(*cells)) for df in (fact, dim))
    r, c, first = F.col("_grid_rows"), F.col("_grid_cols"), F.col("_grid_first")
    starts = accumulate((rows * cols for rows, cols in cells.values()), initial=0)
    sizes = F.broadcast(fact.sparkSession.createDataFrame(
        [(k, *size, start) for (k, size), start in zip(cells.items(), starts)],
        T.StructType([T.StructField(key, dim.schema[key].dataType), *[T.StructField(x, T.LongType()) for x in ("_grid_rows", "_grid_cols", "_grid_first")]]),
    ))
    zero = F.lit(0).cast("bigint")

    def dealt(df: DataFrame, parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id(), *[F.col(f"`{x}`") for x in df.columns]), parts)

    fact_s = fact.join(sizes, on=key).withColumn(SALT, dealt(fact, r))
    fact_s = fact_s.withColumn(SALT, F.explode(F.transform(F.sequence(zero, c - 1), lambda j: (first + F.col(SALT) * c + j).cast("int"))))
    dim_s = dim.join(sizes, on=key).withColumn(SALT, dealt(dim, c))
    dim_s = dim_s.withColumn(SALT, F.explode(F.transform(F.sequence(zero, r - 1), lambda i: (first + i * c + F.col(SALT)).cast("int"))))
    tasks = grid_tasks(cells, shuffle_partitions(fact.sparkSession))
    fact_s, dim_s = (df.drop("_grid_rows", "_grid_cols", "_grid_first").repartitionById(tasks, SALT) for df in (fact_s, dim_s))
    return fact_s.join(dim_s.hint("shuffle_merge"), on=[key, SALT], how="inner").drop(SALT)


def _rows_with(dim: DataFrame, key: str, keys: list) -> dict:
    """{key: rows} of the given keys in `dim`: a row a task and key, then their sums."""
    if not keys:
        return {}
    names = dim.sparkSession.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(key, dim.schema[key].dataType)]))
    return {r["k"]: r["n"] for r in dim.select(F.col(key)).join(F.broadcast(names), key).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    *,
    dim_key: str | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    hot_share: float | None = None,
    sample_fraction: float = DEFAULT_SAMPLE_FRACTION,
    salt_buckets: int | None = None,
    size_of: DataFrame | None = None,
    known_heavy: tuple[list[tuple], int] | None = None,
    plan: list | None = None,
) -> DataFrame:
    """`fact JOIN dim USING (key)` with a size-checked broadcast or a salted shuffle.

    `how` is "left" or "inner" (the fact side is always kept whole for
    "left"). `dim_key` names the key on the lookup side if it differs; it is
    renamed to `key` so the result has one key column, like SQL's USING.
    `salt_buckets` fixes the salts per hot key instead of deriving them from
    the key's share. `size_of` is checked in place of `dim` where it bounds it
    and is cheaper to size (the rows `dim` aggregates). If `plan` is a list, the
    chosen JoinPlan is appended.

    `known_heavy`, (key, rows) pairs and the rows of the fact side, replaces the sample
    of the fact side, which is then read once, by the join itself.

    Keys that are hot on the lookup side, or hot on the fact side with several lookup
    rows, are joined apart on a grid (see `grids`).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join supports left and inner joins, not {how!r}")
    if dim_key and dim_key != key:
        dim = dim.withColumnRenamed(dim_key, key)

    ok, rows, size = fits_broadcast(dim if size_of is None else size_of, max_broadcast_rows, max_broadcast_bytes)
    if ok:
        if plan is not None:
            plan.append(JoinPlan("broadcast", rows, size))
        return fact.join(F.broadcast(dim), on=key, how=how)

    partitions = shuffle_partitions(fact.sparkSession)
    share = hot_share if hot_share is not None else HOT_FACTOR / partitions
    dim_hot, _, dim_rows = _sampled(dim, key, share, sample_fraction)
    if known_heavy is None:
        hot, of_lookup, fact_rows = _sampled(fact, key, share, sample_fraction, also=tuple(k for k, _ in dim_hot))
    else:
        rows_of, fact_rows = dict(known_heavy[0]), max(known_heavy[1], 1)
        hot = [(k, n / fact_rows) for k, n in rows_of.items() if k is not None and n >= share * fact_rows]
        of_lookup = {k: rows_of.get(k, 0) / fact_rows for k, _ in dim_hot}
    # Lookup rows of the fact's hot keys are counted exactly: a few make many pairs there.
    lookup_rows = _rows_with(dim, key, [k for k, _ in hot])
    both = {k: (sh * fact_rows, lookup_rows[k]) for k, sh in hot if lookup_rows.get(k, 0) > 1}
    alone = {k: (of_lookup[k] * fact_rows, sh * dim_rows) for k, sh in dim_hot if k not in both}
    cells = grids({**both, **alone}, fact_rows, dim_rows, partitions, MAX_CELL_PAIRS)
    if salt_buckets:
        cells = {k: (salt_buckets if k in both else 1, salt_buckets if k in alone or lookup_rows[k] >= salt_buckets else 1) for k in cells}
    # A key whose grid has one column is a salted key.
    cells = {k: size for k, size in cells.items() if size[1] > 1}
    salts = {k: salt_buckets or salts_for(sh, partitions) for k, sh in hot if k not in cells}
    if plan is not None:
        plan.append(JoinPlan("shuffle", rows, size, tuple(salts), tuple(salts.values()), tuple(cells), tuple(cells.values())))
    if not cells:
        return _salted(fact, dim, key, how, salts, salt_buckets or partitions)
    names = fact.sparkSession.createDataFrame([(k,) for k in cells], T.StructType([T.StructField(key, dim.schema[key].dataType)]))
    rest_fact, rest_dim = (df.join(F.broadcast(names), on=key, how="left_anti") for df in (fact, dim))
    apart = _on_grid(fact, dim, key, cells)
    return _salted(rest_fact, rest_dim, key, how, salts, salt_buckets or partitions).unionByName(apart)
