"""Session settings.

`CLUSTER_CONF` is what the jobs expect on a large cluster; `local_session`
builds the single-machine session used by tests and the bench.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CLUSTER_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn joins into broadcasts when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Start high and let AQE coalesce: AQE can merge reducers but never split
    # them, so this is sized for the largest shuffle, a salted DWD join of a
    # ~5 TB day at ~256 MB per reducer. Small shuffles (the ADS aggregate)
    # coalesce to a few reducers; salt counts follow this number.
    "spark.sql.shuffle.partitions": "20000",
    # ODS and DWD are map-only: one input split becomes one output file. 512 MB
    # of raw text is ~100 MB of parquet per file, and a 10 TB day still makes
    # ~20,000 tasks.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Day folders are strings such as 20240101, never ints.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


# Initial shuffle partitions by job, where the job's shuffle is far smaller than
# the salted DWD join: the ADS count shuffles one row per task and group.
JOB_CONF = {job: {"spark.sql.shuffle.partitions": "2000"} for job in ("ads", "ads_text", "report")}


def apply_cluster_conf(spark: SparkSession, job: str | None = None) -> None:
    """Set CLUSTER_CONF (and the job's JOB_CONF) entries the user did not pass with --conf."""
    given = spark.sparkContext.getConf()
    for key, value in (CLUSTER_CONF | JOB_CONF.get(job, {})).items():
        if not given.contains(key):
            spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "accesslake") -> SparkSession:
    """Local session; sets a checkpoint folder only when none is configured."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Small local inputs: let a few MB still split across all cores
        # (the 4 MB default open cost is the floor of a file split).
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="accesslake-wh-"))
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        # Tests only: a cluster names its shared folder in spark.checkpoint.dir.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="accesslake-ckpt-"))
    return spark
