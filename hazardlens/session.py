"""Session helpers: building a local session and finding shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE re-plans shuffles at runtime
# (partition coalescing, skew-join splitting); the session zone is pinned so
# that zone-less timestamps print and compare the same everywhere.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Parquet options of whole records that are stored more than once.
COMPACT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def recommended_conf(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Spill-aware settings for a cluster run of the batch job.

    The dedup exchange carries full rows, so it gets about one partition per
    ``target_partition_bytes`` of input (never fewer than 2x the cores); AQE
    coalesces the small establishment exchanges toward the same advisory
    size and splits skewed join partitions; scan splits match the target.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **JOB_CONF,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "hazardlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (a cluster passes its own)."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HAZARDLENS_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_session(master: str | None = None, app_name: str = "hazardlens", input_bytes: int | None = None) -> SparkSession:
    """Session for a job run: the submitted cluster's master when there is one.

    Under ``spark-submit`` the master comes from the submit arguments and is
    not overridden; a plain ``python`` run without ``master`` gets
    ``local[*]``. The job settings (AQE, skew joins, UTC) are applied either way;
    with ``input_bytes`` the sizes of ``recommended_conf`` follow from it and
    the cluster's cores.
    """
    from pyspark import SparkConf, SparkContext
    if master is None:
        SparkContext._ensure_initialized()   # JVM-backed conf: sees spark-submit's --master
        if not SparkConf().contains("spark.master"):
            master = "local[*]"
    builder = SparkSession.builder.appName(app_name).config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if input_bytes:
        for k, v in recommended_conf(input_bytes, spark.sparkContext.defaultParallelism).items():
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    The cluster names it in ``spark.checkpoint.dir`` (or a job registers one on
    the SparkContext). Only a local master may do without: one JVM sees its own
    temporary folder, so a fresh one is created and registered. Any other
    master without a shared folder raises, since executors on other machines
    could not read what is staged.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="hazardlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/stage-{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a lineage
    cut that survives lost executors and is computed once."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, the shuffle files of a query go when it ends, not when the driver next
    collects its garbage. For frames that run once: a second run shuffles again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a staged folder (only ever one made by ``staging_path``)."""
    if "/stage-" not in path:
        raise ValueError(f"not a staged folder: {path}")
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def drop_staged_frame(df: DataFrame) -> None:
    """Remove the folder of a frame made by ``staged``."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_staged(df.sparkSession, folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute a scan that yields fewer partitions than the cluster has cores.

    A single unsplittable file (one parquet row group) is read by one task;
    before CPU-heavy narrow work (text scans) that caps parallelism at 1. On
    a large input the scan already has more splits than cores and this is a
    no-op, so it never adds a shuffle at scale. Rows are hash-partitioned on
    ``keys`` (deterministic on retry, no pre-sort; pass the key of the next
    aggregation so that exchange is reused), else round-robin. The rows are the
    same either way; only the number of tasks differs.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)
