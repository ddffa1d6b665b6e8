"""Session defaults and the shared working folder.

Jobs never write to a machine-local temporary folder on a cluster: intermediate tables and
checkpoints go under the folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (a local test session) do we create a folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings that matter for these jobs. AQE coalesces the small post-aggregation
# partitions, splits skewed join partitions (a hot user or item) and turns joins whose runtime
# side is small into broadcast joins.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


MIB = 1024 * 1024


def sized_conf(
    input_bytes: int, cores: int, partition_bytes: int = 256 * MIB, max_partitions: int = 200_000
) -> dict:
    """Shuffle and scan sizing for an input of ``input_bytes`` on ``cores`` executor cores.

    The largest shuffles here (deduplication, the (genre, user) aggregate) are on the order of
    the ratings input, so ``spark.sql.shuffle.partitions`` is the input divided by
    ``partition_bytes`` (a partition stays well inside an executor core's share of memory and
    spills if it must), never fewer than two per core, and at most ``max_partitions``: beyond
    that the scheduling and map-status cost (maps x reducers) outweighs smaller partitions, so
    partitions grow instead (about 500 MiB at 100 TB). AQE coalesces the small
    post-aggregation stages back down, so a large value costs little there.
    """
    partitions = min(max_partitions, max(2 * cores, -(-input_bytes // partition_bytes)))
    return {
        **RUNTIME_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(partition_bytes, 128 * MIB)),
    }


def configure(spark: SparkSession, input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """Apply the runtime SQL settings (and, given the input size, the sized shuffle settings)
    to a session, and make sure the shared folder is known."""
    conf = dict(RUNTIME_CONF)
    if input_bytes is not None:
        conf = sized_conf(input_bytes, cores or spark.sparkContext.defaultParallelism)
    for k, v in conf.items():
        spark.conf.set(k, v)
    shared_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "prefkit") -> SparkSession:
    """A local session for tests and the benchmark (no UI, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint directory when only that is
    set). Where the session names none, a local session (tests) gets a folder of its own; on a
    cluster that is an error, since executors would write to their own disks.
    The SparkContext checkpoint directory is pointed at the same place so that
    ``DataFrame.checkpoint()`` and ALS's periodic checkpoints land there.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="prefkit-ckpt-")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def is_local(master: str) -> bool:
    """Whether driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


def input_bytes_of(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under ``paths``, by the file system that holds each."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return total


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there: what several parts of a
    plan use is computed once, and after a lost executor it is read again instead of made again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder for one written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/prefkit-{name}-{uuid.uuid4().hex[:12]}"

