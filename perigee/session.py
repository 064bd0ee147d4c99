"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. UTC is a correctness setting; the others let
# Spark re-plan joins and split oversized shuffle partitions from measured sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, shuffled_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Set the number of shuffle partitions for a job that shuffles about that many bytes.

    Meant to err on the high side: adaptive execution merges partitions that turn out
    small, but only spilling helps against ones that are too large. Returns the number set.
    """
    cores = spark.sparkContext.defaultParallelism
    partitions = max(cores, -(-shuffled_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def local_session(cores: int | str = "*", app: str = "perigee", **conf: str) -> SparkSession:
    """Build a local session for tests and benchmarks. Clusters pass their own session in."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder, chosen once per session.
    On a cluster executors would each write to their own disk, so that is an error.
    What is written below the path is removed when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("perigee.scratch.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="perigee-")
        spark.conf.set("perigee.scratch.dir", root)
    base = f"{root.rstrip('/')}/perigee"
    path = f"{base}/{purpose}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


@atexit.register
def remove_scratch() -> None:
    """Remove all scratch paths of sessions that still run."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may have ended; nothing else depends on this
            return


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, on whatever file system it is, if it exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, on whatever file system; none if it doesn't exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Used where several branches of one plan need the same derived table: it is computed
    once, its lineage ends at a file that outlives executors, and Catalyst sees its size.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
