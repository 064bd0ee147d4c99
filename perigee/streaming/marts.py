"""Streaming minute rollup and streaming latest-state snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perigee.operators.marts import (
    EXTREMES,
    ROLLUP_MEASURES,
    SNAPSHOT_COLUMNS,
    SUMS_COLUMNS,
    fleet_health_snapshot,
    from_sums,
    merged_sums,
    rollup_input,
    rollup_sums,
    with_bands,
)
from perigee.streaming.ingest import with_trigger
from perigee.streaming.keyed import KeyedTable

_DOUBLE_SUMS = {f"{c}_{n}" for c in EXTREMES for n in ("min", "max")}
SUMS_SCHEMA = ", ".join(
    ["sat_id string", "minute_bucket timestamp", "slot int"]
    + [f"{c} {'double' if c in _DOUBLE_SUMS or c.endswith('_odd') else 'bigint'}" for c in SUMS_COLUMNS]
)
_STATE = [c for c in SNAPSHOT_COLUMNS if not c.endswith("_band")]
SNAPSHOT_SCHEMA = ", ".join(
    f"{c} {'string' if c == 'sat_id' or c.endswith('_band') else 'timestamp' if c == 'latest_sim_time' else 'boolean' if c == 'eclipsed' else 'double'}"
    for c in SNAPSHOT_COLUMNS
)


def add_sums(batch: DataFrame, batch_id: int, path: str, measures: Sequence[str] = ROLLUP_MEASURES) -> None:
    """Store the sums of a batch's minutes under its number; a repeated batch replaces its own."""
    sums = rollup_sums(rollup_input(batch), measures)
    (
        sums.withColumn("date", F.to_date("minute_bucket"))
        .repartition("date", "sat_id")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("date")
        .parquet(f"{path}/batch={batch_id}")
    )


def start_rollup(raw: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the minute rollup of a raw-view stream, as mergeable sums per batch and minute.

    Every row counts as soon as its batch is done, so there are no open minutes to flush,
    and a late row corrects its minute, however late. Memory doesn't grow with the stream.
    """
    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: add_sums(batch, batch_id, path)
    )
    return with_trigger(writer, every).start()


def read_sums(spark: SparkSession, path: str, batch_id: int | None = None, upto: int | None = None) -> DataFrame:
    """Stored sums of all batches, of one (only its files are listed), or of those up to one."""
    folder = path if batch_id is None else f"{path}/batch={batch_id}"
    parts = spark.read.schema(SUMS_SCHEMA + ", date date, batch bigint").option("basePath", path).parquet(folder)
    return parts if upto is None else parts.where(F.col("batch") <= upto)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The rollup of all batches so far: the sums of each minute merged."""
    return from_sums(merged_sums(read_sums(spark, path)))


def snapshot_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, "sat_id", SNAPSHOT_SCHEMA)


def start_snapshot(raw: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the snapshot up to date after each batch; ties on the latest time all stay.

    The rows of a batch's own satellites are made of those before and the batch's latest ones;
    only their buckets are written (see :mod:`perigee.streaming.keyed`).
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        table = snapshot_table(batch.sparkSession, root)
        new = fleet_health_snapshot(batch).select(*_STATE).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = table.read(new, before=batch_id).select(*_STATE).unionByName(new)
            newest = rows.groupBy("sat_id").agg(F.max("latest_sim_time").alias("latest_sim_time"))
            latest = rows.join(newest, ["sat_id", "latest_sim_time"])
            table.replace(with_bands(latest).select(*SNAPSHOT_COLUMNS), new, batch_id)
        finally:
            new.unpersist()

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(update)
    return with_trigger(writer, every).start()


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version of the streaming snapshot."""
    return snapshot_table(spark, root).read()
