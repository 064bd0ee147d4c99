"""Continuous ingest: messages to the partitioned telemetry table, rejects to their own."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.sources import telemetry as store
from perigee.sources import wire
from perigee.streaming.arrivals import hourly_counts


def with_trigger(writer, every: str | None):
    """Process what is there and stop, or keep running with a trigger interval."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def start_ingest(
    messages: DataFrame,
    table_root: str,
    dead_letter_root: str,
    checkpoint_root: str,
    every: str | None = None,
    max_rows_per_file: int = store.MAX_ROWS_PER_FILE,
) -> StreamingQuery:
    """Write good messages to the telemetry table and bad ones to the dead letters, in one query.

    Every batch is decoded once and kept while its outputs are written, all under the batch's
    number (directory level ``batch``, which readers don't see): a batch repeated after a
    failure replaces its own output. Bad messages never stop the stream. Directories come
    from event time, so a late row goes to its own hour and nothing already written is
    replaced. ``every=None`` drains the source and stops. Counters: :func:`ingest_counters`;
    closed hours and late rows: :mod:`perigee.streaming.arrivals` over ``checkpoint_root``/arrivals.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = wire.parsed(batch)
        bad_only = lambda c: F.when(F.col("reject_reason").isNotNull(), F.col(c))  # noqa: E731 - good messages live on as records
        decoded = decoded.withColumns({c: bad_only(c) for c in ("key", "value")}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = decoded.where(F.col("reject_reason").isNull()).select("_record.*")
            with store.tasks_of_few_files(batch.sparkSession, max_rows_per_file):
                (
                    store.gathered_by_partition(store.with_partition_columns(good))
                    .write.mode("overwrite")
                    .option("compression", "zstd")
                    .option("maxRecordsPerFile", max_rows_per_file)
                    .partitionBy(*S.PARTITION_COLUMNS)
                    .parquet(f"{table_root}/batch={batch_id}")
                )
            bad = decoded.where(F.col("reject_reason").isNotNull()).select("key", "value", "reject_reason")
            bad.write.mode("overwrite").option("compression", "zstd").parquet(f"{dead_letter_root}/batch={batch_id}")
            arrived = hourly_counts(store.with_partition_columns(good).withColumn("date", F.col("date").cast("date")))
            arrived.write.mode("overwrite").parquet(f"{checkpoint_root}/arrivals/batch={batch_id}")
            counters = decoded.agg(*wire.counters())
            counters.write.mode("overwrite").parquet(f"{checkpoint_root}/counters/batch={batch_id}")
        finally:
            decoded.unpersist()

    writer = messages.writeStream.option("checkpointLocation", f"{checkpoint_root}/query").foreachBatch(write)
    return with_trigger(writer, every).start()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait until queries started with ``every=None`` have processed everything."""
    for query in queries:
        query.awaitTermination()


def ingest_counters(spark: SparkSession, checkpoint_root: str) -> DataFrame:
    """One row: messages seen, received and failed to decode in all batches so far, over all restarts."""
    names = ["messages_seen", "messages_received", "decode_errors"]
    per_batch = spark.read.schema(", ".join(f"{c} bigint" for c in names)).parquet(f"{checkpoint_root}/counters")
    return per_batch.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def read_dead_letters(spark: SparkSession, dead_letter_root: str) -> DataFrame:
    stored = spark.read.schema("key binary, value binary, reject_reason string").parquet(dead_letter_root)
    return stored.select("key", "value", "reject_reason")
