"""The stored telemetry table, marts and events: readers and writers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee import schema as S
from perigee.functions import scalars as X

# Rows per file of the telemetry table: about 200 MB of compressed telemetry.
MAX_ROWS_PER_FILE = 2_000_000
# Files that one task is meant to write, and bytes of a row on its way there.
FILES_PER_TASK = 256
ROW_BYTES = 128


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    tls: bool = False,
) -> dict[str, str]:
    """Hadoop S3A settings for an S3-compatible store, to be passed to the session builder.

    Keys may be left out where the cluster supplies credentials itself.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def read_telemetry(spark: SparkSession, root: str) -> DataFrame:
    """Telemetry columns plus ``date`` and ``hour``, with directory pruning on all three keys.

    The schema is given, never inferred: an id such as 007 stays text.
    """
    df = (
        spark.read.schema(S.STORED_TELEMETRY_SCHEMA)
        .option("basePath", root)
        .option("mergeSchema", "false")
        .parquet(root)
    )
    return df.select(*S.TELEMETRY_COLUMNS, "date", "hour")


def written_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per file of the stored table: its directory keys, rows and bytes.

    The totals are the writer's counters (rows flushed, files and bytes written), taken
    from what is actually stored.
    """
    stored = spark.read.schema(S.STORED_TELEMETRY_SCHEMA).option("basePath", root).parquet(root)
    return stored.groupBy(
        *S.PARTITION_COLUMNS,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("n_bytes"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def write_totals(files: DataFrame) -> DataFrame:
    """One row: rows, files and bytes written."""
    return files.agg(
        F.sum("n_rows").alias("rows_flushed"),
        F.count(F.lit(1)).alias("files_written"),
        F.sum("n_bytes").alias("bytes_written"),
    )


def between_times(stored: DataFrame, start=None, end=None) -> DataFrame:
    """Rows with ``start <= time < end``, with the matching range on the directories of day and hour.

    Catalyst cannot derive the directory range from a filter on the time text, so it is
    stated as well. Bounds are aware or naive-UTC datetimes.
    """
    t = X.parse_iso(F.col("sim_time_iso"))
    for bound, keep_time, keep_day in (
        (start, lambda b: t >= b, lambda d, h: (F.col("date") > d) | ((F.col("date") == d) & (F.col("hour") >= h))),
        (end, lambda b: t < b, lambda d, h: (F.col("date") < d) | ((F.col("date") == d) & (F.col("hour") <= h))),
    ):
        if bound is not None:
            instant = F.lit(bound).cast("timestamp")
            stored = stored.where(keep_day(F.to_date(instant), X.hour_text(instant)) & keep_time(instant))
    return stored


def with_partition_columns(telemetry: DataFrame) -> DataFrame:
    """Add ``date`` (yyyy-MM-dd) and ``hour`` (HH), both from event time."""
    t = X.parse_iso(F.col("sim_time_iso"))
    return telemetry.select(
        *S.TELEMETRY_COLUMNS,
        F.date_format(t, "yyyy-MM-dd").alias("date"),
        X.hour_text(t).alias("hour"),
    )


def gathered_by_partition(df: DataFrame) -> DataFrame:
    """Rows of one directory brought together, so that each gets few files.

    A rebalance rather than a plain repartition: adaptive execution splits a directory
    that is much larger than the others over several tasks and merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in S.PARTITION_COLUMNS])


@contextmanager
def tasks_of_few_files(spark: SparkSession, max_rows_per_file: int) -> Iterator[None]:
    """Adaptive execution makes tasks of about ``FILES_PER_TASK`` files while this is open.

    By bytes alone it makes little more tasks than there are cores. With small files the time
    goes by their number, and a stage would wait for a task that starts when all others end.
    """
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    wanted = FILES_PER_TASK * max_rows_per_file * ROW_BYTES
    usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    spark.conf.set(key, str(min(wanted, usual)))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def write_telemetry(
    telemetry: DataFrame,
    root: str,
    mode: str = "append",
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> None:
    """Write telemetry to ``sat_id=/date=/hour=HH/`` directories as zstd Parquet.

    Appending never replaces files already there, so late rows of an hour are kept.
    """
    gathered = gathered_by_partition(with_partition_columns(S.require_schema(telemetry)))
    with tasks_of_few_files(telemetry.sparkSession, max_rows_per_file):
        (
            gathered.write.mode(mode)
            .partitionBy(*S.PARTITION_COLUMNS)
            .option("compression", "zstd")
            .option("maxRecordsPerFile", max_rows_per_file)
            .parquet(root)
        )


def select_fleet(
    telemetry: DataFrame,
    name_contains: str | None = None,
    limit: int | None = None,
    require_match: bool = True,
) -> DataFrame:
    """Rows of the satellites whose id contains a text (any case), first ``limit`` by name.

    With ``require_match`` an empty selection raises ValueError, as a mistyped filter
    otherwise passes for an idle fleet.
    """
    chosen = telemetry
    if name_contains is not None:
        chosen = chosen.where(F.upper("sat_id").contains(name_contains.upper()))
    if limit is not None:
        first = chosen.select("sat_id").distinct().orderBy("sat_id").limit(limit)
        chosen = chosen.join(first, "sat_id", "left_semi")
    if require_match and chosen.isEmpty():
        raise ValueError(f"no satellites match filter={name_contains!r}, limit={limit}")
    return chosen


# ---- marts and events -------------------------------------------------------------------


def write_mart(mart: DataFrame, path: str) -> None:
    """Full refresh of a mart, sorted so that row groups can be skipped by satellite."""
    keys = [c for c in ("sat_id", "minute_bucket") if c in mart.columns]
    (
        mart.repartitionByRange(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )


def write_rollup_days(rollup: DataFrame, path: str) -> None:
    """Incremental refresh: replace exactly the days present in ``rollup``.

    Days are directories; dynamic partition overwrite leaves the other days alone. Within
    a day, rows are range-split by satellite so one day may use many tasks.
    """
    (
        rollup.withColumn("date", F.to_date("minute_bucket"))
        .repartitionByRange(F.col("date"), F.col("sat_id"), F.col("minute_bucket"))
        .sortWithinPartitions("date", "sat_id", "minute_bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("date")
        .parquet(path)
    )


def read_mart(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_events(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the six event columns as zstd Parquet."""
    (
        events.select(*S.EVENT_SCHEMA.fieldNames())
        .write.mode(mode)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.EVENT_SCHEMA).parquet(path)


def for_satellite(df: DataFrame, sat_id: str) -> DataFrame:
    """Rows of one satellite; a bare comparison, so it prunes directories and row groups."""
    return df.where(F.col("sat_id") == F.lit(sat_id))


def within_last(df: DataFrame, time: str, span: Column) -> DataFrame:
    """Rows no older than ``span`` before the newest one (an interval column expression)."""
    newest = df.agg(F.max(time))
    return df.where(F.col(time) >= newest.scalar() - span)
