"""What arrived when: closed hours and late rows of an ingest stream.

With the rows of a batch, ingest writes how many of them fell into each hour of each satellite,
under the batch's number, so a repeated batch counts once. An hour is complete once a later hour
of its satellite arrives, in whatever batch; rows that come after that are late. They are in the table
like all others; here they are counted, and their hour is marked as reopened.

The same log says which days a batch touched, and so does a withdrawal, which takes a whole batch
out of the table again: :mod:`perigee.plans.daily` brings tables by day up to date from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.session import child_names, remove_path

ARRIVALS_SCHEMA = "sat_id string, date date, hour string, n_rows bigint"


def hourly_counts(rows: DataFrame) -> DataFrame:
    """Rows of each satellite's hours, of a table with the columns of the directories."""
    return rows.groupBy("sat_id", "date", "hour").agg(F.count(F.lit(1)).alias("n_rows"))


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """sat_id, hour_start, batch, n_rows: rows that a batch brought for an hour."""
    stored = spark.read.schema(ARRIVALS_SCHEMA + ", batch bigint").option("basePath", path).parquet(path)
    start = F.to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), "hour"), "yyyy-MM-dd HH")
    return stored.select("sat_id", start.alias("hour_start"), "batch", "n_rows")


def _newest_by_batch(arrivals: DataFrame) -> DataFrame:
    """Per satellite and batch that brought any of its rows: its newest hour before and after the batch."""
    per_batch = arrivals.groupBy("sat_id", "batch").agg(F.max("hour_start").alias("newest"))
    so_far = W.partitionBy("sat_id").orderBy("batch")  # one row a batch
    return per_batch.select(
        "sat_id", "batch",
        F.max("newest").over(so_far.rowsBetween(W.unboundedPreceding, -1)).alias("newest_before"),
        F.max("newest").over(so_far.rowsBetween(W.unboundedPreceding, 0)).alias("newest_after"),
    )


def late_rows(arrivals: DataFrame) -> DataFrame:
    """sat_id, date, batch, n_late: rows that came for an hour before the newest one of all earlier batches."""
    late = arrivals.join(_newest_by_batch(arrivals), ["sat_id", "batch"]).where(F.col("hour_start") < F.col("newest_before"))
    return late.groupBy("sat_id", F.to_date("hour_start").alias("date"), "batch").agg(F.sum("n_rows").alias("n_late"))


def hours(arrivals: DataFrame) -> DataFrame:
    """sat_id, hour_start, n_rows, closed_by, reopened: every hour's rows, batch that completed it, and later batches with rows of it.

    ``closed_by`` is the first batch after which a later hour was known (not before the hour's own
    first); null while the hour is its satellite's newest.
    """
    newest = _newest_by_batch(arrivals)
    grew = newest.where(F.col("newest_before").isNull() | (F.col("newest_after") > F.col("newest_before")))
    grew = grew.select("sat_id", F.col("newest_after").alias("hour_start"), F.col("batch").alias("grew_in"), F.lit(None).cast("bigint").alias("first"), F.lit(None).cast("bigint").alias("n_rows"))
    own = arrivals.groupBy("sat_id", "hour_start").agg(F.min("batch").alias("first"), F.sum("n_rows").alias("n_rows"))
    both = grew.unionByName(own.withColumn("grew_in", F.lit(None).cast("bigint")))
    later = W.partitionBy("sat_id").orderBy(F.unix_seconds("hour_start")).rangeBetween(1, W.unboundedFollowing)
    closing = both.withColumn("closing", F.min("grew_in").over(later)).where(F.col("first").isNotNull())
    closed = closing.select("sat_id", "hour_start", "n_rows", F.when(F.col("closing").isNotNull(), F.greatest("closing", "first")).alias("closed_by"))
    again = arrivals.join(newest, ["sat_id", "batch"]).where(F.col("hour_start") < F.col("newest_before"))
    first = arrivals.groupBy("sat_id", "hour_start").agg(F.min("batch").alias("first_batch"))
    again = again.join(first, ["sat_id", "hour_start"]).where(F.col("batch") > F.col("first_batch"))
    again = again.groupBy("sat_id", "hour_start").agg(F.count(F.lit(1)).alias("reopened"))
    return closed.join(again, ["sat_id", "hour_start"], "left").withColumn("reopened", F.coalesce("reopened", F.lit(0).cast("bigint")))


# ---- changes --------------------------------------------------------------------------------


def _logged(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """Numbers, beyond ``after``, of the batches with a complete entry below a path."""
    found = sorted(int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith("batch="))
    return [b for b in found if b > after and "_SUCCESS" in child_names(spark, f"{path}/batch={b}")]


def batches(spark: SparkSession, checkpoint_root: str, after: int = -1) -> list[int]:
    """Batches in the table, beyond ``after``: those with a complete log of arrivals."""
    return _logged(spark, f"{checkpoint_root}/arrivals", after)


def withdrawn(spark: SparkSession, checkpoint_root: str) -> list[int]:
    """Batches that were taken out of the table."""
    return _logged(spark, f"{checkpoint_root}/withdrawn")


def withdraw_batch(spark: SparkSession, table_root: str, checkpoint_root: str, batch: int) -> None:
    """Remove all rows that a finished batch brought, and log the days they were of.

    The log is written first, so a call that fails half-way can be repeated. Dead letters and
    counters stay: they say what was received. A batch that isn't in the table raises ValueError.
    """
    known = batches(spark, checkpoint_root)
    if batch not in known and batch not in withdrawn(spark, checkpoint_root):
        raise ValueError(f"no batch {batch} in {table_root}")
    if batch in known:
        days = read_arrivals(spark, f"{checkpoint_root}/arrivals").where(F.col("batch") == batch)
        days = days.select(F.to_date("hour_start").alias("date")).distinct()
        days.write.mode("overwrite").parquet(f"{checkpoint_root}/withdrawn/batch={batch}")
    remove_path(spark, f"{table_root}/batch={batch}")
    remove_path(spark, f"{checkpoint_root}/arrivals/batch={batch}")


def touched_days(spark: SparkSession, checkpoint_root: str, arrived: list[int], gone: list[int]) -> DataFrame:
    """``date``: the days with rows of the given batches, arrived or withdrawn."""
    days = spark.createDataFrame([], "date date")
    if arrived:
        log = spark.read.schema(ARRIVALS_SCHEMA).parquet(*[f"{checkpoint_root}/arrivals/batch={b}" for b in arrived])
        days = days.unionByName(log.select("date"))
    if gone:
        days = days.unionByName(spark.read.schema("date date").parquet(*[f"{checkpoint_root}/withdrawn/batch={b}" for b in gone]))
    return days.where(F.col("date").isNotNull()).distinct()
