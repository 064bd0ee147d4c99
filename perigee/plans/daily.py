"""Tables by day, brought up to date from the log of what arrived or was withdrawn.

A refresh asks the log which batches are new to it and which days those touched, reads the
telemetry of these days only, and replaces exactly these days in every table: the minute rollup,
the violations of the model checks, and sketches of the distinct times of each satellite. A day
left without rows goes. All tables change under one version, which counts once its record of
applied batches is complete; a refresh that fails before that is repeated under the same number,
and readers stay at the version before. Work grows with the days touched, not with the history.

Refreshes of one root must not overlap each other. A refresh may run while ingest does: it takes
batches whose log is complete.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee import schema as S
from perigee.operators import marts, quality, staging
from perigee.session import child_names, remove_path
from perigee.sources import telemetry as store
from perigee.streaming import arrivals
from perigee.streaming.keyed import MANIFESTS_KEPT, DatedTable

SKETCH_LOG_K = 12  # relative error of about 1.6 per cent


@dataclass(frozen=True)
class Daily:
    """A table by day: its columns, its order within a file, and how to make days of it from raw rows with their date."""

    schema: str
    order: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]


def _rollup(raw: DataFrame) -> DataFrame:
    return marts.sat_minute_rollup(raw).withColumn("date", F.to_date("minute_bucket"))


def _violations(raw: DataFrame) -> DataFrame:
    return quality.daily_violations(quality.staged(raw), quality.telemetry_checks())


def time_sketches(raw: DataFrame) -> DataFrame:
    """Rows and a mergeable sketch of the distinct times of each satellite and day."""
    return raw.groupBy("sat_id", "date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(F.unix_micros("sim_time"), SKETCH_LOG_K).alias("times")
    )


_ROLLUP_SCHEMA = ", ".join(["sat_id string", "minute_bucket timestamp", *[f"{m} double" for m in marts.ROLLUP_MEASURES], "date date"])
TABLES = {
    "sat_minute_rollup": Daily(_ROLLUP_SCHEMA, ("sat_id", "minute_bucket"), _rollup),
    "violations": Daily("date date, model string, column_name string, check_name string, violations bigint", (), _violations),
    "time_sketches": Daily("sat_id string, date date, n_rows bigint, times binary", ("sat_id",), time_sketches),
}


def _table(spark: SparkSession, root: str, name: str) -> DatedTable:
    return DatedTable(spark, f"{root}/{name}", TABLES[name].schema, TABLES[name].order)


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    found = [int(n.split("=")[1]) for n in child_names(spark, f"{root}/applied") if n.startswith("version=")]
    return sorted(v for v in found if "_SUCCESS" in child_names(spark, f"{root}/applied/version={v}"))


def _applied(spark: SparkSession, root: str, version: int) -> tuple[int, set[int]]:
    """The last batch a version knows, and the withdrawn ones it knows."""
    rows = spark.read.schema("batch bigint, gone boolean").parquet(f"{root}/applied/version={version}").collect()
    return max(r["batch"] for r in rows if not r["gone"]), {r["batch"] for r in rows if r["gone"]}


def refresh(spark: SparkSession, table_root: str, checkpoint_root: str, root: str) -> list:
    """Bring all tables below ``root`` up to date; returns the days replaced, in order.

    Nothing new: no version, no days. Batches are numbered in the order they come, so what is new
    are those beyond the last one applied. Each table scans the touched days for its own columns.
    Only the list of new batches, withdrawn ones and touched days passes through the driver.
    """
    known = _versions(spark, root)
    last, gone = _applied(spark, root, known[-1]) if known else (-1, set())
    gone_now = set(arrivals.withdrawn(spark, checkpoint_root))
    new = [b for b in arrivals.batches(spark, checkpoint_root, after=last) if b not in gone_now]
    if not new and gone_now == gone:
        return []
    # a batch that came and went between two refreshes left nothing to undo
    undone = sorted(b for b in gone_now - gone if b <= last)
    days = [r["date"] for r in arrivals.touched_days(spark, checkpoint_root, new, undone).collect()]
    last = max([last, *new])
    version = known[-1] + 1 if known else 0
    keys = spark.createDataFrame([(d,) for d in days], "date date")
    raw = _raw_of_days(spark, table_root, last, gone_now, days)
    for name, daily in TABLES.items():
        _table(spark, root, name).replace(daily.build(raw), keys, version)
    record = [(last, False)] + [(b, True) for b in sorted(gone_now)]
    spark.createDataFrame(record, "batch bigint, gone boolean").coalesce(1).write.mode("overwrite").parquet(f"{root}/applied/version={version}")
    for old in known[: len(known) + 1 - MANIFESTS_KEPT]:
        remove_path(spark, f"{root}/applied/version={old}")
    return sorted(days)


def _raw_of_days(spark: SparkSession, table_root: str, last: int, gone: set[int], days: list) -> DataFrame:
    """Raw view, with ``date``, of the given days and the batches up to ``last``: other directories are pruned."""
    stored = spark.read.schema(T.StructType([*S.STORED_TELEMETRY_SCHEMA.fields, T.StructField("batch", T.LongType())]))
    stored = stored.option("basePath", table_root).parquet(table_root).where(F.col("date").isin(days) & (F.col("batch") <= last))
    if gone:
        stored = stored.where(~F.col("batch").isin(sorted(gone)))
    return staging.raw_telemetry(stored).withColumn("date", F.to_date("sim_time"))


def read_daily(spark: SparkSession, root: str, name: str, first_day=None, last_day=None) -> DataFrame:
    """One of the tables at the newest published version; with bounds, only these days' files are opened."""
    known = _versions(spark, root)
    table = _table(spark, root, name)
    if not known:
        return spark.createDataFrame([], table.schema)
    return table.read_range(known[-1] + 1, first_day, last_day)


def model_checks(spark: SparkSession, root: str) -> DataFrame:
    """The checks of the raw and staging models over all days, from the stored counts."""
    return quality.summed(read_daily(spark, root, "violations"))


def distinct_times(spark: SparkSession, root: str, first_day=None, last_day=None) -> DataFrame:
    """Rows and approximate distinct times per satellite over a range of days, from the stored sketches."""
    days = read_daily(spark, root, "time_sketches", first_day, last_day)
    return days.groupBy("sat_id").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("times")).alias("n_distinct_times")
    )
