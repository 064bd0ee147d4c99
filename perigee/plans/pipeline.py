"""The end-to-end jobs: telemetry to marts, and back-testing of the detectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import aggregates, detectors, evaluation, labels, marts, staging
from perigee.session import materialize
from perigee.sources import telemetry as store


@dataclass(frozen=True)
class Backtest:
    """What a back-test run produced; marts and events are stored tables."""

    bound_labels: DataFrame
    rollup: DataFrame
    events: DataFrame
    scores: DataFrame


def refresh_marts(spark: SparkSession, telemetry_root: str, mart_root: str) -> None:
    """Full refresh of both marts from the stored telemetry."""
    raw = staging.raw_telemetry(store.read_telemetry(spark, telemetry_root))
    store.write_mart(marts.sat_minute_rollup(raw), f"{mart_root}/sat_minute_rollup")
    store.write_mart(marts.fleet_health_snapshot(raw), f"{mart_root}/fleet_health_snapshot")


def refresh_rollup_days(
    spark: SparkSession, telemetry_root: str, rollup_path: str, first_day: str, last_day: str
) -> None:
    """Recompute the rollup for a range of days (yyyy-MM-dd, inclusive) and swap them in.

    Only those days' directories are read; a minute never spans two days.
    """
    stored = store.read_telemetry(spark, telemetry_root).where(
        F.col("date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    )
    rollup = marts.sat_minute_rollup(staging.raw_telemetry(stored))
    store.write_rollup_days(rollup, rollup_path)


def bind_to_data(raw: DataFrame, fault_labels: DataFrame) -> DataFrame:
    """Labels bound to the earliest minute present, stored, since every later step uses them."""
    minute = F.date_trunc("minute", F.col("sim_time"))
    start = raw.agg(F.min(minute).alias("sim_start"))
    return materialize(labels.bind_labels(fault_labels, start), "labels")


def backtest(
    raw: DataFrame,
    fault_labels: DataFrame,
    settings: detectors.DetectorSettings | None = None,
) -> Backtest:
    """Inject labels into clean telemetry, roll up, detect, and score the detectors.

    The labels, the mart and the events are each used several times downstream, so each
    is written once to the shared scratch folder and read back.
    """
    bound = bind_to_data(raw, fault_labels)
    observed = labels.inject(raw, bound)
    rollup = materialize(marts.sat_minute_rollup(observed), "rollup")
    events = materialize(detectors.detect(rollup, settings), "events")
    return Backtest(bound, rollup, events, evaluation.scorecard(events, bound))


def score_stored(
    spark: SparkSession, rollup_path: str, events_path: str, fault_labels: DataFrame
) -> DataFrame:
    """Detect on a stored mart, store the events, and score them against the labels."""
    rollup = store.read_mart(spark, rollup_path)
    store.write_events(detectors.detect(rollup), events_path)
    events = store.read_events(spark, events_path)
    start = aggregates.sim_start(rollup)
    bound = materialize(labels.bind_labels(fault_labels, start), "labels")
    return evaluation.scorecard(events, bound)
