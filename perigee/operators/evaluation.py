"""Scoring of detector events against bound fault labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import scalars as X

_KEYS = ["sat_id", "detector_name"]


def fault_windows(bound: DataFrame) -> DataFrame:
    """Earliest start and number of labels per (satellite, detector)."""
    return (
        bound.withColumn("detector_name", X.detector_for_fault(F.col("fault_type")))
        .groupBy(*_KEYS)
        .agg(F.min("start").alias("earliest_start"), F.count(F.lit(1)).alias("n_specs"))
    )


def classify_events(events: DataFrame, bound: DataFrame) -> DataFrame:
    """Events with ``outcome`` TP or FP and, for TP, the latency from the earliest start.

    Every event at or after the earliest start counts as TP. Event times without a zone
    are UTC. The window side has one row per key, so the join cannot multiply events.
    """
    event_time = X.parse_iso(F.col("sim_time_iso"))
    hit = F.coalesce(F.col("event_time") >= F.col("earliest_start"), F.lit(False))
    latency = X.seconds_between(F.col("event_time"), F.col("earliest_start"))
    return (
        events.withColumn("event_time", event_time)
        .join(fault_windows(bound), _KEYS, "left")
        .withColumn("outcome", F.when(hit, "TP").otherwise("FP"))
        .withColumn("latency_seconds", F.when(hit, latency))
        .drop("n_specs")
    )


def missed_faults(events: DataFrame, bound: DataFrame) -> DataFrame:
    """(Satellite, detector) keys with labels but no event at or after the earliest start.

    It is enough to compare each key's latest event, one row per key after a partial
    aggregation.
    """
    latest = events.groupBy(*_KEYS).agg(
        F.max(X.parse_iso(F.col("sim_time_iso"))).alias("latest_event")
    )
    caught = F.coalesce(F.col("latest_event") >= F.col("earliest_start"), F.lit(False))
    return fault_windows(bound).join(latest, _KEYS, "left").where(~caught).drop("latest_event")


def unknown_detectors(events: DataFrame) -> DataFrame:
    """Events whose detector no fault type maps to."""
    known = F.coalesce(F.col("detector_name").isin(*S.DETECTORS), F.lit(False))
    return events.where(~known)


def scorecard(events: DataFrame, bound: DataFrame) -> DataFrame:
    """One row per detector: TP, FP, FN, recall, precision, mean latency.

    All known detectors appear, also without events or labels; recall and precision are 1
    on an empty denominator and mean latency is null without a TP. An event of an unknown
    detector fails the job.
    """
    known = F.coalesce(F.col("detector_name").isin(*S.DETECTORS), F.lit(False))
    checked = events.withColumn(
        "detector_name",
        F.when(known, F.col("detector_name")).otherwise(
            F.raise_error(F.concat(F.lit("unknown detector "), F.col("detector_name")))
        ),
    )
    is_tp = F.col("outcome") == "TP"
    hits = (
        classify_events(checked, bound)
        .groupBy("detector_name")
        .agg(
            F.count_if(is_tp).alias("tp"),
            F.count_if(~is_tp).alias("fp"),
            F.sum("latency_seconds").alias("latency"),
        )
        .withColumn("fn", F.lit(0).cast("bigint"))
    )
    misses = (
        missed_faults(events, bound)
        .groupBy("detector_name")
        .agg(F.sum("n_specs").alias("fn"))
        .withColumns({"tp": F.lit(0).cast("bigint"), "fp": F.lit(0).cast("bigint")})
        .withColumn("latency", F.lit(None).cast("double"))
    )
    # One zero row per known detector, so that each is reported.
    blank = bound.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(d) for d in S.DETECTORS])).alias("detector_name"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("tp", "fp", "fn")],
        F.lit(None).cast("double").alias("latency"),
    )
    total = (
        hits.unionByName(misses)
        .unionByName(blank)
        .groupBy("detector_name")
        .agg(
            F.sum("tp").alias("true_positives"),
            F.sum("fp").alias("false_positives"),
            F.sum("fn").alias("false_negatives"),
            F.sum("latency").alias("_latency"),
        )
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return total.select(
        "detector_name",
        "true_positives",
        "false_positives",
        "false_negatives",
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(1.0).alias("recall"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0).alias("precision"),
        F.when(tp > 0, F.col("_latency") / tp).alias("mean_latency_seconds"),
    )


def summary(scores: DataFrame) -> DataFrame:
    """Printable scorecard: latency in minutes, null (not zero) when there was no TP."""
    return scores.select(
        "detector_name",
        F.col("true_positives").alias("tp"),
        F.col("false_positives").alias("fp"),
        F.col("false_negatives").alias("fn"),
        F.round("recall", 2).alias("recall"),
        F.round("precision", 2).alias("precision"),
        F.round(F.col("mean_latency_seconds") / 60.0, 1).alias("latency_min"),
    ).orderBy("detector_name")
