from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.operators import evaluation as E
from perigee.operators.labels import bind_labels
from perigee.sources.labels import labels_from_rows

EVENTS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.EVENT_SCHEMA.fields)


def events(spark, *rows):
    return spark.createDataFrame([(s, d, t, "warning", 1.0, "test") for s, d, t in rows], EVENTS)


def bound(spark, *rows):
    labels = labels_from_rows(
        spark, [{"sat_id": s, "fault_type": k, "start_iso": t} for s, k, t in rows]
    )
    return bind_labels(labels, F.lit(datetime(2026, 5, 1, tzinfo=UTC)).cast("timestamp"))


def scores(ev, labels):
    return {r["detector_name"]: r for r in E.scorecard(ev, labels).collect()}


FADE = ("BIRD-1", S.CAPACITY_FADE, "2026-05-01T00:00:00+00:00")


def test_event_in_the_window_is_a_true_positive(spark):
    sc = scores(events(spark, ("BIRD-1", "capacity_fade", "2026-05-02T00:00:00+00:00")), bound(spark, FADE))
    r = sc["capacity_fade"]
    assert (r["true_positives"], r["false_positives"], r["false_negatives"]) == (1, 0, 0)
    assert (r["recall"], r["precision"]) == (1.0, 1.0)
    assert set(sc) == set(S.DETECTORS)


def test_event_before_the_start_is_false_and_the_fault_missed(spark):
    late = ("BIRD-1", S.CAPACITY_FADE, "2026-05-05T00:00:00+00:00")
    r = scores(events(spark, ("BIRD-1", "capacity_fade", "2026-05-01 00:00:00")), bound(spark, late))[
        "capacity_fade"
    ]
    assert (r["true_positives"], r["false_positives"], r["false_negatives"]) == (0, 1, 1)
    assert (r["recall"], r["precision"]) == (0.0, 0.0)


def test_event_on_another_satellite_is_false(spark):
    other = ("BIRD-2", S.CAPACITY_FADE, "2026-05-01T00:00:00+00:00")
    r = scores(events(spark, ("BIRD-1", "capacity_fade", "2026-05-02 00:00:00")), bound(spark, other))[
        "capacity_fade"
    ]
    assert (r["true_positives"], r["false_positives"], r["false_negatives"]) == (0, 1, 1)


def test_fault_without_event_is_missed_once_per_label(spark):
    hot = ("BIRD-1", S.THERMAL_RUNAWAY, "2026-05-01T00:00:00+00:00")
    again = ("BIRD-1", S.THERMAL_RUNAWAY, "2026-05-03T00:00:00+00:00")
    sc = scores(events(spark), bound(spark, hot, again))
    assert sc["thermal_runaway"]["false_negatives"] == 2
    assert sc["thermal_runaway"]["mean_latency_seconds"] is None
    assert sc["stuck_sensor"]["recall"] == sc["stuck_sensor"]["precision"] == 1.0


def test_latency_counts_from_the_earliest_start(spark):
    later = ("BIRD-1", S.CAPACITY_FADE, "2026-05-01T02:00:00+00:00")
    ev = events(spark, ("BIRD-1", "capacity_fade", "2026-05-01 03:00:00"))
    assert scores(ev, bound(spark, later, FADE))["capacity_fade"]["mean_latency_seconds"] == 10_800.0


def test_zero_latency_stays_distinct_from_none(spark):
    ev = events(spark, ("BIRD-1", "capacity_fade", "2026-05-01 00:00:00"))
    rows = {r["detector_name"]: r["latency_min"]
            for r in E.summary(E.scorecard(ev, bound(spark, FADE))).collect()}
    assert rows == {"capacity_fade": 0.0, "stuck_sensor": None, "thermal_runaway": None}


def test_other_time_zones_are_converted_for_hits_and_misses_alike(spark):
    ev = events(spark, ("BIRD-1", "capacity_fade", "2026-05-01T01:00:00+02:00"))
    r = scores(ev, bound(spark, FADE))["capacity_fade"]
    assert (r["true_positives"], r["false_positives"], r["false_negatives"]) == (0, 1, 1)


def test_unknown_detector_is_an_error(spark):
    ev = events(spark, ("BIRD-1", "attitude", "2026-05-02 00:00:00"))
    assert E.unknown_detectors(ev).count() == 1
    with pytest.raises(Exception, match="unknown detector attitude"):
        scores(ev, bound(spark, FADE))
