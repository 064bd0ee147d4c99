"""Block-wise ordered computations against direct loops over each whole history."""

import random
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perigee.functions import sequence as Q
from helpers import plan_of


def histories(seed, sats=4, longest=260):
    """Random histories with gaps of minutes to days, of very different lengths."""
    rng = random.Random(seed)
    rows = []
    for s in range(sats):
        t = datetime(2026, 5, 1, 23, 30, tzinfo=UTC)
        for _ in range(rng.choice([1, 4, 5, 6, 89, 90, 91, longest])):
            t += timedelta(minutes=rng.choice([1, 1, 1, 1, 2, 60, 1440, 4000]))
            rows.append(
                {"sat_id": f"S{s}", "minute_bucket": t, "x": rng.random(), "flag": rng.random() < 0.7}
            )
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    fields = pa.schema(
        [
            ("sat_id", pa.string()),
            ("minute_bucket", pa.timestamp("us", tz="UTC")),
            ("x", pa.float64()),
            ("flag", pa.bool_()),
        ]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=fields))


def by_sat(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["sat_id"], r["minute_bucket"])):
        out.setdefault(r["sat_id"], []).append(r)
    return out


def result(df, column):
    out = {}
    for r in df.orderBy("sat_id", "seq").collect():
        out.setdefault(r["sat_id"], []).append(r[column])
    return out


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Blocks far smaller than the histories, smaller even than the rolling window."""
    monkeypatch.setattr(Q.split_blocks, "__defaults__", (16, "seq"))


@pytest.mark.parametrize("seed", range(3))
def test_positions_are_consecutive_in_time_order(spark, seed):
    rows = histories(seed)
    out = Q.number_rows(frame(spark, rows), "sat_id", "minute_bucket").collect()
    got = {(r["sat_id"], r["minute_bucket"].replace(tzinfo=UTC)): r["seq"] for r in out}
    assert len(got) == len(rows)
    for sat, ordered in by_sat(rows).items():
        assert [got[sat, r["minute_bucket"]] for r in ordered] == list(range(1, len(ordered) + 1))


@pytest.mark.parametrize("seed", range(3))
def test_rolling_max(spark, seed):
    rows = histories(seed)
    got = result(Q.rolling_max(frame(spark, rows), "x", 90, "m"), "m")
    for sat, ordered in by_sat(rows).items():
        xs = [r["x"] for r in ordered]
        want = [max(xs[i - 89 : i + 1]) if i >= 89 else None for i in range(len(xs))]
        assert got[sat] == want


@pytest.mark.parametrize("seed", range(3))
def test_step_and_slope(spark, seed):
    rows = histories(seed)
    steps = result(Q.step_change(frame(spark, rows), "x", "d"), "d")
    slopes = result(Q.endpoint_slope(frame(spark, rows), "x", 5, "d"), "d")
    for sat, ordered in by_sat(rows).items():
        xs = [r["x"] for r in ordered]
        assert steps[sat] == [None] + [b - a for a, b in zip(xs, xs[1:])]
        assert slopes[sat] == [
            (xs[i] - xs[i - 4]) / 4 if i >= 4 else None for i in range(len(xs))
        ]


@pytest.mark.parametrize("seed", range(3))
def test_run_length_continues_over_blocks(spark, seed):
    rows = histories(seed)
    for r in rows:  # long runs, so that some span several blocks
        r["flag"] = r["flag"] or r["x"] < 0.9
    got = result(Q.run_length(frame(spark, rows), "flag", "n"), "n")
    for sat, ordered in by_sat(rows).items():
        want, n = [], 0
        for r in ordered:
            n = n + 1 if r["flag"] else 0
            want.append(n)
        assert got[sat] == want


def test_blocks_bound_the_rows_in_a_group(spark):
    df = spark.range(1, 1001).select(F.lit("S").alias("sat_id"), F.col("id").alias("seq"))
    sizes = Q.split_blocks(df, 10, 100).groupBy("sat_id", "block").count().collect()
    assert max(r["count"] for r in sizes) <= 110


def test_no_window_is_partitioned_by_satellite_over_full_rows(spark):
    """Only the slice table, one row per day, is ordered per satellite alone."""
    plan = plan_of(Q.rolling_max(frame(spark, histories(0)), "x", 90, "m"))
    assert plan.count("hashpartitioning(sat_id") == 4
    assert "block" in plan and "_slice" in plan


def test_time_order_violations(spark):
    t = datetime(2026, 5, 1, tzinfo=UTC)
    minutes = [0, 1, 3, 2, 4, 4, 9, 8]
    rows = [("S", i, t + timedelta(minutes=m)) for i, m in enumerate(minutes)]
    df = spark.createDataFrame(rows, "sat_id string, n bigint, t timestamp")
    for span in (2, 3, 100):
        bad = Q.time_order_violations(df, "sat_id", "t", "n", span)
        assert sorted(r["n"] for r in bad.collect()) == [3, 5, 7]
