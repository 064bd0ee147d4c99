import math
import random
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from perigee.functions import scalars as X
from perigee.operators import aggregates, marts, quality, staging
from perigee.plans import dashboards
from helpers import NOMINAL, T0, plan_of, record, telemetry


def raw_of(spark, recs):
    return staging.raw_telemetry(telemetry(spark, recs))


def fleet(sats=2, minutes=20):
    """Satellites whose nights start at different minutes of a twelve-minute round; charge falls by night."""
    out = []
    for s in range(sats):
        charge = 0.71 - 0.05 * s
        for i in range(minutes):
            night = (i + 5 * s) % 12 >= 8
            charge += -0.004 if night else 0.0025
            out.append(
                record(
                    f"BIRD-{s + 1}", T0 + timedelta(minutes=i), eclipsed=night, battery_soc=round(charge, 6),
                    net_power_w=-47.0 if night else 92.0,
                )
            )
    return out


def test_strict_view_fails_and_lenient_view_keeps_bad_rows(spark):
    t = telemetry(spark, [record(), record(at=T0 + timedelta(minutes=1))]).withColumn(
        "sim_time_iso", F.when(F.minute(F.col("sim_time_iso").cast("timestamp")) == 1, "noon")
        .otherwise(F.col("sim_time_iso"))
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.raw_telemetry(t).collect()
    assert staging.raw_telemetry_lenient(t).where("sim_time is null").count() == 1


def test_epoch_seconds_round_half_to_even(spark):
    base = ["00.5", "01.5", "02.5", "01.7"]
    df = spark.createDataFrame([(f"1970-01-01T00:00:{s}+00:00",) for s in base], "t string")
    got = [r[0] for r in df.select(X.seconds_into_orbit(X.parse_iso(F.col("t")))).collect()]
    assert got == [0, 2, 2, 2]


def test_bands_quadrants_and_regimes_at_their_edges(spark):
    df = spark.createDataFrame(
        [(0.2499, -20.1, 0.0, 0.0, 1.0), (0.25, -20.0, 0.0, -0.1, 1.01), (0.5, 40.0, -1.0, 0.0, -1.01),
         (None, 50.1, None, 5.0, None)],
        "soc double, c double, lat double, lon double, heat double",
    )
    got = df.select(
        X.battery_band(F.col("soc")), X.thermal_band(F.col("c")),
        X.ground_quadrant(F.col("lat"), F.col("lon")), X.thermal_regime(F.col("heat")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("critical", "critical", "NE", "steady"),
        ("degraded", "degraded", "NW", "warming"),
        ("nominal", "nominal", "SE", "cooling"),
        ("nominal", "critical", "SW", "steady"),
    ]


def test_rollup_measures(spark):
    recs = [
        record(at=T0 + timedelta(seconds=s), battery_soc=v, eclipsed=e, net_power_w=p)
        for s, v, e, p in ((0, 0.8, True, -1.0), (20, 0.9, False, 5.0), (40, 0.7, False, 0.0))
    ]
    (r,) = marts.sat_minute_rollup(raw_of(spark, recs)).collect()
    assert r["battery_soc_mean"] == pytest.approx(0.8)
    assert (r["battery_soc_min"], r["battery_soc_max"]) == (0.7, 0.9)
    assert r["charging_fraction"] == pytest.approx(1 / 3)
    assert r["eclipse_fraction"] == pytest.approx(1 / 3)
    x, y, z = (NOMINAL[f"position_eci_km_{a}"] for a in "xyz")
    assert r["position_magnitude_km_mean"] == pytest.approx((x * x + y * y + z * z) ** 0.5)
    assert len(r) == 17


def test_rollup_equals_the_join_of_the_subsystem_views(spark):
    raw = raw_of(spark, fleet())
    joined = marts.rollup_from_subsystems(
        staging.stg_eps(raw), staging.stg_thermal(raw), staging.stg_geometry(raw)
    )
    one_pass = marts.sat_minute_rollup(raw)
    assert one_pass.count() == 40
    assert one_pass.exceptAll(joined).count() == 0 and joined.exceptAll(one_pass).count() == 0


def test_rollup_ignores_rows_without_keys(spark):
    raw = raw_of(spark, fleet())
    for key, kind in (("sat_id", "string"), ("sim_time", "timestamp")):
        odd = raw_of(spark, [record("X")]).withColumn(key, F.lit(None).cast(kind))
        raw = raw.unionByName(odd)
    assert marts.sat_minute_rollup(raw).count() == 40
    assert marts.fleet_health_snapshot(raw).count() == 2


def test_rollup_reads_its_input_once_and_aggregates_before_the_shuffle(spark, tmp_path):
    path = f"{tmp_path}/raw"
    raw_of(spark, fleet()).write.parquet(path)
    rollup = marts.sat_minute_rollup(spark.read.parquet(path))
    rollup.collect()
    plan = plan_of(rollup)
    assert "partial_sum" in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1, final


def test_only_the_columns_of_the_wanted_measures_are_read(spark, tmp_path):
    path = f"{tmp_path}/raw"
    raw_of(spark, fleet()).write.parquet(path)
    plan = plan_of(marts.sat_minute_rollup(spark.read.parquet(path), ["battery_soc_mean", "battery_soc_max"]))
    read = set(re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1).split(","))
    assert {c.split(":")[0] for c in read} == {"sat_id", "sim_time", "battery_soc"}


def _any_double(rng, kind):
    if kind == 0:
        return rng.uniform(-1, 1) * 10 ** rng.uniform(-300, 300)
    if kind == 1:
        return rng.choice([5e18, -5e18, 1e-10, 0.0, -0.0, 1.7e308, 5e-324, -1e-310, 2.0**31, -(2.0**-64), 2.0**-65])
    if kind == 2:
        return rng.uniform(-7000, 7000)
    return rng.choice([1e16, 1.0, -1e16, 0.1, -0.1, 1e-10])


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_means_equal_the_correctly_rounded_sum_over_the_count(spark, parts):
    rng = random.Random(5)
    groups = {f"S{g}": [_any_double(rng, g % 4) for _ in range(rng.choice([1, 2, 9, 40]))] for g in range(48)}
    groups |= {"two large": [5e18, 5e18], "two small": [1e-10, 1e-10], "cancels": [1e300, 1e-300, -1e300]}
    rows = [(sat, x, None if i % 5 == 0 else x) for sat, xs in groups.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "sat_id string, battery_soc double, net_heat_w double").repartition(parts)
    df = df.withColumn("sim_time", F.lit("2031-03-09 05:00:10").cast("timestamp"))
    measures = ["battery_soc_mean", "battery_soc_min", "net_heat_w_mean"]
    halves = [marts.rollup_sums(df.where(c), measures) for c in (F.abs("battery_soc") < 1, F.abs("battery_soc") >= 1)]
    for rollup in (marts.from_sums(marts.rollup_sums(df, measures), measures), marts.from_sums(marts.merged_sums(halves[0].unionByName(halves[1])), measures)):
        got = {r["sat_id"]: r for r in rollup.collect()}
        assert len(got) == len(groups)
        for sat, xs in groups.items():
            some = [x for i, x in enumerate(xs) if i % 5]
            for name, values in (("battery_soc_mean", xs), ("net_heat_w_mean", some)):
                try:
                    wanted = math.fsum(values) / len(values) if values else None
                except OverflowError:
                    continue
                assert got[sat][name] == wanted, (sat, name)
            assert got[sat]["battery_soc_min"] == min(xs)


def test_values_that_are_no_finite_numbers_make_the_mean(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", math.inf), ("B", math.nan), ("B", 1e300), ("C", None)], "sat_id string, battery_soc double")
    df = df.withColumn("sim_time", F.lit("2031-03-09 05:00:10").cast("timestamp"))
    got = {r["sat_id"]: r["battery_soc_mean"] for r in marts.from_sums(marts.rollup_sums(df, ["battery_soc_mean"]), ["battery_soc_mean"]).collect()}
    assert got["A"] == math.inf and math.isnan(got["B"]) and got["C"] is None


def test_snapshot_keeps_ties_and_sorts_no_scan(spark):
    last = T0 + timedelta(hours=1)
    recs = [record("A", T0), record("A", last, battery_soc=0.2), record("A", last, battery_soc=0.4),
            record("B", T0, bus_temperature_c=45.0)]
    snap = marts.fleet_health_snapshot(raw_of(spark, recs))
    got = sorted((r["sat_id"], r["battery_health_band"], r["thermal_health_band"]) for r in snap.collect())
    assert got == [("A", "critical", "nominal"), ("A", "degraded", "nominal"), ("B", "nominal", "degraded")]
    plan = plan_of(snap)
    assert "Window" not in plan and not re.search(r"Sort \[.*\n.*(Scan|Filter|Project)", plan)
    assert quality.duplicate_keys(snap, ["sat_id"]).first()["n_rows"] == 2


# ---- eclipse passes and steps over slice borders -----------------------------------------


def random_flags(seed):
    rng = random.Random(seed)
    recs = []
    for s in range(4):
        t, dark = T0, rng.random() < 0.5
        for _ in range(rng.choice([1, 2, 40, 120])):
            t += timedelta(seconds=rng.choice([10, 60, 600, 4000, 9000]))
            if rng.random() < rng.choice([0.1, 0.9]):
                dark = not dark
            recs.append(
                record(f"S{s}", t, eclipsed=dark, battery_soc=rng.random(),
                       bus_temperature_k=280 + rng.random())
            )
    rng.shuffle(recs)
    return recs


def grouped(recs):
    out = {}
    for r in sorted(recs, key=lambda r: (r["sat_id"], r["sim_time_iso"])):
        out.setdefault(r["sat_id"], []).append(r)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_eclipse_intervals_match_a_walk(spark, seed):
    recs = random_flags(seed)
    want = []
    for sat, rows in grouped(recs).items():
        start, n = None, 0
        for i, r in enumerate(rows):
            if r["eclipsed"]:
                start, n = start or r["sim_time_iso"], n + 1
            ends_here = start and (not r["eclipsed"] or i == len(rows) - 1)
            if ends_here:
                want.append((sat, start, r["sim_time_iso"], n))
                start, n = None, 0
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss+00:00")
    for slice_seconds in (600, 3600, 10**6):
        got = aggregates.eclipse_intervals(raw_of(spark, recs), slice_seconds).select(
            "sat_id", iso("start_time"), iso("end_time"), "n_rows"
        )
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("seed", range(2))
def test_eclipse_delta_means_match_a_walk(spark, seed):
    recs = random_flags(seed)
    got = {r["sat_id"]: r for r in aggregates.eclipse_delta_means(raw_of(spark, recs)).collect()}
    for sat, rows in grouped(recs).items():
        steps = [b["battery_soc"] - a["battery_soc"] for a, b in zip(rows, rows[1:]) if b["eclipsed"]]
        assert got[sat]["n_steps"] == len(steps)
        if steps:
            assert got[sat]["soc_step_mean"] == pytest.approx(sum(steps) / len(steps))
        else:
            assert got[sat]["soc_step_mean"] is None


# ---- quality -----------------------------------------------------------------------------


def test_all_31_model_checks_pass_on_clean_data(spark):
    raw = raw_of(spark, fleet())
    report = quality.model_report(raw, marts.sat_minute_rollup(raw), marts.fleet_health_snapshot(raw))
    rows = report.collect()
    assert len(rows) == 31
    assert all(r["violations"] == 0 for r in rows)


def test_model_checks_see_violations(spark):
    raw = raw_of(spark, fleet()).withColumn(
        "battery_soc", F.when(F.minute("sim_time") != 3, F.col("battery_soc"))
    )
    snap = marts.fleet_health_snapshot(raw)
    doubled = snap.unionByName(snap).withColumn("thermal_health_band", F.lit("warm"))
    report = quality.model_report(raw, marts.sat_minute_rollup(raw), doubled)
    bad = {(r["model"], r["column_name"], r["check_name"]): r["violations"]
           for r in report.where("violations > 0").collect()}
    assert bad == {
        ("raw_telemetry", "battery_soc", "not_null"): 2,
        ("stg_eps", "battery_soc", "not_null"): 2,
        ("sat_minute_rollup", "battery_soc_mean", "not_null"): 2,
        ("fleet_health_snapshot", "thermal_health_band", "accepted_values"): 4,
        ("fleet_health_snapshot", "sat_id", "unique"): 2,
    }


def test_physical_checks(spark):
    recs = [record(), record(at=T0 + timedelta(minutes=1), battery_soc=0.1, altitude_km=900.0,
                             bus_temperature_c=99.0, sun_vector_eci_x=0.5)]
    bad = {r["check_name"] for r in quality.physical_report(raw_of(spark, recs)).where("violations = 1").collect()}
    assert bad == {"soc_range", "altitude_range", "celsius_matches_kelvin", "unit_length"}


def test_behaviour_report(spark):
    (a, _) = quality.behaviour_report(raw_of(spark, fleet())).orderBy("sat_id").collect()
    assert a["discharges_in_eclipse"] is True
    assert a["cools_in_eclipse"] is False
    assert a["latitude_range_ok"] is False
    assert a["eclipse_fraction_ok"] is True


# ---- dashboards and counts ---------------------------------------------------------------


def test_dashboard_reads(spark):
    raw = raw_of(spark, fleet())
    rollup = marts.sat_minute_rollup(raw)
    view = dashboards.fleet_view(marts.fleet_health_snapshot(raw))
    assert view.columns == dashboards.FLEET_COLUMNS
    assert [r["sat_id"] for r in view.collect()] == ["BIRD-1", "BIRD-2"]
    series = dashboards.temperature_series(rollup, "BIRD-2")
    assert series.columns == ["time", "temp_c"]
    times = [r["time"] for r in series.collect()]
    assert len(times) == 20 and times == sorted(times)
    assert [r[0] for r in dashboards.satellite_names(rollup).collect()] == ["BIRD-1", "BIRD-2"]


def test_event_feeds_are_newest_first_and_limited(spark):
    rows = [(f"S{i % 3}", "stuck_sensor", f"2026-05-01 00:{i // 2:02d}:00", "critical", 1.0, "x")
            for i in range(110)]
    ev = spark.createDataFrame(
        rows, "sat_id string, detector_name string, sim_time_iso string, severity string, "
        "score double, description string"
    )
    feed = dashboards.anomaly_feed(ev)
    assert feed.count() == 100
    assert "TakeOrderedAndProject" in plan_of(feed)
    assert feed.first()["sim_time_iso"] == "2026-05-01 00:54:00"
    mine = dashboards.satellite_events(ev, "S1").collect()
    assert len(mine) == 20 and "sat_id" not in mine[0].asDict()


def test_counts_and_their_approximation(spark):
    raw = raw_of(spark, fleet() + fleet(1, 5))
    exact = {r["sat_id"]: (r["n_rows"], r["n_distinct_times"]) for r in aggregates.row_counts(raw).collect()}
    assert exact == {"BIRD-1": (25, 20), "BIRD-2": (20, 20)}
    near = aggregates.row_counts(raw, approximate=True).where("sat_id = 'BIRD-2'").first()
    assert abs(near["n_distinct_times"] - 20) <= 2
