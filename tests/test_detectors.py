import random
from datetime import datetime
from dataclasses import replace

import pytest

from perigee.operators import detectors as D
from perigee.operators.detectors import CapacityFade, DetectorSettings, StuckSensor, ThermalRunaway
from helpers import mart, plan_of


def events(df):
    return [r.asDict() for r in df.orderBy("sat_id", "detector_name").collect()]


# ---- one history per satellite, all detectors at once -------------------------------------

QUICK = DetectorSettings(
    capacity_fade=CapacityFade(threshold=0.2, slack=0.002, window=4),
    stuck_sensor=StuckSensor(thermal_mass=600.0, residual_k=0.5, consecutive=3, min_expected_k=0.05),
    thermal_runaway=ThermalRunaway(ceiling_c=31.0, slope_window=3, min_slope=0.25),
)


def history(sat, count, **series):
    """Samples of one satellite; a series is a function of the minute."""
    return [{"sat": sat, "minute": i, **{name: f(i) for name, f in series.items()}} for i in range(count)]


def test_each_detector_reports_its_own_satellite_once(spark):
    samples = (
        history("calm", 40, soc=lambda i: 0.7 + 0.01 * (i % 3), temp_k=lambda i: 281.0)
        # ceilings 0.8 to minute 9, then 0.7: 0.098 a minute, past 0.2 with the third low window
        + history("fading", 40, soc=lambda i: 0.8 if i < 10 else 0.7)
        # 12 W on 600 J/K is 1.2 K a minute, but nothing moves from minute 6 on
        + history("held", 40, temp_k=lambda i: 270.0 + 1.2 * min(i, 5), heat=lambda i: 12.0)
        # 0.5 K a minute from 29 C: above 31 C at minute 5
        + history("hot", 40, temp_k=lambda i: 302.15 + 0.5 * i, heat=lambda i: 5.0)
    )
    found = {(e["sat_id"], e["detector_name"]): e for e in events(D.detect(mart(spark, samples), QUICK))}
    assert set(found) == {("fading", "capacity_fade"), ("held", "stuck_sensor"), ("hot", "thermal_runaway")}
    fade, stuck, hot = (found[k] for k in sorted(found))
    assert (fade["sim_time_iso"], fade["severity"]) == ("2033-02-07 00:15:00", "warning")
    assert fade["score"] == pytest.approx(3 * 0.098 - 3 * 0.0 - 0.0) and "drifted by 0.294 from baseline 0.800" in fade["description"]
    assert (stuck["sim_time_iso"], stuck["severity"]) == ("2033-02-07 00:08:00", "critical")
    assert stuck["score"] == pytest.approx(1.2) and "1.20 K sustained for 3 minutes" in stuck["description"]
    assert hot["sim_time_iso"] == "2033-02-07 00:05:00" and hot["score"] == pytest.approx(0.5)


def test_rules_that_must_not_fire(spark):
    samples = (
        history("tiny heat", 30, heat=lambda i: 0.4)  # expects 0.04 K a minute, under the floor
        + history("interrupted", 30, temp_k=lambda i: 280.0 + 1.2 * (i % 3 == 0), heat=lambda i: 12.0 * (i % 3 != 0))
        + history("hot but level", 30, temp_k=lambda i: 306.0 + 0.2 * (i % 2))
        + history("too short", 3, soc=lambda i: 0.9 - 0.3 * i)
    )
    assert events(D.detect(mart(spark, samples), QUICK)) == []


def test_input_is_usable_plus_unusable(spark):
    odd = [("soc", None), ("temp_k", None), ("heat", float("nan")), ("soc", float("nan"))]
    samples = history("a", 10) + [{"sat": "b", "minute": i, name: value} for i, (name, value) in enumerate(odd)]
    m = mart(spark, samples)
    bad = D.unusable_rows(m).orderBy("minute_bucket").collect()
    assert D.detector_input(m).count() + len(bad) == len(samples)
    assert [(r["null_columns"], r["nan_columns"]) for r in bad] == [
        (["battery_soc_mean"], []), (["bus_temperature_k_mean"], []), ([], ["net_heat_w_mean"]), ([], ["battery_soc_mean"])
    ]


# ---- against a direct evaluation of the rules --------------------------------------------

SETTINGS = DetectorSettings(
    capacity_fade=CapacityFade(threshold=0.3, slack=0.01, window=20),
    stuck_sensor=StuckSensor(thermal_mass=100.0, residual_k=1.0, consecutive=4),
    thermal_runaway=ThermalRunaway(ceiling_c=20.0, min_slope=0.2),
)


def expected_events(samples, s):
    """First firing minute and score per (satellite, detector), straight from the rules."""
    out = {}
    sats = sorted({x["sat"] for x in samples})
    for sat in sats:
        rows = sorted((x for x in samples if x["sat"] == sat), key=lambda x: x["minute"])
        soc = [r["soc"] for r in rows]
        temp = [r["temp_k"] for r in rows]
        n = s.capacity_fade.window
        ceilings = {i: max(soc[i - n + 1 : i + 1]) for i in range(n - 1, len(rows))}
        level = 0.0
        for i in range(n, len(rows)):
            level = max(0.0, level + ceilings[n - 1] - ceilings[i] - s.capacity_fade.slack)
            if level >= s.capacity_fade.threshold:
                out[sat, "capacity_fade"] = (rows[i]["minute"], level)
                break
        need = s.stuck_sensor.consecutive

        def off(i):
            want = rows[i]["heat"] * 60.0 / s.stuck_sensor.thermal_mass
            gap = abs(want - (temp[i] - temp[i - 1]))
            return gap > s.stuck_sensor.residual_k and abs(want) > 0.01, gap

        for i in range(need, len(rows)):
            if all(off(j)[0] for j in range(i - need + 1, i + 1)):
                out[sat, "stuck_sensor"] = (rows[i]["minute"], off(i)[1])
                break
        w = s.thermal_runaway.slope_window
        for i in range(w - 1, len(rows)):
            c = temp[i] - 273.15
            rise = (temp[i] - temp[i - w + 1]) / (w - 1)
            if c > s.thermal_runaway.ceiling_c and rise >= s.thermal_runaway.min_slope:
                out[sat, "thermal_runaway"] = (
                    rows[i]["minute"], c - s.thermal_runaway.ceiling_c
                )
                break
    return out


def random_samples(seed, sats=12):
    rng = random.Random(seed)
    samples = []
    for k in range(sats):
        minute, soc, temp = 0, 0.9, 285.0
        for _ in range(rng.choice([1, 3, 5, 19, 20, 21, 22, 60, 150])):
            minute += rng.choice([1, 1, 1, 2, 700, 3000])
            soc = min(1.0, max(0.2, soc + rng.uniform(-0.03, 0.02)))
            temp += rng.uniform(-0.8, 0.9)
            samples.append(
                {
                    "sat": f"S{k:02d}", "minute": minute, "soc": soc, "temp_k": temp,
                    "heat": rng.choice([0.0, 1.0, 4.0, 4.0, 4.0, -4.0]),
                }
            )
    rng.shuffle(samples)
    return samples


MART_START = datetime(2033, 2, 7)  # of helpers.mart


def as_result(df):
    out = {}
    for r in df.collect():
        minute = (datetime.fromisoformat(r["sim_time_iso"]) - MART_START).total_seconds() / 60
        out[r["sat_id"], r["detector_name"]] = (minute, r["score"])
    return out


@pytest.mark.parametrize("seed,block_rows", [(0, 7), (1, 7), (2, 50), (3, 8192)])
def test_all_detectors_match_the_rules(spark, seed, block_rows):
    samples = [s for s in random_samples(seed) if s["minute"] < 40_000]
    settings = DetectorSettings(
        SETTINGS.capacity_fade, SETTINGS.stuck_sensor, SETTINGS.thermal_runaway, block_rows
    )
    got = as_result(D.detect(mart(spark, samples), settings))
    want = expected_events(samples, settings)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for k in want:
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-9)
    assert want  # the data do make detectors fire


def test_one_pass_equals_single_detectors(spark):
    m = mart(spark, random_samples(5))
    together = as_result(D.detect(m, SETTINGS))
    apart = {}
    for name in ("capacity_fade", "stuck_sensor", "thermal_runaway"):
        apart |= as_result(D.detect(m, SETTINGS, [name]))
    assert together == apart


def test_block_size_changes_nothing(spark):
    """Also blocks shorter than the window, so that the baseline comes from a later block."""
    m = mart(spark, random_samples(4))
    usual = as_result(D.detect(m, SETTINGS))
    small = as_result(D.detect(m, replace(SETTINGS, block_rows=7)))
    assert {k: v[0] for k, v in small.items()} == {k: v[0] for k, v in usual.items()} and usual
    assert [small[k][1] for k in usual] == pytest.approx([v[1] for v in usual.values()], abs=1e-9)


def test_null_rows_are_left_out_and_reported(spark):
    samples = [{"minute": i, "heat": 5.0, "temp_k": 290.0} for i in range(12)]
    samples[4]["soc"] = None
    m = mart(spark, samples)
    assert [r["null_columns"] for r in D.unusable_rows(m).collect()] == [["battery_soc_mean"]]
    assert D.detector_input(m).count() == 11


def test_unknown_detector_name_is_an_error(spark):
    with pytest.raises(KeyError):
        D.detect(mart(spark, [{"minute": 0}]), detectors=["attitude"])


def test_extra_detector_and_stats(spark):
    m = mart(spark, [{"minute": i, "temp_k": 303.15 + 0.5 * i} for i in range(50)])
    ev = D.run_detectors(m, {"again": lambda df: D.thermal_runaway(df, ceiling_c=40.0)})
    assert ev.count() == 2
    row = D.run_stats(m, ev).first()
    assert (row["rows_consumed"], row["sats_processed"], row["events_emitted"]) == (50, 1, 2)


def test_block_summary_reuses_the_shuffled_rows(spark, tmp_path):
    """On data too large to broadcast, mart rows are shuffled by block once, not twice."""
    mart(spark, random_samples(2)).write.parquet(str(tmp_path / "m"))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        events = D.detect(spark.read.parquet(str(tmp_path / "m")), SETTINGS)
        events.collect()
        plan = plan_of(events)
    finally:
        for k in keys:
            spark.conf.unset(k)
    final = plan[: plan.index("Initial Plan")]
    assert any("ReusedExchange" in x and "baseline" in x and "block" in x for x in final.split("\n"))
