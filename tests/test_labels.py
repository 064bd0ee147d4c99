import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import joins
from perigee.functions import scalars as X
from perigee.operators import labels as L
from perigee.operators.staging import raw_telemetry
from perigee.sources.labels import labels_from_rows, load_labels
from helpers import NOMINAL, record, telemetry

START = datetime(2026, 5, 1, tzinfo=UTC)


def bound(spark, rows, start=START):
    return L.bind_labels(
        labels_from_rows(spark, rows), F.lit(start.isoformat()).cast("timestamp")
    )


def fault(kind, sat="BIRD-1", start=START, **params):
    return {"sat_id": sat, "fault_type": kind, "start_iso": start.isoformat(), "params": params}


def observe(spark, records, rows):
    out = L.inject(raw_telemetry(telemetry(spark, records)), bound(spark, rows))
    return {(r["sat_id"], r["sim_time_iso"]): r for r in out.collect()}


def at(**delta):
    return START + timedelta(**delta)


def test_no_labels_change_nothing(spark):
    recs = [record(at=at(minutes=i)) for i in range(3)]
    got = observe(spark, recs, [])
    assert all(got[r["sat_id"], r["sim_time_iso"]]["battery_soc"] == r["battery_soc"] for r in recs)


def test_label_not_started_or_on_another_satellite(spark):
    recs = [record(at=at(hours=3)), record("BIRD-2", at(hours=3))]
    rows = [fault(S.STUCK_SENSOR, start=at(hours=4)), fault(S.CAPACITY_FADE, sat="KITE-4", fade_rate_per_day=2.0)]
    for r in observe(spark, recs, rows).values():
        assert (r["battery_soc"], r["bus_temperature_k"]) == (NOMINAL["battery_soc"], NOMINAL["bus_temperature_k"])


def test_fade_loses_its_rate_of_the_reading_until_the_floor(spark):
    hours = (0, 6, 18, 60)
    recs = [record(at=at(hours=h), battery_soc=0.8 - 0.002 * h, battery_charge_wh=100.0 + h) for h in hours]
    got = observe(spark, recs, [fault(S.CAPACITY_FADE, fade_rate_per_day=0.4, floor=0.75)])
    for rec, left in zip(recs, (1.0, 0.9, 0.75, 0.75), strict=True):
        r = got[rec["sat_id"], rec["sim_time_iso"]]
        assert r["battery_soc"] == pytest.approx(rec["battery_soc"] * left)
        assert r["battery_charge_wh"] == pytest.approx(rec["battery_charge_wh"] * left)
        assert r["bus_temperature_k"] == NOMINAL["bus_temperature_k"]


def test_stuck_sensor_repeats_the_reading_at_its_start(spark):
    recs = [record(at=at(minutes=5 * i), bus_temperature_k=276.0 + 3 * i, net_heat_w=float(i)) for i in range(5)]
    got = observe(spark, recs, [fault(S.STUCK_SENSOR, start=at(minutes=10))])
    seen = [got[r["sat_id"], r["sim_time_iso"]] for r in recs]
    assert [r["bus_temperature_k"] for r in seen] == [276.0, 279.0, 282.0, 282.0, 282.0]
    assert [r["bus_temperature_c"] for r in seen[2:]] == pytest.approx([282.0 - 273.15] * 3)
    assert [r["net_heat_w"] for r in seen] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_runaway_adds_its_rate_until_the_cap(spark):
    recs = [record(at=at(minutes=m), bus_temperature_k=283.5) for m in (0, 20, 90, 600)]
    got = observe(spark, recs, [fault(S.THERMAL_RUNAWAY, rate_k_per_hour=9.0, cap_k=12.0)])
    assert [got[r["sat_id"], r["sim_time_iso"]]["bus_temperature_k"] for r in recs] == pytest.approx([283.5, 286.5, 295.5, 295.5])


def layered_by_hand(records, rows):
    """Apply the labels one tick after another in list order."""
    out, held = {}, {}
    for rec in sorted(records, key=lambda r: r["sim_time_iso"]):
        t = datetime.fromisoformat(rec["sim_time_iso"])
        sat, soc, k = rec["sat_id"], rec["battery_soc"], rec["bus_temperature_k"]
        for f in rows:
            start = datetime.fromisoformat(f["start_iso"])
            if f["sat_id"] != sat or t < start:
                continue
            elapsed = (t - start).total_seconds()
            p = f["params"]
            if f["fault_type"] == S.CAPACITY_FADE:
                soc *= max(p.get("floor", 0.5), 1 - p.get("fade_rate_per_day", 0.02) * elapsed / 86400)
            elif f["fault_type"] == S.THERMAL_RUNAWAY:
                k += min(p.get("cap_k", 50.0), p.get("rate_k_per_hour", 2.0) * elapsed / 3600)
            else:
                k = held.setdefault(sat, k)
        out[sat, rec["sim_time_iso"]] = (soc, k)
    return out


@pytest.mark.parametrize("small", [True, False])
def test_random_layers_match_tick_by_tick(spark, monkeypatch, small):
    """Also with label tables too large to broadcast, where rows are salted."""
    if not small:
        monkeypatch.setattr(L, "is_small", lambda df: False)
    rng = random.Random(11)
    sats = [f"S{i}" for i in range(10)]
    records, rows = [], []
    for sat in sats:
        for m in range(40):
            records.append(
                record(sat, at(minutes=5 * m), battery_soc=rng.random(),
                       bus_temperature_k=280 + 20 * rng.random())
            )
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            rows.append(
                fault(
                    rng.choice(S.FAULT_TYPES), sat, at(minutes=rng.randrange(0, 220)),
                    **rng.choice([{}, {"rate_k_per_hour": 9.0, "cap_k": 6.0},
                                  {"fade_rate_per_day": 3.0, "floor": 0.7}]),
                )
            )
    rng.shuffle(rows)
    got = observe(spark, records, rows)
    assert len(got) == len(records)
    for key, (soc, k) in layered_by_hand(records, rows).items():
        assert got[key]["battery_soc"] == pytest.approx(soc, abs=1e-12)
        assert got[key]["bus_temperature_k"] == pytest.approx(k, abs=1e-9)


def test_active_labels_in_list_order(spark):
    rows = [fault(S.STUCK_SENSOR, start=at(hours=1)), fault(S.CAPACITY_FADE)]
    raw = raw_telemetry(telemetry(spark, [record(at=at(minutes=30)), record(at=at(hours=2))]))
    got = L.active_labels(raw, bound(spark, rows)).orderBy("sim_time").collect()
    assert [r["active"] for r in got] == [[1], [0, 1]]


# ---- loading, validation, offsets --------------------------------------------------------


def test_exactly_one_start_is_required(spark):
    both = {"sat_id": "S", "fault_type": S.THERMAL_RUNAWAY,
            "start_iso": START.isoformat(), "start_offset": "+00:30:00"}
    neither = {"sat_id": "S", "fault_type": S.THERMAL_RUNAWAY}
    for bad in (both, neither):
        with pytest.raises(Exception, match="and not both"):
            labels_from_rows(spark, [bad]).collect()


@pytest.mark.parametrize(
    "row,text",
    [
        ({"sat_id": "S", "fault_type": "attitude", "start_offset": "+00:30:00"}, "unknown fault_type"),
        ({"sat_id": "S", "fault_type": S.STUCK_SENSOR, "start_offset": "00:30:00"}, "bad start_offset"),
        ({"sat_id": "S", "fault_type": S.STUCK_SENSOR, "start_iso": "soon"}, "bad start_iso"),
    ],
)
def test_bad_labels_fail_the_job(spark, row, text):
    with pytest.raises(Exception, match=text):
        labels_from_rows(spark, [row]).collect()


def test_absent_label_file_means_no_labels(spark, tmp_path):
    assert load_labels(spark, str(tmp_path / "none.json")).count() == 0


def test_label_file_with_the_three_types(spark, tmp_path):
    path = tmp_path / "faults.json"
    path.write_text(
        "\n".join(
            '{"ordinal": %d, "sat_id": "S%d", "fault_type": "%s", "start_offset": "+00:10:00", '
            '"params": {"floor": 0.6}}' % (i, i, t)
            for i, t in enumerate(S.FAULT_TYPES)
        )
    )
    got = load_labels(spark, str(path)).orderBy("ordinal").collect()
    assert [r["fault_type"] for r in got] == list(S.FAULT_TYPES)
    assert got[0]["params"] == {"floor": 0.6}


def test_offset_grammar(spark):
    texts = ["+00:30:00", "+01:00:00", "+002-12:00:00", "01:00:00", "+1:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.offset_seconds(F.col("t"))).collect()]
    assert got == [1800, 3600, 216000, None, None]


def test_binding_resolves_offsets_and_keeps_absolute_starts(spark):
    rows = [
        {"sat_id": "SAT-1", "fault_type": S.THERMAL_RUNAWAY, "start_offset": "+01:30:00"},
        {"sat_id": "SAT-2", "fault_type": S.CAPACITY_FADE, "start_iso": START.isoformat()},
    ]
    start = spark.createDataFrame([("2026-05-26T20:00:00+00:00",)], "s string").select(
        F.col("s").cast("timestamp")
    )
    got = L.bind_labels(labels_from_rows(spark, rows), start).orderBy("ordinal")
    texts = [r[0] for r in got.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss")).collect()]
    assert texts == ["2026-05-26 21:30:00", "2026-05-01 00:00:00"]


def test_size_check_stops_past_the_bound(spark):
    assert joins.is_small(spark.range(10), 10)
    assert not joins.is_small(spark.range(11), 10)
