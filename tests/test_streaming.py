import json
import random
from collections import Counter
from dataclasses import replace
from datetime import UTC, timedelta

import pytest
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.operators import detectors as D
from perigee.operators import marts
from perigee.operators.staging import raw_telemetry
from perigee.sources import telemetry as store
from perigee.sources import wire
from perigee.streaming import arrivals
from perigee.streaming import detectors as stream_detectors
from perigee.streaming import ingest
from perigee.streaming import marts as stream_marts
from perigee.streaming.keyed import KeyedTable
from helpers import T0, record, telemetry
from test_detectors import SETTINGS, random_samples


class Feed:
    """A directory a stream reads, to which tables are added one batch at a time."""

    def __init__(self, path):
        self.path = str(path)

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.path)


def message_rows(spark, bodies):
    return spark.createDataFrame([(b"k", b) for b in bodies], "key binary, value binary")


def run_ingest(spark, tmp_path, feed, **options):
    query = ingest.start_ingest(
        wire.replay_directory(spark, feed.path),
        str(tmp_path / "table"), str(tmp_path / "rejects"), str(tmp_path / "checkpoint"), **options,
    )
    ingest.drain([query])
    return ingest.ingest_counters(spark, str(tmp_path / "checkpoint")).first().asDict()


def body(**over):
    return json.dumps({**record(), **over}).encode()


def test_ingest_splits_good_and_bad_and_resumes(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    hour = lambda h, m=0: (T0 + timedelta(hours=h, minutes=m)).isoformat()
    feed.add(message_rows(spark, [body(), b"not valid json {", b'{"sat_id": "BIRD-1"}',
                                  body(sim_time_iso=hour(1))]))
    counters = run_ingest(spark, tmp_path, feed)
    assert counters == {"messages_seen": 4, "messages_received": 2, "decode_errors": 2}
    # Restart from the checkpoint: one new message, late for its hour.
    feed.add(message_rows(spark, [body(sim_time_iso=hour(0, 5))]))
    run_ingest(spark, tmp_path, feed)
    counters = run_ingest(spark, tmp_path, feed)  # nothing new: nothing repeated
    assert counters == {"messages_seen": 5, "messages_received": 3, "decode_errors": 2}
    table = store.read_telemetry(spark, str(tmp_path / "table"))
    assert sorted(r["sim_time_iso"] for r in table.collect()) == [hour(0), hour(0, 5), hour(1)]
    assert table.where("hour = 5").count() == 2
    reasons = ingest.read_dead_letters(spark, str(tmp_path / "rejects")).orderBy("reject_reason")
    assert [r["reject_reason"] for r in reasons.collect()] == ["bad_json", "missing"]
    parts = {p.parent.relative_to(tmp_path / "table").as_posix()
             for p in (tmp_path / "table").rglob("*.parquet")}
    assert "batch=0/sat_id=BIRD-1/date=2031-03-09/hour=05" in parts


def test_closed_hours_and_late_rows(spark):
    hour_at = lambda h: T0.replace(minute=0) + timedelta(hours=h)
    # satellite A: hours 0 and 1 at first, then hour 3, then late rows of 0 and a first late hour 2; B never moves on
    seen = [("A", 0, 0, 5), ("A", 1, 0, 2), ("A", 3, 1, 4), ("A", 0, 2, 3), ("A", 2, 2, 1), ("A", 3, 2, 1), ("B", 5, 1, 9), ("B", 5, 3, 1)]
    rows = spark.createDataFrame([(s, hour_at(h), b, n) for s, h, b, n in seen], "sat_id string, hour_start timestamp, batch bigint, n_rows bigint")
    got = {(r["sat_id"], r["hour_start"].astimezone(UTC)): (r["n_rows"], r["closed_by"], r["reopened"]) for r in arrivals.hours(rows).collect()}
    assert got == {("A", hour_at(0)): (8, 0, 1), ("A", hour_at(1)): (2, 1, 0), ("A", hour_at(2)): (1, 2, 0), ("A", hour_at(3)): (5, None, 0), ("B", hour_at(5)): (10, None, 0)}
    late = {(r["sat_id"], r["batch"]): r["n_late"] for r in arrivals.late_rows(rows).collect()}
    assert late == {("A", 2): 4}
    empty = rows.limit(0)
    assert arrivals.hours(empty).collect() == arrivals.late_rows(empty).collect() == []


def test_ingest_bounds_file_size(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(message_rows(spark, [body(sim_time_iso=(T0 + timedelta(seconds=i)).isoformat())
                                  for i in range(7)]))
    run_ingest(spark, tmp_path, feed, max_rows_per_file=3)
    assert len(list((tmp_path / "table").rglob("*.parquet"))) == 3


def raw_stream(spark, path):
    return raw_telemetry(spark.readStream.schema(S.TELEMETRY_SCHEMA).parquet(path))


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    batch = raw_telemetry(telemetry(spark, [record(at=T0 + timedelta(seconds=i)) for i in range(90)]))
    path = str(tmp_path / "sums")
    for _ in range(2):
        stream_marts.add_sums(batch, 0, path)
    assert sorted(map(tuple, stream_marts.read_rollup(spark, path).collect())) == sorted(map(tuple, marts.sat_minute_rollup(batch).collect()))


@pytest.mark.parametrize("shuffled", [False, True])
def test_streaming_rollup_equals_batch_whatever_the_order(spark, tmp_path, shuffled):
    """Complete after a drain, equal to the last bit, and corrected by rows that come late."""
    rng = random.Random(3)
    recs = [
        record(f"S{s}", T0 + timedelta(seconds=7 * i + s), battery_soc=rng.random(), net_heat_w=rng.choice([1.1, float("nan")]) if i == 9 else rng.gauss(0, 9),
               eclipsed=rng.random() < 0.4)
        for s in range(3) for i in range(200)
    ]
    feed = Feed(tmp_path / "in")
    recs.sort(key=lambda r: r["sim_time_iso"])
    if shuffled:
        rng.shuffle(recs)
    path, checkpoint = str(tmp_path / "rollup"), str(tmp_path / "ck")
    for part in (recs[:250], recs[250:]):
        feed.add(telemetry(spark, part))
        ingest.drain([stream_marts.start_rollup(raw_stream(spark, feed.path), path, checkpoint)])
    batch = marts.sat_minute_rollup(raw_telemetry(telemetry(spark, recs)))
    streamed = stream_marts.read_rollup(spark, path).select(*batch.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect())) and batch.count() > 60


def test_rollup_does_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(5)
    recs = [record("S", T0 + timedelta(seconds=i), bus_temperature_k=280 + rng.random() * 9, net_heat_w=rng.gauss(0, 300)) for i in range(600)]
    raw = raw_telemetry(telemetry(spark, recs))
    one, *others = [sorted(map(str, marts.sat_minute_rollup(raw.repartition(n, F.rand(n))).collect())) for n in (1, 3, 7)]
    assert all(o == one for o in others)


def test_streaming_snapshot_follows_new_data(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    root, checkpoint = str(tmp_path / "snap"), str(tmp_path / "ck")
    first = [record("A", T0), record("B", T0, battery_soc=0.3)]
    second = [record("A", T0 + timedelta(hours=1), battery_soc=0.2), record("A", T0 + timedelta(hours=1), battery_soc=0.22),
              record("B", T0 - timedelta(hours=1), battery_soc=0.9), record("B", T0, battery_soc=0.31)]
    for part in (first, second):
        feed.add(telemetry(spark, part))
        ingest.drain([stream_marts.start_snapshot(raw_stream(spark, feed.path), root, checkpoint)])
    streamed = stream_marts.read_snapshot(spark, root)
    batch = marts.fleet_health_snapshot(raw_telemetry(telemetry(spark, first + second)))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert {r["battery_health_band"] for r in streamed.collect()} == {"critical", "degraded"}


@pytest.mark.parametrize(("batches", "window"), [(1, 20), (4, 20), (2, 1)])
def test_streaming_detectors_equal_batch_detectors(spark, tmp_path, batches, window):
    """Whatever the batches, with a window of one sample, and with one satellite that has most rows."""
    samples = random_samples(7)
    hot = samples[0]["sat"]
    samples = [s for s in samples if s["sat"] == hot or s["minute"] % 3 == 0]
    recs = [
        record(s["sat"], T0 + timedelta(minutes=s["minute"]), battery_soc=s["soc"], bus_temperature_k=s["temp_k"], net_heat_w=s["heat"])
        for s in sorted(samples, key=lambda s: s["minute"])
    ]
    settings = replace(SETTINGS, capacity_fade=replace(SETTINGS.capacity_fade, window=window), block_rows=64)
    feed = Feed(tmp_path / "in")
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    size = -(-len(recs) // batches)
    for i in range(0, len(recs), size):
        feed.add(telemetry(spark, recs[i : i + size]))
        ingest.drain([stream_detectors.start_detectors(raw_stream(spark, feed.path), root, checkpoint, settings)])
    streamed = stream_detectors.read_stream_events(spark, root).collect()
    batch = D.detect(marts.sat_minute_rollup(raw_telemetry(telemetry(spark, recs))), settings).collect()
    assert same_events(streamed, batch) and len(batch) > 3


def same_events(some, others):
    """Equal but for the last digits of scores, as sums are added up in other steps."""
    key = lambda r: (r["sat_id"], r["detector_name"])
    pairs = list(zip(sorted(some, key=key), sorted(others, key=key), strict=True))
    return all(a["score"] == pytest.approx(b["score"], abs=1e-9) and [a[c] for c in EXACT] == [b[c] for c in EXACT] for a, b in pairs)


EXACT = ["sat_id", "detector_name", "sim_time_iso", "severity", "description"]


def detector_feed(spark, tmp_path, parts, settings):
    """Events after each part."""
    feed = Feed(tmp_path / "in")
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    for part in parts:
        feed.add(telemetry(spark, part))
        ingest.drain([stream_detectors.start_detectors(raw_stream(spark, feed.path), root, checkpoint, settings)])
        yield stream_detectors.read_stream_events(spark, root).collect()


def observed(seed):
    return [
        record(s["sat"], T0 + timedelta(minutes=s["minute"]), battery_soc=s["soc"], bus_temperature_k=s["temp_k"], net_heat_w=s["heat"])
        for s in sorted(random_samples(seed), key=lambda s: s["minute"])
    ]


def test_late_rows_and_split_minutes_change_events_like_in_batch(spark, tmp_path):
    settings = replace(SETTINGS, block_rows=64)
    recs = observed(11)
    rng = random.Random(2)
    late = set(rng.sample(range(len(recs)), 40))
    # every record has a twin half a minute later, which comes in a later part
    twins = [r | {"sim_time_iso": r["sim_time_iso"].replace(":00+00:00", ":30+00:00"), "bus_temperature_k": r["bus_temperature_k"] + 0.4} for r in recs]
    third = len(recs) // 3
    parts = [[r for i, r in enumerate(recs[:third]) if i not in late], [*twins[:third], *recs[third : 2 * third]], [*[recs[i] for i in sorted(late) if i < third], *recs[2 * third :]]]
    *_, events = detector_feed(spark, tmp_path, parts, settings)
    batch = D.detect(marts.sat_minute_rollup(raw_telemetry(telemetry(spark, sum(parts, [])))), settings).collect()
    assert same_events(events, batch) and len(batch) > 3


def test_a_batch_reads_the_state_of_its_own_satellites_only(spark, tmp_path, monkeypatch):
    settings = replace(SETTINGS, block_rows=64)
    recs = observed(7)
    half = len(recs) // 2
    counts = Counter(r["sat_id"] for r in recs[half:])
    busy = max(counts, key=counts.get)
    history_read, states = [], []
    read_sums, update = stream_detectors.read_sums, stream_detectors.updated_state
    monkeypatch.setattr(stream_detectors, "read_sums", lambda s, p, batch_id=None, upto=None: history_read.append(batch_id) or read_sums(s, p, batch_id, upto))
    monkeypatch.setattr(stream_detectors, "updated_state", lambda new, *rest: states.append((rest[1].count(), new.count())) or update(new, *rest))
    later = [r for r in recs[half:] if r["sat_id"] == busy]
    parts = [recs[:half], later[:5], later[5:10]]
    assert len(later) >= 10
    for _ in detector_feed(spark, tmp_path, parts, settings):
        pass
    assert None not in history_read  # no batch read what others had written
    assert states[1][0] == states[2][0] == 1 and states[1][1] <= 6 and states[2][1] <= 6


def test_keyed_table_replaces_only_what_is_touched(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", "k string, v int", buckets=4)
    make = lambda rows: spark.createDataFrame(rows, "k string, v int")
    assert table.read().collect() == [] and table.versions() == []
    table.replace(make([(f"k{i}", i) for i in range(20)]), make([(f"k{i}", 0) for i in range(20)]), 0)
    before = table.manifest()
    written = table.replace(make([("k3", 33), ("k3", 34)]), make([("k3", 0)]), 1)
    assert len(written) == 1 and {b for b, v in table.manifest().items() if v == 1} == set(written)
    assert sorted(r["v"] for r in table.read().collect()) == sorted([*(i for i in range(20) if i != 3), 33, 34])
    assert table.manifest(before=1) == before and {r["v"] for r in table.read(before=1).collect()} == set(range(20))
    table.replace(make([("k3", 35)]), make([("k3", 0)]), 1)  # the same batch once more
    assert sorted(r["v"] for r in table.read(make([("k3", 0)])).collect()) == [35]
    for v in range(2, 8):  # k5 goes, then comes back
        table.replace(make([("k5", v)] if v % 2 else []), make([("k5", 0)]), v)
    assert table.versions() == [6, 7] and sorted(r["v"] for r in table.read(make([("k5", 0)])).collect()) == [7]
    assert len(list((tmp_path / "t" / "data").glob("version=*/bucket=*"))) <= 8
    assert table.read().count() == 20
