import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from perigee.operators import marts, quality
from perigee.operators.staging import raw_telemetry
from perigee.plans import daily
from perigee.sources import telemetry as store
from perigee.sources import wire
from perigee.streaming import arrivals, ingest
from helpers import T0, record, telemetry

D0 = T0.date()


class Store:
    """A telemetry table fed by a stream, a batch at a time, and the tables by day."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        self.places = (f"{path}/table", f"{path}/checkpoint")

    def add(self, records):
        messages = wire.encoded(telemetry(self.spark, records))
        messages.coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        feed = wire.replay_directory(self.spark, f"{self.path}/in")
        ingest.drain([ingest.start_ingest(feed, self.places[0], f"{self.path}/rejects", self.places[1])])

    def refresh(self):
        return daily.refresh(self.spark, *self.places, f"{self.path}/daily")

    def read(self, name, *bounds):
        return daily.read_daily(self.spark, f"{self.path}/daily", name, *bounds)

    def raw(self):
        return raw_telemetry(store.read_telemetry(self.spark, self.places[0]))

    def check(self):
        """Refreshed tables equal those made of the whole telemetry."""
        raw = self.raw()
        assert rows(self.read("sat_minute_rollup").drop("date")) == rows(marts.sat_minute_rollup(raw))
        report = quality.count_violations(quality.staged(raw), quality.telemetry_checks())
        kept = daily.model_checks(self.spark, f"{self.path}/daily")
        assert rows(kept) == rows(report)
        exact = raw.groupBy("sat_id").agg(F.count("sim_time"), F.count_distinct("sim_time"))
        assert rows(daily.distinct_times(self.spark, f"{self.path}/daily")) == rows(exact)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some(rng, day, n=40):
    start = T0 + timedelta(days=day)
    return [record(f"S{rng.randrange(3)}", start + timedelta(seconds=rng.randrange(600)), battery_soc=rng.random(), net_heat_w=rng.gauss(0, 9)) for _ in range(n)]


@pytest.fixture
def filled(spark, tmp_path):
    rng, kept = random.Random(8), Store(spark, tmp_path)
    kept.add(some(rng, 0) + some(rng, 1))
    assert kept.refresh() == [D0, D0 + timedelta(days=1)]
    kept.check()
    return kept, rng


def files_of(df):
    return {f.split("/data/")[1] for f in df.inputFiles()}


def test_refresh_replaces_touched_days_only(filled):
    kept, rng = filled
    before = files_of(kept.read("sat_minute_rollup"))
    kept.add(some(rng, 1, 5) + some(rng, 4, 5))  # late rows of a known day, and a new day after a gap
    assert kept.refresh() == [D0 + timedelta(days=1), D0 + timedelta(days=4)]
    kept.check()
    untouched = f"version=0/bucket={(D0 - date(1970, 1, 1)).days}/"
    after = files_of(kept.read("sat_minute_rollup"))
    assert {f for f in after if f.startswith("version=0/")} == {f for f in before if f.startswith(untouched)} != set()
    # bounds open one day's files only
    one = kept.read("sat_minute_rollup", D0, D0)
    assert {f.split("/")[1] for f in files_of(one)} == {untouched.split("/")[1]}
    assert {r["date"] for r in one.collect()} == {D0}


def test_nothing_new_makes_no_version(filled):
    kept, _ = filled
    assert kept.refresh() == []
    assert kept.read("violations").where("date is null").count() == 0


def test_withdrawn_batches_leave_all_tables(filled):
    kept, rng = filled
    kept.add(some(rng, 1, 7) + some(rng, 2, 7))
    kept.refresh()
    for _ in range(2):  # may be repeated
        arrivals.withdraw_batch(kept.spark, *kept.places, 1)
    assert kept.refresh() == [D0 + timedelta(days=1), D0 + timedelta(days=2)]
    kept.check()
    assert {r["date"] for r in kept.read("time_sketches").collect()} == {D0, D0 + timedelta(days=1)}  # the emptied day went
    kept.add(some(rng, 3, 3))  # a batch that comes and goes between two refreshes
    arrivals.withdraw_batch(kept.spark, *kept.places, 2)
    assert kept.refresh() == []
    kept.check()
    with pytest.raises(ValueError):
        arrivals.withdraw_batch(kept.spark, *kept.places, 9)
    arrivals.withdraw_batch(kept.spark, *kept.places, 0)  # now the table is empty
    assert len(kept.refresh()) == 2
    assert all(kept.read(name).isEmpty() for name in daily.TABLES)


def test_failed_refresh_is_invisible_and_repeated(filled, monkeypatch):
    kept, rng = filled
    before = rows(kept.read("sat_minute_rollup"))
    kept.add(some(rng, 0, 9))
    broken = daily.Daily("sat_id string, date date, n_rows bigint, times binary", (), lambda raw: raw.select(F.raise_error(F.lit("stop"))))
    with monkeypatch.context() as patch:
        patch.setitem(daily.TABLES, "time_sketches", broken)
        with pytest.raises(Exception):  # noqa: B017 - whatever the engine raises
            kept.refresh()
    assert rows(kept.read("sat_minute_rollup")) == before  # though that table was already written
    assert kept.refresh() == [D0]
    kept.check()


def test_refresh_before_anything_arrived(spark, tmp_path):
    kept = Store(spark, tmp_path)
    assert kept.refresh() == []
    assert kept.read("sat_minute_rollup").isEmpty()
    assert daily.model_checks(spark, f"{tmp_path}/daily").isEmpty()
