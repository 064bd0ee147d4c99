from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.operators import aggregates, marts, quality
from perigee.operators.staging import raw_telemetry
from perigee.plans import pipeline
from perigee.sources import telemetry as store
from helpers import T0, plan_of, record, telemetry


def files(root):
    return sorted(p.relative_to(root).parent.as_posix() for p in root.rglob("*.parquet"))


def test_partition_layout(spark, tmp_path):
    root = tmp_path / "t"
    at = datetime(2031, 3, 9, 9, 15, tzinfo=UTC)
    store.write_telemetry(telemetry(spark, [record("BIRD-7", at)]), str(root))
    assert files(root) == ["sat_id=BIRD-7/date=2031-03-09/hour=09"]


def test_one_directory_per_satellite_and_hour(spark, tmp_path):
    root = tmp_path / "t"
    recs = [record(f"BIRD-{i % 3 + 1}", T0 + timedelta(minutes=i)) for i in range(30)]
    recs += [record(f"BIRD-{i + 1}", T0 + timedelta(hours=1)) for i in range(3)]
    store.write_telemetry(telemetry(spark, recs), str(root))
    assert len(files(root)) == 6
    back = store.read_telemetry(spark, str(root))
    assert back.count() == 33
    counts = aggregates.files_per_partition(back).collect()
    assert {r["n_files"] for r in counts} == {1}
    assert sum(r["n_rows"] for r in counts) == 33


def test_write_counters_come_from_the_stored_files(spark, tmp_path):
    root = tmp_path / "t"
    recs = [record(f"S{i % 2}", T0 + timedelta(minutes=i)) for i in range(30)]
    store.write_telemetry(telemetry(spark, recs), str(root))
    totals = store.write_totals(store.written_files(spark, str(root))).first()
    on_disk = sum(p.stat().st_size for p in root.rglob("*.parquet"))
    assert tuple(totals) == (30, 2, on_disk)


def test_files_that_repeat_the_key_columns_are_read(spark, tmp_path):
    """Tables of other writers may hold sat_id in the file as well as in the path."""
    part = tmp_path / "t" / "sat_id=007" / "date=2031-03-09" / "hour=09"
    part.mkdir(parents=True)
    at = datetime(2031, 3, 9, 9, 15, tzinfo=UTC)
    pq.write_table(pa.Table.from_pylist([record("007", at)]), part / "part-0000.parquet")
    (row,) = store.read_telemetry(spark, str(tmp_path / "t")).collect()
    assert (row["sat_id"], row["hour"], str(row["date"])) == ("007", 9, "2031-03-09")
    assert row["battery_soc"] == 0.62


def test_late_rows_are_appended_to_their_hour(spark, tmp_path):
    root = str(tmp_path / "t")
    store.write_telemetry(telemetry(spark, [record(at=T0), record(at=T0 + timedelta(hours=1))]), root)
    store.write_telemetry(telemetry(spark, [record(at=T0 + timedelta(minutes=5))]), root)
    assert store.read_telemetry(spark, root).where("hour = 5").count() == 2


def test_file_size_bound(spark, tmp_path):
    root = tmp_path / "t"
    recs = [record(at=T0 + timedelta(seconds=i)) for i in range(7)]
    store.write_telemetry(telemetry(spark, recs), str(root), max_rows_per_file=3)
    assert len(files(root)) == 3
    assert store.read_telemetry(spark, str(root)).count() == 7


def test_small_files_are_spread_over_more_tasks_than_cores(spark, tmp_path):
    random = [(F.rand(i) if c not in ("eclipsed", "sat_id", "sim_time_iso") else F.lit(False)).alias(c) for i, c in enumerate(S.TELEMETRY_COLUMNS)]
    named = {"sat_id": F.expr("concat('S', id % 60)"), "sim_time_iso": F.lit(T0.isoformat())}
    table = spark.range(60_000).select("*", *[c for n, c in zip(S.TELEMETRY_COLUMNS, random, strict=True) if n not in named]).withColumns(named)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set(key, "32m")
    try:
        store.write_telemetry(table.select(*S.TELEMETRY_COLUMNS), str(tmp_path / "t"), max_rows_per_file=50)
        assert spark.conf.get(key) == "32m"
        tasks = {p.name[:10] for p in (tmp_path / "t").rglob("*.parquet")}
        stored = store.written_files(spark, str(tmp_path / "t")).agg(F.sum("n_rows"), F.max("n_rows")).first()
        assert tuple(stored) == (60_000, 50) and len(tasks) >= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset(key)


def test_round_trip_keeps_rows_ids_and_schema(spark, tmp_path):
    root = str(tmp_path / "t")
    recs = [record("007", T0 + timedelta(minutes=i)) for i in range(50)]
    before = telemetry(spark, recs)
    store.write_telemetry(before, root)
    after = store.read_telemetry(spark, root)
    assert S.schema_problems(after) == []
    assert {r["sat_id"] for r in after.select("sat_id").distinct().collect()} == {"007"}
    assert quality.round_trip_report(raw_telemetry(before), raw_telemetry(after)).count() == 0
    fewer = after.where("minute(cast(sim_time_iso as timestamp)) > 3")
    assert quality.round_trip_report(raw_telemetry(before), raw_telemetry(fewer)).count() == 1


def test_schema_drift_is_refused(spark, tmp_path):
    drifted = telemetry(spark, [record()]).drop("net_heat_w").withColumn(
        "battery_soc", F.lit("high")
    )
    problems = S.schema_problems(drifted)
    assert len(problems) == 2
    with pytest.raises(TypeError, match="missing column net_heat_w"):
        store.write_telemetry(drifted, str(tmp_path / "t"))


def test_reads_are_pruned_by_directory_and_column(spark, tmp_path):
    root = str(tmp_path / "t")
    recs = [record(f"S{s}", T0 + timedelta(hours=h)) for s in range(2) for h in range(30)]
    store.write_telemetry(telemetry(spark, recs), root)
    read = store.between_times(
        store.for_satellite(store.read_telemetry(spark, root), "S1"),
        datetime(2031, 3, 10, 1, tzinfo=UTC),
        datetime(2031, 3, 10, 3, tzinfo=UTC),
    ).select("sat_id", "battery_soc", "sim_time_iso")
    assert read.count() == 2
    plan = plan_of(read)
    filters = plan[plan.index("PartitionFilters") :]
    assert "sat_id" in filters and "date" in filters
    assert "hour#" in read._jdf.queryExecution().optimizedPlan().toString()
    assert "ReadSchema: struct<sim_time_iso:string,battery_soc:double>" in plan


def test_fleet_selection(spark):
    sats = ["BIRD-2", "BIRD-1", "KITE-1", "bird-3"]
    t = telemetry(spark, [record(s, T0 + timedelta(minutes=i)) for s in sats for i in range(2)])
    got = store.select_fleet(t, "bird", 2)
    assert {r["sat_id"] for r in got.collect()} == {"BIRD-1", "BIRD-2"}
    assert got.count() == 4
    assert store.select_fleet(t, "Bird").select("sat_id").distinct().count() == 3
    with pytest.raises(ValueError, match="no satellites match"):
        store.select_fleet(t, "nothing")


def test_object_store_settings():
    conf = store.object_store_conf("http://store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert "spark.hadoop.fs.s3a.secret.key" not in store.object_store_conf("http://store:9000")


def test_mart_refresh_full_and_by_day(spark, tmp_path):
    root, out = str(tmp_path / "t"), str(tmp_path / "m")
    recs = [record(f"S{s}", T0 + timedelta(minutes=40 * i)) for s in range(2) for i in range(40)]
    store.write_telemetry(telemetry(spark, recs), root)
    pipeline.refresh_marts(spark, root, out)
    full = store.read_mart(spark, f"{out}/sat_minute_rollup")
    assert full.count() == 80
    assert store.read_mart(spark, f"{out}/fleet_health_snapshot").count() == 2

    days = f"{out}/by_day"
    pipeline.refresh_rollup_days(spark, root, days, "2031-03-09", "2031-03-10")
    late = [record("S0", T0 + timedelta(minutes=1), battery_soc=0.1)]
    store.write_telemetry(telemetry(spark, late), root)
    pipeline.refresh_rollup_days(spark, root, days, "2031-03-09", "2031-03-09")
    by_day = store.read_mart(spark, days).select(*full.columns)
    assert by_day.count() == 81
    assert by_day.where("battery_soc_mean = 0.1D").count() == 1
    assert by_day.exceptAll(full).count() == 1 and full.exceptAll(by_day).count() == 0


def test_full_mart_file_order_allows_skipping(spark, tmp_path):
    raw = raw_telemetry(telemetry(spark, [record(f"S{i % 5}", T0 + timedelta(minutes=i)) for i in range(50)]))
    store.write_mart(marts.sat_minute_rollup(raw), str(tmp_path / "m"))
    read = store.for_satellite(store.read_mart(spark, str(tmp_path / "m")), "S3")
    assert read.count() == 10
    assert "EqualTo(sat_id,S3)" in plan_of(read)
