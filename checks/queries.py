"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame.

Telemetry is derived from the events table (see perigee.plans.adapter). Accumulated doubles
are rounded to six digits, since summation order differs between engines, and timestamps
leave as naive UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee import schema as S
from perigee.functions import scalars as X
from perigee.functions import sequence as Q
from perigee.operators import aggregates, detectors, evaluation, labels, marts, quality, staging
from perigee.plans import adapter, daily, dashboards, pipeline
from perigee.session import configure, materialize, scratch_dir
from perigee.sources import telemetry as store
from perigee.sources import wire
from perigee.sources.labels import labels_from_rows, load_labels
from perigee.streaming import arrivals
from perigee.streaming import detectors as stream_detectors
from perigee.streaming import ingest as stream_ingest
from perigee.streaming import marts as stream_marts

SERIES_SAT = "SAT-03"
EVENTS_SAT = "SAT-13"

# Labels with one that no detector can catch, and labels that overlap on one satellite.
WITH_MISS = [
    *adapter.FAULTS,
    {
        "sat_id": "SAT-05",
        "fault_type": S.THERMAL_RUNAWAY,
        "start_offset": "+00:10:00",
        "params": {"rate_k_per_hour": 0.1},
    },
]
LAYERED = [
    {
        "sat_id": "SAT-05",
        "fault_type": S.THERMAL_RUNAWAY,
        "start_offset": "+00:20:00",
        "params": {"rate_k_per_hour": 3.0, "cap_k": 4.0},
    },
    {"sat_id": "SAT-05", "fault_type": S.STUCK_SENSOR, "start_offset": "+01:00:00"},
    {
        "sat_id": "SAT-05",
        "fault_type": S.THERMAL_RUNAWAY,
        "start_offset": "+00:40:00",
    },
    {"sat_id": "SAT-05", "fault_type": S.CAPACITY_FADE, "start_offset": "+00:30:00"},
    {
        "sat_id": "SAT-05",
        "fault_type": S.CAPACITY_FADE,
        "start_offset": "+02:00:00",
        "params": {"fade_rate_per_day": 6.0, "floor": 0.7},
    },
]

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name, with the session settings applied.

    Tables that a query stores and reads several times are its own: each run starts anew.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _stored.clear()
        return fn(configure(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---- shared inputs ----------------------------------------------------------------------


def _events(spark, sf_dir):
    return adapter.read_events_table(spark, sf_dir)


def _telemetry(spark, sf_dir):
    return adapter.telemetry_from_events(_events(spark, sf_dir))


def _raw(spark, sf_dir):
    return staging.raw_telemetry(_telemetry(spark, sf_dir))


def _rollup(spark, sf_dir, measures=marts.ROLLUP_MEASURES):
    return marts.sat_minute_rollup(_raw(spark, sf_dir), measures)


_stored: dict[tuple, DataFrame] = {}


def _once(spark, sf_dir, name, build):
    """A stored mart of the running query: built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def _bound(spark, sf_dir, name="faults", rows=None):
    rows = adapter.FAULTS if rows is None else rows
    build = lambda: pipeline.bind_to_data(_raw(spark, sf_dir), labels_from_rows(spark, rows))
    return _once(spark, sf_dir, f"bound_{name}", build)


def _observed(spark, sf_dir):
    return labels.inject(_raw(spark, sf_dir), _bound(spark, sf_dir))


def _observed_rollup(spark, sf_dir):
    build = lambda: materialize(marts.sat_minute_rollup(_observed(spark, sf_dir)), "rollup")
    return _once(spark, sf_dir, "observed_rollup", build)


def _observed_events(spark, sf_dir):
    build = lambda: materialize(detectors.detect(_observed_rollup(spark, sf_dir)), "events")
    return _once(spark, sf_dir, "observed_events", build)


def rounded(c, digits: int = 6):
    """Half up, in double arithmetic that every engine does alike."""
    scale = float(10**digits)
    scaled = c * F.lit(scale)
    return F.when(F.isnan(c) | (F.abs(c) >= 1e9), c).otherwise(F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(scale))


def edge(df: DataFrame) -> DataFrame:
    """Publish: doubles rounded to six digits, timestamps naive."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = rounded(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = X.as_naive(c)
        out.append(c.alias(f.name))
    return df.select(*out)


# ---- views and marts --------------------------------------------------------------------


@query
def raw_telemetry(spark, sf_dir):
    return edge(_raw(spark, sf_dir))


@query
def raw_telemetry_lenient(spark, sf_dir):
    """Lenient casts over partly unreadable times and numbers: rows kept, bad values null."""
    us = F.unix_micros(X.parse_iso(F.col("sim_time_iso")))
    damaged = _telemetry(spark, sf_dir).withColumns(
        {
            "battery_soc": F.when(us % 5 == 0, F.lit("n/a")).otherwise(
                F.col("battery_soc").cast("string")
            ),
            "sim_time_iso": F.when(us % 7 == 0, F.lit("not a time")).otherwise(
                F.col("sim_time_iso")
            ),
        }
    )
    raw = staging.raw_telemetry_lenient(damaged)
    return raw.groupBy("sat_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("sim_time").isNull()).alias("bad_times"),
        F.count_if(F.col("battery_soc").isNull()).alias("bad_soc"),
    )


@query
def stg_geometry(spark, sf_dir):
    return edge(staging.stg_geometry(_raw(spark, sf_dir)))


@query
def stg_eps(spark, sf_dir):
    return edge(staging.stg_eps(_raw(spark, sf_dir)))


@query
def stg_thermal(spark, sf_dir):
    return edge(staging.stg_thermal(_raw(spark, sf_dir)))


@query
def unit_conversions(spark, sf_dir):
    return edge(
        _raw(spark, sf_dir).select(
            "sat_id",
            "sim_time",
            X.kelvin_to_celsius(F.col("bus_temperature_k")).alias("temp_c"),
            X.soc_to_watt_hours(F.col("battery_soc")).alias("charge_wh"),
            (X.seconds_into_orbit(F.col("sim_time")) / 60.0).alias("minutes_into_orbit"),
        )
    )


@query
def flatten_ticks(spark, sf_dir):
    """Nest telemetry into tick structs, then flatten it back."""
    raw = _raw(spark, sf_dir)
    vectors = ["position_eci_km", "velocity_eci_km_s", "sun_vector_eci"]
    geo = [F.array(*[f"{v}_{a}" for a in "xyz"]).alias(v) for v in vectors]
    geo += [F.col(c) for c in ("eclipsed", "latitude_deg", "longitude_deg", "altitude_km")]
    ticks = raw.select(
        "sat_id",
        "sim_time",
        F.struct(*geo).alias("geo"),
        F.struct(*S.TELEMETRY_COLUMNS[15:20]).alias("eps"),
        F.struct(*S.TELEMETRY_COLUMNS[20:]).alias("thermal"),
    )
    return edge(wire.flatten_ticks(ticks))


@query
def sat_minute_rollup(spark, sf_dir):
    return edge(_rollup(spark, sf_dir))


@query
def rollup_subsystem_join(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return edge(
        marts.rollup_from_subsystems(
            staging.stg_eps(raw), staging.stg_thermal(raw), staging.stg_geometry(raw)
        )
    )


@query
def rollup_refreshed_by_day(spark, sf_dir):
    """Incremental refresh: every day's directory written twice, the second replaces the first."""
    path = scratch_dir(spark, "rollup_days")
    rollup = _rollup(spark, sf_dir)
    store.write_rollup_days(rollup.where(F.hour("minute_bucket") < 12), path)
    store.write_rollup_days(rollup, path)
    return edge(store.read_mart(spark, path).select(*rollup.columns))


@query
def fleet_health_snapshot(spark, sf_dir):
    return edge(marts.fleet_health_snapshot(_raw(spark, sf_dir)))


# ---- dashboards -------------------------------------------------------------------------


@query
def fleet_view(spark, sf_dir):
    return edge(dashboards.fleet_view(marts.fleet_health_snapshot(_raw(spark, sf_dir))))


@query
def sat_series_soc(spark, sf_dir):
    return edge(dashboards.soc_series(_rollup(spark, sf_dir, ["battery_soc_mean"]), SERIES_SAT))


@query
def sat_series_temp_c(spark, sf_dir):
    return edge(dashboards.temperature_series(_rollup(spark, sf_dir, ["bus_temperature_k_mean"]), SERIES_SAT))


@query
def sat_series_net_power(spark, sf_dir):
    return edge(dashboards.net_power_series(_rollup(spark, sf_dir, ["net_power_w_mean"]), SERIES_SAT))


@query
def sat_series_eclipse(spark, sf_dir):
    return edge(dashboards.eclipse_series(_rollup(spark, sf_dir, ["eclipse_fraction"]), SERIES_SAT))


@query
def sat_series_annotated(spark, sf_dir):
    return edge(
        dashboards.annotated_series(
            _observed_rollup(spark, sf_dir), _observed_events(spark, sf_dir), EVENTS_SAT
        )
    )


@query
def sat_series_recent(spark, sf_dir):
    """Charge series restricted to the panel's time range: the newest two hours."""
    rollup = materialize(_rollup(spark, sf_dir, ["battery_soc_mean"]), "rollup")
    series = dashboards.soc_series(rollup, SERIES_SAT)
    return edge(store.within_last(series, "time", F.expr("interval 2 hours")))


@query
def sat_picker(spark, sf_dir):
    return dashboards.satellite_names(_rollup(spark, sf_dir, []))


@query
def anomaly_feed_top100(spark, sf_dir):
    return edge(dashboards.anomaly_feed(_observed_events(spark, sf_dir)))


@query
def sat_events_top20(spark, sf_dir):
    return edge(dashboards.satellite_events(_observed_events(spark, sf_dir), EVENTS_SAT))


# ---- ordered analytics ------------------------------------------------------------------


@query
def rolling_max_soc(spark, sf_dir):
    out = Q.rolling_max(_rollup(spark, sf_dir, ["battery_soc_mean"]), "battery_soc_mean", 90, "rolling_max")
    return edge(out.select("sat_id", "minute_bucket", "seq", "rolling_max"))


@query
def cusum_score(spark, sf_dir):
    out = detectors.detector_signals(_observed_rollup(spark, sf_dir), detectors=["capacity_fade"])
    return edge(out.select("sat_id", "minute_bucket", "baseline", "cusum"))


@query
def heat_residual(spark, sf_dir):
    out = detectors.detector_signals(_observed_rollup(spark, sf_dir), detectors=["stuck_sensor"])
    return edge(out.select("sat_id", "minute_bucket", "residual_k"))


@query
def residual_run_length(spark, sf_dir):
    out = detectors.detector_signals(_observed_rollup(spark, sf_dir), detectors=["stuck_sensor"])
    return out.select("sat_id", X.as_naive(F.col("minute_bucket")).alias("minute_bucket"), "run_length")


@query
def eclipse_run_length(spark, sf_dir):
    """Consecutive fully eclipsed minutes up to each minute."""
    rollup = _rollup(spark, sf_dir, ["eclipse_fraction"]).select(
        "sat_id", "minute_bucket", (F.col("eclipse_fraction") == 1.0).alias("dark")
    )
    out = Q.run_length(rollup, "dark", "dark_minutes")
    return edge(out.select("sat_id", "minute_bucket", "dark_minutes"))


@query
def temp_step(spark, sf_dir):
    out = Q.step_change(_rollup(spark, sf_dir, ["bus_temperature_k_mean"]), "bus_temperature_k_mean", "step_k")
    return edge(out.select("sat_id", "minute_bucket", "step_k"))


@query
def temp_slope(spark, sf_dir):
    out = Q.endpoint_slope(_rollup(spark, sf_dir, ["bus_temperature_k_mean"]), "bus_temperature_k_mean", 5, "slope")
    return edge(out.select("sat_id", "minute_bucket", "slope"))


@query
def time_order_check(spark, sf_dir):
    """Samples not later than the one that arrived before them, with delayed clocks."""
    arrivals = _events(spark, sf_dir).select(
        "event_id",
        F.format_string("SAT-%02d", F.col("user_id") % adapter.FLEET_SIZE).alias("sat_id"),
        F.timestamp_micros(
            F.unix_micros(F.col("ts").cast("timestamp"))
            - F.get_json_object("props", "$.k").cast("bigint") * 60_000_000
        ).alias("t"),
    )
    out = Q.time_order_violations(arrivals, "sat_id", "t", "event_id", 4096)
    return edge(out.select("sat_id", "event_id", "t", "previous_time"))


@query
def eclipse_intervals(spark, sf_dir):
    return edge(aggregates.eclipse_intervals(_raw(spark, sf_dir)))


@query
def eclipse_delta_means(spark, sf_dir):
    return edge(aggregates.eclipse_delta_means(_raw(spark, sf_dir)))


# ---- aggregates -------------------------------------------------------------------------


@query
def latest_time(spark, sf_dir):
    return edge(aggregates.latest_time(_raw(spark, sf_dir)))


@query
def sim_start(spark, sf_dir):
    return edge(aggregates.sim_start(_rollup(spark, sf_dir, [])))


@query
def orbit_mean_power(spark, sf_dir):
    return edge(aggregates.orbit_mean_power(_raw(spark, sf_dir)))


@query
def channel_ranges(spark, sf_dir):
    return edge(aggregates.channel_ranges(_raw(spark, sf_dir)))


@query
def eclipse_fraction(spark, sf_dir):
    return edge(aggregates.eclipse_fraction(_raw(spark, sf_dir)))


@query
def fleet_count_distinct(spark, sf_dir):
    return aggregates.row_counts(_raw(spark, sf_dir))


@query
def fleet_select(spark, sf_dir):
    chosen = store.select_fleet(_telemetry(spark, sf_dir), "sat-1", 3)
    return chosen.groupBy("sat_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def partition_counts(spark, sf_dir):
    return aggregates.partition_counts(_raw(spark, sf_dir))


# ---- labels and injection ---------------------------------------------------------------


def _labels_from_events(spark, sf_dir):
    """One label per event, a part of them malformed, to exercise the label rules at size."""
    eid = F.col("event_id")
    days = F.lpad((eid % 400).cast("string"), 3, "0")
    clock = F.date_format(F.col("ts").cast("timestamp"), "HH:mm:ss")
    offset = F.when(eid % 3 == 0, F.concat(F.lit("+"), clock)).otherwise(
        F.concat(F.lit("+"), days, F.lit("-"), clock)
    )
    iso = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    kind = (
        F.when(eid % 4 == 0, S.CAPACITY_FADE)
        .when(eid % 4 == 1, S.STUCK_SENSOR)
        .when(eid % 4 == 2, S.THERMAL_RUNAWAY)
        .otherwise(F.when(eid % 8 == 3, S.THERMAL_RUNAWAY).otherwise("attitude_excursion"))
    )
    return _events(spark, sf_dir).select(
        eid.cast("int").alias("ordinal"),
        F.concat(F.lit("SAT-"), F.lpad((F.col("user_id") % 15).cast("string"), 2, "0")).alias("sat_id"),
        kind.alias("fault_type"),
        F.when(eid % 10 < 4, iso).alias("start_iso"),
        F.when(
            (eid % 10 > 2) & (eid % 10 < 9),
            F.when(eid % 11 == 0, F.regexp_replace(offset, r"^\+", "")).otherwise(offset),
        ).alias("start_offset"),
        F.lit(None).cast("map<string,double>").alias("params"),
    )


@query
def fault_offset_parse(spark, sf_dir):
    out = _labels_from_events(spark, sf_dir).where(F.col("start_offset").isNotNull())
    return out.select(
        "ordinal", "start_offset", X.offset_seconds(F.col("start_offset")).alias("offset_s")
    )


@query
def fault_label_problems(spark, sf_dir):
    return labels.label_problems(_labels_from_events(spark, sf_dir)).select("ordinal", "problem")


@query
def fault_bind(spark, sf_dir):
    checked = labels.label_problems(_labels_from_events(spark, sf_dir))
    valid = checked.where(F.col("problem").isNull()).drop("problem")
    start = _raw(spark, sf_dir).agg(F.min(F.date_trunc("minute", F.col("sim_time"))))
    return edge(labels.bind_labels(valid, start).select("ordinal", "sat_id", "start"))


@query
def fault_windows(spark, sf_dir):
    """Earliest start and label count per (satellite, detector) over many labels."""
    checked = labels.label_problems(_labels_from_events(spark, sf_dir))
    valid = checked.where(F.col("problem").isNull()).drop("problem")
    start = _raw(spark, sf_dir).agg(F.min(F.date_trunc("minute", F.col("sim_time"))))
    return edge(evaluation.fault_windows(labels.bind_labels(valid, start)))


def _injected(spark, sf_dir, name, rows, columns):
    bound = _bound(spark, sf_dir, name, rows)
    observed = labels.inject(_raw(spark, sf_dir), bound)
    return edge(observed.select("sat_id", "sim_time", *columns))


@query
def inject_capacity_fade(spark, sf_dir):
    columns = ["battery_soc", "battery_charge_wh", "net_power_w"]
    return _injected(spark, sf_dir, "fade", adapter.FAULTS[:1], columns)


@query
def inject_stuck_sensor(spark, sf_dir):
    columns = ["bus_temperature_k", "bus_temperature_c", "net_heat_w"]
    return _injected(spark, sf_dir, "stuck", adapter.FAULTS[1:2], columns)


@query
def inject_thermal_runaway(spark, sf_dir):
    columns = ["bus_temperature_k", "bus_temperature_c", "net_heat_w"]
    return _injected(spark, sf_dir, "runaway", adapter.FAULTS[2:], columns)


@query
def inject_layered(spark, sf_dir):
    columns = ["battery_soc", "battery_charge_wh", "bus_temperature_k", "bus_temperature_c"]
    return _injected(spark, sf_dir, "layered", LAYERED, columns)


@query
def active_labels(spark, sf_dir):
    active = labels.active_labels(_raw(spark, sf_dir), _bound(spark, sf_dir, "layered", LAYERED))
    listed = F.array_join(F.transform("active", lambda x: x.cast("string")), ",")
    return edge(active.select("sat_id", "sim_time", listed.alias("active")))


# ---- detection and evaluation -----------------------------------------------------------


@query
def detect_capacity_fade(spark, sf_dir):
    return edge(detectors.capacity_fade(_observed_rollup(spark, sf_dir)))


@query
def detect_stuck_sensor(spark, sf_dir):
    return edge(detectors.stuck_sensor(_observed_rollup(spark, sf_dir)))


@query
def detect_thermal_runaway(spark, sf_dir):
    return edge(detectors.thermal_runaway(_observed_rollup(spark, sf_dir)))


@query
def detect_all(spark, sf_dir):
    """All detectors in one pass, written to and read back from the event table."""
    path = scratch_dir(spark, "events")
    store.write_events(detectors.run_detectors(_observed_rollup(spark, sf_dir)), path)
    return edge(store.read_events(spark, path))


@query
def unusable_mart_rows(spark, sf_dir):
    """Mart rows set aside because a channel is null or not a number, after blanking channels by hour."""
    hour = F.hour("minute_bucket")
    holed = _rollup(spark, sf_dir).withColumns(
        {
            "battery_soc_mean": F.when(hour != 9, F.col("battery_soc_mean")),
            "net_heat_w_mean": F.when(hour != 12, F.col("net_heat_w_mean")),
            "bus_temperature_k_mean": F.when(hour == 12, F.lit(float("nan"))).otherwise(F.col("bus_temperature_k_mean")),
        }
    )
    out = detectors.unusable_rows(holed)
    named = [F.array_join(c, ",").alias(c) for c in ("null_columns", "nan_columns")]
    return edge(out.select("sat_id", "minute_bucket", *named))


@query
def run_stats(spark, sf_dir):
    return detectors.run_stats(_observed_rollup(spark, sf_dir), _observed_events(spark, sf_dir))


@query
def classify_events(spark, sf_dir):
    out = evaluation.classify_events(_observed_events(spark, sf_dir), _bound(spark, sf_dir))
    return edge(out.select("sat_id", "detector_name", "event_time", "outcome", "latency_seconds"))


@query
def detector_scorecard(spark, sf_dir):
    """Clean telemetry to scorecard: inject, roll up, detect, score."""
    fault_labels = labels_from_rows(spark, adapter.FAULTS)
    return edge(pipeline.backtest(_raw(spark, sf_dir), fault_labels).scores)


@query
def detector_scorecard_with_miss(spark, sf_dir):
    bound = _bound(spark, sf_dir, "miss", WITH_MISS)
    return edge(evaluation.scorecard(_observed_events(spark, sf_dir), bound))


@query
def scorecard_summary(spark, sf_dir):
    scores = evaluation.scorecard(_observed_events(spark, sf_dir), _bound(spark, sf_dir))
    return evaluation.summary(scores)


@query
def missed_faults(spark, sf_dir):
    bound = _bound(spark, sf_dir, "miss", WITH_MISS)
    return edge(evaluation.missed_faults(_observed_events(spark, sf_dir), bound))


# ---- quality ----------------------------------------------------------------------------


@query
def dq_model_checks(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    rollup = materialize(marts.sat_minute_rollup(raw), "rollup")
    snapshot = materialize(marts.fleet_health_snapshot(raw), "snapshot")
    return quality.model_report(raw, rollup, snapshot)


@query
def dq_physical_ranges(spark, sf_dir):
    return quality.physical_report(_raw(spark, sf_dir))


@query
def dq_behaviour(spark, sf_dir):
    return quality.behaviour_report(_raw(spark, sf_dir))


@query
def dq_duplicate_samples(spark, sf_dir):
    """Repeated (satellite, time) keys once times are cut to whole seconds."""
    raw = _raw(spark, sf_dir).withColumn("sim_time", F.date_trunc("second", F.col("sim_time")))
    return edge(quality.duplicate_keys(raw, ["sat_id", "sim_time"]))


# ---- wire and storage -------------------------------------------------------------------


def _damaged_messages(telemetry: DataFrame) -> DataFrame:
    """Encoded telemetry in which every tenth of the clock is broken in another way."""
    us = F.unix_micros(X.parse_iso(F.col("sim_time_iso")))
    base = telemetry.withColumn("_k", us % 10)
    text = F.to_json(F.struct(*S.TELEMETRY_COLUMNS))
    without = F.to_json(F.struct(*S.TELEMETRY_COLUMNS[:-1]))
    plus = F.to_json(F.struct(*S.TELEMETRY_COLUMNS, F.lit(1).alias("attitude_deg")))
    retyped = F.to_json(
        F.struct(*S.TELEMETRY_COLUMNS[:-1], F.lit("warm").alias("net_heat_w"))
    )
    bad_time = F.to_json(
        F.struct("sat_id", F.lit("yesterday").alias("sim_time_iso"), *S.TELEMETRY_COLUMNS[2:])
    )
    value = (
        F.when(F.col("_k") == 0, F.expr("substring(_t, 1, length(_t) - 5)"))
        .when(F.col("_k") == 1, without)
        .when(F.col("_k") == 2, plus)
        .when(F.col("_k") == 3, retyped)
        .when(F.col("_k") == 4, bad_time)
        .when(F.col("_k") == 5, F.concat(F.lit("["), F.col("_t"), F.lit("]")))
        .otherwise(F.col("_t"))
    )
    return base.withColumn("_t", text).select(
        F.col("sat_id").cast("binary").alias("key"), value.cast("binary").alias("value")
    )


@query
def json_roundtrip(spark, sf_dir):
    return edge(wire.decoded(wire.encoded(_telemetry(spark, sf_dir))))


@query
def json_message_keys(spark, sf_dir):
    messages = wire.encoded(_telemetry(spark, sf_dir))
    return messages.groupBy(F.col("key").cast("string").alias("message_key")).agg(
        F.count(F.lit(1)).alias("n_messages")
    )


@query
def json_dead_letter(spark, sf_dir):
    out = wire.rejected(_damaged_messages(_telemetry(spark, sf_dir)))
    return out.groupBy(F.col("key").cast("string").alias("sat_id"), "reject_reason").agg(
        F.count(F.lit(1)).alias("n_messages")
    )


@query
def json_decoded_good(spark, sf_dir):
    return edge(wire.decoded(_damaged_messages(_telemetry(spark, sf_dir))))


@query
def partitioned_roundtrip(spark, sf_dir):
    """Write the sat_id/date/hour table and read it back."""
    root = scratch_dir(spark, "telemetry")
    store.write_telemetry(_telemetry(spark, sf_dir), root)
    return edge(store.read_telemetry(spark, root).withColumn("hour", F.col("hour").cast("bigint")))


@query
def partition_pruned_read(spark, sf_dir):
    """One satellite and a time range of the stored table, pruned by directory."""
    root = scratch_dir(spark, "telemetry")
    store.write_telemetry(_telemetry(spark, sf_dir), root)
    rows = store.between_times(
        store.for_satellite(store.read_telemetry(spark, root), SERIES_SAT),
        F.lit("1970-06-14T10:00:00+00:00"),
        F.lit("1970-06-14T12:30:00+00:00"),
    )
    return edge(rows.select("sat_id", "sim_time_iso", "battery_soc"))


@query
def ingest_totals(spark, sf_dir):
    """Rows of the stored table counted file by file, per satellite."""
    root = scratch_dir(spark, "telemetry")
    store.write_telemetry(_telemetry(spark, sf_dir), root)
    files = store.written_files(spark, root)
    return files.groupBy("sat_id").agg(F.sum("n_rows").alias("rows_flushed"))


@query
def files_per_partition(spark, sf_dir):
    """Rows of each directory of the stored table, and whether it has any file (their number is the writer's choice)."""
    root = scratch_dir(spark, "telemetry")
    store.write_telemetry(_telemetry(spark, sf_dir), root)
    out = aggregates.files_per_partition(store.read_telemetry(spark, root))
    return out.select("sat_id", "date", F.col("hour").cast("bigint").alias("hour"), "n_rows", (F.col("n_files") > 0).alias("has_files"))


@query
def bounded_files(spark, sf_dir):
    """Rows of each satellite in files that may hold fifty rows, and whether all of them keep to that."""
    root = scratch_dir(spark, "telemetry")
    store.write_telemetry(_telemetry(spark, sf_dir), root, max_rows_per_file=50)
    files = store.written_files(spark, root)
    return files.groupBy("sat_id").agg(F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("n_rows") <= 50).alias("bounded"))


@query
def round_trip_report(spark, sf_dir):
    """Satellites that differ after a table lost a tenth of one satellite's rows."""
    telemetry = _telemetry(spark, sf_dir)
    lost = (F.col("sat_id") == SERIES_SAT) & (F.unix_micros(X.parse_iso(F.col("sim_time_iso"))) % 10 == 0)
    root = scratch_dir(spark, "telemetry")
    store.write_telemetry(telemetry.where(~lost), root)
    return quality.round_trip_report(telemetry, store.read_telemetry(spark, root))


@query
def fleet_approx_distinct(spark, sf_dir):
    """Approximate distinct times per satellite, as rows and whether within a tenth of the exact number."""
    raw = _raw(spark, sf_dir)
    near = aggregates.row_counts(raw, approximate=True)
    exact = aggregates.row_counts(raw).select("sat_id", F.col("n_distinct_times").alias("exact"))
    close = F.abs(F.col("n_distinct_times") - F.col("exact")) <= 0.1 * F.col("exact")
    return near.join(exact, "sat_id").select("sat_id", "n_rows", close.alias("close"))


@query
def label_file_windows(spark, sf_dir):
    """Labels written as JSON lines, loaded, bound to the data, and summed up as windows."""
    path = scratch_dir(spark, "label-file")
    labels_from_rows(spark, adapter.FAULTS).write.json(path)
    bound = pipeline.bind_to_data(_raw(spark, sf_dir), load_labels(spark, path))
    return edge(evaluation.fault_windows(bound))


@query
def unknown_detector_events(spark, sf_dir):
    """Events of a detector that no fault type maps to."""
    events = _observed_events(spark, sf_dir)
    renamed = F.when(F.col("sat_id") == EVENTS_SAT, F.lit("attitude")).otherwise(F.col("detector_name"))
    out = evaluation.unknown_detectors(events.withColumn("detector_name", renamed))
    return edge(out.select("sat_id", "detector_name", "sim_time_iso", "severity"))


@query
def marts_refreshed_in_full(spark, sf_dir):
    """Rollup of a full mart refresh from the stored table."""
    base = scratch_dir(spark, "refresh")
    store.write_telemetry(_telemetry(spark, sf_dir), f"{base}/telemetry")
    pipeline.refresh_marts(spark, f"{base}/telemetry", f"{base}/marts")
    return edge(store.read_mart(spark, f"{base}/marts/sat_minute_rollup"))


# ---- streaming --------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    """The events table as a stream; a pattern, since a stream source takes no bare file."""
    table_schema = _events(spark, sf_dir).schema
    return spark.readStream.schema(table_schema).parquet(f"{sf_dir}/event[s].parquet")


def _raw_stream(spark, sf_dir):
    return staging.raw_telemetry(adapter.telemetry_from_events(_event_stream(spark, sf_dir)))


def _ingested(spark, sf_dir):
    base = scratch_dir(spark, "ingest")
    messages = _damaged_messages(adapter.telemetry_from_events(_event_stream(spark, sf_dir)))
    started = stream_ingest.start_ingest(
        messages, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint"
    )
    stream_ingest.drain([started])
    return base


@query
def stream_ingest_table(spark, sf_dir):
    """Message stream to the partitioned table, read back."""
    base = _ingested(spark, sf_dir)
    return edge(store.read_telemetry(spark, f"{base}/table").select(*S.TELEMETRY_COLUMNS))


@query
def stream_dead_letter(spark, sf_dir):
    rejects = stream_ingest.read_dead_letters(spark, f"{_ingested(spark, sf_dir)}/rejects")
    return rejects.groupBy(F.col("key").cast("string").alias("sat_id"), "reject_reason").agg(
        F.count(F.lit(1)).alias("n_messages")
    )


@query
def replayed_messages(spark, sf_dir):
    """Messages stored as tables, replayed as a stream, decoded and stored."""
    base = scratch_dir(spark, "replay")
    wire.encoded(_telemetry(spark, sf_dir)).write.parquet(f"{base}/messages")
    messages = wire.replay_directory(spark, f"{base}/messages")
    stream_ingest.drain([stream_ingest.start_ingest(messages, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint")])
    return edge(store.read_telemetry(spark, f"{base}/table").select(*S.TELEMETRY_COLUMNS))


@query
def stream_ingest_counters(spark, sf_dir):
    """Lifetime counters of the ingest query."""
    return stream_ingest.ingest_counters(spark, f"{_ingested(spark, sf_dir)}/checkpoint")


@query
def stream_rollup(spark, sf_dir):
    """Streaming rollup after a drain: every minute, complete."""
    base = scratch_dir(spark, "rollup_stream")
    started = stream_marts.start_rollup(_raw_stream(spark, sf_dir), f"{base}/sums", f"{base}/checkpoint")
    stream_ingest.drain([started])
    return edge(stream_marts.read_rollup(spark, f"{base}/sums"))


def _telemetry_for_parts(spark, sf_dir):
    """The telemetry of a stream that arrives in parts, made once and stored, with its time in microseconds (``us``).

    A compressed file of events has few row groups, and one task reads a whole group. Events are dealt
    out before anything is made of them, so that every file written from here on is one of many alike.
    """
    events = _events(spark, sf_dir)
    made = adapter.telemetry_from_events(events.repartition(*events.columns))
    build = lambda: materialize(made.withColumn("us", F.unix_micros(X.parse_iso(F.col("sim_time_iso")))), "telemetry")
    return _once(spark, sf_dir, "telemetry_for_parts", build)


def _in_batches(spark, telemetry, parts, start):
    """Telemetry of each part of the rows arrives after the one before: the stream runs once for each, on one checkpoint."""
    base = scratch_dir(spark, "batches")
    for part in parts:
        telemetry.where(part).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(S.TELEMETRY_SCHEMA).parquet(f"{base}/in")
        stream_ingest.drain([start(staging.raw_telemetry(source), base)])
    return base


def _halves():
    """Two parts, each with about half of the rows of every minute."""
    early = F.pmod(F.xxhash64("sim_time_iso"), F.lit(2)) == 0
    return [early, ~early]


def _ingested_in_parts(spark, sf_dir, after_part=lambda base: None):
    """Ingest in three parts by time, where every seventh microsecond arrives in the last part, late or not."""
    telemetry = _telemetry_for_parts(spark, sf_dir)
    us = F.col("us")
    first, last = telemetry.agg(F.min(us), F.max(us)).first()
    part = F.when((us % 7 == 0) | (us >= first + (last - first) // 3 * 2), 2).when(us >= first + (last - first) // 3, 1).otherwise(0)

    def start(base):
        messages = wire.replay_directory(spark, f"{base}/in")
        return stream_ingest.start_ingest(messages, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint")

    base = scratch_dir(spark, "arrivals")
    for i in range(3):
        wire.encoded(telemetry.where(part == i)).write.mode("append").parquet(f"{base}/in")
        stream_ingest.drain([start(base)])
        after_part(base)
    return base


def _arrivals(spark, sf_dir):
    return arrivals.read_arrivals(spark, f"{_ingested_in_parts(spark, sf_dir)}/checkpoint/arrivals")


def _refreshed(spark, sf_dir):
    """The tables by day, refreshed after each part of the stream."""
    refresh = lambda base: daily.refresh(spark, f"{base}/table", f"{base}/checkpoint", f"{base}/daily")
    return _ingested_in_parts(spark, sf_dir, refresh)


@query
def rollup_refreshed_from_changes(spark, sf_dir):
    """Rollup by day, of which each refresh replaces the days that the log of arrivals names."""
    rollup = daily.read_daily(spark, f"{_refreshed(spark, sf_dir)}/daily", "sat_minute_rollup")
    return edge(rollup.drop("date"))


@query
def rollup_after_withdrawal(spark, sf_dir):
    """The same when the second batch was withdrawn after the refreshes, and the tables refreshed once more."""
    base = _refreshed(spark, sf_dir)
    arrivals.withdraw_batch(spark, f"{base}/table", f"{base}/checkpoint", 1)
    daily.refresh(spark, f"{base}/table", f"{base}/checkpoint", f"{base}/daily")
    return edge(daily.read_daily(spark, f"{base}/daily", "sat_minute_rollup").drop("date"))


@query
def dq_checks_kept_by_day(spark, sf_dir):
    """Checks of the raw and staging models, summed from counts by day that refreshes keep."""
    return daily.model_checks(spark, f"{_refreshed(spark, sf_dir)}/daily")


@query
def distinct_times_from_sketches(spark, sf_dir):
    """Rows and distinct times from stored sketches, the latter as whether within a tenth of the exact number."""
    near = daily.distinct_times(spark, f"{_refreshed(spark, sf_dir)}/daily")
    exact = aggregates.row_counts(_raw(spark, sf_dir)).select("sat_id", F.col("n_distinct_times").alias("exact"))
    close = F.abs(F.col("n_distinct_times") - F.col("exact")) <= 0.1 * F.col("exact")
    return near.join(exact, "sat_id").select("sat_id", "n_rows", close.alias("close"))


@query
def stream_closed_hours(spark, sf_dir):
    """Every hour of each satellite: rows, the batch that completed it, and how often it was reopened."""
    return edge(arrivals.hours(_arrivals(spark, sf_dir)))


@query
def stream_late_rows(spark, sf_dir):
    """Late rows by satellite, day and batch."""
    return edge(arrivals.late_rows(_arrivals(spark, sf_dir)))


@query
def stream_bounded_files(spark, sf_dir):
    """Files of a stream that may hold fifty rows: rows of each satellite, and whether all files keep to that."""
    base = scratch_dir(spark, "ingest")
    messages = wire.encoded(adapter.telemetry_from_events(_event_stream(spark, sf_dir)))
    stream_ingest.drain([stream_ingest.start_ingest(messages, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", max_rows_per_file=50)])
    files = store.written_files(spark, f"{base}/table")
    return files.groupBy("sat_id").agg(F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("n_rows") <= 50).alias("bounded"))


def _hot_minutes(mart):
    """A detector of one's own: the first minute of a satellite above 20 degrees."""
    hot = mart.where(X.kelvin_to_celsius(F.col("bus_temperature_k_mean")) > 20.0)
    first = hot.groupBy("sat_id").agg(F.min("minute_bucket").alias("t"), F.min_by("bus_temperature_k_mean", "minute_bucket").alias("score"))
    return first.select("sat_id", F.lit("hot_minute").alias("detector_name"), F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("sim_time_iso"), F.lit("info").alias("severity"), "score", F.lit("hot").alias("description"))


@query
def detect_with_own_detector(spark, sf_dir):
    """The built-in detectors and a further one, run together."""
    return edge(detectors.run_detectors(_observed_rollup(spark, sf_dir), {"hot_minute": _hot_minutes}))


@query
def stream_rollup_late_rows(spark, sf_dir):
    """Rollup when half of the rows of every minute arrive after all others, in a batch of their own."""
    start = lambda raw, base: stream_marts.start_rollup(raw, f"{base}/sums", f"{base}/checkpoint")
    base = _in_batches(spark, _telemetry(spark, sf_dir), _halves(), start)
    return edge(stream_marts.read_rollup(spark, f"{base}/sums"))


@query
def stream_snapshot(spark, sf_dir):
    base = scratch_dir(spark, "snapshot_stream")
    started = stream_marts.start_snapshot(
        _raw_stream(spark, sf_dir), f"{base}/snapshot", f"{base}/checkpoint"
    )
    stream_ingest.drain([started])
    return edge(stream_marts.read_snapshot(spark, f"{base}/snapshot"))


@query
def stream_snapshot_ties(spark, sf_dir):
    """Snapshot over times cut to the hour, in two batches: all rows tied on the latest hour stay."""

    def start(raw, base):
        hourly = raw.withColumn("sim_time", F.date_trunc("hour", F.col("sim_time")))
        return stream_marts.start_snapshot(hourly, f"{base}/snapshot", f"{base}/checkpoint")

    base = _in_batches(spark, _telemetry(spark, sf_dir), _halves(), start)
    return edge(stream_marts.read_snapshot(spark, f"{base}/snapshot"))


def _observed_telemetry(spark, sf_dir):
    return labels.inject(_raw(spark, sf_dir), _bound(spark, sf_dir)).select(*S.TELEMETRY_COLUMNS)


def _start_detectors(raw, base):
    return stream_detectors.start_detectors(raw, f"{base}/out", f"{base}/checkpoint")


@query
def stream_detectors_events(spark, sf_dir):
    """Observed telemetry stream to rollup sums, state and events."""
    base = _in_batches(spark, _observed_telemetry(spark, sf_dir), [F.lit(True)], _start_detectors)
    return edge(stream_detectors.read_stream_events(spark, f"{base}/out"))


@query
def stream_detectors_carried(spark, sf_dir):
    """Events when the telemetry arrives in three parts, one after the other in time: state goes on from part to part."""
    observed = materialize(_observed_telemetry(spark, sf_dir), "observed")
    t = X.parse_iso(F.col("sim_time_iso"))
    first, last = observed.agg(F.min(t), F.max(t)).first()
    cuts = [first + (last - first) * share for share in (0.3, 0.6)]
    parts = [t < F.lit(cuts[0]), (t >= F.lit(cuts[0])) & (t < F.lit(cuts[1])), t >= F.lit(cuts[1])]
    base = _in_batches(spark, observed, parts, _start_detectors)
    return edge(stream_detectors.read_stream_events(spark, f"{base}/out"))


@query
def stream_detectors_late_rows(spark, sf_dir):
    """Events when half of the rows of every minute arrive after all others: all satellites are scored anew."""
    observed = materialize(_observed_telemetry(spark, sf_dir), "observed")
    base = _in_batches(spark, observed, _halves(), _start_detectors)
    return edge(stream_detectors.read_stream_events(spark, f"{base}/out"))
