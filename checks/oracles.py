"""Independent SQL for the registered queries, over the same tables, in DuckDB's dialect."""

from __future__ import annotations

_TEL = """
base AS (
  SELECT event_id, epoch_us(ts) // 120 AS us,
         cast(json_extract_string(props, '$.k') AS integer) AS k,
         user_id % 15 AS sat, value,
         (epoch_us(ts) // 120 // 1000000) % 5400 AS ph
  FROM events),
tel AS (
  SELECT 'SAT-' || lpad(cast(sat AS varchar), 2, '0') AS sat_id,
    strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS sim_time_iso,
    6900::double + k / 10::double AS position_eci_km_x,
    value % 10::double AS position_eci_km_y,
    0::double AS position_eci_km_z,
    0::double AS velocity_eci_km_s_x,
    7.5::double + k / 1000::double AS velocity_eci_km_s_y,
    0::double AS velocity_eci_km_s_z,
    1::double AS sun_vector_eci_x, 0::double AS sun_vector_eci_y, 0::double AS sun_vector_eci_z,
    ph >= 3500 AS eclipsed,
    k * 1.8::double - 90::double AS latitude_deg,
    value % 360::double - 180::double AS longitude_deg,
    500::double + k AS altitude_km,
    CASE WHEN ph >= 3500 THEN 0::double ELSE 245::double END AS solar_power_w,
    CASE WHEN ph >= 3500 THEN 60::double ELSE 90::double END AS bus_power_w,
    CASE WHEN ph >= 3500 THEN -60::double ELSE 155::double END AS net_power_w,
    0.85::double + (k % 10) / 100::double AS battery_soc,
    (0.85::double + (k % 10) / 100::double) * 150::double AS battery_charge_wh,
    285::double + 0.003::double * (CASE WHEN ph < 2700 THEN ph ELSE 5400 - ph END)
      AS bus_temperature_k,
    285::double + 0.003::double * (CASE WHEN ph < 2700 THEN ph ELSE 5400 - ph END)
      - 273.15::double AS bus_temperature_c,
    CASE WHEN ph >= 3500 THEN 0::double ELSE 190::double END AS solar_heat_input_w,
    100::double AS earth_ir_input_w, 300::double AS radiative_heat_output_w,
    CASE WHEN ph < 2700 THEN 297::double ELSE -297::double END AS net_heat_w
  FROM base),
raw AS (SELECT tel.*, cast(sim_time_iso AS timestamp) AS sim_time FROM tel)"""

_DOUBLES = [
    *[f"position_eci_km_{a}" for a in "xyz"],
    *[f"velocity_eci_km_s_{a}" for a in "xyz"],
    *[f"sun_vector_eci_{a}" for a in "xyz"],
    "latitude_deg", "longitude_deg", "altitude_km", "solar_power_w", "bus_power_w",
    "net_power_w", "battery_soc", "battery_charge_wh", "bus_temperature_k", "bus_temperature_c",
    "solar_heat_input_w", "earth_ir_input_w", "radiative_heat_output_w", "net_heat_w",
]


def _r(*names: str) -> str:
    """Select list of columns rounded to six digits."""
    return ", ".join(_r_as(n, n) for n in names)


def _r_as(expr: str, name: str) -> str:
    return (
        f"CASE WHEN isnan(({expr})::double) OR abs({expr}) >= 1e9 THEN ({expr})::double "
        f"ELSE floor(({expr})::double * 1e6::double + 0.5::double) / 1e6::double END AS {name}"
    )


def _mean(expr: str, name: str) -> str:
    """The mean by a compensated sum; values that are not finite make it if there are any."""
    return (
        f"CASE WHEN bool_or(NOT isfinite({expr})) THEN sum(CASE WHEN NOT isfinite({expr}) THEN {expr} END) "
        f"ELSE fsum({expr}) / count({expr})::double END AS {name}"
    )


_TELEMETRY_LIST = f"sat_id, sim_time_iso, eclipsed, {_r(*_DOUBLES)}"

def _norm(stem: str) -> str:
    return "sqrt(" + " + ".join(f"{stem}_{a} * {stem}_{a}" for a in "xyz") + ")"


_MEASURES = ", ".join([
    _mean("battery_soc", "battery_soc_mean"),
    "min(battery_soc) AS battery_soc_min",
    "max(battery_soc) AS battery_soc_max",
    _mean("solar_power_w", "solar_power_w_mean"),
    _mean("bus_power_w", "bus_power_w_mean"),
    _mean("net_power_w", "net_power_w_mean"),
    "sum(CASE WHEN net_power_w > 0 THEN 1 ELSE 0 END) / count(*)::double AS charging_fraction",
    _mean("bus_temperature_k", "bus_temperature_k_mean"),
    "min(bus_temperature_k) AS bus_temperature_k_min",
    "max(bus_temperature_k) AS bus_temperature_k_max",
    _mean("net_heat_w", "net_heat_w_mean"),
    "sum(CASE WHEN eclipsed THEN 1 ELSE 0 END) / count(*)::double AS eclipse_fraction",
    _mean("altitude_km", "altitude_km_mean"),
    _mean(_norm("position_eci_km"), "position_magnitude_km_mean"),
    _mean(_norm("velocity_eci_km_s"), "orbital_speed_km_s_mean"),
])

_MEASURE_NAMES = [
    "battery_soc_mean", "battery_soc_min", "battery_soc_max", "solar_power_w_mean",
    "bus_power_w_mean", "net_power_w_mean", "charging_fraction", "bus_temperature_k_mean",
    "bus_temperature_k_min", "bus_temperature_k_max", "net_heat_w_mean", "eclipse_fraction",
    "altitude_km_mean", "position_magnitude_km_mean", "orbital_speed_km_s_mean",
]


def _rollup(source: str, name: str = "roll", where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT sat_id, date_trunc('minute', sim_time) AS minute_bucket, {_MEASURES}
  FROM {source} WHERE {where} GROUP BY sat_id, date_trunc('minute', sim_time))"""


_LIMITS = """
bands(channel, below, above, band, severity) AS (VALUES
  ('soc', 0.25, NULL, 'critical', 2), ('soc', 0.50, NULL, 'degraded', 1),
  ('temp', -20, 50, 'critical', 2), ('temp', -10, 40, 'degraded', 1))"""


def _band(channel: str, value: str) -> str:
    """The most severe band whose limits a value is outside of."""
    return (
        f"coalesce((SELECT arg_max(band, severity) FROM bands WHERE channel = '{channel}' "
        f"AND ({value} < below OR {value} > above)), 'nominal')"
    )


_SNAPSHOT = f"""
{_LIMITS},
placed AS (SELECT *, rank() OVER (PARTITION BY sat_id ORDER BY sim_time DESC) AS place
  FROM raw WHERE sim_time IS NOT NULL AND sat_id IS NOT NULL),
snap AS (SELECT *, sim_time AS latest_sim_time, {_band('soc', 'battery_soc')} AS battery_health_band,
  {_band('temp', 'bus_temperature_c')} AS thermal_health_band FROM placed WHERE place = 1)"""

_SNAPSHOT_OUT = f"""SELECT sat_id, latest_sim_time, eclipsed, battery_health_band,
  thermal_health_band, {_r('battery_soc', 'bus_temperature_k', 'bus_temperature_c',
  'latitude_deg', 'longitude_deg', 'altitude_km', 'solar_power_w', 'net_power_w')} FROM snap"""

# Label sets: ordinal, satellite, type, offset in seconds, fade rate, floor, heat rate, cap.
_FAULT_ROWS = [
    "(0, 'SAT-00', 'battery_capacity_fade', 0, 0.15, 0.6, 2.0, 50.0)",
    "(1, 'SAT-09', 'stuck_temperature_sensor', 1800, 0.02, 0.5, 2.0, 50.0)",
    "(2, 'SAT-13', 'thermal_runaway', 3600, 0.02, 0.5, 6.0, 40.0)",
    "(3, 'SAT-05', 'thermal_runaway', 600, 0.02, 0.5, 0.1, 50.0)",
]
_LAYERED_ROWS = [
    "(0, 'SAT-05', 'thermal_runaway', 1200, 0.02, 0.5, 3.0, 4.0)",
    "(1, 'SAT-05', 'stuck_temperature_sensor', 3600, 0.02, 0.5, 2.0, 50.0)",
    "(2, 'SAT-05', 'thermal_runaway', 2400, 0.02, 0.5, 2.0, 50.0)",
    "(3, 'SAT-05', 'battery_capacity_fade', 1800, 0.02, 0.5, 2.0, 50.0)",
    "(4, 'SAT-05', 'battery_capacity_fade', 7200, 6.0, 0.7, 2.0, 50.0)",
]


def _bound(rows: list[str]) -> str:
    return f"""
start_of AS (SELECT min(date_trunc('minute', sim_time)) AS sim_start FROM raw),
bound AS (
  SELECT ordinal, sat_id, fault_type, fade_rate::double AS fade_rate, floor_at::double AS floor_at,
    heat_rate::double AS heat_rate, cap_k::double AS cap_k,
    sim_start + to_seconds(off_s) AS start
  FROM (VALUES {", ".join(rows)})
    AS v(ordinal, sat_id, fault_type, off_s, fade_rate, floor_at, heat_rate, cap_k), start_of)"""


def _seconds(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 1000000::double)"


# One label of a type per satellite: plain left joins.
_INJECT = f"""
held AS (
  SELECT r.sat_id, arg_min(r.bus_temperature_k, r.sim_time) AS held_k
  FROM raw r JOIN bound b ON b.sat_id = r.sat_id AND b.fault_type = 'stuck_temperature_sensor'
    AND r.sim_time >= b.start GROUP BY r.sat_id),
marked AS (
  SELECT r.*,
    greatest(f.floor_at, 1::double - f.fade_rate *
      greatest(0::double, {_seconds('r.sim_time', 'f.start')} / 86400::double)) AS fade,
    h.held_k,
    least(t.cap_k, t.heat_rate *
      greatest(0::double, {_seconds('r.sim_time', 't.start')} / 3600::double)) AS bias,
    s.ordinal AS stuck_on, t.ordinal AS hot_on, f.ordinal AS fade_on
  FROM raw r
  LEFT JOIN bound f ON f.sat_id = r.sat_id AND f.fault_type = 'battery_capacity_fade'
    AND r.sim_time >= f.start
  LEFT JOIN bound s ON s.sat_id = r.sat_id AND s.fault_type = 'stuck_temperature_sensor'
    AND r.sim_time >= s.start
  LEFT JOIN bound t ON t.sat_id = r.sat_id AND t.fault_type = 'thermal_runaway'
    AND r.sim_time >= t.start
  LEFT JOIN held h ON h.sat_id = r.sat_id),
inj AS (
  SELECT * REPLACE (
    CASE WHEN fade_on IS NULL THEN battery_soc ELSE battery_soc * fade END AS battery_soc,
    CASE WHEN fade_on IS NULL THEN battery_charge_wh ELSE battery_charge_wh * fade END
      AS battery_charge_wh,
    CASE WHEN stuck_on IS NOT NULL THEN held_k
         WHEN hot_on IS NOT NULL THEN bus_temperature_k + bias ELSE bus_temperature_k END
      AS bus_temperature_k,
    CASE WHEN stuck_on IS NOT NULL THEN held_k - 273.15::double
         WHEN hot_on IS NOT NULL THEN bus_temperature_k + bias - 273.15::double
         ELSE bus_temperature_c END AS bus_temperature_c)
  FROM marked)"""

# The overlapping set: first bias before the stuck label, second after it.
_INJECT_LAYERED = f"""
effects AS (
  SELECT r.*, b.*  EXCLUDE (sat_id),
    r.sim_time >= b.start AS on_now,
    least(b.cap_k, b.heat_rate *
      greatest(0::double, {_seconds('r.sim_time', 'b.start')} / 3600::double)) AS bias,
    greatest(b.floor_at, 1::double - b.fade_rate *
      greatest(0::double, {_seconds('r.sim_time', 'b.start')} / 86400::double)) AS fade
  FROM raw r JOIN bound b ON b.sat_id = r.sat_id),
wide AS (
  SELECT sat_id, sim_time,
    max(CASE WHEN ordinal = 0 AND on_now THEN bias ELSE 0::double END) AS bias_a,
    max(CASE WHEN ordinal = 2 AND on_now THEN bias ELSE 0::double END) AS bias_b,
    bool_or(ordinal = 1 AND on_now) AS stuck,
    bool_or(fault_type <> 'battery_capacity_fade' AND on_now) AS thermal,
    min(CASE WHEN ordinal = 3 AND on_now THEN fade ELSE 1::double END) AS fade_a,
    min(CASE WHEN ordinal = 4 AND on_now THEN fade ELSE 1::double END) AS fade_b,
    max(bus_temperature_k) AS k, max(bus_temperature_c) AS c
  FROM effects GROUP BY sat_id, sim_time),
frozen AS (
  SELECT sat_id, arg_min(k + bias_a, sim_time) AS held_k FROM wide WHERE stuck GROUP BY sat_id),
layered AS (
  SELECT w.sat_id, w.sim_time, fade_a, fade_b, thermal,
    CASE WHEN stuck THEN held_k + bias_b ELSE k + bias_a + bias_b END AS k2
  FROM wide w LEFT JOIN frozen z ON z.sat_id = w.sat_id)"""

_DETECT = """
ordered AS (
  SELECT sat_id, minute_bucket, battery_soc_mean AS soc, bus_temperature_k_mean AS tk,
    net_heat_w_mean * 60::double / 99000::double AS expected,
    row_number() OVER w AS seq,
    max(battery_soc_mean) OVER (w ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS ceiling,
    bus_temperature_k_mean - lag(bus_temperature_k_mean) OVER w AS step,
    bus_temperature_k_mean - 273.15::double AS temp_c,
    ((bus_temperature_k_mean - 273.15::double)
      - (lag(bus_temperature_k_mean, 4) OVER w - 273.15::double)) / 4::double AS slope
  FROM roll WINDOW w AS (PARTITION BY sat_id ORDER BY minute_bucket)),
baselines AS (SELECT sat_id, ceiling AS baseline FROM ordered WHERE seq = 90),
drifts AS (
  SELECT o.*, b.baseline, abs(expected - step) AS residual,
    coalesce(abs(expected - step) > 0.1::double AND abs(expected) > 0.01::double, false) AS bad,
    CASE WHEN seq > 90 THEN coalesce(b.baseline - ceiling - 0.001::double, 0) ELSE 0::double END
      AS x
  FROM ordered o LEFT JOIN baselines b ON b.sat_id = o.sat_id),
sums AS (
  SELECT *, sum(x) OVER (PARTITION BY sat_id ORDER BY minute_bucket
                         ROWS UNBOUNDED PRECEDING) AS p,
    seq - max(CASE WHEN bad THEN 0 ELSE seq END) OVER (
      PARTITION BY sat_id ORDER BY minute_bucket ROWS UNBOUNDED PRECEDING) AS run
  FROM drifts),
signals AS (
  SELECT *, CASE WHEN seq > 90 THEN p - least(0::double, min(p) OVER (
      PARTITION BY sat_id ORDER BY minute_bucket ROWS UNBOUNDED PRECEDING)) END AS cusum
  FROM sums),
fired AS (
  SELECT sat_id, 'capacity_fade' AS detector_name, min(minute_bucket) AS minute_bucket
  FROM signals WHERE cusum >= 0.10::double GROUP BY sat_id
  UNION ALL
  SELECT sat_id, 'stuck_sensor', min(minute_bucket) FROM signals WHERE run >= 5 GROUP BY sat_id
  UNION ALL
  SELECT sat_id, 'thermal_runaway', min(minute_bucket) FROM signals
  WHERE temp_c > 35 AND seq >= 5 AND slope >= 0.04::double GROUP BY sat_id),
ev AS (
  SELECT f.sat_id, f.detector_name, f.minute_bucket AS event_time,
    strftime(f.minute_bucket, '%Y-%m-%d %H:%M:%S') AS sim_time_iso,
    CASE f.detector_name WHEN 'capacity_fade' THEN 'warning' ELSE 'critical' END AS severity,
    CASE f.detector_name WHEN 'capacity_fade' THEN s.cusum WHEN 'stuck_sensor' THEN s.residual
      ELSE s.temp_c - 35::double END AS score,
    CASE f.detector_name
      WHEN 'capacity_fade' THEN
        'Battery SoC ceiling drifted by ' || printf('%.3f', s.cusum) || ' from baseline '
        || printf('%.3f', s.baseline) || '; consistent with capacity fade.'
      WHEN 'stuck_sensor' THEN
        'Temperature held while heat balance predicts movement; residual '
        || printf('%.2f', s.residual) || ' K sustained for ' || cast(s.run AS varchar)
        || ' minutes.'
      ELSE 'Bus temperature ' || printf('%.1f', s.temp_c) || ' C exceeds ceiling '
        || printf('%.1f', 35::double) || ' C with positive slope ' || printf('%.2f', s.slope)
        || ' K/min.' END AS description
  FROM fired f JOIN signals s ON s.sat_id = f.sat_id AND s.minute_bucket = f.minute_bucket)"""

_EVENT_OUT = (
    "SELECT sat_id, detector_name, sim_time_iso, severity, "
    f"{_r('score')}, description FROM ev"
)

_WINDOWS = """
named AS (
  SELECT sat_id, start, CASE fault_type WHEN 'battery_capacity_fade' THEN 'capacity_fade'
    WHEN 'stuck_temperature_sensor' THEN 'stuck_sensor' WHEN 'thermal_runaway'
    THEN 'thermal_runaway' END AS detector_name FROM bound),
wins AS (
  SELECT sat_id, detector_name, min(start) AS earliest_start, count(*) AS n_specs
  FROM named GROUP BY sat_id, detector_name)"""

_SCORE = f"""
classed AS (
  SELECT e.sat_id, e.detector_name, e.event_time,
    CASE WHEN e.event_time >= w.earliest_start THEN 'TP' ELSE 'FP' END AS outcome,
    CASE WHEN e.event_time >= w.earliest_start THEN {_seconds('e.event_time', 'w.earliest_start')}
      END AS latency_seconds
  FROM ev e LEFT JOIN wins w ON w.sat_id = e.sat_id AND w.detector_name = e.detector_name),
missed AS (
  SELECT * FROM wins w WHERE NOT EXISTS (
    SELECT 1 FROM ev e WHERE e.sat_id = w.sat_id AND e.detector_name = w.detector_name
      AND e.event_time >= w.earliest_start)),
counted AS (
  SELECT d.detector_name,
    (SELECT count(*) FROM classed c WHERE c.detector_name = d.detector_name AND outcome = 'TP')
      AS tp,
    (SELECT count(*) FROM classed c WHERE c.detector_name = d.detector_name AND outcome = 'FP')
      AS fp,
    (SELECT coalesce(sum(n_specs), 0)::bigint FROM missed m
      WHERE m.detector_name = d.detector_name) AS fn,
    (SELECT avg(latency_seconds) FROM classed c WHERE c.detector_name = d.detector_name)
      AS mean_latency_seconds
  FROM (VALUES ('capacity_fade'), ('stuck_sensor'), ('thermal_runaway')) AS d(detector_name)),
scores AS (
  SELECT detector_name, tp AS true_positives, fp AS false_positives, fn AS false_negatives,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::double ELSE 1::double END AS recall,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::double ELSE 1::double END AS precision,
    mean_latency_seconds
  FROM counted)"""

_SCORE_OUT = f"""SELECT detector_name, true_positives, false_positives, false_negatives,
  {_r('recall', 'precision', 'mean_latency_seconds')} FROM scores"""

# One label per event, some malformed.
_EVENT_LABELS = """
lab AS (
  SELECT cast(event_id AS integer) AS ordinal,
    'SAT-' || lpad(cast(user_id % 15 AS varchar), 2, '0') AS sat_id,
    CASE event_id % 4 WHEN 0 THEN 'battery_capacity_fade' WHEN 1 THEN 'stuck_temperature_sensor'
      WHEN 2 THEN 'thermal_runaway' ELSE
        CASE WHEN event_id % 8 = 3 THEN 'thermal_runaway' ELSE 'attitude_excursion' END END
      AS fault_type,
    CASE WHEN event_id % 10 < 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END
      AS start_iso,
    CASE WHEN event_id % 10 > 2 AND event_id % 10 < 9 THEN
      CASE WHEN event_id % 11 = 0 THEN '' ELSE '+' END ||
      CASE WHEN event_id % 3 = 0 THEN '' ELSE lpad(cast(event_id % 400 AS varchar), 3, '0') || '-'
        END || strftime(ts, '%H:%M:%S') END AS start_offset,
    CASE WHEN event_id % 10 > 2 AND event_id % 10 < 9 AND event_id % 11 <> 0 THEN
      (CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 400 END) * 86400
      + extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
      + floor(extract(second FROM ts))::bigint END AS offset_s,
    date_trunc('second', ts) AS start_at
  FROM events),
judged AS (
  SELECT *, CASE
    WHEN (start_iso IS NULL) = (start_offset IS NULL) THEN 'label of ' || sat_id
      || ': give start_iso or start_offset, and not both'
    WHEN fault_type = 'attitude_excursion' THEN 'unknown fault_type attitude_excursion'
    WHEN start_offset IS NOT NULL AND offset_s IS NULL THEN 'bad start_offset ' || start_offset
    END AS problem FROM lab),
start_of AS (SELECT min(date_trunc('minute', sim_time)) AS sim_start FROM raw),
bound AS (
  SELECT ordinal, sat_id, fault_type,
    CASE WHEN start_iso IS NOT NULL THEN start_at ELSE sim_start + to_seconds(offset_s) END AS start
  FROM judged, start_of WHERE problem IS NULL)"""

_US = "epoch_us(sim_time)"
_REASON = f"""CASE {_US} % 10 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'missing' WHEN 2 THEN 'extra'
  WHEN 3 THEN 'bad_type' WHEN 4 THEN 'bad_time' WHEN 5 THEN 'bad_json' END"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([_TEL, *ctes]) + "\n"


# Rows by hour and batch when telemetry arrives in three parts: see the query.
_ARRIVALS = """
us AS (SELECT sat_id, sim_time, epoch_us(sim_time) AS us FROM raw),
span AS (SELECT min(us) AS lo, max(us) AS hi FROM us),
arr AS (SELECT sat_id, date_trunc('hour', sim_time) AS hour_start,
    cast(CASE WHEN us % 7 = 0 OR us >= lo + (hi - lo) // 3 * 2 THEN 2 WHEN us >= lo + (hi - lo) // 3 THEN 1 ELSE 0 END AS bigint) AS batch,
    count(*) AS n_rows FROM us, span GROUP BY ALL)"""

# the telemetry without the second of the three parts
_STAYED = """
bounds AS (SELECT min(epoch_us(sim_time)) AS lo, max(epoch_us(sim_time)) AS hi FROM raw),
stayed AS (SELECT raw.* FROM raw, bounds WHERE epoch_us(sim_time) % 7 = 0 OR epoch_us(sim_time) < lo + (hi - lo) // 3
    OR epoch_us(sim_time) >= lo + (hi - lo) // 3 * 2)"""


def _series(expr: str, name: str) -> str:
    return (
        _with(_rollup("raw"))
        + f"SELECT minute_bucket AS time, {_r_as(expr, name)} FROM roll WHERE sat_id = 'SAT-03'"
    )


def _detected(rows: list[str], *more: str) -> str:
    return _with(_bound(rows), _INJECT, _rollup("inj"), _DETECT, *more)


def _model_checks(*models: str) -> str:
    """The checks of all models, or of those named."""
    norm = "sqrt(position_eci_km_x * position_eci_km_x)"
    telemetry = {
        "raw_telemetry": [
            ("sat_id", "sat_id"), ("sim_time", "sim_time"), ("battery_soc", "battery_soc"),
            ("bus_temperature_k", "bus_temperature_k"), ("eclipsed", "eclipsed"),
        ],
        "stg_geometry": [
            ("sat_id", "sat_id"), ("sim_time", "sim_time"), ("position_magnitude_km", norm),
            ("ground_quadrant", "'SW'"),
        ],
        "stg_eps": [
            ("sat_id", "sat_id"), ("sim_time", "sim_time"), ("battery_soc", "battery_soc"),
            ("is_charging", "1"),
        ],
        "stg_thermal": [
            ("sat_id", "sat_id"), ("sim_time", "sim_time"),
            ("bus_temperature_k", "bus_temperature_k"), ("thermal_regime", "'steady'"),
        ],
    }
    parts = []

    def add(model, column, check, count):
        if models and model not in models:
            return
        parts.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, '{check}' AS check_name, "
            f"({count}) AS violations"
        )

    for model, columns in telemetry.items():
        for column, expr in columns:
            add(model, column, "not_null", f"SELECT count(*) FROM raw WHERE ({expr}) IS NULL")
    quadrant = (
        "CASE WHEN latitude_deg >= 0 AND longitude_deg >= 0 THEN 'NE' WHEN latitude_deg >= 0 "
        "AND longitude_deg < 0 THEN 'NW' WHEN latitude_deg < 0 AND longitude_deg >= 0 THEN 'SE' "
        "ELSE 'SW' END"
    )
    add("stg_geometry", "ground_quadrant", "accepted_values",
        f"SELECT count(*) FROM raw WHERE {quadrant} NOT IN ('NE', 'NW', 'SE', 'SW')")
    add("stg_eps", "is_charging", "accepted_values",
        "SELECT count(*) FROM raw WHERE CASE WHEN net_power_w > 0 THEN 1 ELSE 0 END NOT IN (0, 1)")
    add("stg_thermal", "thermal_regime", "accepted_values",
        "SELECT count(*) FROM raw WHERE CASE WHEN net_heat_w > 1 THEN 'warming' WHEN net_heat_w "
        "< -1 THEN 'cooling' ELSE 'steady' END NOT IN ('warming', 'cooling', 'steady')")
    for c in ("sat_id", "minute_bucket", "battery_soc_mean", "eclipse_fraction"):
        add("sat_minute_rollup", c, "not_null", f"SELECT count(*) FROM roll WHERE {c} IS NULL")
    for c in ("sat_id", "latest_sim_time", "battery_health_band", "thermal_health_band"):
        add("fleet_health_snapshot", c, "not_null", f"SELECT count(*) FROM snap WHERE {c} IS NULL")
    for c in ("battery_health_band", "thermal_health_band"):
        add("fleet_health_snapshot", c, "accepted_values",
            f"SELECT count(*) FROM snap WHERE {c} NOT IN ('critical', 'degraded', 'nominal')")
    add("fleet_health_snapshot", "sat_id", "unique",
        "SELECT count(*) FROM (SELECT sat_id FROM snap GROUP BY sat_id HAVING count(*) > 1)")
    return _with(_rollup("raw"), _SNAPSHOT) + "\nUNION ALL\n".join(parts)


def _physical_checks() -> str:
    r = (
        "sqrt(position_eci_km_x * position_eci_km_x + position_eci_km_y * position_eci_km_y "
        "+ position_eci_km_z * position_eci_km_z)"
    )
    sun = (
        "sqrt(sun_vector_eci_x * sun_vector_eci_x + sun_vector_eci_y * sun_vector_eci_y "
        "+ sun_vector_eci_z * sun_vector_eci_z)"
    )
    rules = [
        ("battery_soc", "soc_range", "battery_soc >= 0.20 AND battery_soc <= 1.00"),
        ("bus_temperature_k", "temperature_range",
         "bus_temperature_k > 240 AND bus_temperature_k < 330"),
        ("position_eci_km", "orbit_radius", f"{r} > 6700 AND {r} < 7200"),
        ("altitude_km", "altitude_range", "altitude_km > 300 AND altitude_km < 800"),
        ("latitude_deg", "latitude_range", "abs(latitude_deg) <= 97.5"),
        ("sun_vector_eci", "unit_length", f"abs({sun} - 1) < 1e-6"),
        ("bus_temperature_c", "celsius_matches_kelvin",
         "abs(bus_temperature_c - (bus_temperature_k - 273.15::double)) < 1e-6"),
    ]
    return _with() + "\nUNION ALL\n".join(
        f"SELECT 'raw_telemetry' AS model, '{c}' AS column_name, '{n}' AS check_name, "
        f"(SELECT count(*) FROM raw WHERE NOT ({ok})) AS violations"
        for c, n, ok in rules
    )


_ORBIT = f"cast(floor(round_even({_US} / 1000000::double, 0) / 5400::double) AS bigint)"

_STEPS = """
steps AS (
  SELECT sat_id, eclipsed,
    battery_soc - lag(battery_soc) OVER w AS d_soc,
    bus_temperature_k - lag(bus_temperature_k) OVER w AS d_k
  FROM raw WINDOW w AS (PARTITION BY sat_id ORDER BY sim_time)),
dsteps AS (
  SELECT sat_id, avg(d_soc) AS soc_step_mean, avg(d_k) AS temperature_step_mean_k,
    count(d_soc) AS n_steps FROM steps WHERE eclipsed GROUP BY sat_id)"""

_PASSES = """
flagged AS (
  SELECT sat_id, sim_time, eclipsed, lead(sim_time) OVER w AS next_time,
    CASE WHEN eclipsed AND NOT coalesce(lag(eclipsed) OVER w, false) THEN 1 ELSE 0 END AS opens
  FROM raw WINDOW w AS (PARTITION BY sat_id ORDER BY sim_time)),
passes AS (
  SELECT *, sum(opens) OVER (PARTITION BY sat_id ORDER BY sim_time ROWS UNBOUNDED PRECEDING)
    AS pass FROM flagged)"""


def oracle_sql() -> dict[str, str]:
    roll_out = f"SELECT sat_id, minute_bucket, {_r(*_MEASURE_NAMES)} FROM roll"
    faults, with_miss = _FAULT_ROWS[:3], _FAULT_ROWS
    inject_columns = {
        "inject_capacity_fade": (faults[:1], ["battery_soc", "battery_charge_wh", "net_power_w"]),
        "inject_stuck_sensor": (
            faults[1:2], ["bus_temperature_k", "bus_temperature_c", "net_heat_w"]),
        "inject_thermal_runaway": (
            faults[2:3], ["bus_temperature_k", "bus_temperature_c", "net_heat_w"]),
    }
    sql = {
        "raw_telemetry": _with() + f"SELECT sim_time, {_TELEMETRY_LIST} FROM raw",
        "raw_telemetry_lenient": _with() + f"""SELECT sat_id, count(*) AS n_rows,
          count(*) FILTER ({_US} % 7 = 0) AS bad_times, count(*) FILTER ({_US} % 5 = 0) AS bad_soc
          FROM raw GROUP BY sat_id""",
        "stg_geometry": _with() + f"""SELECT sat_id, sim_time, sim_time_iso, eclipsed,
          {_r(*_DOUBLES[:12])},
          {_r_as('sqrt(position_eci_km_x * position_eci_km_x + position_eci_km_y * position_eci_km_y + position_eci_km_z * position_eci_km_z)', 'position_magnitude_km')},
          {_r_as('sqrt(velocity_eci_km_s_x * velocity_eci_km_s_x + velocity_eci_km_s_y * velocity_eci_km_s_y + velocity_eci_km_s_z * velocity_eci_km_s_z)', 'orbital_speed_km_s')},
          CASE WHEN latitude_deg >= 0 AND longitude_deg >= 0 THEN 'NE'
               WHEN latitude_deg >= 0 AND longitude_deg < 0 THEN 'NW'
               WHEN latitude_deg < 0 AND longitude_deg >= 0 THEN 'SE' ELSE 'SW' END
            AS ground_quadrant FROM raw""",
        "stg_eps": _with() + f"""SELECT sat_id, sim_time, eclipsed,
          {_r('solar_power_w', 'bus_power_w', 'net_power_w', 'battery_soc', 'battery_charge_wh')},
          CASE WHEN net_power_w > 0 THEN 1 ELSE 0 END AS is_charging,
          extract(hour FROM sim_time) AS sim_hour,
          cast(extract(epoch FROM sim_time) AS bigint) % 5400 AS seconds_into_orbit FROM raw""",
        "stg_thermal": _with() + f"""SELECT sat_id, sim_time, eclipsed,
          {_r(*_DOUBLES[17:])},
          {_r_as('solar_heat_input_w + earth_ir_input_w', 'total_heat_input_w')},
          CASE WHEN net_heat_w > 1 THEN 'warming' WHEN net_heat_w < -1 THEN 'cooling'
            ELSE 'steady' END AS thermal_regime FROM raw""",
        "unit_conversions": _with() + f"""SELECT sat_id, sim_time,
          {_r_as('bus_temperature_k - 273.15::double', 'temp_c')},
          {_r_as('battery_soc * 150::double', 'charge_wh')},
          {_r_as("cast(extract(epoch FROM sim_time) AS bigint) % 5400 / 60::double", 'minutes_into_orbit')} FROM raw""",
        "flatten_ticks": _with() + f"""SELECT {_TELEMETRY_LIST.replace('sim_time_iso',
          "replace(sim_time_iso, '.000000+', '+') AS sim_time_iso", 1)} FROM raw""",
        "sat_minute_rollup": _with(_rollup("raw")) + roll_out,
        "rollup_subsystem_join": _with(_rollup("raw")) + roll_out,
        "rollup_refreshed_by_day": _with(_rollup("raw")) + roll_out,
        "fleet_health_snapshot": _with(_SNAPSHOT) + _SNAPSHOT_OUT,
        "fleet_view": _with(_SNAPSHOT) + f"""SELECT sat_id, latest_sim_time, battery_health_band,
          thermal_health_band, eclipsed, {_r('battery_soc', 'bus_temperature_c', 'latitude_deg',
          'longitude_deg', 'altitude_km')} FROM snap ORDER BY sat_id""",
        "sat_series_soc": _series("battery_soc_mean", "battery_soc_mean"),
        "sat_series_temp_c": _series("bus_temperature_k_mean - 273.15::double", "temp_c"),
        "sat_series_net_power": _series("net_power_w_mean", "net_power_w_mean"),
        "sat_series_eclipse": _series("eclipse_fraction", "eclipse_fraction"),
        "sat_series_recent": _series("battery_soc_mean", "battery_soc_mean")
        + " AND minute_bucket >= (SELECT max(minute_bucket) - INTERVAL 2 HOUR FROM roll"
        " WHERE sat_id = 'SAT-03')",
        "sat_series_annotated": _detected(faults) + f"""
          SELECT r.minute_bucket AS time, {_r('battery_soc_mean')},
          {_r_as('bus_temperature_k_mean - 273.15::double', 'temp_c')},
          {_r('net_power_w_mean', 'eclipse_fraction')}, e.detector_name, e.severity,
          {_r_as('e.score', 'score')}
          FROM roll r LEFT JOIN ev e ON e.sat_id = r.sat_id AND e.event_time = r.minute_bucket
          WHERE r.sat_id = 'SAT-13'""",
        "sat_picker": _with() + "SELECT DISTINCT sat_id FROM raw ORDER BY sat_id",
        "anomaly_feed_top100": _detected(faults) + _EVENT_OUT
        + " ORDER BY sim_time_iso DESC, sat_id, detector_name LIMIT 100",
        "sat_events_top20": _detected(faults) + f"""SELECT sim_time_iso, detector_name, severity,
          {_r('score')}, description FROM ev WHERE sat_id = 'SAT-13'
          ORDER BY sim_time_iso DESC, detector_name LIMIT 20""",
        "rolling_max_soc": _with(_rollup("raw"), _DETECT) + f"""SELECT sat_id, minute_bucket, seq,
          {_r_as('CASE WHEN seq >= 90 THEN ceiling END', 'rolling_max')} FROM ordered""",
        "cusum_score": _detected(faults)
        + f"SELECT sat_id, minute_bucket, {_r('baseline', 'cusum')} FROM signals",
        "heat_residual": _detected(faults)
        + f"SELECT sat_id, minute_bucket, {_r_as('residual', 'residual_k')} FROM signals",
        "residual_run_length": _detected(faults)
        + "SELECT sat_id, minute_bucket, run AS run_length FROM signals",
        "eclipse_run_length": _with(_rollup("raw")) + """
          , nums AS (SELECT sat_id, minute_bucket, eclipse_fraction = 1 AS dark,
            row_number() OVER (PARTITION BY sat_id ORDER BY minute_bucket) AS seq FROM roll)
          SELECT sat_id, minute_bucket, seq - max(CASE WHEN dark THEN 0 ELSE seq END) OVER (
            PARTITION BY sat_id ORDER BY minute_bucket ROWS UNBOUNDED PRECEDING) AS dark_minutes
          FROM nums""",
        "temp_step": _with(_rollup("raw"), _DETECT)
        + f"SELECT sat_id, minute_bucket, {_r_as('step', 'step_k')} FROM ordered",
        "temp_slope": _with(_rollup("raw")) + f""", lagged AS (
          SELECT sat_id, minute_bucket, bus_temperature_k_mean AS tk,
            lag(bus_temperature_k_mean, 4) OVER (PARTITION BY sat_id ORDER BY minute_bucket) AS t4
          FROM roll)
          SELECT sat_id, minute_bucket, {_r_as('(tk - t4) / 4::double', 'slope')} FROM lagged""",
        "time_order_check": """WITH arrivals AS (
            SELECT event_id, 'SAT-' || lpad(cast(user_id % 15 AS varchar), 2, '0') AS sat_id,
              make_timestamp(epoch_us(ts)
                - cast(json_extract_string(props, '$.k') AS bigint) * 60000000) AS t FROM events),
          seen AS (SELECT *, lag(t) OVER (PARTITION BY sat_id ORDER BY event_id) AS previous_time
            FROM arrivals)
          SELECT sat_id, event_id, t, previous_time FROM seen WHERE t <= previous_time""",
        "eclipse_intervals": _with(_PASSES) + """SELECT sat_id, min(sim_time) AS start_time,
          coalesce(max(next_time) FILTER (next_time IS NOT NULL AND sim_time = last_in), max(sim_time))
            AS end_time, count(*) AS n_rows
          FROM (SELECT *, max(sim_time) OVER (PARTITION BY sat_id, pass) AS last_in
                FROM passes WHERE eclipsed) GROUP BY sat_id, pass""",
        "eclipse_delta_means": _with(_STEPS) + f"""SELECT s.sat_id,
          {_r('soc_step_mean', 'temperature_step_mean_k')}, coalesce(n_steps, 0) AS n_steps
          FROM (SELECT DISTINCT sat_id FROM raw) s LEFT JOIN dsteps d ON d.sat_id = s.sat_id""",
        "latest_time": _with()
        + "SELECT sat_id, max(sim_time) AS latest_sim_time FROM raw GROUP BY sat_id",
        "sim_start": _with(_rollup("raw")) + "SELECT min(minute_bucket) AS sim_start FROM roll",
        "orbit_mean_power": _with() + f"""SELECT sat_id, {_ORBIT} AS orbit,
          {_r_as('avg(net_power_w)', 'net_power_w_mean')}, count(*) AS n_rows
          FROM raw GROUP BY sat_id, {_ORBIT}""",
        "channel_ranges": _with() + f"""SELECT sat_id,
          {_r_as('max(bus_temperature_k) - min(bus_temperature_k)', 'temperature_range_k')},
          {_r_as('max(battery_soc) - min(battery_soc)', 'soc_range')},
          {_r_as('max(latitude_deg) - min(latitude_deg)', 'latitude_range_deg')}
          FROM raw GROUP BY sat_id""",
        "eclipse_fraction": _with() + f"""SELECT sat_id,
          {_r_as('sum(CASE WHEN eclipsed THEN 1 ELSE 0 END) / count(*)::double', 'eclipse_fraction')},
          count(*) AS n_rows FROM raw GROUP BY sat_id""",
        "fleet_count_distinct": _with() + """SELECT sat_id, count(*) AS n_rows,
          count(DISTINCT sim_time_iso) AS n_distinct_times FROM raw GROUP BY sat_id""",
        "fleet_select": _with() + """, chosen AS (SELECT DISTINCT sat_id FROM raw
            WHERE upper(sat_id) LIKE '%SAT-1%' ORDER BY sat_id LIMIT 3)
          SELECT sat_id, count(*) AS n_rows FROM raw WHERE sat_id IN (SELECT sat_id FROM chosen)
          GROUP BY sat_id""",
        "partition_counts": _with() + """SELECT sat_id, strftime(sim_time, '%Y-%m-%d') AS date,
          strftime(sim_time, '%H') AS hour, count(*) AS n_rows FROM raw GROUP BY ALL""",
        "fault_offset_parse": _with(_EVENT_LABELS)
        + "SELECT ordinal, start_offset, offset_s FROM lab WHERE start_offset IS NOT NULL",
        "fault_label_problems": _with(_EVENT_LABELS) + "SELECT ordinal, problem FROM judged",
        "fault_bind": _with(_EVENT_LABELS) + "SELECT ordinal, sat_id, start FROM bound",
        "fault_windows": _with(_EVENT_LABELS, _WINDOWS)
        + "SELECT sat_id, detector_name, earliest_start, n_specs FROM wins",
        "inject_layered": _with(_bound(_LAYERED_ROWS), _INJECT_LAYERED) + f"""
          SELECT r.sat_id, r.sim_time,
            {_r_as('r.battery_soc * coalesce(fade_a, 1) * coalesce(fade_b, 1)', 'battery_soc')},
            {_r_as('r.battery_charge_wh * coalesce(fade_a, 1) * coalesce(fade_b, 1)', 'battery_charge_wh')},
            {_r_as('coalesce(k2, r.bus_temperature_k)', 'bus_temperature_k')},
            {_r_as('CASE WHEN thermal THEN k2 - 273.15::double ELSE r.bus_temperature_c END', 'bus_temperature_c')}
          FROM raw r LEFT JOIN layered l ON l.sat_id = r.sat_id AND l.sim_time = r.sim_time""",
        "active_labels": _with(_bound(_LAYERED_ROWS)) + """SELECT r.sat_id, r.sim_time,
            coalesce(string_agg(cast(b.ordinal AS varchar), ',' ORDER BY b.ordinal), '') AS active
          FROM raw r LEFT JOIN bound b ON b.sat_id = r.sat_id AND r.sim_time >= b.start
          GROUP BY r.sat_id, r.sim_time""",
        "detect_capacity_fade": _detected(faults)
        + _EVENT_OUT + " WHERE detector_name = 'capacity_fade'",
        "detect_stuck_sensor": _detected(faults)
        + _EVENT_OUT + " WHERE detector_name = 'stuck_sensor'",
        "detect_thermal_runaway": _detected(faults)
        + _EVENT_OUT + " WHERE detector_name = 'thermal_runaway'",
        "detect_all": _detected(faults) + _EVENT_OUT,
        "unusable_mart_rows": _with(_rollup("raw"), """
          holed AS (SELECT sat_id, minute_bucket, extract(hour FROM minute_bucket) AS h,
            CASE WHEN h <> 9 THEN battery_soc_mean END AS soc,
            CASE WHEN h = 12 THEN 'nan'::double ELSE bus_temperature_k_mean END AS temp,
            CASE WHEN h <> 12 THEN net_heat_w_mean END AS heat FROM roll),
          named AS (SELECT sat_id, minute_bucket,
            concat_ws(',', CASE WHEN soc IS NULL THEN 'battery_soc_mean' END,
              CASE WHEN temp IS NULL THEN 'bus_temperature_k_mean' END,
              CASE WHEN heat IS NULL THEN 'net_heat_w_mean' END) AS null_columns,
            concat_ws(',', CASE WHEN isnan(soc) THEN 'battery_soc_mean' END,
              CASE WHEN isnan(temp) THEN 'bus_temperature_k_mean' END,
              CASE WHEN isnan(heat) THEN 'net_heat_w_mean' END) AS nan_columns FROM holed)""")
        + "SELECT * FROM named WHERE null_columns <> '' OR nan_columns <> ''",
        "run_stats": _detected(faults) + """SELECT count(*) AS rows_consumed,
          count(DISTINCT sat_id) AS sats_processed, (SELECT count(*) FROM ev) AS events_emitted
          FROM roll""",
        "classify_events": _detected(faults, _WINDOWS, _SCORE) + f"""SELECT sat_id, detector_name,
          event_time, outcome, {_r('latency_seconds')} FROM classed""",
        "detector_scorecard": _detected(faults, _WINDOWS, _SCORE) + _SCORE_OUT,
        # Events come from the three-label data; the fourth label is only scored.
        "detector_scorecard_with_miss": _detected(
            faults,
            _bound(with_miss).replace("start_of AS", "start_all AS").replace(
                "start_of)", "start_all)").replace("bound AS", "bound_all AS"),
            _WINDOWS.replace("FROM bound)", "FROM bound_all)"),
            _SCORE,
        ) + _SCORE_OUT,
        "scorecard_summary": _detected(faults, _WINDOWS, _SCORE) + """SELECT detector_name,
          true_positives AS tp, false_positives AS fp, false_negatives AS fn,
          round(recall, 2) AS recall, round(precision, 2) AS precision,
          round(mean_latency_seconds / 60, 1) AS latency_min FROM scores ORDER BY detector_name""",
        "missed_faults": _detected(
            faults,
            _bound(with_miss).replace("start_of AS", "start_all AS").replace(
                "start_of)", "start_all)").replace("bound AS", "bound_all AS"),
            _WINDOWS.replace("FROM bound)", "FROM bound_all)"),
            _SCORE,
        ) + "SELECT sat_id, detector_name, earliest_start, n_specs FROM missed",
        "dq_model_checks": _model_checks(),
        "dq_physical_ranges": _physical_checks(),
        "dq_behaviour": _with(_STEPS) + f""", orbits AS (
            SELECT sat_id, avg(net_power_w) AS power FROM raw GROUP BY sat_id, {_ORBIT}),
          worst AS (SELECT sat_id, max(abs(power)) AS power FROM orbits GROUP BY sat_id),
          spans AS (SELECT sat_id, max(bus_temperature_k) - min(bus_temperature_k) AS dk,
            max(battery_soc) - min(battery_soc) AS ds, max(latitude_deg) - min(latitude_deg) AS dl,
            avg(CASE WHEN eclipsed THEN 1 ELSE 0 END) AS dark FROM raw GROUP BY sat_id)
          SELECT s.sat_id, soc_step_mean < 0 AS discharges_in_eclipse,
            temperature_step_mean_k < 0 AS cools_in_eclipse,
            power < 0.5 * (1361::double * 1.2 * 0.15) AS power_balanced,
            dk < 30 AS temperature_range_ok, ds > 0.02::double AS soc_range_ok,
            dark <= 0.45::double AS eclipse_fraction_ok, dl > 90 AS latitude_range_ok
          FROM spans s JOIN worst w ON w.sat_id = s.sat_id LEFT JOIN dsteps d ON d.sat_id = s.sat_id""",
        "dq_duplicate_samples": _with() + """SELECT sat_id, date_trunc('second', sim_time) AS sim_time,
          count(*) AS n_rows FROM raw GROUP BY ALL HAVING count(*) > 1""",
        "json_roundtrip": _with() + f"SELECT {_TELEMETRY_LIST} FROM raw",
        "json_message_keys": _with()
        + "SELECT sat_id AS message_key, count(*) AS n_messages FROM raw GROUP BY sat_id",
        "json_dead_letter": _with() + f"""SELECT sat_id, {_REASON} AS reject_reason,
          count(*) AS n_messages FROM raw WHERE {_US} % 10 <= 5 GROUP BY ALL""",
        "json_decoded_good": _with() + f"SELECT {_TELEMETRY_LIST} FROM raw WHERE {_US} % 10 > 5",
        "partitioned_roundtrip": _with() + f"""SELECT {_TELEMETRY_LIST},
          cast(sim_time AS date) AS date, extract(hour FROM sim_time) AS hour FROM raw""",
        "ingest_totals": _with()
        + "SELECT sat_id, count(*) AS rows_flushed FROM raw GROUP BY sat_id",
        "partition_pruned_read": _with() + f"""SELECT sat_id, sim_time_iso, {_r('battery_soc')}
          FROM raw WHERE sat_id = 'SAT-03' AND sim_time >= TIMESTAMP '1970-06-14 10:00:00'
          AND sim_time < TIMESTAMP '1970-06-14 12:30:00'""",
        "stream_ingest_table": _with() + f"SELECT {_TELEMETRY_LIST} FROM raw WHERE {_US} % 10 > 5",
        "stream_dead_letter": _with() + f"""SELECT sat_id, {_REASON} AS reject_reason,
          count(*) AS n_messages FROM raw WHERE {_US} % 10 <= 5 GROUP BY ALL""",
        "stream_rollup": _with(_rollup("raw")) + roll_out,
        "marts_refreshed_in_full": _with(_rollup("raw")) + roll_out,
        "replayed_messages": _with() + f"SELECT {_TELEMETRY_LIST} FROM raw",
        "bounded_files": _with() + "SELECT sat_id, count(*) AS n_rows, true AS bounded FROM raw GROUP BY sat_id",
        "round_trip_report": _with() + f"""SELECT sat_id, count(*) AS n_rows,
          count(DISTINCT sim_time_iso) AS n_distinct_times,
          count(*) FILTER ({_US} % 10 <> 0) AS n_rows_after,
          count(DISTINCT CASE WHEN {_US} % 10 <> 0 THEN sim_time_iso END) AS n_distinct_times_after
          FROM raw WHERE sat_id = 'SAT-03' GROUP BY sat_id""",
        "fleet_approx_distinct": _with() + "SELECT sat_id, count(*) AS n_rows, true AS close FROM raw GROUP BY sat_id",
        "label_file_windows": _with(_bound(faults), _WINDOWS)
        + "SELECT sat_id, detector_name, earliest_start, n_specs FROM wins",
        "unknown_detector_events": _detected(faults)
        + "SELECT sat_id, 'attitude' AS detector_name, sim_time_iso, severity FROM ev WHERE sat_id = 'SAT-13'",
        "stream_closed_hours": _with(_ARRIVALS) + """SELECT o.sat_id, o.hour_start, cast(sum(o.n_rows) AS bigint) AS n_rows,
          (SELECT CASE WHEN count(*) > 0 THEN greatest(min(l.batch), min(o.batch)) END FROM arr l WHERE l.sat_id = o.sat_id AND l.hour_start > o.hour_start) AS closed_by,
          count(*) FILTER (o.batch > o.first_batch AND EXISTS (SELECT 1 FROM arr e WHERE e.sat_id = o.sat_id
            AND e.batch < o.batch AND e.hour_start > o.hour_start)) AS reopened
          FROM (SELECT *, min(batch) OVER (PARTITION BY sat_id, hour_start) AS first_batch FROM arr) o GROUP BY o.sat_id, o.hour_start""",
        "stream_late_rows": _with(_ARRIVALS) + """SELECT sat_id, cast(hour_start AS date) AS date, batch, cast(sum(n_rows) AS bigint) AS n_late
          FROM arr o WHERE EXISTS (SELECT 1 FROM arr e WHERE e.sat_id = o.sat_id AND e.batch < o.batch AND e.hour_start > o.hour_start)
          GROUP BY ALL""",
        "rollup_refreshed_from_changes": _with(_rollup("raw")) + roll_out,
        "rollup_after_withdrawal": _with(_STAYED, _rollup("stayed")) + roll_out,
        "dq_checks_kept_by_day": _model_checks("raw_telemetry", "stg_geometry", "stg_eps", "stg_thermal"),
        "distinct_times_from_sketches": _with() + "SELECT sat_id, count(*) AS n_rows, true AS close FROM raw GROUP BY sat_id",
        "stream_bounded_files": _with() + "SELECT sat_id, count(*) AS n_rows, true AS bounded FROM raw GROUP BY sat_id",
        "detect_with_own_detector": _detected(faults, """hot AS (SELECT sat_id, min(minute_bucket) AS t,
            arg_min(bus_temperature_k_mean, minute_bucket) AS score FROM roll WHERE bus_temperature_k_mean - 273.15 > 20 GROUP BY sat_id)""")
        + _EVENT_OUT + f""" UNION ALL SELECT sat_id, 'hot_minute' AS detector_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS sim_time_iso,
          'info' AS severity, {_r_as('score', 'score')}, 'hot' AS description FROM hot""",
        "stream_rollup_late_rows": _with(_rollup("raw")) + roll_out,
        "stream_snapshot": _with(_SNAPSHOT) + _SNAPSHOT_OUT,
        "stream_snapshot_ties": _with(
            "hourly AS (SELECT * REPLACE (date_trunc('hour', sim_time) AS sim_time) FROM raw)",
            _SNAPSHOT.replace("FROM raw", "FROM hourly"),
        ) + _SNAPSHOT_OUT,
        "stream_ingest_counters": _with() + f"""SELECT count(*) AS messages_seen,
          count(*) FILTER ({_US} % 10 > 5) AS messages_received,
          count(*) FILTER ({_US} % 10 <= 5) AS decode_errors FROM raw""",
        "files_per_partition": _with() + """SELECT sat_id, cast(sim_time AS date) AS date,
          extract(hour FROM sim_time) AS hour, count(*) AS n_rows, true AS has_files FROM raw GROUP BY ALL""",
        "stream_detectors_events": _detected(faults) + _EVENT_OUT,
        "stream_detectors_carried": _detected(faults) + _EVENT_OUT,
        "stream_detectors_late_rows": _detected(faults) + _EVENT_OUT,
    }
    for name, (rows, columns) in inject_columns.items():
        sql[name] = (
            _with(_bound(rows), _INJECT) + f"SELECT sat_id, sim_time, {_r(*columns)} FROM inj"
        )
    return sql
