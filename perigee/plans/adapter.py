"""Telemetry derived from a generic events table.

The events table (event_id, ts, user_id, event_type, value, props) is time-series shaped
but is not telemetry. This maps each event to one telemetry record with plain arithmetic:
15 satellites, a month compressed to six hours, orbit phase from the clock, and a heat
balance that agrees with the temperature slope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee import schema as S

# The mapping constants.
TIME_COMPRESSION = 120
FLEET_SIZE = 15
ECLIPSE_PHASE_S = 3500
WARMING_PHASE_S = 2700

# The back-testing labels for this data.
FAULTS = [
    {
        "sat_id": "SAT-00",
        "fault_type": S.CAPACITY_FADE,
        "start_offset": "+00:00:00",
        "params": {"fade_rate_per_day": 0.15, "floor": 0.6},
    },
    {"sat_id": "SAT-09", "fault_type": S.STUCK_SENSOR, "start_offset": "+00:30:00"},
    {
        "sat_id": "SAT-13",
        "fault_type": S.THERMAL_RUNAWAY,
        "start_offset": "+01:00:00",
        "params": {"rate_k_per_hour": 6.0, "cap_k": 40.0},
    },
]


def read_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, as scanned."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """The 26 telemetry columns, one row per event."""
    base = events.select(
        F.expr(f"unix_micros(cast(ts as timestamp)) div {TIME_COMPRESSION}").alias("us"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("user_id") % FLEET_SIZE).alias("sat"),
        "value",
    ).withColumn("phase", F.expr(f"us div 1000000 % {S.ORBIT_SECONDS}"))
    k, phase = F.col("k"), F.col("phase")
    eclipsed = phase >= ECLIPSE_PHASE_S
    warming = phase < WARMING_PHASE_S

    def const(x: float):
        return F.lit(float(x))

    def lit_when(cond, yes: float, no: float):
        return F.when(cond, const(yes)).otherwise(const(no))

    soc = const(0.85) + (k % 10) / const(100)
    swing = F.when(warming, phase).otherwise(F.lit(S.ORBIT_SECONDS) - phase)
    kelvin = const(285) + const(0.003) * swing
    out = {
        "sat_id": F.concat(F.lit("SAT-"), F.lpad(F.col("sat").cast("string"), 2, "0")),
        "sim_time_iso": F.concat(
            F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            F.lit("+00:00"),
        ),
        "position_eci_km_x": const(6900) + k / const(10),
        "position_eci_km_y": F.col("value") % const(10),
        "position_eci_km_z": const(0),
        "velocity_eci_km_s_x": const(0),
        "velocity_eci_km_s_y": const(7.5) + k / const(1000),
        "velocity_eci_km_s_z": const(0),
        "sun_vector_eci_x": const(1),
        "sun_vector_eci_y": const(0),
        "sun_vector_eci_z": const(0),
        "eclipsed": eclipsed,
        "latitude_deg": k * const(1.8) - const(90),
        "longitude_deg": F.col("value") % const(360) - const(180),
        "altitude_km": const(500) + k,
        "solar_power_w": lit_when(eclipsed, 0, 245),
        "bus_power_w": lit_when(eclipsed, 60, 90),
        "net_power_w": lit_when(eclipsed, -60, 155),
        "battery_soc": soc,
        "battery_charge_wh": soc * const(S.BATTERY_CAPACITY_WH),
        "bus_temperature_k": kelvin,
        "bus_temperature_c": kelvin - const(S.KELVIN_OFFSET),
        "solar_heat_input_w": lit_when(eclipsed, 0, 190),
        "earth_ir_input_w": const(100),
        "radiative_heat_output_w": const(300),
        "net_heat_w": lit_when(warming, 297, -297),
    }
    return base.select(*[out[c].alias(c) for c in S.TELEMETRY_COLUMNS])
