"""Typed raw view and the per-subsystem views derived from it. No shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import scalars as X


def _raw_columns(cast) -> list[Column]:
    typed = [
        cast(F.col(f.name), f.dataType.simpleString()).alias(f.name)
        for f in S.TELEMETRY_SCHEMA.fields
    ]
    sim_time = cast(F.col("sim_time_iso"), "timestamp").alias("sim_time")
    return typed[:2] + [sim_time] + typed[2:]


def raw_telemetry(stored: DataFrame) -> DataFrame:
    """The 26 telemetry columns with explicit types, plus the parsed ``sim_time``."""
    return stored.select(*_raw_columns(lambda c, t: c.cast(t)))


def raw_telemetry_lenient(stored: DataFrame) -> DataFrame:
    """Like :func:`raw_telemetry`, but a value that cannot be cast becomes null.

    For quality reports over suspect data; the strict view fails the job instead.
    """
    return stored.select(*_raw_columns(lambda c, t: c.try_cast(t)))


def add_geometry(raw: DataFrame) -> DataFrame:
    p = [F.col(f"position_eci_km_{a}") for a in "xyz"]
    v = [F.col(f"velocity_eci_km_s_{a}") for a in "xyz"]
    return raw.withColumns(
        {
            "position_magnitude_km": X.norm(*p),
            "orbital_speed_km_s": X.norm(*v),
            "ground_quadrant": X.ground_quadrant(F.col("latitude_deg"), F.col("longitude_deg")),
        }
    )


def add_eps(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "is_charging": F.when(F.col("net_power_w") > 0, 1).otherwise(0),
            "sim_hour": F.hour("sim_time").cast("bigint"),
            "seconds_into_orbit": X.seconds_into_orbit(F.col("sim_time")),
        }
    )


def add_thermal(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "total_heat_input_w": F.col("solar_heat_input_w") + F.col("earth_ir_input_w"),
            "thermal_regime": X.thermal_regime(F.col("net_heat_w")),
        }
    )


def stg_geometry(raw: DataFrame) -> DataFrame:
    """Orbit geometry per tick: vector lengths and ground quadrant."""
    return add_geometry(raw).select(
        "sat_id",
        "sim_time",
        "sim_time_iso",
        *[f"position_eci_km_{a}" for a in "xyz"],
        *[f"velocity_eci_km_s_{a}" for a in "xyz"],
        *[f"sun_vector_eci_{a}" for a in "xyz"],
        "eclipsed",
        "latitude_deg",
        "longitude_deg",
        "altitude_km",
        "position_magnitude_km",
        "orbital_speed_km_s",
        "ground_quadrant",
    )


def stg_eps(raw: DataFrame) -> DataFrame:
    """Electrical power per tick: charging flag, hour of day, position in the orbit."""
    return add_eps(raw).select(
        "sat_id",
        "sim_time",
        "eclipsed",
        "solar_power_w",
        "bus_power_w",
        "net_power_w",
        "battery_soc",
        "battery_charge_wh",
        "is_charging",
        "sim_hour",
        "seconds_into_orbit",
    )


def stg_thermal(raw: DataFrame) -> DataFrame:
    """Thermal state per tick: total heat input and warming/cooling regime."""
    return add_thermal(raw).select(
        "sat_id",
        "sim_time",
        "eclipsed",
        "bus_temperature_k",
        "bus_temperature_c",
        "solar_heat_input_w",
        "earth_ir_input_w",
        "radiative_heat_output_w",
        "net_heat_w",
        "total_heat_input_w",
        "thermal_regime",
    )
