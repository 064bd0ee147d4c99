"""Dashboard reads over the marts and the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions import scalars as X
from perigee.operators.aggregates import sat_picker
from perigee.sources.telemetry import for_satellite

FLEET_COLUMNS = [
    "sat_id",
    "latest_sim_time",
    "battery_soc",
    "bus_temperature_c",
    "battery_health_band",
    "thermal_health_band",
    "eclipsed",
    "latitude_deg",
    "longitude_deg",
    "altitude_km",
]


def fleet_view(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(*FLEET_COLUMNS).orderBy("sat_id")


def _series(rollup: DataFrame, sat_id: str, value) -> DataFrame:
    time = F.col("minute_bucket").alias("time")
    return for_satellite(rollup, sat_id).select(time, value).orderBy("time")


def soc_series(rollup: DataFrame, sat_id: str) -> DataFrame:
    return _series(rollup, sat_id, F.col("battery_soc_mean"))


def temperature_series(rollup: DataFrame, sat_id: str) -> DataFrame:
    celsius = X.kelvin_to_celsius(F.col("bus_temperature_k_mean"))
    return _series(rollup, sat_id, celsius.alias("temp_c"))


def net_power_series(rollup: DataFrame, sat_id: str) -> DataFrame:
    return _series(rollup, sat_id, F.col("net_power_w_mean"))


def eclipse_series(rollup: DataFrame, sat_id: str) -> DataFrame:
    return _series(rollup, sat_id, F.col("eclipse_fraction"))


def satellite_events(events: DataFrame, sat_id: str, limit: int = 20) -> DataFrame:
    """Newest events of one satellite; equal times are ordered by detector name."""
    return (
        for_satellite(events, sat_id)
        .select("sim_time_iso", "detector_name", "severity", "score", "description")
        .orderBy(F.col("sim_time_iso").desc(), "detector_name")
        .limit(limit)
    )


def anomaly_feed(events: DataFrame, limit: int = 100) -> DataFrame:
    """Newest events of the fleet; equal times are ordered by satellite and detector."""
    return (
        events.select("sim_time_iso", "sat_id", "detector_name", "severity", "score", "description")
        .orderBy(F.col("sim_time_iso").desc(), "sat_id", "detector_name")
        .limit(limit)
    )


def satellite_names(rollup: DataFrame) -> DataFrame:
    return sat_picker(rollup)


def annotated_series(rollup: DataFrame, events: DataFrame, sat_id: str) -> DataFrame:
    """A satellite's minute series with the detector that fired in each minute, if any."""
    minute = X.parse_iso(F.col("sim_time_iso"))
    marks = for_satellite(events, sat_id).select(
        F.date_trunc("minute", minute).alias("minute_bucket"), "detector_name", "severity", "score"
    )
    return (
        for_satellite(rollup, sat_id)
        .join(marks, "minute_bucket", "left")
        .select(
            F.col("minute_bucket").alias("time"),
            "battery_soc_mean",
            X.kelvin_to_celsius(F.col("bus_temperature_k_mean")).alias("temp_c"),
            "net_power_w_mean",
            "eclipse_fraction",
            "detector_name",
            "severity",
            "score",
        )
        .orderBy("time", "detector_name")
    )
