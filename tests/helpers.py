"""Small builders of telemetry, mart rows and labels for tests."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pyarrow as pa

from perigee import schema as S

T0 = datetime(2031, 3, 9, 5, 0, 0, tzinfo=UTC)

# One quiet satellite state; numbers are arbitrary but distinct, so that swapped columns show.
_AXES = {"position_eci_km": (-4100.0, 5200.0, 1350.0), "velocity_eci_km_s": (-5.1, -4.4, 3.25), "sun_vector_eci": (0.36, 0.48, 0.8)}
NOMINAL = {f"{stem}_{axis}": value for stem, values in _AXES.items() for axis, value in zip("xyz", values, strict=True)} | {
    "eclipsed": False,
    "latitude_deg": 11.5,
    "longitude_deg": -73.25,
    "altitude_km": 412.0,
    "solar_power_w": 171.0,
    "bus_power_w": 58.0,
    "net_power_w": 113.0,
    "battery_soc": 0.62,
    "battery_charge_wh": 93.0,
    "bus_temperature_k": 301.0,
    "bus_temperature_c": 27.85,
    "solar_heat_input_w": 140.0,
    "earth_ir_input_w": 77.0,
    "radiative_heat_output_w": 217.5,
    "net_heat_w": -0.5,
}


def record(sat: str = "BIRD-1", at: datetime = T0, **over) -> dict:
    return {"sat_id": sat, "sim_time_iso": at.isoformat(), **NOMINAL, **over}


_ARROW = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}


def telemetry(spark, records: list[dict]):
    fields = [(f.name, _ARROW[f.dataType.simpleString()]) for f in S.TELEMETRY_SCHEMA.fields]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=pa.schema(fields)))


def mart(spark, samples: list[dict]):
    """Detector input: sat, minute number, soc, temp_k, heat (with quiet defaults)."""
    rows = [
        {
            "sat_id": s.get("sat", "SAT-1"),
            "minute_bucket": datetime(2033, 2, 7, tzinfo=UTC) + timedelta(minutes=s["minute"]),
            "battery_soc_mean": s.get("soc", 0.8),
            "bus_temperature_k_mean": s.get("temp_k", 288.0),
            "net_heat_w_mean": s.get("heat", 0.25),
        }
        for s in samples
    ]
    fields = pa.schema(
        [
            ("sat_id", pa.string()),
            ("minute_bucket", pa.timestamp("us", tz="UTC")),
            ("battery_soc_mean", pa.float64()),
            ("bus_temperature_k_mean", pa.float64()),
            ("net_heat_w_mean", pa.float64()),
        ]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=fields))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
