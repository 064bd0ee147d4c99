"""Table schemas and fixed domain values shared by every reader, operator and check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The telemetry record, in wire and table order.
_TELEMETRY_FIELDS = [
    ("sat_id", T.StringType()),
    ("sim_time_iso", T.StringType()),
    ("position_eci_km_x", T.DoubleType()),
    ("position_eci_km_y", T.DoubleType()),
    ("position_eci_km_z", T.DoubleType()),
    ("velocity_eci_km_s_x", T.DoubleType()),
    ("velocity_eci_km_s_y", T.DoubleType()),
    ("velocity_eci_km_s_z", T.DoubleType()),
    ("sun_vector_eci_x", T.DoubleType()),
    ("sun_vector_eci_y", T.DoubleType()),
    ("sun_vector_eci_z", T.DoubleType()),
    ("eclipsed", T.BooleanType()),
    ("latitude_deg", T.DoubleType()),
    ("longitude_deg", T.DoubleType()),
    ("altitude_km", T.DoubleType()),
    ("solar_power_w", T.DoubleType()),
    ("bus_power_w", T.DoubleType()),
    ("net_power_w", T.DoubleType()),
    ("battery_soc", T.DoubleType()),
    ("battery_charge_wh", T.DoubleType()),
    ("bus_temperature_k", T.DoubleType()),
    ("bus_temperature_c", T.DoubleType()),
    ("solar_heat_input_w", T.DoubleType()),
    ("earth_ir_input_w", T.DoubleType()),
    ("radiative_heat_output_w", T.DoubleType()),
    ("net_heat_w", T.DoubleType()),
]

# Every field is required. Spark relaxes nullability on file reads, so required-ness is
# enforced at decode time and by the not-null checks rather than by this flag alone.
TELEMETRY_SCHEMA = T.StructType([T.StructField(n, t, False) for n, t in _TELEMETRY_FIELDS])
TELEMETRY_COLUMNS = TELEMETRY_SCHEMA.fieldNames()

# Directory levels of the stored telemetry table: sat_id=<id>/date=<yyyy-MM-dd>/hour=<HH>.
PARTITION_COLUMNS = ["sat_id", "date", "hour"]
STORED_TELEMETRY_SCHEMA = T.StructType(
    TELEMETRY_SCHEMA.fields
    + [T.StructField("date", T.DateType(), True), T.StructField("hour", T.IntegerType(), True)]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sat_id", T.StringType(), False),
        T.StructField("detector_name", T.StringType(), False),
        T.StructField("sim_time_iso", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("description", T.StringType(), False),
    ]
)

# Ordinal keeps the order in which labels were listed; layered faults depend on it.
LABEL_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType(), True),
        T.StructField("sat_id", T.StringType(), True),
        T.StructField("fault_type", T.StringType(), True),
        T.StructField("start_iso", T.StringType(), True),
        T.StructField("start_offset", T.StringType(), True),
        T.StructField("params", T.MapType(T.StringType(), T.DoubleType()), True),
    ]
)

# Enumerations.
SEVERITIES = ("info", "warning", "critical")
CAPACITY_FADE = "battery_capacity_fade"
STUCK_SENSOR = "stuck_temperature_sensor"
THERMAL_RUNAWAY = "thermal_runaway"
FAULT_TYPES = (CAPACITY_FADE, STUCK_SENSOR, THERMAL_RUNAWAY)
DETECTOR_FOR_FAULT = {
    CAPACITY_FADE: "capacity_fade",
    STUCK_SENSOR: "stuck_sensor",
    THERMAL_RUNAWAY: "thermal_runaway",
}
DETECTORS = tuple(DETECTOR_FOR_FAULT.values())
QUADRANTS = ("NE", "NW", "SE", "SW")
THERMAL_REGIMES = ("warming", "cooling", "steady")
HEALTH_BANDS = ("critical", "degraded", "nominal")

# Physical constants and limits.
KELVIN_OFFSET = 273.15
ORBIT_SECONDS = 5400
BATTERY_CAPACITY_WH = 150.0
BUS_HEAT_CAPACITY_J_PER_K = 110.0 * 900.0
PEAK_GENERATION_W = 1361.0 * 1.2 * 0.15  # solar flux x array area x efficiency

# The topic name telemetry is published under.
TELEMETRY_TOPIC = "telemetry.raw"


def schema_problems(df: DataFrame, expected: T.StructType = TELEMETRY_SCHEMA) -> list[str]:
    """Differences between a DataFrame's columns and the expected schema, as messages.

    Extra columns are allowed (partition columns, derived columns); missing or retyped
    ones are not. Only schema metadata is read.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in actual:
            problems.append(f"missing column {field.name}")
        elif actual[field.name] != field.dataType:
            problems.append(
                f"column {field.name} is {actual[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    return problems


def require_schema(df: DataFrame, expected: T.StructType = TELEMETRY_SCHEMA) -> DataFrame:
    """Return ``df`` unchanged, or raise TypeError naming every schema difference."""
    problems = schema_problems(df, expected)
    if problems:
        raise TypeError("schema drift: " + "; ".join(problems))
    return df
