"""Data-quality checks. Each table is checked in one aggregation pass over its rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import scalars as X
from perigee.operators import aggregates
from perigee.operators.staging import add_eps, add_geometry, add_thermal


@dataclass(frozen=True)
class Check:
    """A named row-level rule; ``violated`` is true (not null) for a violating row."""

    model: str
    column: str
    name: str
    violated: Column


def not_null(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "not_null", F.col(c).isNull()) for c in columns]


def accepted_values(model: str, column: str, values) -> Check:
    """Values outside the list violate the rule; null does not (that is not_null's job)."""
    return Check(model, column, "accepted_values", ~F.col(column).isin(*values))


def within(model: str, column: str, name: str, ok: Column) -> Check:
    """A range rule; a null value does not violate it."""
    return Check(model, column, name, ~ok)


def _counters(checks: list[Check]) -> list[Column]:
    return [F.count_if(c.violated).alias(f"_{i}") for i, c in enumerate(checks)]


def _as_rows(checks: list[Check]) -> Column:
    """The counters turned into one row per check."""
    entries = [
        F.struct(
            F.lit(c.model).alias("model"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.name).alias("check_name"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return F.inline(F.array(*entries))


def count_violations(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: model, column_name, check_name, violations.

    All counters are computed in the same scan and turned into rows afterwards.
    """
    return df.agg(*_counters(checks)).select(_as_rows(checks))


def daily_violations(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Violations of each day, one row per check and ``date``; days of one table add up (see :func:`summed`)."""
    return df.groupBy("date").agg(*_counters(checks)).select("date", _as_rows(checks))


def summed(daily: DataFrame) -> DataFrame:
    """The report over all days of :func:`daily_violations`."""
    return daily.groupBy("model", "column_name", "check_name").agg(F.sum("violations").alias("violations"))


def staged(raw: DataFrame) -> DataFrame:
    """Raw rows with the columns of all three staging models, for :func:`telemetry_checks`."""
    return add_thermal(add_eps(add_geometry(raw)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; null keys are ignored."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def unique_check(df: DataFrame, model: str, keys: list[str]) -> DataFrame:
    """The uniqueness rule in the report's shape."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(model).alias("model"),
        F.lit(", ".join(keys)).alias("column_name"),
        F.lit("unique").alias("check_name"),
        "violations",
    )


# The rules attached to each model.
def telemetry_checks() -> list[Check]:
    """Rules of the raw and the three staging models, all at telemetry grain."""
    return [
        *not_null(
            "raw_telemetry", "sat_id", "sim_time", "battery_soc", "bus_temperature_k", "eclipsed"
        ),
        *not_null("stg_geometry", "sat_id", "sim_time", "position_magnitude_km", "ground_quadrant"),
        accepted_values("stg_geometry", "ground_quadrant", S.QUADRANTS),
        *not_null("stg_eps", "sat_id", "sim_time", "battery_soc", "is_charging"),
        accepted_values("stg_eps", "is_charging", (0, 1)),
        *not_null("stg_thermal", "sat_id", "sim_time", "bus_temperature_k", "thermal_regime"),
        accepted_values("stg_thermal", "thermal_regime", S.THERMAL_REGIMES),
    ]


def rollup_checks() -> list[Check]:
    return not_null(
        "sat_minute_rollup", "sat_id", "minute_bucket", "battery_soc_mean", "eclipse_fraction"
    )


def snapshot_checks() -> list[Check]:
    return [
        *not_null(
            "fleet_health_snapshot",
            "sat_id",
            "latest_sim_time",
            "battery_health_band",
            "thermal_health_band",
        ),
        accepted_values("fleet_health_snapshot", "battery_health_band", S.HEALTH_BANDS),
        accepted_values("fleet_health_snapshot", "thermal_health_band", S.HEALTH_BANDS),
    ]


def model_report(raw: DataFrame, rollup: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The 31 model checks. Staging columns are derived on the raw rows: one scan for all."""
    return (
        count_violations(staged(raw), telemetry_checks())
        .unionByName(count_violations(rollup, rollup_checks()))
        .unionByName(count_violations(snapshot, snapshot_checks()))
        .unionByName(unique_check(snapshot, "fleet_health_snapshot", ["sat_id"]))
    )


def physical_checks() -> list[Check]:
    """Channel envelopes, unit sun vector, and agreement of the two temperature units."""
    m = "raw_telemetry"
    soc, k, c = F.col("battery_soc"), F.col("bus_temperature_k"), F.col("bus_temperature_c")
    r = X.norm(*[F.col(f"position_eci_km_{a}") for a in "xyz"])
    sun = X.norm(*[F.col(f"sun_vector_eci_{a}") for a in "xyz"])
    alt = F.col("altitude_km")
    # Limits of each channel.
    return [
        within(m, "battery_soc", "soc_range", (soc >= 0.20) & (soc <= 1.00)),
        within(m, "bus_temperature_k", "temperature_range", (k > 240.0) & (k < 330.0)),
        within(m, "position_eci_km", "orbit_radius", (r > 6700.0) & (r < 7200.0)),
        within(m, "altitude_km", "altitude_range", (alt > 300.0) & (alt < 800.0)),
        within(m, "latitude_deg", "latitude_range", F.abs("latitude_deg") <= 97.5),
        within(m, "sun_vector_eci", "unit_length", F.abs(sun - 1.0) < 1e-6),
        within(
            m, "bus_temperature_c", "celsius_matches_kelvin",
            F.abs(c - X.kelvin_to_celsius(k)) < 1e-6,
        ),
    ]


def physical_report(raw: DataFrame) -> DataFrame:
    return count_violations(raw, physical_checks())


def behaviour_report(raw: DataFrame) -> DataFrame:
    """Per satellite: do the channels behave together as physics says? One flag per rule.

    A rule that a satellite's data cannot answer (no eclipse rows) passes as null.
    """
    orbit = aggregates.orbit_number(F.col("sim_time")).alias("orbit")
    swings = ["bus_temperature_k", "battery_soc", "latitude_deg"]
    per_orbit = raw.groupBy("sat_id", orbit).agg(
        F.avg("net_power_w").alias("power"),
        F.count_if("eclipsed").alias("dark"),
        F.count(F.lit(1)).alias("n"),
        *[F.max(c).alias(f"max_{c}") for c in swings],
        *[F.min(c).alias(f"min_{c}") for c in swings],
    )
    per_sat = per_orbit.groupBy("sat_id").agg(
        F.max(F.abs("power")).alias("worst_orbit_power_w"),
        (F.sum("dark") / F.sum("n")).alias("eclipse_fraction"),
        *[(F.max(f"max_{c}") - F.min(f"min_{c}")).alias(f"range_{c}") for c in swings],
    )
    measured = per_sat.join(aggregates.eclipse_delta_means(raw), "sat_id")
    # Limits of each rule.
    return measured.select(
        "sat_id",
        (F.col("soc_step_mean") < 0).alias("discharges_in_eclipse"),
        (F.col("temperature_step_mean_k") < 0).alias("cools_in_eclipse"),
        (F.col("worst_orbit_power_w") < 0.5 * S.PEAK_GENERATION_W).alias("power_balanced"),
        (F.col("range_bus_temperature_k") < 30.0).alias("temperature_range_ok"),
        (F.col("range_battery_soc") > 0.02).alias("soc_range_ok"),
        (F.col("eclipse_fraction") <= 0.45).alias("eclipse_fraction_ok"),
        (F.col("range_latitude_deg") > 90.0).alias("latitude_range_ok"),
    )


def round_trip_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Satellites whose row or distinct-time counts differ between two tables."""
    b = aggregates.row_counts(before)
    a = aggregates.row_counts(after).select(
        "sat_id",
        F.col("n_rows").alias("n_rows_after"),
        F.col("n_distinct_times").alias("n_distinct_times_after"),
    )
    same = F.col("n_rows").eqNullSafe(F.col("n_rows_after")) & F.col(
        "n_distinct_times"
    ).eqNullSafe(F.col("n_distinct_times_after"))
    return b.join(a, "sat_id", "full").where(~same)
