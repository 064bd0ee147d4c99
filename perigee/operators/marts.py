"""Minute rollup and latest-state snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions import exact
from perigee.functions import scalars as X
from perigee.operators.staging import add_eps, add_geometry


def _holds(flag: str) -> Column:
    """Whether a flag holds; a null flag counts as not holding."""
    return F.col(flag).cast("int") == 1


# Mean measures of the rollup and the columns they average.
MEANS = {
    "battery_soc_mean": "battery_soc",
    "solar_power_w_mean": "solar_power_w",
    "bus_power_w_mean": "bus_power_w",
    "net_power_w_mean": "net_power_w",
    "bus_temperature_k_mean": "bus_temperature_k",
    "net_heat_w_mean": "net_heat_w",
    "altitude_km_mean": "altitude_km",
    "position_magnitude_km_mean": "position_magnitude_km",
    "orbital_speed_km_s_mean": "orbital_speed_km_s",
}
SHARES = {"charging_fraction": "is_charging", "eclipse_fraction": "eclipsed"}
EXTREMES = ("battery_soc", "bus_temperature_k")
BOUNDS = {"min": F.min, "max": F.max}
ROLLUP_MEASURES = [
    "battery_soc_mean",
    "battery_soc_min",
    "battery_soc_max",
    "solar_power_w_mean",
    "bus_power_w_mean",
    "net_power_w_mean",
    "charging_fraction",
    "bus_temperature_k_mean",
    "bus_temperature_k_min",
    "bus_temperature_k_max",
    "net_heat_w_mean",
    "eclipse_fraction",
    "altitude_km_mean",
    "position_magnitude_km_mean",
    "orbital_speed_km_s_mean",
]


def rollup_input(raw: DataFrame) -> DataFrame:
    """Rows the rollup aggregates: every subsystem's columns side by side."""
    return add_geometry(add_eps(raw.where(F.col("sat_id").isNotNull())))


def rollup_sums(rows: DataFrame, measures: Sequence[str] = ROLLUP_MEASURES) -> DataFrame:
    """Exact, mergeable sums behind the measures: see :func:`merged_sums` and :func:`from_sums`.

    Groups are (sat_id, minute_bucket, slot): slot is null for the minute's own row; other rows
    hold digits of far values (see :mod:`perigee.functions.exact`). Values that are not finite are
    summed apart; if there are any, they make the mean. Rows without a time belong to no minute:
    their group is dropped by its count, since a null filter would be pushed down to the scan and
    parse every time text once more.
    """
    means = [m for m in measures if m in MEANS]
    minute = F.date_trunc("minute", F.col("sim_time"))
    split = exact.with_digits(rows.withColumn("minute_bucket", minute), {m: MEANS[m] for m in means}, list(MEANS).index)
    own = F.col("slot").isNull()
    out = [F.count_if(own).alias("n_rows"), F.sum("amount").alias("amount"), F.count("minute_bucket").alias("_timed")]
    for m in means:
        x = F.col(MEANS[m])
        odd = F.isnan(x) | (F.abs(x) == float("inf"))
        out += [F.sum(F.when(own, F.col(f"{m}_{d}"))).alias(f"{m}_{d}") for d in exact.DIGITS]
        out += [F.count(F.when(own, x)).alias(f"{m}_n"), F.sum(F.when(own & odd, x)).alias(f"{m}_odd")]
    out += [F.count(F.when(own & _holds(c), 1)).alias(f"{m}_n") for m, c in SHARES.items() if m in measures]
    out += [f(F.when(own, F.col(c))).alias(f"{c}_{n}") for c in EXTREMES for n, f in BOUNDS.items() if f"{c}_{n}" in measures]
    return split.groupBy("sat_id", "minute_bucket", "slot").agg(*out).where(F.col("_timed") > 0).drop("_timed")


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums of sums: what several parts of the rows of a minute add up to, in whatever order."""
    lowest = {f"{c}_min" for c in EXTREMES}
    highest = {f"{c}_max" for c in EXTREMES}
    merge = lambda c: F.min(c) if c in lowest else F.max(c) if c in highest else F.sum(c)
    names = [c for c in SUMS_COLUMNS if c in sums.columns]
    return sums.groupBy("sat_id", "minute_bucket", "slot").agg(*[merge(c).alias(c) for c in names])


SUMS_COLUMNS = ["n_rows", "amount"]
for _m in ROLLUP_MEASURES:
    SUMS_COLUMNS += [f"{_m}_{d}" for d in (*exact.DIGITS, "n", "odd")] if _m in MEANS else [f"{_m}_n"] if _m in SHARES else [_m]


def from_sums(sums: DataFrame, measures: Sequence[str] = ROLLUP_MEASURES) -> DataFrame:
    """The rollup of a table of sums, one row per satellite and minute.

    The rows of far values, usually none, join their minute's row. Both come from one
    aggregation: they are told apart by a count, as a filter on the slot would be pushed below it
    and have the input read twice.
    """
    keys = ["sat_id", "minute_bucket"]
    far = sums.where(F.col("n_rows") == 0).groupBy(*keys).agg(F.collect_list(F.struct("slot", "amount")).alias("far"))
    means = [m for m in measures if m in MEANS]
    rows, found = sums.where(F.col("n_rows") > 0), {}
    if means:
        rows, found = exact.means_of_digits(rows.drop("slot", "amount").join(far, keys, "left"), means, "far", list(MEANS).index)
    columns = []
    for m in measures:
        if m in MEANS:
            columns.append(F.when(F.col(f"{m}_odd").isNotNull(), F.col(f"{m}_odd")).otherwise(found[m]).alias(m))
        else:
            columns.append((F.col(f"{m}_n") / F.col("n_rows")).alias(m) if m in SHARES else F.col(m))
    return rows.select(*keys, *columns)


def sat_minute_rollup(raw: DataFrame, measures: Sequence[str] = ROLLUP_MEASURES) -> DataFrame:
    """Per-satellite, per-minute aggregates in a single pass over the raw view.

    The three subsystem views are projections of the same rows, so joining them back on
    (sat_id, sim_time) would only rebuild what one row already holds. Aggregation is
    partial on the map side, so a satellite with a large share of the rows is reduced to
    its minutes before the shuffle. ``measures`` may name those wanted; only their columns are read.
    """
    return from_sums(rollup_sums(rollup_input(raw), measures), measures)


def rollup_from_subsystems(eps: DataFrame, thermal: DataFrame, geometry: DataFrame) -> DataFrame:
    """The same rollup for subsystem tables that come from different sources.

    An inner join on (sat_id, sim_time); both columns together spread any one satellite
    over all partitions.
    """
    keys = ["sat_id", "sim_time"]
    joined = (
        eps.select(
            *keys, "eclipsed", "battery_soc", "solar_power_w", "bus_power_w", "net_power_w",
            "is_charging",
        )
        .join(thermal.select(*keys, "bus_temperature_k", "net_heat_w"), keys)
        .join(
            geometry.select(*keys, "altitude_km", "position_magnitude_km", "orbital_speed_km_s"),
            keys,
        )
    )
    return from_sums(rollup_sums(joined))


SNAPSHOT_COLUMNS = [
    "sat_id",
    "latest_sim_time",
    "battery_soc",
    "bus_temperature_k",
    "bus_temperature_c",
    "eclipsed",
    "latitude_deg",
    "longitude_deg",
    "altitude_km",
    "solar_power_w",
    "net_power_w",
    "battery_health_band",
    "thermal_health_band",
]


def with_bands(state: DataFrame) -> DataFrame:
    """Add the two health bands to per-satellite state rows."""
    return state.withColumns(
        {
            "battery_health_band": X.battery_band(F.col("battery_soc")),
            "thermal_health_band": X.thermal_band(F.col("bus_temperature_c")),
        }
    )


def fleet_health_snapshot(raw: DataFrame) -> DataFrame:
    """Latest state per satellite with health bands; rows tied on the latest time all stay.

    A hash aggregation of two columns finds each satellite's latest time, one row per
    satellite, which then selects its rows by a join. Spark broadcasts those times if their
    measured size allows; nothing is sorted for that, and no history is gathered.
    """
    state = raw.where(F.col("sat_id").isNotNull() & F.col("sim_time").isNotNull()).select(
        F.col("sim_time").alias("latest_sim_time"),
        *[c for c in SNAPSHOT_COLUMNS if c != "latest_sim_time" and not c.endswith("_band")],
    )
    newest = state.groupBy("sat_id").agg(F.max("latest_sim_time").alias("latest_sim_time"))
    return with_bands(state.join(newest, ["sat_id", "latest_sim_time"])).select(*SNAPSHOT_COLUMNS)
