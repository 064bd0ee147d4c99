"""Fault labels: validation, binding to a start time, and injection into telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import scalars as X
from perigee.functions.joins import is_small, join_keyed


def label_problems(labels: DataFrame) -> DataFrame:
    """Labels with a ``problem`` column: null when valid, else what is wrong."""
    has_iso = F.col("start_iso").isNotNull()
    has_offset = F.col("start_offset").isNotNull()
    known = F.coalesce(F.col("fault_type").isin(*S.FAULT_TYPES), F.lit(False))
    problem = (
        F.when(F.col("sat_id").isNull(), F.lit("sat_id is missing"))
        .when(
            has_iso == has_offset,
            F.concat(
                F.lit("label of "),
                F.col("sat_id"),
                F.lit(": give start_iso or start_offset, and not both"),
            ),
        )
        .when(
            ~known,
            F.concat(F.lit("unknown fault_type "), F.coalesce("fault_type", F.lit("null"))),
        )
        .when(
            has_offset & X.offset_seconds(F.col("start_offset")).isNull(),
            F.concat(F.lit("bad start_offset "), F.col("start_offset")),
        )
        .when(
            has_iso & X.try_parse_iso(F.col("start_iso")).isNull(),
            F.concat(F.lit("bad start_iso "), F.col("start_iso")),
        )
    )
    return labels.withColumn("problem", problem)


def validated(labels: DataFrame) -> DataFrame:
    """The labels unchanged; the job fails with the first problem's text if any is invalid."""
    checked = label_problems(labels)
    sat = F.when(F.col("problem").isNull(), F.col("sat_id")).otherwise(
        F.raise_error(F.col("problem"))
    )
    return checked.withColumn("sat_id", sat).drop("problem")


def bind_labels(labels: DataFrame, sim_start: DataFrame | Column) -> DataFrame:
    """Add ``start``: the absolute start, or ``sim_start`` plus the relative offset.

    ``sim_start`` is a timestamp column expression or a one-row, one-column DataFrame,
    which is used as a scalar subquery.
    """
    base = sim_start.scalar() if isinstance(sim_start, DataFrame) else sim_start
    absolute = X.parse_iso(F.col("start_iso"))
    relative = X.shift_seconds(base, X.offset_seconds(F.col("start_offset")))
    return labels.withColumn("start", F.coalesce(absolute, relative))


def _elapsed(label: Column) -> Column:
    """Seconds since a label's start at the row's time."""
    return (F.col("_us") - label["start_us"]) / F.lit(1e6)


def _is_active(label: Column) -> Column:
    return F.col("_us") >= label["start_us"]


def _runaway_bias(label: Column) -> Column:
    hours = _elapsed(label) / F.lit(3600.0)
    return F.least(label["cap"], label["rate"] * F.greatest(F.lit(0.0), hours))


def _fade_factor(label: Column) -> Column:
    days = _elapsed(label) / F.lit(86400.0)
    return F.greatest(label["floor"], F.lit(1.0) - label["rate"] * F.greatest(F.lit(0.0), days))


def _ordered_labels(bound: DataFrame) -> DataFrame:
    """One row per labelled satellite: its labels in list order, fades apart from the rest.

    ``_fades`` scale charge and ``_thermals`` change temperature; the two never interact.
    Also when each group first becomes active, so that earlier rows skip it. Labels are a
    hand-written configuration; a satellite has a few of them.
    """
    kind, params = F.col("fault_type"), F.col("params")
    start = F.unix_micros("start")
    # Parameter names and defaults.
    fade = F.struct(
        "ordinal",
        start.alias("start_us"),
        X.param(params, "fade_rate_per_day", 0.02).alias("rate"),
        X.param(params, "floor", 0.5).alias("floor"),
    )
    thermal = F.struct(
        "ordinal",
        start.alias("start_us"),
        (kind == S.STUCK_SENSOR).alias("sticks"),
        X.param(params, "rate_k_per_hour", 2.0).alias("rate"),
        X.param(params, "cap_k", 50.0).alias("cap"),
    )
    is_fade = kind == S.CAPACITY_FADE
    return bound.groupBy("sat_id").agg(
        F.array_sort(F.collect_list(F.when(is_fade, fade))).alias("_fades"),
        F.array_sort(F.collect_list(F.when(~is_fade, thermal))).alias("_thermals"),
        F.min(F.when(is_fade, start)).alias("_fade_us"),
        F.min(F.when(~is_fade, start)).alias("_thermal_us"),
        F.min(F.when(kind == S.STUCK_SENSOR, start)).alias("_stuck_us"),
    )


def _held_temperatures(raw: DataFrame, labelled: DataFrame, labels_fit: bool) -> DataFrame:
    """Per satellite, the temperature its stuck sensor freezes at.

    That is the value at the first row where any stuck label is active, with the biases of
    active labels listed before the first active stuck label already applied. The first
    row is found by a map-side combined aggregation, so a satellite with many rows sends
    one row per input partition.
    """
    stuck = labelled.where(F.col("_stuck_us").isNotNull())
    us = F.unix_micros("sim_time")
    first = (
        join_keyed(
            raw.select("sat_id", us.alias("_us"), F.col("bus_temperature_k").alias("_k")),
            stuck.select("sat_id", "_stuck_us"),
            "sat_id",
            "inner",
            F.col("_us"),
            labels_fit,
        )
        .where(F.col("_us") >= F.col("_stuck_us"))
        .groupBy("sat_id")
        .agg(F.min_by("_k", "_us").alias("_k"), F.min("_us").alias("_us"))
    )

    def step(acc: Column, label: Column) -> Column:
        warmer = _is_active(label) & ~label["sticks"] & ~acc["frozen"]
        return F.struct(
            F.when(warmer, acc["k"] + _runaway_bias(label)).otherwise(acc["k"]).alias("k"),
            (acc["frozen"] | (_is_active(label) & label["sticks"])).alias("frozen"),
        )

    start = F.struct(F.col("_k").alias("k"), F.lit(False).alias("frozen"))
    frozen_at = F.aggregate("_thermals", start, step)["k"]
    return first.join(stuck.select("sat_id", "_thermals"), "sat_id").select(
        "sat_id", frozen_at.alias("_held")
    )


def inject(raw: DataFrame, bound: DataFrame) -> DataFrame:
    """Telemetry as it would be observed under the bound labels; columns unchanged.

    Labels of one satellite layer in list order: a fade scales charge, a stuck sensor pins
    the temperature, a runaway adds a growing bias. Rows of satellites without labels, and
    rows before a label's start, pass through untouched.
    """
    labels_fit = is_small(bound)
    ordered = _ordered_labels(bound)
    held = _held_temperatures(raw, ordered, labels_fit)
    labelled = ordered.join(held, "sat_id", "left").drop("_stuck_us")
    timed = raw.withColumn("_us", F.unix_micros("sim_time"))
    rows = join_keyed(timed, labelled, "sat_id", "left", F.col("sim_time"), labels_fit)

    def faded(acc: Column, label: Column) -> Column:
        return F.when(_is_active(label), acc * _fade_factor(label)).otherwise(acc)

    def heated(acc: Column, label: Column) -> Column:
        return (
            F.when(~_is_active(label), acc)
            .when(label["sticks"], F.col("_held"))
            .otherwise(acc + _runaway_bias(label))
        )

    def fold(labels: str, start: Column, step) -> Column:
        """Fold over the labels; the usual single label needs no loop and is compiled."""
        one = step(start, F.element_at(labels, 1))
        return F.when(F.size(labels) == 1, one).otherwise(F.aggregate(labels, start, step))

    k = F.col("bus_temperature_k")
    fading = F.col("_us") >= F.col("_fade_us")
    heating = F.col("_us") >= F.col("_thermal_us")
    rows = rows.withColumns(
        {
            "_factor": F.when(fading, fold("_fades", F.lit(1.0), faded)),
            "_observed_k": F.when(heating, fold("_thermals", k, heated)),
        }
    )

    def scaled(c: str) -> Column:
        return F.coalesce(F.col(c) * F.col("_factor"), F.col(c))

    observed = {
        "battery_soc": scaled("battery_soc"),
        "battery_charge_wh": scaled("battery_charge_wh"),
        "bus_temperature_k": F.coalesce("_observed_k", "bus_temperature_k"),
        "bus_temperature_c": F.coalesce(
            X.kelvin_to_celsius(F.col("_observed_k")), F.col("bus_temperature_c")
        ),
    }
    return rows.withColumns(observed).select(*raw.columns)


def active_labels(raw: DataFrame, bound: DataFrame) -> DataFrame:
    """Telemetry keys with the ordinals of the labels active at that time, in list order."""
    per_sat = bound.groupBy("sat_id").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "start"))).alias("_labels")
    )
    rows = join_keyed(
        raw.select("sat_id", "sim_time"),
        per_sat,
        "sat_id",
        "left",
        F.col("sim_time"),
        is_small(bound),
    )
    active = F.filter("_labels", lambda x: F.col("sim_time") >= x["start"])
    ordinals = F.transform(active, lambda x: x["ordinal"])
    return rows.select(
        "sat_id", "sim_time", F.coalesce(ordinals, F.array().cast("array<int>")).alias("active")
    )
