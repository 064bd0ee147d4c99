"""Anomaly detectors over the minute mart, as window expressions on bounded blocks.

All detectors read one ordered history per satellite. They share one pass: rows are
numbered, split into blocks with a look-back halo, and every detector's signal is computed
by windows with the same partitioning and order, hence one shuffle and one sort. What a
block needs from earlier blocks (running cumulative sums, the last reset of a run counter)
travels in a one-row-per-block table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import scalars as X
from perigee.functions.sequence import BLOCK_ROWS, before, in_block, number_rows, split_blocks


# Event severities and texts (printf formats, for Spark and Python alike).
SEVERITY = {"capacity_fade": "warning", "stuck_sensor": "critical", "thermal_runaway": "critical"}
EVENT_TEXT = {
    "capacity_fade": (
        "Battery SoC ceiling drifted by %.3f from baseline %.3f; consistent with capacity fade."
    ),
    "stuck_sensor": (
        "Temperature held while heat balance predicts movement; "
        "residual %.2f K sustained for %d minutes."
    ),
    "thermal_runaway": (
        "Bus temperature %.1f C exceeds ceiling %.1f C with positive slope %.2f K/min."
    ),
}


# Default detector parameters.
@dataclass(frozen=True)
class CapacityFade:
    """Cumulative drop of the rolling charge ceiling below its first full-window level."""

    threshold: float = 0.10
    slack: float = 0.001
    window: int = 90


@dataclass(frozen=True)
class StuckSensor:
    """Temperature that does not follow the reported heat balance for several rows."""

    thermal_mass: float = S.BUS_HEAT_CAPACITY_J_PER_K
    residual_k: float = 0.1
    consecutive: int = 5
    min_expected_k: float = 0.01
    step_seconds: float = 60.0


@dataclass(frozen=True)
class ThermalRunaway:
    """Temperature above a ceiling while still rising."""

    ceiling_c: float = 35.0
    slope_window: int = 5
    min_slope: float = 0.04


@dataclass(frozen=True)
class DetectorSettings:
    capacity_fade: CapacityFade = field(default_factory=CapacityFade)
    stuck_sensor: StuckSensor = field(default_factory=StuckSensor)
    thermal_runaway: ThermalRunaway = field(default_factory=ThermalRunaway)
    block_rows: int = BLOCK_ROWS


INPUT_COLUMNS = [
    "sat_id",
    "minute_bucket",
    "battery_soc_mean",
    "bus_temperature_k_mean",
    "net_heat_w_mean",
]


def _null_and_nan() -> tuple[Column, Column]:
    """Names of the input columns that are null, and of those that are not a number."""
    null = [F.when(F.col(c).isNull(), F.lit(c)) for c in INPUT_COLUMNS]
    nan = [F.when(F.isnan(c), F.lit(c)) for c in INPUT_COLUMNS[2:]]
    return F.array_compact(F.array(*null)), F.array_compact(F.array(*nan))


def detector_input(mart: DataFrame) -> DataFrame:
    """The five mart columns detectors read, without rows they cannot use.

    Every other row is listed by :func:`unusable_rows`, so that input = usable + unusable.
    """
    return mart.select(*INPUT_COLUMNS).dropna(subset=INPUT_COLUMNS)


def unusable_rows(mart: DataFrame) -> DataFrame:
    """Mart rows with a null or a value that is not a number, and which columns these are in."""
    null, nan = _null_and_nan()
    rows = mart.select(*INPUT_COLUMNS, null.alias("null_columns"), nan.alias("nan_columns"))
    return rows.where((F.size("null_columns") > 0) | (F.size("nan_columns") > 0))


# What a satellite's history leaves behind for the rows that follow: see :func:`detector_signals`.
HISTORY_SCHEMA = (
    "sat_id string, n bigint, tail array<struct<minute_bucket:timestamp,battery_soc_mean:double,"
    "bus_temperature_k_mean:double,net_heat_w_mean:double>>, baseline double, total double, lowest double, last_reset bigint"
)


def look_back_rows(settings: DetectorSettings, detectors: Sequence[str] = S.DETECTORS) -> int:
    """Rows before a row that its signals need."""
    needed = {
        "capacity_fade": settings.capacity_fade.window - 1,
        "stuck_sensor": 1,
        "thermal_runaway": settings.thermal_runaway.slope_window - 1,
    }
    return max([needed[d] for d in detectors], default=0)


def detector_signals(
    mart: DataFrame,
    settings: DetectorSettings | None = None,
    detectors: Sequence[str] = S.DETECTORS,
    history: DataFrame | None = None,
) -> DataFrame:
    """One row per usable mart row with the requested detectors' running signals.

    capacity_fade adds ``baseline``, ``rolling_max``, ``cusum``; stuck_sensor adds
    ``residual_k``, ``run_length``; thermal_runaway adds ``temp_c``, ``slope``.

    ``history`` (HISTORY_SCHEMA, at most a row per satellite) stands for the rows before those of
    ``mart``, all of them earlier: their number, the last of them that look-back windows need, and
    the running values at their end. Signals then go on from there; running values are returned as
    well (``total``, ``lowest``, ``last_reset``), for :func:`next_history`.
    """
    settings = settings or DetectorSettings()
    unknown = set(detectors) - set(S.DETECTORS)
    if unknown:
        raise KeyError(f"unknown detectors: {sorted(unknown)}")
    fade = settings.capacity_fade if "capacity_fade" in detectors else None
    stuck = settings.stuck_sensor if "stuck_sensor" in detectors else None
    runaway = settings.thermal_runaway if "thermal_runaway" in detectors else None

    rows = detector_input(mart)
    halo = look_back_rows(settings, detectors)
    if history is None:
        numbered = number_rows(rows, "sat_id", "minute_bucket")
        blocks = split_blocks(numbered, halo, settings.block_rows)
    else:
        seeds = history.select("sat_id", "n", *[F.col(c).alias(f"{c}_before") for c in ("baseline", "total", "lowest", "last_reset")])
        counts = history.select("sat_id", F.col("n").alias("_n_before"))
        numbered = number_rows(rows, "sat_id", "minute_bucket", per_key=counts)
        numbered = numbered.withColumn("seq", F.col("seq") + F.coalesce("_n_before", F.lit(0))).drop("_n_before")
        earlier_rows = history.select("sat_id", "n", F.size("tail").alias("_kept"), F.posexplode("tail").alias("_at", "_row"))
        earlier_rows = earlier_rows.select("sat_id", "_row.*", (F.col("n") - F.col("_kept") + F.col("_at") + 1).alias("seq"), F.lit(True).alias("_old"))
        everything = numbered.withColumn("_old", F.lit(False)).unionByName(earlier_rows)
        blocks = split_blocks(everything, halo, settings.block_rows).withColumn("own", F.col("own") & ~F.col("_old")).drop("_old")

    # Look-back signals: need the halo, so they come before it is dropped. They are window
    # functions over stored columns only: the block summary below reads the same shuffled
    # rows, and Spark reuses that shuffle as long as nothing else is computed before it.
    w = in_block("sat_id", "minute_bucket")
    look_back: dict[str, Column] = {}
    if fade:
        recent = w.rowsBetween(-(fade.window - 1), 0)
        look_back["rolling_max"] = F.when(
            F.col("seq") >= fade.window, F.max("battery_soc_mean").over(recent)
        )
    if stuck:
        look_back["_step"] = F.col("bus_temperature_k_mean") - F.lag(
            "bus_temperature_k_mean"
        ).over(w)
    if runaway:
        look_back["_oldest"] = F.lag("bus_temperature_k_mean", runaway.slope_window - 1).over(w)
    signals = blocks.withColumns(look_back).where("own").drop("own")

    # The baseline is the rolling maximum of the first full window; the block that has it
    # tells all others of its satellite, by way of a table with one row per block.
    if fade:
        first_full = F.max(F.when(F.col("seq") == fade.window, F.col("rolling_max")))
        found = signals.groupBy("sat_id", "block").agg(first_full.alias("_found"))
        known = found.select("sat_id", "block", F.max("_found").over(W.partitionBy("sat_id")).alias("baseline"))
        if history is not None:
            known = known.join(seeds.select("sat_id", "baseline_before"), "sat_id", "left")
            known = known.select("sat_id", "block", F.coalesce("baseline_before", "baseline").alias("baseline"))
        signals = signals.join(known, ["sat_id", "block"])

    # Running signals: inside the block first, then with what earlier blocks hand over.
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    handed_over: list[Column] = []
    carried: dict[str, Column] = {}
    if fade:
        drift = F.col("baseline") - F.col("rolling_max") - F.lit(fade.slack)
        scored = F.when(F.col("seq") > fade.window, drift)
        signals = signals.withColumn("_sum", F.sum(F.coalesce(scored, F.lit(0.0))).over(so_far))
        signals = signals.withColumn("_low", F.min("_sum").over(so_far))
        handed_over += [
            F.max_by("_sum", "minute_bucket").alias("_total"),
            F.min("_sum").alias("_lowest"),
        ]
    if stuck:
        expected = F.col("net_heat_w_mean") * F.lit(stuck.step_seconds) / F.lit(stuck.thermal_mass)
        off_model = (F.col("residual_k") > stuck.residual_k) & (
            F.abs(expected) > stuck.min_expected_k
        )
        reset_at = F.when(~F.coalesce(off_model, F.lit(False)), F.col("seq"))
        signals = signals.withColumn("residual_k", F.abs(expected - F.col("_step")))
        signals = signals.withColumn("_reset", F.max(reset_at).over(so_far))
        handed_over.append(F.max("_reset").alias("_last_reset"))

    if handed_over:
        earlier = before("sat_id", "block")
        per_block = signals.groupBy("sat_id", "block").agg(*handed_over)
        at_start = {"total": F.lit(0.0), "lowest": F.lit(0.0), "last_reset": F.lit(None).cast("bigint")}
        if history is not None:
            per_block = per_block.join(seeds, "sat_id", "left")
            at_start = {c: F.coalesce(F.col(f"{c}_before"), v) for c, v in at_start.items()}
        if fade:
            carried["_sum_in"] = F.coalesce(F.sum("_total").over(earlier), F.lit(0.0)) + at_start["total"]
            # Lowest running sum of each block on the whole-history scale.
            per_block = per_block.withColumn("_low_abs", F.col("_lowest") + carried["_sum_in"])
            carried["_low_in"] = F.least(F.coalesce(F.min("_low_abs").over(earlier), F.lit(0.0)), at_start["lowest"])
        if stuck:
            carried["_reset_in"] = F.coalesce(F.max("_last_reset").over(earlier), at_start["last_reset"])
        carry = per_block.select("sat_id", "block", *[c.alias(n) for n, c in carried.items()])
        signals = signals.join(carry, ["sat_id", "block"])

    out = ["sat_id", "minute_bucket", "seq"]
    final: dict[str, Column] = {}
    if fade:
        total = F.col("_sum_in") + F.col("_sum")
        lowest = F.least(F.lit(0.0), F.col("_low_in"), F.col("_sum_in") + F.col("_low"))
        final["cusum"] = F.when(F.col("seq") > fade.window, total - lowest)
        out += ["baseline", "rolling_max", "cusum"]
        if history is not None:
            final |= {"total": total, "lowest": lowest}
    if stuck:
        final["run_length"] = F.col("seq") - F.coalesce("_reset", "_reset_in", F.lit(0))
        out += ["residual_k", "run_length"]
        if history is not None:
            final["last_reset"] = F.coalesce("_reset", "_reset_in")
    if runaway:
        temp_c = X.kelvin_to_celsius(F.col("bus_temperature_k_mean"))
        final["temp_c"] = temp_c
        final["slope"] = (temp_c - X.kelvin_to_celsius(F.col("_oldest"))) / F.lit(
            runaway.slope_window - 1
        )
        out += ["temp_c", "slope"]
    if history is not None:
        out += [c for c in (*INPUT_COLUMNS[2:], "total", "lowest", "last_reset") if c in final or c in INPUT_COLUMNS]
    return signals.withColumns(final).select(*out)


def next_history(signals: DataFrame, history: DataFrame, settings: DetectorSettings | None = None) -> DataFrame:
    """The history after ``signals``, which went on from ``history``; satellites without new rows keep theirs."""
    keep = look_back_rows(settings or DetectorSettings())
    ends = signals.groupBy("sat_id").agg(
        F.max("seq").alias("n"), F.max("baseline").alias("baseline"), F.max_by("total", "seq").alias("total"),
        F.min("lowest").alias("lowest"), F.max("last_reset").alias("last_reset"),
    )
    row = F.struct("minute_bucket", *INPUT_COLUMNS[2:])
    last = signals.join(ends.select("sat_id", F.col("n").alias("_end")), "sat_id").where(F.col("seq") > F.col("_end") - keep)
    tails = last.groupBy("sat_id").agg(F.collect_list(row).alias("new"))  # at most ``keep`` rows
    made = ends.join(tails, "sat_id").alias("new").join(history.alias("old"), "sat_id", "full")
    tail = F.concat(F.coalesce(F.col("old.tail"), F.array()), F.coalesce(F.array_sort(F.col("new.new")), F.array()))
    kept = F.slice(tail, F.greatest(F.size(tail) - keep + 1, F.lit(1)), keep)
    values = [F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in ("n", "baseline", "total", "lowest", "last_reset")]
    return made.select("sat_id", values[0], kept.alias("tail"), *values[1:])


def _firing(name: str, settings: DetectorSettings) -> Column:
    """Whether a row satisfies a detector's rule."""
    if name == "capacity_fade":
        return F.col("cusum") >= settings.capacity_fade.threshold
    if name == "stuck_sensor":
        return F.col("run_length") >= settings.stuck_sensor.consecutive
    runaway = settings.thermal_runaway
    return (
        (F.col("temp_c") > runaway.ceiling_c)
        & (F.col("seq") >= runaway.slope_window)
        & (F.col("slope") >= runaway.min_slope)
    )


def _payload(name: str, settings: DetectorSettings) -> dict[str, Column]:
    """Severity, score and text of a detector's event."""
    ceiling = F.lit(float(settings.thermal_runaway.ceiling_c))
    score, values = {
        "capacity_fade": (F.col("cusum"), [F.col("cusum"), F.col("baseline")]),
        "stuck_sensor": (F.col("residual_k"), [F.col("residual_k"), F.col("run_length")]),
        "thermal_runaway": (
            F.col("temp_c") - ceiling,
            [F.col("temp_c"), ceiling, F.col("slope")],
        ),
    }[name]
    return {
        "severity": F.lit(SEVERITY[name]),
        "score": score,
        "description": F.format_string(EVENT_TEXT[name], *values),
    }


def detect(
    mart: DataFrame,
    settings: DetectorSettings | None = None,
    detectors: Sequence[str] = S.DETECTORS,
) -> DataFrame:
    """Event table: the first firing row of each (satellite, detector).

    One aggregation picks all detectors' first rows, so the signal plan runs once.
    """
    settings = settings or DetectorSettings()
    return first_events(detector_signals(mart, settings, detectors), settings, detectors)


def first_events(
    signals: DataFrame, settings: DetectorSettings, detectors: Sequence[str] = S.DETECTORS
) -> DataFrame:
    """The first firing row of each (satellite, detector) among rows with signals, as events."""
    fires = {name: _firing(name, settings) for name in detectors}
    any_fire = F.lit(False)
    for c in fires.values():
        any_fire = any_fire | F.coalesce(c, F.lit(False))
    firsts = [
        F.min_by(
            F.struct(
                F.lit(name).alias("detector_name"),
                F.date_format("minute_bucket", "yyyy-MM-dd HH:mm:ss").alias("sim_time_iso"),
                *[c.alias(n) for n, c in _payload(name, settings).items()],
            ),
            F.when(fires[name], F.col("seq")),
        ).alias(name)
        for name in detectors
    ]
    per_sat = signals.where(any_fire).groupBy("sat_id").agg(*firsts)
    events = per_sat.select(
        "sat_id", F.explode(F.array_compact(F.array(*detectors))).alias("event")
    )
    return events.select("sat_id", "event.*").select(*S.EVENT_SCHEMA.fieldNames())


def capacity_fade(mart: DataFrame, **params) -> DataFrame:
    """Events of the capacity-fade detector alone; keyword arguments set its parameters."""
    return detect(mart, DetectorSettings(capacity_fade=CapacityFade(**params)), ["capacity_fade"])


def stuck_sensor(mart: DataFrame, **params) -> DataFrame:
    """Events of the stuck-sensor detector alone; keyword arguments set its parameters."""
    return detect(mart, DetectorSettings(stuck_sensor=StuckSensor(**params)), ["stuck_sensor"])


def thermal_runaway(mart: DataFrame, **params) -> DataFrame:
    """Events of the thermal-runaway detector alone; keyword arguments set its parameters."""
    return detect(
        mart, DetectorSettings(thermal_runaway=ThermalRunaway(**params)), ["thermal_runaway"]
    )


# Any callable DataFrame -> event DataFrame can be registered and run by run_detectors.
REGISTRY = {
    "capacity_fade": capacity_fade,
    "stuck_sensor": stuck_sensor,
    "thermal_runaway": thermal_runaway,
}


def run_detectors(mart: DataFrame, extra: dict | None = None) -> DataFrame:
    """Events of the built-in detectors in one pass, plus those of any ``extra`` detectors."""
    events = detect(mart)
    for fn in (extra or {}).values():
        events = events.unionByName(fn(mart).select(*S.EVENT_SCHEMA.fieldNames()))
    return events


def run_stats(mart: DataFrame, events: DataFrame) -> DataFrame:
    """One row: mart rows consumed, satellites processed, events emitted."""
    consumed = mart.agg(
        F.count(F.lit(1)).alias("rows_consumed"),
        F.count_distinct("sat_id").alias("sats_processed"),
    )
    emitted = events.agg(F.count(F.lit(1)).alias("events_emitted"))
    return consumed.withColumn("events_emitted", emitted.scalar())
