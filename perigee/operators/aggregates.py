"""Per-satellite and fleet-wide aggregates. All combine partially before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.functions import scalars as X
from perigee.functions.sequence import HOUR_SECONDS, time_chunk


def latest_time(raw: DataFrame) -> DataFrame:
    return raw.groupBy("sat_id").agg(F.max("sim_time").alias("latest_sim_time"))


def sim_start(mart: DataFrame) -> DataFrame:
    """Earliest minute of the mart: one row, used as the start that offsets refer to."""
    return mart.agg(F.min("minute_bucket").alias("sim_start"))


def row_counts(raw: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows and distinct sample times per satellite."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return raw.groupBy("sat_id").agg(
        F.count(F.lit(1)).alias("n_rows"), distinct("sim_time_iso").alias("n_distinct_times")
    )


def sat_picker(mart: DataFrame) -> DataFrame:
    return mart.select("sat_id").distinct().orderBy("sat_id")


def orbit_number(t: Column) -> Column:
    """Number of the nominal orbit since the epoch that a time falls in."""
    return F.floor(F.rint(X.epoch_seconds(t)) / F.lit(S.ORBIT_SECONDS)).cast("bigint")


def orbit_mean_power(raw: DataFrame) -> DataFrame:
    """Mean net power per satellite and nominal orbit."""
    return raw.groupBy("sat_id", orbit_number(F.col("sim_time")).alias("orbit")).agg(
        F.avg("net_power_w").alias("net_power_w_mean"), F.count(F.lit(1)).alias("n_rows")
    )


def channel_ranges(raw: DataFrame) -> DataFrame:
    """Max minus min of the channels that should swing over an orbit."""
    return raw.groupBy("sat_id").agg(
        (F.max("bus_temperature_k") - F.min("bus_temperature_k")).alias("temperature_range_k"),
        (F.max("battery_soc") - F.min("battery_soc")).alias("soc_range"),
        (F.max("latitude_deg") - F.min("latitude_deg")).alias("latitude_range_deg"),
    )


def eclipse_fraction(raw: DataFrame) -> DataFrame:
    return raw.groupBy("sat_id").agg(
        F.avg(F.when(F.col("eclipsed"), 1.0).otherwise(0.0)).alias("eclipse_fraction"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _time_sliced(raw: DataFrame, columns: list[str], slice_seconds: int):
    """The needed columns with their time slice, and the ordered window inside a slice."""
    sliced = raw.select("sat_id", "sim_time", *columns).withColumn(
        "_slice", time_chunk(F.col("sim_time"), slice_seconds)
    )
    return sliced, W.partitionBy("sat_id", "_slice").orderBy("sim_time")


def eclipse_delta_means(raw: DataFrame, slice_seconds: int = HOUR_SECONDS) -> DataFrame:
    """Mean step change of charge and temperature over the rows inside eclipse.

    Steps inside a time slice are summed there. The step from one slice's last row to the
    next slice's first is added from the slice summaries, so no satellite's history is
    gathered in one place.
    """
    value_columns = ["battery_soc", "bus_temperature_k"]
    sliced, w = _time_sliced(raw, ["eclipsed", *value_columns], slice_seconds)
    steps = sliced.select(
        "*", *[(F.col(c) - F.lag(c).over(w)).alias(f"_step_{c}") for c in value_columns]
    )
    per_slice = []
    for c in value_columns:
        inside = F.when(F.col("eclipsed"), F.col(f"_step_{c}"))
        per_slice += [
            F.sum(inside).alias(f"_sum_{c}"),
            F.count(inside).alias(f"_n_{c}"),
            F.min_by(c, "sim_time").alias(f"_first_{c}"),
            F.max_by(c, "sim_time").alias(f"_last_{c}"),
        ]
    summary = steps.groupBy("sat_id", "_slice").agg(
        *per_slice, F.min_by("eclipsed", "sim_time").alias("_first_eclipsed")
    )
    by_sat = W.partitionBy("sat_id").orderBy("_slice")
    edges = summary.select(
        "*",
        *[
            F.when(
                F.col("_first_eclipsed"), F.col(f"_first_{c}") - F.lag(f"_last_{c}").over(by_sat)
            ).alias(f"_edge_{c}")
            for c in value_columns
        ],
    )

    def mean(c: str):
        total = F.coalesce(F.sum(f"_sum_{c}"), F.lit(0.0)) + F.coalesce(
            F.sum(f"_edge_{c}"), F.lit(0.0)
        )
        n = F.sum(f"_n_{c}") + F.count(f"_edge_{c}")
        return F.when(n > 0, total / n)

    return edges.groupBy("sat_id").agg(
        mean("battery_soc").alias("soc_step_mean"),
        mean("bus_temperature_k").alias("temperature_step_mean_k"),
        (F.sum("_n_battery_soc") + F.count("_edge_battery_soc")).alias("n_steps"),
    )


def eclipse_intervals(raw: DataFrame, slice_seconds: int = HOUR_SECONDS) -> DataFrame:
    """Contiguous eclipse passes: start, end and number of rows.

    A pass ends at the first sunlit row after it; one still open ends at the last row.
    Passes are built inside (satellite, time slice) groups first. Only the first and last
    run of a slice can continue in a neighbour, so only those are joined up across slices.
    """
    sliced, w = _time_sliced(raw, ["eclipsed"], slice_seconds)
    flag = F.coalesce(F.col("eclipsed"), F.lit(False))
    changed = (flag != F.lag(flag, 1).over(w)) | F.lag(flag, 1).over(w).isNull()
    runs = (
        sliced.withColumn("_flag", flag)
        .withColumn("_new", F.when(changed, 1).otherwise(0))
        .withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("sat_id", "_slice", "_run")
        .agg(
            F.first("_flag").alias("_flag"),
            F.min("sim_time").alias("start_time"),
            F.max("sim_time").alias("_last_time"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    in_slice = W.partitionBy("sat_id", "_slice").orderBy("_run")
    whole_slice = W.partitionBy("sat_id", "_slice")
    runs = runs.withColumn("_next_start", F.lead("start_time").over(in_slice)).withColumn(
        "_runs", F.max("_run").over(whole_slice)
    )
    is_edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    inner = runs.where(~is_edge & F.col("_flag")).select(
        "sat_id", "start_time", F.col("_next_start").alias("end_time"), "n_rows"
    )

    by_sat = W.partitionBy("sat_id").orderBy("_slice", "_run")
    edge = runs.where(is_edge)
    # The closing run of a slice with several runs never continues that slice's first run.
    opens = (
        (F.col("_run") > 1)
        | F.lag("_flag").over(by_sat).isNull()
        | (F.lag("_flag").over(by_sat) != F.col("_flag"))
    )
    edge = (
        edge.withColumn("_next_start", F.coalesce("_next_start", F.lead("start_time").over(by_sat)))
        .withColumn("_open", F.when(opens, 1).otherwise(0))
        .withColumn("_pass", F.sum("_open").over(by_sat.rowsBetween(W.unboundedPreceding, 0)))
    )
    joined = (
        edge.where("_flag")
        .groupBy("sat_id", "_pass")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max(F.coalesce("_next_start", "_last_time")).alias("end_time"),
            F.sum("n_rows").alias("n_rows"),
        )
        .drop("_pass")
    )
    return inner.unionByName(joined)


def files_per_partition(stored: DataFrame) -> DataFrame:
    """Rows and files in each directory of a stored telemetry table."""
    named = stored.select(*S.PARTITION_COLUMNS, F.input_file_name().alias("_file"))
    return named.groupBy(*S.PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_file").alias("n_files")
    )


def partition_counts(raw: DataFrame) -> DataFrame:
    """Rows each (satellite, date, hour) directory would hold."""
    return raw.groupBy(
        "sat_id",
        F.date_format("sim_time", "yyyy-MM-dd").alias("date"),
        X.hour_text(F.col("sim_time")).alias("hour"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))
