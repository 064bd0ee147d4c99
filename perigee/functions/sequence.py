"""Ordered per-satellite computations whose work does not pile up on one satellite.

A plain ``Window.partitionBy("sat_id")`` puts a satellite's whole history into one task.
The helpers here cut a history into bounded pieces, compute inside the pieces, and pass a
small per-piece summary from one piece to the next, so results stay exact:

* :func:`number_rows` gives each row its position in its satellite's history;
* :func:`split_blocks` regroups rows into blocks of a fixed row count, each with a halo of
  the rows just before it, so look-back windows see what they need across any time gap;
* :func:`in_block` and :func:`before` are the window specs for the two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600
BLOCK_ROWS = 8_192


def time_chunk(t: Column, chunk_seconds: int) -> Column:
    """Number of the fixed-length time slice a timestamp falls in."""
    return F.floor(F.unix_seconds(t) / F.lit(chunk_seconds)).cast("bigint")


def before(key: str, order: str) -> WindowSpec:
    """All earlier rows of a per-piece summary table (one row per piece, so narrow)."""
    return W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def number_rows(
    df: DataFrame,
    key: str,
    time: str,
    chunk_seconds: int = DAY_SECONDS,
    seq: str = "seq",
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Add ``seq``: 1, 2, 3, ... per ``key`` in ``time`` order, exact across time gaps.

    Rows are shuffled once, on (key, time slice). Slice row counts, one row per slice, are
    accumulated separately and joined on the same columns. Rows with a null key or time
    have no place in a history and are left out. ``per_key`` may hold further columns, one
    row per key; they ride along on the slice table instead of needing a join of their own.
    """
    sliced = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn(
        "_slice", time_chunk(F.col(time), chunk_seconds)
    )
    counts = sliced.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        key,
        "_slice",
        F.coalesce(F.sum("_n").over(before(key, "_slice")), F.lit(0)).alias("_before"),
    )
    if per_key is not None:
        offsets = offsets.join(per_key, key, "left")
    # Positions inside a slice come first: the join then finds the rows already sorted.
    local = F.row_number().over(W.partitionBy(key, "_slice").orderBy(time))
    return (
        sliced.withColumn("_local", local)
        .join(offsets, [key, "_slice"])
        .withColumn(seq, F.col("_before") + F.col("_local"))
        .drop("_slice", "_before", "_local")
    )


def split_blocks(
    df: DataFrame,
    halo_rows: int,
    block_rows: int = BLOCK_ROWS,
    seq: str = "seq",
) -> DataFrame:
    """Add ``block`` and ``own``: each row goes to its block and, as halo, to later ones.

    A block owns ``block_rows`` consecutive rows of one key and also receives the
    ``halo_rows`` rows before them, marked ``own = false``. Group size is bounded by
    construction whatever the key's share of the data.
    """
    pos = F.col(seq) - 1
    size = F.lit(block_rows).cast("bigint")
    home = F.floor(pos / size).cast("bigint")
    last = F.floor((pos + halo_rows) / size).cast("bigint")
    return df.withColumn("block", F.explode(F.sequence(home, last))).withColumn(
        "own", F.col("block") == home
    )


def in_block(key: str, order: str, piece: str = "block") -> WindowSpec:
    """Ordered window inside one bounded piece of a key's history."""
    return W.partitionBy(key, piece).orderBy(order)


def rolling_max(
    df: DataFrame, value: str, rows: int, out: str, key: str = "sat_id", time: str = "minute_bucket"
) -> DataFrame:
    """Maximum over the last ``rows`` rows per key; null until that many rows exist."""
    blocks = split_blocks(number_rows(df, key, time), rows - 1)
    w = in_block(key, time).rowsBetween(-(rows - 1), 0)
    return (
        blocks.withColumn(out, F.max(value).over(w))
        .where("own")
        .withColumn(out, F.when(F.col("seq") >= rows, F.col(out)))
        .drop("block", "own")
    )


def step_change(
    df: DataFrame, value: str, out: str, key: str = "sat_id", time: str = "minute_bucket"
) -> DataFrame:
    """Difference from the previous row per key; null on a key's first row."""
    blocks = split_blocks(number_rows(df, key, time), 1)
    return (
        blocks.withColumn(out, F.col(value) - F.lag(value).over(in_block(key, time)))
        .where("own")
        .drop("block", "own")
    )


def endpoint_slope(
    df: DataFrame, value: str, rows: int, out: str, key: str = "sat_id", time: str = "minute_bucket"
) -> DataFrame:
    """(newest - oldest) / (rows - 1) over the last ``rows`` rows; null before they exist."""
    blocks = split_blocks(number_rows(df, key, time), rows - 1)
    oldest = F.lag(value, rows - 1).over(in_block(key, time))
    return (
        blocks.withColumn(out, (F.col(value) - oldest) / F.lit(rows - 1))
        .where("own")
        .drop("block", "own")
    )


def run_length(
    df: DataFrame, flag: str, out: str, key: str = "sat_id", time: str = "minute_bucket"
) -> DataFrame:
    """Consecutive true rows of ``flag`` up to and including each row (null counts as false).

    Inside a block the run goes back to the last false row; a block without one continues
    the run of the blocks before it through the carried position of their last false row.
    """
    rows = split_blocks(number_rows(df, key, time), 0)
    w = in_block(key, time).rowsBetween(W.unboundedPreceding, 0)
    broken_at = F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col("seq"))
    rows = rows.withColumn("_broken", F.max(broken_at).over(w))
    carry = (
        rows.groupBy(key, "block")
        .agg(F.max("_broken").alias("_last"))
        .select(key, "block", F.max("_last").over(before(key, "block")).alias("_earlier"))
    )
    return (
        rows.join(carry, [key, "block"])
        .withColumn(out, F.col("seq") - F.coalesce("_broken", "_earlier", F.lit(0)))
        .drop("block", "own", "_broken", "_earlier")
    )


def time_order_violations(df: DataFrame, key: str, time: str, order: str, order_span: int) -> DataFrame:
    """Rows whose ``time`` is not later than that of the row before them in ``order``.

    ``order`` is an integer arrival position (an offset or event number); slices of
    ``order_span`` positions bound each group, and each slice's last time is carried on.
    """
    sliced = df.withColumn("_slice", F.floor(F.col(order) / F.lit(order_span)).cast("bigint"))
    w = W.partitionBy(key, "_slice").orderBy(order)
    rows = sliced.withColumn("_prev", F.lag(time).over(w))
    lasts = rows.groupBy(key, "_slice").agg(F.max_by(time, order).alias("_last"))
    carry = lasts.select(
        key,
        "_slice",
        F.lag("_last").over(W.partitionBy(key).orderBy("_slice")).alias("_carried"),
    )
    return (
        rows.join(carry, [key, "_slice"])
        .withColumn("previous_time", F.coalesce("_prev", "_carried"))
        .where(F.col(time) <= F.col("previous_time"))
        .drop("_slice", "_prev", "_carried")
    )
