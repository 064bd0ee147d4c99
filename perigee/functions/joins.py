"""Joins of a large keyed table with a table that is usually small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows up to which a side may be broadcast. Label and threshold rows are well under 1 kB.
BROADCAST_ROWS = 50_000
SALTS = 64


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops counting just past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_keyed(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str,
    spread: Column,
    small_fits: bool,
) -> DataFrame:
    """Join on ``key`` with at most one ``small`` row per key and any key skew in ``big``.

    ``small_fits`` is the outcome of :func:`is_small`. When true the small side is
    broadcast and ``big`` is not shuffled. Otherwise both sides are shuffled on
    (key, salt): ``spread`` scatters the rows of one key of ``big`` over SALTS groups and
    every ``small`` row is copied to each of them, so no task holds a whole hot key.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    if small_fits:
        return big.join(F.broadcast(small), key, how)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = small.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    return salted_big.join(copies, [key, "_salt"], how).drop("_salt")
