"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.session import materialize


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back.

    ``release`` then asks the driver's JVM to collect its garbage, upon which Spark removes the
    shuffle files of plans that nothing refers to any more. Otherwise they stay until memory on
    the driver happens to run short, which a job of many large steps can't wait for.
    """
    out = materialize(df, name)
    if release:
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix finaliser), vectorised."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks_by_length(texts: list, limit: int):
    """Ranges (start, stop) of consecutive texts of about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
