"""Fault-label tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from perigee import schema as S
from perigee.operators.labels import validated


# As an Arrow table a label list becomes a local relation whose size the optimizer knows.
_ARROW_LABELS = pa.schema(
    [
        ("ordinal", pa.int32()),
        ("sat_id", pa.string()),
        ("fault_type", pa.string()),
        ("start_iso", pa.string()),
        ("start_offset", pa.string()),
        ("params", pa.map_(pa.string(), pa.float64())),
    ]
)


def no_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.LABEL_SCHEMA)


def labels_from_rows(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """Labels given in code, numbered in the order listed."""
    numbered = [
        {
            "ordinal": i,
            "sat_id": r.get("sat_id"),
            "fault_type": r.get("fault_type"),
            "start_iso": r.get("start_iso"),
            "start_offset": r.get("start_offset"),
            "params": [(k, float(v)) for k, v in (r.get("params") or {}).items()],
        }
        for i, r in enumerate(rows)
    ]
    if not numbered:
        return no_labels(spark)
    table = pa.Table.from_pylist(numbered, schema=_ARROW_LABELS)
    return validated(spark.createDataFrame(table, S.LABEL_SCHEMA))


def load_labels(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Labels from a JSON-lines or Parquet table; an absent path means no labels.

    Invalid rows fail the job that uses them; see operators.labels.label_problems for a
    report instead.
    """
    try:
        raw = spark.read.schema(S.LABEL_SCHEMA).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return no_labels(spark)
        raise
    return validated(raw)
