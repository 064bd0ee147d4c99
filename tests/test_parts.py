"""Streams in parts over a file of events with a single row group."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import queries


@pytest.fixture
def one_group(spark, tmp_path):
    """An events table that only one task can read; small partitions are not merged while it is used."""
    rnd = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [
        {"event_id": i, "ts": start + timedelta(seconds=rnd.randrange(2_000_000)), "user_id": rnd.randrange(90), "event_type": "view", "value": rnd.random() * 500, "props": f'{{"k": {i % 97}}}'}
        for i in range(4000)
    ]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "events.parquet")
    queries._stored.clear()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    queries._stored.clear()


def test_ingested_parts_are_dealt_to_all_tasks(spark, one_group):
    base = queries._ingested_in_parts(spark, one_group)
    messages = spark.read.parquet(f"{base}/in")
    files = [r["count"] for r in messages.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(files) == 4000 and max(files) < 1600
