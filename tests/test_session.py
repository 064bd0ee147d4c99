from pathlib import Path

import pytest

from perigee import session


def test_scratch_follows_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("perigee.scratch.dir")
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(root.rstrip("/"))


def test_materialized_tables_have_no_upstream_plan(spark):
    df = session.materialize(spark.range(10).selectExpr("id", "id * 2 AS twice"), "t")
    assert df.count() == 10
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_shuffle_partitions_follow_the_data(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 1 << 40) == 8192
        assert session.size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_configure_sets_utc(spark):
    session.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster(), "x")


def test_scratch_is_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    kept = session.materialize(spark.range(5), "x")
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert kept.count() == 5 and folder.exists()
    session.remove_scratch()
    assert not folder.exists()
