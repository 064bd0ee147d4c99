import pytest


@pytest.fixture(scope="session")
def make(spark):
    """DataFrame from rows and a schema, with an extra column whose name clashes with internal ones."""
    from pyspark.sql import functions as F

    def build(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions).withColumn("size", F.lit("x")).withColumn("token", F.lit(None).cast("int"))

    return build
