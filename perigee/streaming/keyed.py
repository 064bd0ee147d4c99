"""Tables with a row or a few per key, of which a batch replaces only the keys it touches.

Keys are dealt by hash into a fixed number of buckets. A batch reads the buckets of its keys,
writes them anew under its own number, and then a manifest that says which batch last wrote each
bucket. A manifest counts once it is complete, so readers see all of a batch or nothing, and a batch
that is repeated after a failure starts again from the manifest before it. Work follows the
buckets touched, not the batches so far: a manifest has one row a bucket, two manifests are kept,
and what neither names is removed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.session import child_names, remove_path

BUCKETS = 64
MANIFESTS_KEPT = 2


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, key: str, schema: str | T.StructType, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root, key, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        found = [int(n.split("=")[1]) for n in child_names(self.spark, f"{self.root}/manifest") if n.startswith("version=")]
        return sorted(v for v in found if "_SUCCESS" in child_names(self.spark, f"{self.root}/manifest/version={v}"))

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """Bucket to the version that wrote it last; of the newest version, or the newest below ``before``."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return {}
        rows = self.spark.read.schema("bucket int, written bigint").parquet(f"{self.root}/manifest/version={known[-1]}").collect()
        return {r["bucket"]: r["written"] for r in rows}

    def read(self, keys: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those of the given keys; only buckets with any of these are opened."""
        manifest = self.manifest(before)
        if keys is not None:
            manifest = {b: v for b, v in manifest.items() if b in set(self.touched(keys))}
        rows = self._rows(manifest)
        return rows if keys is None else rows.join(keys.select(self.key).distinct(), self.key, "left_semi")

    def _rows(self, manifest: dict[int, int]) -> DataFrame:
        if not manifest:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/version={v}/bucket={b}" for b, v in sorted(manifest.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, keys: DataFrame) -> list[int]:
        return [r[0] for r in keys.select(self.bucket().alias("bucket")).distinct().collect()]

    def replace(self, rows: DataFrame, keys: DataFrame, version: int) -> list[int]:
        """As version ``version``: the rows of ``keys`` replaced by ``rows``. Returns the buckets written."""
        spark, buckets = self.spark, self.touched(keys)
        manifest = self.manifest(before=version)
        names = self.schema.fieldNames()
        out = rows.select(*names)
        others = self._others_in(buckets, keys, manifest)
        if others is not None:
            out = others.select(*names).unionByName(out)
        if buckets:
            (
                self._gathered(out.withColumn("bucket", self.bucket()))
                .write.mode("overwrite")
                .option("compression", "zstd")
                .partitionBy("bucket")
                .parquet(f"{self.root}/data/version={version}")
            )
        # a bucket whose rows are all gone has no folder
        filled = {int(n.split("=")[1]) for n in child_names(spark, f"{self.root}/data/version={version}") if n.startswith("bucket=")} if buckets else set()
        now = {b: v for b, v in manifest.items() if b not in buckets} | dict.fromkeys(sorted(filled), version)
        listed = spark.createDataFrame(sorted(now.items()), "bucket int, written bigint")  # a row for each bucket
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")
        self._forget_old(version)
        return buckets

    def _others_in(self, buckets: list[int], keys: DataFrame, manifest: dict[int, int]) -> DataFrame | None:
        """Rows of other keys in the buckets to be written anew."""
        old = [f"{self.root}/data/version={manifest[b]}/bucket={b}" for b in buckets if b in manifest]
        if not old:
            return None
        return self.spark.read.schema(self.schema).parquet(*old).join(keys.select(self.key).distinct(), self.key, "left_anti")

    def _gathered(self, rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket")

    def _forget_old(self, version: int) -> None:
        """Removes manifests beyond those kept and the data that no kept one names."""
        known = [v for v in self.versions() if v <= version]
        kept = known[-MANIFESTS_KEPT:]
        for v in set(known) - set(kept):
            remove_path(self.spark, f"{self.root}/manifest/version={v}")
        named = {(b, w) for v in kept for b, w in self.manifest(before=v + 1).items()}
        for name in child_names(self.spark, f"{self.root}/data"):
            written = int(name.split("=")[1]) if name.startswith("version=") else version + 1
            if written >= version:
                continue
            inside = {int(n.split("=")[1]) for n in child_names(self.spark, f"{self.root}/data/{name}") if n.startswith("bucket=")}
            live = {b for b in inside if (b, written) in named}
            for b in inside - live:
                remove_path(self.spark, f"{self.root}/data/{name}/bucket={b}")
            if not live:
                remove_path(self.spark, f"{self.root}/data/{name}")


class DatedTable(KeyedTable):
    """A table of which a version replaces whole days: the key is ``date``, and every day is a bucket.

    A day's rows come from the caller complete, so old ones are not read. A large day is split over
    tasks from measured sizes, sorted by ``order`` within each file.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, order: tuple[str, ...] = ()):
        super().__init__(spark, root, "date", schema)
        self.order = order

    def bucket(self) -> Column:
        return F.unix_date(self.key)

    def _others_in(self, buckets, keys, manifest):
        return None

    def _gathered(self, rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *self.order)

    def read_range(self, before: int | None = None, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
        """Rows of the days from ``first_day`` to ``last_day``; files of other days are not opened."""
        epoch = date(1970, 1, 1)
        inside = lambda b: (first_day is None or b >= (first_day - epoch).days) and (last_day is None or b <= (last_day - epoch).days)
        return self._rows({b: v for b, v in self.manifest(before).items() if inside(b)})
