"""Tables cut into buckets by a hash of their keys, so that a merge reads and writes only the buckets that its batch has keys in.

A merge numbered v writes the touched buckets anew under version v, then a manifest of all buckets and the version that holds each; readers take the newest manifest.  So a merge is seen as a whole or not
at all, one that runs again replaces its own version, and older versions stay readable until they are deleted.  The folder must be one that all executors share.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadenza.operators import merge
from cadenza.operators.merge import Rule


class Buckets:
    """The table under ``path``: ``keys`` tell its rows apart; a bucket should hold as many rows as one task likes to rewrite."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.empty = spark.createDataFrame([], schema)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _versions(self) -> list[int]:
        self.spark.createDataFrame([], "bucket int, held long, _version long").write.partitionBy("_version").mode("ignore").parquet(f"{self.path}/manifest")
        files = self.spark.read.schema("bucket int, held long, _version long").parquet(f"{self.path}/manifest").inputFiles()
        return sorted({int(m[1]) for f in files if (m := re.search(r"/_version=(\d+)/", f))})

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """The version that holds each bucket, of the newest manifest (before a version); at most ``buckets`` entries."""
        versions = [v for v in self._versions() if before is None or v < before]
        if not versions:
            return {}
        rows = self.spark.read.schema("bucket int, held long, _version long").parquet(f"{self.path}/manifest").where(F.col("_version") == versions[-1])
        return {r["bucket"]: r["held"] for r in rows.collect()}

    def _data(self) -> DataFrame:
        laid = StructType(self.empty.schema.fields[:]).add("_version", "long").add("_bucket", "integer")
        self.empty.withColumns({"_version": F.lit(0).cast("long"), "_bucket": F.lit(0)}).write.partitionBy("_version", "_bucket").mode("ignore").parquet(f"{self.path}/data")
        return self.spark.read.schema(laid).parquet(f"{self.path}/data")

    def read(self, only: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The table's rows, or those of some buckets; other folders aren't opened."""
        held: dict[int, list[int]] = {}
        for bucket, version in self.manifest(before).items():
            if only is None or bucket in only:
                held.setdefault(version, []).append(bucket)
        wanted = F.lit(False)
        for version, buckets in held.items():
            wanted |= (F.col("_version") == version) & F.col("_bucket").isin(buckets)
        return self._data().where(wanted).select(*self.empty.columns)

    def _write(self, rows: DataFrame, touched: list[int], version: int) -> None:
        self._data()
        placed = rows.select(*self.empty.columns, F.lit(version).cast("long").alias("_version"), self.bucket().alias("_bucket"))
        placed.hint("rebalance", "_bucket").write.partitionBy("_version", "_bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/data")
        now = self.manifest(before=version) | dict.fromkeys(touched, version)
        listed = self.spark.createDataFrame([(b, v, version) for b, v in now.items()], "bucket int, held long, _version long")
        listed.coalesce(1).write.partitionBy("_version").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/manifest")

    def touched(self, batch: DataFrame) -> list[int]:
        return sorted(r[0] for r in batch.select(self.bucket()).distinct().collect())  # at most ``buckets`` numbers

    def fill(self, rows: DataFrame, version: int = 0) -> None:
        """The whole table anew; keys must be unique."""
        self._write(rows, list(range(self.buckets)), version)

    def upsert(self, source: DataFrame, rules: dict[str, Rule], version: int, when: Column | None = None, changed_flag: str | None = None) -> DataFrame:
        """``merge.upsert`` of a batch, written as ``version``.  Returns the rows of the touched buckets, with ``changed_flag`` if one is named."""
        touched = self.touched(source)
        merged = merge.upsert(self.read(touched, version), source, self.keys, rules, when, changed_flag)
        self._write(merged, touched, version)
        return merged

    def insert_ignore(self, source: DataFrame, version: int, ordinal: str | None = None) -> None:
        """``merge.insert_ignore`` of a batch, written as ``version``."""
        touched = self.touched(source)
        self._write(merge.insert_ignore(self.read(touched, version), source, self.keys, ordinal), touched, version)

    def update(self, source: DataFrame, columns: list[str], version: int) -> None:
        """``merge.update_keyed`` of a batch, written as ``version``."""
        touched = self.touched(source)
        self._write(merge.update_keyed(self.read(touched, version), source, self.keys, columns), touched, version)
