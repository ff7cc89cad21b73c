"""Counts and extremes from the statistics in Parquet footers: caps and cursors without reading a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def statistics(spark: SparkSession, path: str, least: tuple[str, ...] = (), greatest: tuple[str, ...] = ()) -> DataFrame:
    """One row: n, and least_<name> and greatest_<name> of columns.  Aggregates of numbers, dates and booleans are pushed into the scan, which then reads footers alone; those of other types read
    their column.  The row belongs to a session of its own, in which that push-down is on; the caller's settings stay as they are."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    wanted = [F.count("*").alias("n"), *(F.min(c).alias(f"least_{c}") for c in least), *(F.max(c).alias(f"greatest_{c}") for c in greatest)]
    return other.read.parquet(path).agg(*wanted)


def room(spark: SparkSession, path: str, cap: int) -> int:
    """How many rows a table may still take."""
    return max(0, cap - statistics(spark, path).first()["n"])


def cursor(spark: SparkSession, path: str, column: str):
    """The greatest value of a column, from which the next run goes on; null for an empty table."""
    return statistics(spark, path, greatest=(column,)).first()[f"greatest_{column}"]
