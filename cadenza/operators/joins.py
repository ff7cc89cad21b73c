"""Join shapes: keys as a table, optional look-ups, literal conditions, existence under OR, and bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Anti-join; a null among ``keys`` changes nothing, unlike NOT IN."""
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def lookup(df: DataFrame, dimension: DataFrame, on: str, key: str, value: str, name: str) -> DataFrame:
    """``value`` of the dimension row with ``key`` = ``on``, or null."""
    side = dimension.select(F.col(key).alias("_key"), F.col(value).alias(name))
    return df.join(side, F.col(on) == F.col("_key"), "left").drop("_key")


def either(held: DataFrame, fresh: DataFrame, on: list[str]) -> DataFrame:
    """The union of known look-ups and new ones; a key in both keeps what was known."""
    return held.unionByName(without_keys(fresh.select(*held.columns), held, on))


def left_filtered(left: DataFrame, right: DataFrame, on: list[str], condition: Column) -> DataFrame:
    """Left join with rows of the right side that meet a literal condition."""
    return left.join(right.where(condition), on, "left")


def passes_or_exists(df: DataFrame, passes: Column, others: DataFrame, on: list[str], name: str = "_tracked") -> DataFrame:
    """Rows that pass by themselves or have a key in ``others``."""
    flagged = df.join(others.select(*on).distinct().withColumn(name, F.lit(True)), on, "left")
    return flagged.where(F.coalesce(passes, F.lit(False)) | F.col(name).isNotNull()).drop(name)


def band_join(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, days: int) -> DataFrame:
    """Inner join on keys with days at most ``days`` apart, ends included.

    The band is part of the equi-join: days fall into bins as wide as the band, a left row asks for its bin and both neighbours, so a hot
    key is spread over its bins and no pair outside three bins is formed.
    """
    width = max(days, 1)
    bin_of = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / width)
    asks = left.withColumn("_bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: bin_of(left_day) + i)))
    near = F.abs(F.datediff(F.col(left_day), F.col(right_day))) <= days
    return asks.join(right.withColumn("_bin", bin_of(right_day)), [*keys, "_bin"]).where(near).drop("_bin")
