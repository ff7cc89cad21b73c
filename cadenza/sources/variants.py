"""Semi-structured columns as VARIANT: landed JSON that keeps its shape, typed reads of single fields, and a report of how shapes drift.

Malformed JSON and a field that is missing or of another type are null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(value: Column | str) -> Column:
    """A JSON text as a variant; null if it is malformed."""
    return F.try_parse_json(F.col(value) if isinstance(value, str) else value)


def field(value: Column | str, path: str, kind: str) -> Column:
    """One field, or null."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, kind)


def shape(df: DataFrame, column: str) -> str | None:
    """The type that all values of a variant column have in common, as text."""
    return df.agg(F.schema_of_variant_agg(column)).first()[0]  # one text


def paths(df: DataFrame, column: str, depth: int = 3) -> DataFrame:
    """path, kind and n: how often each path of the objects in a variant column holds a value of each kind, down to ``depth`` names.  Elements of arrays aren't told apart by place (``[]``)."""
    held = df.select(F.lit("$").alias("path"), F.col(column).alias("v")).where("v is not null")
    found = None
    for _ in range(depth):
        each = held.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
        inner = each.select(F.concat("path", F.coalesce(F.concat(F.lit("."), "key"), F.lit("[]"))).alias("path"), F.col("value").alias("v"))
        kind = F.regexp_extract(F.schema_of_variant("v"), r"^\w+", 0)
        here = inner.select("path", kind.alias("kind"))
        found = here if found is None else found.union(here)
        held = inner.where(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)"))
    return found.groupBy("path", "kind").agg(F.count("*").alias("n"))


def drift(before: DataFrame, now: DataFrame, column: str, depth: int = 3) -> DataFrame:
    """path, change (``appeared``, ``gone`` or ``changed``), was and is (sorted kinds) of the paths at which two batches differ; kinds of null don't count where others are."""
    kinds = lambda df, name: paths(df, column, depth).groupBy("path").agg(F.array_sort(F.collect_set(F.when(F.col("kind") != "VOID", F.col("kind")))).alias(name))
    both = kinds(before, "was").join(kinds(now, "is"), "path", "full_outer")
    change = F.when(F.col("was").isNull(), "appeared").when(F.col("is").isNull(), "gone").when((F.col("was") != F.col("is")) & (F.size("was") > 0) & (F.size("is") > 0), "changed")
    return both.withColumn("change", change).where("change is not null").select("path", "change", "was", "is")
