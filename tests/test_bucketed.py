"""Merges of buckets against merges of whole tables, and what they touch."""

from pathlib import Path

from pyspark.sql import functions as F

from cadenza.operators import merge
from cadenza.operators.bucketed import Buckets
from cadenza.operators.merge import Rule

SCHEMA = "k long, name string, n int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merges_touch_their_buckets_only(spark, tmp_path):
    target = spark.range(4000).selectExpr("id as k", "concat('name', id) as name", "cast(id as int) as n")
    held = Buckets(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=32)
    assert held.read().count() == 0
    held.fill(target)
    source = spark.createDataFrame([(7, None, 1), (5000, "new", None), (8, "name8", 8)], SCHEMA)
    rules = {"name": Rule.OVERWRITE, "n": Rule.COALESCE}
    want = merge.upsert(target, source, ["k"], rules)
    size = lambda v: sum(f.stat().st_size for f in Path(held.path, f"data/_version={v}").rglob("*.parquet"))
    for _ in range(2):  # the same version again
        flagged = held.upsert(source, rules, 1, changed_flag="changed")
        assert rows(held.read()) == rows(want)
    assert sorted(r.k for r in flagged.where("changed").collect()) == [7, 5000]
    assert len(held.touched(source)) <= 3 and size(1) <= 3.5 / 32 * size(0)
    assert {v for v in held.manifest().values()} == {0, 1} and sum(v == 1 for v in held.manifest().values()) == len(held.touched(source))
    assert rows(held.read(before=1)) == rows(target)
    held.update(spark.createDataFrame([(9, "nine", None), (-1, "none", None)], SCHEMA), ["name"], 2)
    held.insert_ignore(spark.createDataFrame([(9, "no", 1), (6000, "yes", 1)], SCHEMA), 3)
    want = merge.insert_ignore(merge.update_keyed(want, spark.createDataFrame([(9, "nine", None)], SCHEMA), ["k"], ["name"]), spark.createDataFrame([(6000, "yes", 1)], SCHEMA), ["k"])
    assert rows(held.read()) == rows(want)


def test_null_keys_and_empty_batches(spark, tmp_path):
    held = Buckets(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=4)
    held.upsert(spark.createDataFrame([(None, "a", 1), (1, "b", 2)], SCHEMA), {"name": Rule.OVERWRITE, "n": Rule.OVERWRITE}, 0)
    held.upsert(spark.createDataFrame([], SCHEMA), {"name": Rule.OVERWRITE}, 1)
    held.upsert(spark.createDataFrame([(None, "c", 3)], SCHEMA), {"name": Rule.OVERWRITE}, 2)
    assert rows(held.read()) == rows(spark.createDataFrame([(None, "c", 1), (1, "b", 2)], SCHEMA))
    assert held.read().where(F.col("k").isNull()).count() == 1
