"""Counts from writes and from footers, and semi-structured columns."""

import json

from pyspark.sql import functions as F

from cadenza.operators import reconcile
from cadenza.plans import jobs
from cadenza.session import observed
from cadenza.sources import footers, variants


def test_counts_come_from_the_write(spark, monkeypatch):
    df = spark.range(1000).repartition(7).groupBy((F.col("id") % 100).alias("k")).count()
    kept, n = observed(df, "t", {"n": F.count("*"), "even": F.count_if(F.expr("k % 2 = 0"))}, F.col("k") < 30)
    assert n == {"n": 100, "even": 50} and kept.count() == 30
    assert observed(df.where("false"), "t", {"n": F.count("*")})[1] == {"n": 0}
    wanted, held = (spark.createDataFrame([(k,) for k in ks], "key string") for ks in ("abcd", "cdefg"))
    state = spark.createDataFrame([("e", "ours", "synced", True, None, None)], "key string, source string, state string, in_library boolean, last_error string, last_synced_at timestamp")
    out = jobs.sync_library(wanted, held, state, False, "2024-01-01")
    assert out["funnel"].first() == reconcile.funnel(out["plan"]).first() and out["funnel"].first().asDict() == {"add": 2, "remove": 1, "pull": 2}
    only = {(r.key, r.state, r.in_library) for r in out["state"].collect()}  # writes are off: rows only say what is planned
    assert only == {("a", "planned", None), ("b", "planned", None), ("e", "planned", True), ("f", "planned", None), ("g", "planned", None)}


def test_ingest_counts_the_catalogue_itself(spark):
    found = spark.createDataFrame([(f"s{i}", d, i) for i, d in enumerate(["2024", "2024-02", "2024-03-01", "1990", None, "2024", "2024"])] + [("s0", "2024", 9)], "album_sid string, release_date string, ord int")
    albums = spark.createDataFrame([("s1",), ("x",), ("y",)], "spotify_id string")
    rated = spark.createDataFrame([("s0", 60), ("s2", 50), ("s5", 70), ("s6", 10)], "album_sid string, popularity int")
    out = jobs.ingest_albums(found, albums, rated, "2000-01-01", 50, 5)
    assert out["counts"].first().asDict() == {"seen": 8, "fresh": 6, "novel": 4, "passed": 3, "queued": 2}
    assert [r.album_sid for r in out["queued"].orderBy("ord").collect()] == ["s0", "s2"]
    assert jobs.ingest_albums(found, albums, rated, "2000-01-01", 50, 2)["queued"].count() == 0


def test_statistics_read_footers_alone(spark, tmp_path):
    path, before = str(tmp_path / "t"), dict(spark.conf.getAll)
    spark.range(5000).selectExpr("id", "cast(id % 7 as int) as d", "cast(id as string) as s").repartition(3).write.parquet(path)
    got = footers.statistics(spark, path, ("id",), ("id", "d"))
    assert got.first().asDict() == {"n": 5000, "least_id": 0, "greatest_id": 4999, "greatest_d": 6}
    plan = got._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "MAX(d)" in plan
    assert footers.room(spark, path, 6000) == 1000 and footers.room(spark, path, 10) == 0 and footers.cursor(spark, path, "id") == 4999 and footers.cursor(spark, path, "s") == "999"
    assert dict(spark.conf.getAll) == before
    spark.range(0).selectExpr("id").write.parquet(f"{path}-none")
    assert footers.cursor(spark, f"{path}-none", "id") is None


def test_variants(spark):
    rows = ['{"a": 1, "b": {"c": "x", "l": [1, {"d": true}]}}', '{"a": "text"}', "{broken", None, '"plain"', '{"a": null}']
    df = spark.createDataFrame([(r,) for r in rows], "j string").select(variants.parsed("j").alias("v"))
    assert [r[0] for r in df.select(variants.field("v", "$.a", "bigint")).collect()] == [1, None, None, None, None, None]
    assert [r[0] for r in df.select(variants.field("v", "$.b.l[1].d", "boolean")).collect()] == [True, None, None, None, None, None]
    found = {(r.path, r.kind): r.n for r in variants.paths(df, "v", depth=4).collect()}
    assert found == {("$.a", "BIGINT"): 1, ("$.a", "STRING"): 1, ("$.a", "VOID"): 1, ("$.b", "OBJECT"): 1, ("$.b.c", "STRING"): 1, ("$.b.l", "ARRAY"): 1, ("$.b.l[]", "BIGINT"): 1, ("$.b.l[]", "OBJECT"): 1, ("$.b.l[].d", "BOOLEAN"): 1}
    assert variants.shape(df.where("v is not null"), "v") is not None
    old, new = (spark.createDataFrame([(json.dumps(x),) for x in xs], "j string").select(variants.parsed("j").alias("v")) for xs in ([{"a": 1, "b": 2, "n": None}], [{"a": "1", "c": {"d": 1}, "n": 3}]))
    assert {(r.path, r.change) for r in variants.drift(old, new, "v").collect()} == {("$.a", "changed"), ("$.b", "gone"), ("$.c", "appeared"), ("$.c.d", "appeared")}
