"""Registered queries of tables that are kept: merges by buckets, streams over slices, counts from files, and semi-structured columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadenza.operators.bucketed import Buckets
from cadenza.operators.merge import Rule
from cadenza.plans import jobs
from cadenza.plans.catalogue import SQL, _tracks, query, table
from cadenza.session import shared_dir
from cadenza.sources import footers, variants


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(SQL["upsert_overwrite"])
def bucketed_upsert(spark, d):
    """``upsert_overwrite`` on a table in buckets: one batch of changes, one of new rows."""
    target = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    name = F.when(F.col("c_custkey") % 2 == 0, F.lit(None)).otherwise(F.concat("c_name", F.lit("!")))
    held = Buckets(spark, fresh(spark, "customers"), target.schema, ["c_custkey"])
    held.fill(target)
    held.upsert(target.where("c_custkey % 3 = 0").select("c_custkey", name.alias("c_name")), {"c_name": Rule.OVERWRITE}, 1)
    held.upsert(target.where("c_custkey % 7 = 0").select((-1 - F.col("c_custkey")).alias("c_custkey"), name.alias("c_name")), {"c_name": Rule.OVERWRITE}, 2)
    return held.read()


@query(SQL["upsert_rules_matrix"])
def bucketed_rules_matrix(spark, d):
    base = table(spark, d, "supplier")
    target = base.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey", F.lit(1).alias("stamp"))
    source = base.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit("new").alias("s_name"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal") + 1).alias("s_acctbal"), F.lit(None).cast("int").alias("s_nationkey"), F.lit(2).alias("stamp"))
    held = Buckets(spark, fresh(spark, "suppliers"), target.schema, ["s_suppkey"])
    held.fill(target)
    held.upsert(source, {"s_name": Rule.KEEP, "s_acctbal": Rule.COALESCE, "s_nationkey": Rule.OVERWRITE, "stamp": Rule.STAMP}, 1)
    return held.read().withColumn("s_nationkey", F.coalesce(F.col("s_nationkey").cast("string"), F.lit("none")))


@query(SQL["conditional_update_count"])
def bucketed_update_count(spark, d):
    target = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", F.col("o_orderstatus").alias("was"))
    held = Buckets(spark, fresh(spark, "orders"), target.schema, ["o_orderkey"])
    held.fill(target)
    merged = held.upsert(target.where("o_custkey % 5 = 0").select("o_orderkey", F.lit("F").alias("o_orderstatus")), {"o_orderstatus": Rule.OVERWRITE}, 1, changed_flag="changed")
    changed = merged.where("changed").select("o_orderkey", F.lit(True).alias("changed"))
    return held.read().join(changed, "o_orderkey", "left").groupBy(F.col("was").alias("o_orderstatus")).agg(F.count("*").alias("n"), F.count_if("changed").alias("n_changed"))


@query("SELECT count(*) AS n, min(l_orderkey) AS least_l_orderkey, max(l_partkey) AS greatest_l_partkey, max(l_linenumber) AS greatest_l_linenumber FROM lineitem")
def footer_statistics(spark, d):
    row = footers.statistics(spark, f"{d}/lineitem.parquet", ("l_orderkey",), ("l_partkey", "l_linenumber")).first()
    return spark.createDataFrame([tuple(row)], "n long, least_l_orderkey long, greatest_l_partkey long, greatest_l_linenumber long")


@query("""
SELECT p_partkey AS track_id, CASE WHEN k = 'not_found' THEN 'no_plausible_candidate' WHEN k = 'no_lyrics' THEN 'instrumental_or_empty' WHEN k = 'review_required' THEN 'version_token_mismatch' END AS reason,
  CASE WHEN k <> 'not_found' THEN p_partkey END AS candidate_id, CASE WHEN k = 'review_required' THEN 'no_tier1_candidate' END AS promotion, CASE WHEN k = 'review_required' THEN 'live' END AS candidate_token
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 OR p_partkey % 3 = 2 THEN 'not_found' WHEN p_partkey % 5 = 3 THEN 'no_lyrics' WHEN p_partkey % 5 = 2 THEN 'review_required' ELSE 'matched' END AS k FROM part)""")
def match_evidence(spark, d):
    """What led to each outcome, read back from the stored JSON as a variant."""
    done = jobs.evaluate_lyrics(*_tracks(spark, d))["write"].select("track_id", variants.parsed("evidence").alias("e"))
    said = [variants.field("e", f"$.{name}", kind).alias(name) for name, kind in (("reason", "string"), ("candidate_id", "bigint"), ("promotion", "string"))]
    return done.select("track_id", *said, variants.field("e", "$.candidate_tokens[0]", "string").alias("candidate_token"))


@query("""
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT '$.k' AS path, 'changed' AS change, 'BIGINT' AS was, 'STRING' AS now UNION ALL SELECT '$.old', 'gone', 'BOOLEAN', NULL WHERE EXISTS (FROM e WHERE event_id % 2 = 0)
UNION ALL SELECT '$.extra', 'appeared', NULL, 'OBJECT' WHERE EXISTS (FROM e WHERE event_id % 2 = 1 AND k > 50) UNION ALL SELECT '$.extra.n', 'appeared', NULL, 'BIGINT' WHERE EXISTS (FROM e WHERE event_id % 2 = 1 AND k > 50)""")
def payload_drift(spark, d):
    """Even events as the batch before, odd ones as the one after: a field that changes its type, one that goes and one that comes; some payloads are malformed."""
    e, k = table(spark, d, "events"), F.get_json_object("props", "$.k").cast("bigint")
    before = e.where("event_id % 2 = 0").select(F.concat(F.lit('{"k": '), k.cast("string"), F.lit(', "old": true}')).alias("j"))
    after = e.where("event_id % 2 = 1").select(F.when(F.col("event_id") % 9 == 1, "{broken").otherwise(F.concat(F.lit('{"k": "'), k.cast("string"), F.lit('"'), F.when(k > 50, ', "extra": {"n": 1}').otherwise(""), F.lit("}"))).alias("j"))
    found = variants.drift(*(df.select(variants.parsed("j").alias("v")) for df in (before, after)), "v")
    return found.select("path", "change", F.array_join("was", ",").alias("was"), F.array_join("is", ",").alias("now"))
