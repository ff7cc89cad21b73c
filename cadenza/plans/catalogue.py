"""The registered queries: each applies an operator to the supplied tables, beside the same query in SQL.

``query`` registers a function under its name with its SQL (none where SQL can't express it).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import dates
from cadenza.functions import text as T
from cadenza.operators import calendar, joins, merge, rank, reconcile, resolve, similar
from cadenza.operators.merge import Rule
from cadenza.plans import jobs
from cadenza.session import durable
from cadenza.sources import variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_SECOND = "yyyy-MM-dd HH:mm:ss"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def second(c) -> F.Column:
    return F.date_format(c, _SECOND)


@query("""
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_play_per_user(spark, d):
    got = rank.best_per_key(table(spark, d, "events"), ["user_id"], F.struct("ts", "event_id"), descending=True)
    return got.select("user_id", "event_id", "event_type", second("ts").alias("at"))


@query("SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def recent_window_top50(spark, d):
    return rank.newest(table(spark, d, "events"), "ts", "event_id", 50).select("event_id", "user_id", second("ts").alias("at"))


@query("""
WITH w AS (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 50)
SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at, count(*) AS n FROM w GROUP BY event_type""")
def recent_groups_first_seen(spark, d):
    w = rank.newest(table(spark, d, "events"), "ts", "event_id", 50)
    return w.groupBy("event_type").agg(second(F.max("ts")).alias("last_at"), F.count("*").alias("n"))


@query("""
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'held' ELSE 'new' END AS origin FROM events""")
def play_log_insert_ignore(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    held = e.where("ts < timestamp_ntz'2024-01-15'").withColumn("origin", F.lit("held"))
    new = e.where("ts >= timestamp_ntz'2024-01-10'").withColumn("origin", F.lit("new"))
    return merge.insert_ignore(held, new, ["user_id", "ts"], "event_id").select("event_id", "origin")


@query("""
SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view'
UNION ALL SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type = 'view') WHERE r = 1""")
def now_playing_replace(spark, d):
    e = table(spark, d, "events")
    latest = rank.best_per_key(e.where("event_type = 'view'"), ["user_id"], F.struct("ts", "event_id"), descending=True)
    return merge.replace_where(e, latest, ["user_id"], F.col("event_type") == "view").select("event_id", "user_id", "event_type")


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events),
g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type <> 'error')
SELECT l.user_id, l.event_type <> 'error' AS is_playing, strftime(l.ts, '%Y-%m-%d %H:%M:%S') AS updated_at, g.event_type AS last_type, g.value AS last_value
FROM l LEFT JOIN g ON l.user_id = g.user_id AND g.r = 1 WHERE l.r = 1""")
def now_state_idle_keep(spark, d):
    e = table(spark, d, "events")
    order = F.struct("ts", "event_id")
    shown = rank.best_per_key(e.where("event_type <> 'error'"), ["user_id"], order, descending=True)
    state = shown.select("user_id", F.lit(True).alias("is_playing"), F.col("ts").alias("updated_at"), F.col("event_type").alias("last_type"), F.col("value").alias("last_value"))
    latest = rank.best_per_key(e, ["user_id"], order, descending=True)
    idle = latest.select("user_id", (F.col("event_type") != "error").alias("is_playing"), F.col("ts").alias("updated_at"))
    merged = merge.upsert(state, idle, ["user_id"], {"is_playing": Rule.OVERWRITE, "updated_at": Rule.OVERWRITE})
    return merged.withColumn("updated_at", second("updated_at"))


@query("""
SELECT c_custkey, coalesce(m.since, -1) AS since FROM customer LEFT JOIN
(SELECT user_id, CAST(floor(epoch(max(ts))) AS BIGINT) + 1 AS since FROM events GROUP BY user_id) m ON c_custkey = m.user_id""")
def cursor_per_user(spark, d):
    held = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("played_at"), F.lit(False).alias("is_now_playing"))
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("connected").alias("status"))
    return jobs.scrobble_cursors(users, held).select(F.col("user_id").alias("c_custkey"), F.coalesce("since", F.lit(-1)).alias("since"))


@query("""
WITH c AS (SELECT event_type, max(ts) AS since FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY event_type)
SELECT e.event_id, e.event_type FROM events e JOIN c USING (event_type) WHERE e.ts > c.since""")
def incremental_since_cursor(spark, d):
    e = table(spark, d, "events")
    held = e.where("ts < timestamp_ntz'2024-01-20'")
    return jobs.since_cursor(joins.with_keys(e, held, ["event_type"]), held, "ts", ["event_type"]).select("event_id", "event_type")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN c_name || '!' ELSE c_name END AS c_name, c_mktsegment FROM customer
UNION ALL SELECT -1 - c_custkey, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name || '!' END, NULL FROM customer WHERE c_custkey % 7 = 0""")
def upsert_overwrite(spark, d):
    target = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    name = F.when(F.col("c_custkey") % 2 == 0, F.lit(None)).otherwise(F.concat("c_name", F.lit("!")))
    hit = target.where("c_custkey % 3 = 0").select("c_custkey", name.alias("c_name"))
    new = target.where("c_custkey % 7 = 0").select((-1 - F.col("c_custkey")).alias("c_custkey"), name.alias("c_name"))
    return merge.upsert(target, hit.union(new), ["c_custkey"], {"c_name": Rule.OVERWRITE})


@query("""
WITH o AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r,
  CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END AS side FROM events),
t AS (SELECT user_id, event_type, max(k) AS k FROM o WHERE side = 0 GROUP BY 1, 2), s AS (SELECT user_id, event_type, max(k) AS k FROM o WHERE side = 1 GROUP BY 1, 2),
j AS (SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.event_type, t.event_type) AS event_type, coalesce(s.k, t.k) AS k FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type)
SELECT user_id, string_agg(event_type || '=' || k, ',' ORDER BY event_type) AS refs FROM j GROUP BY user_id""")
def upsert_map_merge(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"), (F.col("event_id") % 2).alias("side"))
    maps = lambda side: e.where(F.col("side") == side).groupBy("user_id", "event_type").agg(F.max("k").alias("k")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "k"))).alias("refs"))
    merged = merge.upsert(maps(0), maps(1), ["user_id"], {"refs": Rule.MAP_MERGE})
    return merged.select("user_id", F.array_join(F.transform(F.array_sort(F.map_entries("refs")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",").alias("refs"))


@query("""
SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 AND s_suppkey % 3 <> 0 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal,
  CASE WHEN s_suppkey % 2 = 0 THEN 'none' ELSE CAST(s_nationkey AS VARCHAR) END AS s_nationkey, CASE WHEN s_suppkey % 2 = 0 AND (s_suppkey % 3 <> 0 OR s_nationkey IS NOT NULL) THEN 2 ELSE 1 END AS stamp FROM supplier""")
def upsert_rules_matrix(spark, d):
    base = table(spark, d, "supplier")
    target = base.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey", F.lit(1).alias("stamp"))
    source = base.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit("new").alias("s_name"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal") + 1).alias("s_acctbal"), F.lit(None).cast("int").alias("s_nationkey"), F.lit(2).alias("stamp"))
    merged = merge.upsert(target, source, ["s_suppkey"], {"s_name": Rule.KEEP, "s_acctbal": Rule.COALESCE, "s_nationkey": Rule.OVERWRITE, "stamp": Rule.STAMP})
    return merged.withColumn("s_nationkey", F.coalesce(F.col("s_nationkey").cast("string"), F.lit("none")))


@query("""
SELECT o_orderstatus, count(*) AS n, count(*) FILTER (WHERE o_custkey % 5 = 0 AND o_orderstatus <> 'F') AS n_changed FROM orders GROUP BY o_orderstatus""")
def conditional_update_count(spark, d):
    target = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    source = target.where("o_custkey % 5 = 0").select("o_orderkey", F.lit("F").alias("o_orderstatus"))
    merged = merge.upsert(target.select("o_orderkey", "o_orderstatus", "o_custkey", F.col("o_orderstatus").alias("was")), source, ["o_orderkey"], {"o_orderstatus": Rule.OVERWRITE}, changed_flag="changed")
    return merged.groupBy(F.col("was").alias("o_orderstatus")).agg(F.count("*").alias("n"), F.count_if("changed").alias("n_changed"))


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice FROM orders""")
def observation_no_status(spark, d):
    target = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    seen = target.where("o_orderkey % 4 = 0").select("o_orderkey", F.lit("announced").alias("o_orderstatus"), (F.col("o_totalprice") + 10).alias("o_totalprice"))
    return merge.upsert(target, seen, ["o_orderkey"], {"o_orderstatus": Rule.KEEP, "o_totalprice": Rule.OVERWRITE})


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def prune_to_keepset(spark, d):
    keep = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return merge.prune(table(spark, d, "part"), keep, ["p_partkey"]).select("p_partkey", "p_brand")


@query("SELECT p_partkey, p_brand FROM part WHERE false")
def prune_empty_keep(spark, d):
    keep = table(spark, d, "lineitem").where("l_quantity < 0").select(F.col("l_partkey").alias("p_partkey"))
    return merge.prune(table(spark, d, "part"), keep, ["p_partkey"]).select("p_partkey", "p_brand")


@query("""
WITH h AS (SELECT DISTINCT user_id, user_id * 2 AS position FROM events WHERE ts < TIMESTAMP '2024-01-01 06:00:00'),
s AS (SELECT user_id, min(event_id) AS first FROM events WHERE user_id NOT IN (SELECT user_id FROM h) GROUP BY user_id)
SELECT user_id, (SELECT coalesce(max(position), -1) FROM h) + row_number() OVER (ORDER BY first, user_id) AS position FROM s""")
def position_append(spark, d):
    e = table(spark, d, "events")
    held = e.where("ts < timestamp_ntz'2024-01-01 06:00:00'").select("user_id", (F.col("user_id") * 2).alias("position")).distinct()
    return merge.append_positions(held, e.select("user_id", "event_id"), "user_id", "event_id").select("user_id", "position")


@query("""
WITH k AS (SELECT DISTINCT o_custkey FROM orders), p AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS p FROM k)
SELECT CAST(floor(p / 20) AS BIGINT) AS chunk, string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY o_custkey) AS keys FROM p GROUP BY 1""")
def chunk_ids_20(spark, d):
    got = rank.chunks(table(spark, d, "orders"), "o_custkey", 20)
    return got.select("chunk", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"))


@query("""
SELECT d.source, count(*) AS n, string_agg(DISTINCT d.lang, ',' ORDER BY d.lang) AS langs
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL GROUP BY d.source""")
def uncorpused_selection(spark, d):
    open_ = joins.without_keys(table(spark, d, "documents").select("doc_id", "source", "lang"), table(spark, d, "labels"), ["doc_id"])
    return open_.groupBy("source").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'O') OR (o_orderstatus = 'F' AND o_orderpriority LIKE '1-%')
ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o_orderdate NULLS FIRST, o_orderkey LIMIT 6000""")
def unresolved_tiered_order(spark, d):
    o = table(spark, d, "orders")
    rows = o.select(F.col("o_orderkey").alias("track_id"), F.element_at(F.create_map(*map(F.lit, ("P", "ambiguous", "F", "matched", "O", "not_found"))), F.col("o_orderstatus")).alias("match_status"), F.when(F.col("o_orderpriority").startswith("1-"), "best-of-review").alias("basis"), F.col("o_orderdate").alias("updated_at"), "o_orderstatus")
    return jobs.unresolved(rows, 6000).select(F.col("track_id").alias("o_orderkey"), "o_orderstatus")


@query("""
SELECT c_custkey FROM customer c WHERE c_acctbal >= 9000 OR EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT' AND o.o_totalprice > 450000)""")
def watchlist_or_exists(spark, d):
    hot = table(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.passes_or_exists(table(spark, d, "customer"), F.col("c_acctbal") >= 9000, hot, ["c_custkey"]).select("c_custkey")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey")
def left_literal_on(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return joins.left_filtered(table(spark, d, "customer"), o, ["c_custkey"], F.col("o_orderstatus") == "F").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey")
def scalar_lookup_fk(spark, d):
    return joins.lookup(table(spark, d, "orders"), table(spark, d, "customer").where("c_acctbal > 0"), "o_custkey", "c_custkey", "c_name", "c_name").select("o_orderkey", "c_name")


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_shipdate >= DATE '2000-01-01' AND l_shipdate < DATE '2000-03-01')")
def anti_novel_ids(spark, d):
    seen = table(spark, d, "lineitem").where("l_shipdate >= timestamp_ntz'2000-01-01' and l_shipdate < timestamp_ntz'2000-03-01'")
    return joins.without_keys(table(spark, d, "part"), seen.select(F.col("l_partkey").alias("p_partkey")), ["p_partkey"]).select("p_partkey")


@query("""
SELECT o_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS gap FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) <= 7""")
def band_confirm_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("key"), F.to_date("o_orderdate").alias("ordered"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("shipped"))
    return joins.band_join(o, li, ["key"], "ordered", "shipped", 7).select("o_orderkey", "l_linenumber", "l_partkey", F.datediff("shipped", "ordered").cast("long").alias("gap"))


@query("""
WITH e AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_custkey AS artist_id, lower(o_orderpriority) AS title, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 2 = 0),
c AS (SELECT o_custkey AS artist_id, o_orderkey AS album, lower(o_orderpriority) AS title, CAST(o_orderdate AS DATE) AS day, o_totalprice > 250000 AS gate FROM orders WHERE o_orderkey % 2 = 1),
h AS (SELECT e.id, c.album FROM c JOIN e ON c.artist_id = e.artist_id AND c.title = e.title AND abs(date_diff('day', c.day, e.day)) <= 30)
SELECT 'flips' AS branch, count(DISTINCT id) AS n FROM h
UNION ALL SELECT 'inserts', count(*) FROM c WHERE gate AND album NOT IN (SELECT album FROM h)
UNION ALL SELECT 'skipped', count(*) FROM c WHERE NOT gate AND album NOT IN (SELECT album FROM h)""")
def confirm_branching(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    events = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("artist_id"), F.concat(F.lower("o_orderpriority"), F.lit(" - Single")).alias("title"), F.col("day").alias("release_date"))
    found = o.where("o_orderkey % 2 = 1").select(F.col("o_custkey").alias("artist_id"), F.col("o_orderkey").alias("spotify_album_id"), F.upper("o_orderpriority").alias("title"), F.lit("album").alias("release_type"), F.col("day").alias("release_date"), (F.col("o_totalprice") > 250000).alias("passes_gate"), F.col("o_orderkey").alias("ord"))
    branches = zip(("flips", "inserts", "skipped"), calendar.confirm(found, events, 30), strict=True)
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("branch"), "n") for name, df in branches]
    return counts[0].union(counts[1]).union(counts[2])


@query("""
SELECT o_custkey, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY r) AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS r FROM orders) WHERE r <= 2 AND o_orderstatus = 'F') WHERE s = 1""")
def upc_fallback_top2(spark, d):
    got = rank.ladder(table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()], F.col("o_orderstatus") == "F")
    return got.select("o_custkey", "o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem) WHERE r = 1""")
def source_dedup_first_wins(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rank.best_per_key(li, ["l_orderkey"], F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))


@query("""
WITH p AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS position, count(*) OVER () AS n FROM customer),
b AS (SELECT *, CAST(greatest(1, ceil(n / 70.0)) AS BIGINT) AS buckets FROM p), s AS (SELECT *, (101 % buckets) * 70 AS start FROM b),
z AS (SELECT *, least(70, n - start) AS size FROM s)
SELECT c_custkey, ((position - start - (CAST(floor(101 / buckets) AS BIGINT) % size)) % size + size) % size AS visit FROM z WHERE position >= start AND position < start + size""")
def rotation_bucket(spark, d):
    return rank.rotation(table(spark, d, "customer"), ["c_custkey"], 70, 101).select("c_custkey", "visit")


_SETS = """
WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS newest, arg_min(event_type, (ts, event_id)) AS oldest FROM events GROUP BY user_id),
w AS (SELECT user_id AS key FROM l WHERE newest IN ('purchase', 'view', 'signup')), h AS (SELECT user_id AS key FROM l WHERE oldest IN ('view', 'click', 'error')),
p AS (SELECT key, 'ADD' AS op FROM w WHERE key NOT IN (SELECT key FROM h)
  UNION ALL SELECT key, CASE WHEN key % 3 = 0 THEN 'REMOVE' ELSE 'PULL' END FROM h WHERE key NOT IN (SELECT key FROM w)) """


def _plan(spark, d):
    e, order = table(spark, d, "events").withColumnRenamed("user_id", "key"), F.struct("ts", "event_id")
    ends = e.groupBy("key").agg(F.max_by("event_type", order).alias("newest"), F.min_by("event_type", order).alias("oldest"))
    known = e.where("key % 3 <> 2").select("key", F.when(F.col("key") % 3 == 0, reconcile.OURS).otherwise(reconcile.BEFORE).alias("source"))
    return reconcile.plan(ends.where(F.col("newest").isin("purchase", "view", "signup")), ends.where(F.col("oldest").isin("view", "click", "error")), known)


@query(_SETS + "SELECT key, op FROM p")
def reconcile_sets(spark, d):
    return _plan(spark, d)


@query(_SETS + "SELECT count(*) FILTER (WHERE op = 'ADD') AS add, count(*) FILTER (WHERE op = 'REMOVE') AS remove, count(*) FILTER (WHERE op = 'PULL') AS pull FROM p")
def reconcile_funnel(spark, d):
    return reconcile.funnel(_plan(spark, d))


@query("""
WITH s AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-05' GROUP BY user_id),
h AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-10' GROUP BY user_id), m AS (SELECT max(t) AS since FROM h)
SELECT 'full' AS mode, user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS added FROM s
UNION ALL SELECT 'incremental', coalesce(s.user_id, h.user_id), strftime(coalesce(s.t, h.t), '%Y-%m-%d %H:%M:%S') FROM h FULL JOIN (SELECT s.* FROM s, m WHERE s.t > m.since) s ON s.user_id = h.user_id""")
def saved_full_vs_incremental(spark, d):
    e = table(spark, d, "events").where("event_type = 'purchase'")
    name = lambda c: F.concat(F.lit("t"), c.cast("string"))
    held = e.where("ts < timestamp_ntz'2024-01-10'").groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("added_at"))
    held = held.select(name(F.col("user_id")).alias("spotify_track_id"), *(F.lit(None).cast(t).alias(c) for c, t in (("track_name", "string"), ("artist_name", "string"), ("album_name", "string"), ("album_sid", "string"), ("track_id", "string"), ("album_id", "string"))), "added_at", F.lit(None).cast("bigint").alias("duration_ms"))
    new = e.where("ts >= timestamp_ntz'2024-01-05'")
    none = F.lit(None).cast("string")
    track = F.struct(name(F.col("user_id")).alias("id"), none.alias("name"), F.lit(None).cast("bigint").alias("duration_ms"), F.lit(None).cast("array<struct<id:string,name:string>>").alias("artists"), F.struct(none.alias("id"), none.alias("name")).alias("album"))
    items = new.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("added_at"), track.alias("track"))
    empty = spark.createDataFrame([], "id string, spotify_id string")
    out = [jobs.sync_saved_tracks(held, items, empty, empty, mode).select(F.lit(mode).alias("mode"), F.substring("spotify_track_id", 2, 20).cast("long").alias("user_id"), second("added_at").alias("added")) for mode in ("full", "incremental")]
    return out[0].union(out[1])


@query("""
SELECT event_id, coalesce(CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) < 60, false) AS debounced FROM events""")
def debounce_flag(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    last = F.lag("at").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select("event_id", "at", last.alias("last")).select("event_id", dates.debounced(F.col("at"), F.col("last")).alias("debounced"))


_RAW = """CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN '' WHEN 4 THEN '0000'
  WHEN 5 THEN 'abcd' WHEN 6 THEN strftime(o_orderdate, '%Y/%m') WHEN 7 THEN '2024-13' ELSE '199-01-01' END"""


def _raw_dates(spark, d):
    o = table(spark, d, "orders")
    f = lambda p: F.date_format("o_orderdate", p)
    k, raw = F.col("o_orderkey") % 9, F.lit("199-01-01")
    for i, v in reversed(list(enumerate((f("yyyy"), f("yyyy-MM"), f("yyyy-MM-dd"), F.lit(""), F.lit("0000"), F.lit("abcd"), f("yyyy/MM"), F.lit("2024-13"))))):
        raw = F.when(k == i, v).otherwise(raw)
    return o.select("o_orderkey", raw.alias("raw"))


@query(f"""
SELECT o_orderkey, CASE WHEN regexp_full_match(raw, '[0-9]{{4}}') AND raw <> '0000' THEN raw || '-01-01' WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}') THEN raw || '-01'
  WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN raw END AS day FROM (SELECT o_orderkey, {_RAW} AS raw FROM orders)""")
def release_date_normalize(spark, d):
    return _raw_dates(spark, d).select("o_orderkey", dates.normalize_release_date(F.col("raw")).alias("day"))


@query(f"""
SELECT o_orderkey, regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND coalesce(TRY_CAST(raw AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1999-12-31', false) AS inside,
  CASE WHEN raw = '' THEN '0000-01-01' ELSE substr(raw || '-01-01', 1, 10) END AS key FROM (SELECT o_orderkey, {_RAW} AS raw FROM orders)""")
def date_window_fulldate(spark, d):
    return _raw_dates(spark, d).select("o_orderkey", dates.in_window(F.col("raw"), F.to_date(F.lit("1998-01-01")), 729).alias("inside"), dates.freshness_key(F.col("raw")).alias("key"))


@query(r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}'']', ' ', 'g'), ' +', ' ', 'g')) AS title FROM documents""")
def title_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_title("text").alias("title"))


_TITLES = """p_name || CASE p_partkey % 6 WHEN 0 THEN ' (Live)' WHEN 1 THEN ' (feat. X)' WHEN 2 THEN ' - 2013 Remastered' WHEN 3 THEN ' - From "Film"' WHEN 4 THEN ' [Club Remix]' ELSE '' END"""


def _titles(spark, d):
    p = table(spark, d, "part")
    tail = F.lit("")
    for i, s in enumerate((" (Live)", " (feat. X)", " - 2013 Remastered", ' - From "Film"', " [Club Remix]")):
        tail = F.when(F.col("p_partkey") % 6 == i, s).otherwise(tail)
    return p.select("p_partkey", "p_name", F.concat("p_name", tail).alias("title"))


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'live' WHEN 2 THEN 'remastered' WHEN 4 THEN 'club,remix' ELSE '' END AS tokens FROM part""")
def version_tokens(spark, d):
    return _titles(spark, d).select("p_partkey", F.array_join(T.version_tokens(T.normalize_title("title")), ",").alias("tokens"))


@query("""
SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 2 THEN ' 2013' ELSE '' END AS base, p_name || CASE p_partkey % 6 WHEN 1 THEN ' feat x' WHEN 2 THEN ' 2013' WHEN 3 THEN ' from film' ELSE '' END AS plain FROM part""")
def base_title(spark, d):
    forms = _titles(spark, d).select("p_partkey", T.clean_title("title").alias("clean"), T.normalize_title("title").alias("plain"))
    return forms.select("p_partkey", T.base_title(F.col("clean")).alias("base"), T.base_title(F.col("plain")).alias("plain"))


@query("""
WITH RECURSIVE t AS (SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages UNION SELECT p_name || ' ' || p_type FROM part),
c AS (SELECT title, ch, count(*) AS n FROM (SELECT title, unnest(string_split(title, '')) AS ch FROM t WHERE title <> '') GROUP BY ALL),
p AS (SELECT x.title AS a, y.title AS b FROM c x JOIN c y ON x.ch = y.ch AND x.title <> y.title GROUP BY ALL HAVING 2 * sum(least(x.n, y.n)) >= 0.8 * (length(a) + length(b))),
s AS (
  SELECT a, b, 1 AS alo, length(a) + 1 AS ahi, 1 AS blo, length(b) + 1 AS bhi, 0 AS found FROM p
  UNION ALL
  SELECT a, b, CASE side WHEN 0 THEN alo ELSE i + k END, CASE side WHEN 0 THEN i ELSE ahi END, CASE side WHEN 0 THEN blo ELSE j + k END, CASE side WHEN 0 THEN j ELSE bhi END, CASE side WHEN 0 THEN k ELSE 0 END
  FROM (
    SELECT a, b, alo, ahi, blo, bhi, count(*) AS k, min(i) AS i, min(j) AS j
    FROM (
      SELECT *, i - row_number() OVER (PARTITION BY a, b, alo, ahi, blo, bhi, j - i ORDER BY i) AS run
      FROM (SELECT *, unnest(range(blo, bhi)) AS j FROM (SELECT a, b, alo, ahi, blo, bhi, unnest(range(alo, ahi)) AS i FROM s)) WHERE a[i] = b[j])
    GROUP BY a, b, alo, ahi, blo, bhi, j - i, run
    QUALIFY row_number() OVER (PARTITION BY a, b, alo, ahi, blo, bhi ORDER BY count(*) DESC, min(i), min(j)) = 1), (VALUES (0), (1)) v(side))
SELECT a, b, 2.0 * m / (length(a) + length(b)) AS ratio FROM (SELECT a, b, sum(found) AS m FROM s GROUP BY a, b) WHERE 2.0 * m / (length(a) + length(b)) >= 0.8""")
def title_similarity(spark, d):
    titles = table(spark, d, "pages").select(F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    named = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("title"))
    return similar.similar(titles.union(named), T.FUZZY)


def _tracks(spark, d):
    """Parts as tracks of their brands' artists, and candidates made of them: the same title, one with noise, a live one, an instrumental one, or none."""
    p = table(spark, d, "part")
    seconds = (F.col("p_size") * 7 + F.col("p_partkey") % 50).cast("double")
    tracks = p.select(F.col("p_partkey").alias("track_id"), F.col("p_name").alias("title"), F.array(F.concat(F.lit("The "), "p_brand", F.lit(" "), F.col("p_partkey").cast("string"))).alias("artist_names"), F.array().cast("array<string>").alias("aliases"), seconds.alias("duration_sec"))
    k = F.col("p_partkey") % 5
    title = F.when(k == 1, F.concat("p_name", F.lit(" (feat. Y)"))).when(k == 2, F.concat("p_name", F.lit(" (Live)"))).otherwise(F.col("p_name"))
    cands = p.where("p_partkey % 5 <> 4").select(F.col("p_partkey").alias("id"), title.alias("title"), F.concat("p_brand", F.lit(" "), F.col("p_partkey").cast("string")).alias("artist"), F.lit(None).cast("string").alias("album"), (seconds + F.when(F.col("p_partkey") % 3 == 0, 2.0).when(F.col("p_partkey") % 3 == 1, 0.0).otherwise(2.5)).alias("duration_sec"), (k == 3).alias("instrumental"), F.lit("words").alias("plain_lyrics"), F.lit(None).cast("string").alias("synced_lyrics"), F.col("p_partkey").alias("ord"))
    return tracks, cands


_DECIDED = """CASE WHEN p_partkey % 5 = 4 OR p_partkey % 3 = 2 THEN 'not_found' WHEN p_partkey % 5 = 3 THEN 'no_lyrics' WHEN p_partkey % 5 = 2{0} THEN 'review_required' ELSE 'matched' END"""


@query(f"""
SELECT track_id, match_status, CASE WHEN match_status = 'matched' THEN 'exact-title' END AS basis FROM (SELECT p_partkey AS track_id, {_DECIDED.format('')} AS match_status FROM part)""")
def match_decision(spark, d):
    return resolve.decide(*_tracks(spark, d)).select("track_id", "match_status", "basis")


@query(f"""
SELECT track_id, match_status, CASE WHEN match_status = 'matched' THEN 'exact-title' END AS basis,
  CASE WHEN match_status = 'not_found' THEN NULL WHEN track_id % 5 = 2 AND track_id % 7 <> 0 THEN track_id + 1000000000 ELSE track_id END AS candidate_id,
  CASE WHEN match_status = 'review_required' THEN 'no_tier1_candidate' END AS promotion
FROM (SELECT p_partkey AS track_id, {_DECIDED.format(' AND p_partkey % 7 = 0')} AS match_status FROM part)""")
def match_promotion(spark, d):
    tracks, cands = _tracks(spark, d)
    twin = cands.where("id % 5 = 2 and id % 7 <> 0").select(*((F.col("id") + 1_000_000_000).alias("id") if c == "id" else F.regexp_replace("title", r" \(Live\)", "").alias("title") if c == "title" else F.col(c) for c in cands.columns))
    pairs = durable(resolve.plausible(tracks, cands.union(twin)), "pairs")  # read twice
    return resolve.promote(resolve.decide(tracks, cands.union(twin), pairs), pairs).select("track_id", "match_status", "basis", "candidate_id", "promotion")


_BASES = "(VALUES (NULL, 0), ('fuzzy-title', 1), ('best-of-review', 2), ('exact-title', 3), ('isrc', 5), ('other', 0))"


@query(f"""
WITH b(basis, s) AS (SELECT * FROM {_BASES} v(basis, s)), o(status) AS (VALUES ('matched'), ('no_lyrics'), ('not_found'), ('ambiguous'))
SELECT q.quality, o.status AS old_status, coalesce(b.basis, '-') AS old_basis, n.status AS new_status, coalesce(m.basis, '-') AS new_basis, q.n,
  o.status IN ('not_found', 'ambiguous') OR (n.status = 'matched' AND m.s > b.s) AS replaces
FROM (SELECT quality, count(*) AS n FROM labels GROUP BY quality) q, o, b, o n, b m""")
def replacement_guard(spark, d):
    q = table(spark, d, "labels").groupBy("quality").agg(F.count("*").alias("n"))
    bases, states = F.array(*(F.lit(b) for b in (None, "fuzzy-title", "best-of-review", "exact-title", "isrc", "other"))), F.array(*map(F.lit, ("matched", "no_lyrics", "not_found", "ambiguous")))
    g = q.withColumn("old_status", F.explode(states)).withColumn("old_b", F.explode(bases)).withColumn("new_status", F.explode(states)).withColumn("new_b", F.explode(bases))
    guard = resolve.should_replace(F.col("old_status"), F.col("old_b"), F.col("new_status"), F.col("new_b"))
    return g.select("quality", "old_status", F.coalesce("old_b", F.lit("-")).alias("old_basis"), "new_status", F.coalesce("new_b", F.lit("-")).alias("new_basis"), "n", guard.alias("replaces"))


@query("""
WITH said AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS album_sid, p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
g(p_type, slug, weak) AS (VALUES ('ECONOMY', 'hip-hop', false), ('PROMO', 'k-pop', true), ('SMALL', 'k-pop', true), ('LARGE', 'rock', false)),
m AS (SELECT album_sid, slug, weak FROM said JOIN g USING (p_type))
SELECT DISTINCT album_sid, slug FROM m WHERE NOT weak OR album_sid NOT IN (SELECT album_sid FROM m WHERE NOT weak)""")
def genre_attach(spark, d):
    genres = spark.createDataFrame([("ECONOMY", "hip-hop", False), ("PROMO", "k-pop", True), ("SMALL", "k-pop", True), ("LARGE", "rock", False)], "genre string, slug string, arbitration_only boolean")
    artists = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("spotify_id"), F.array("p_type").alias("genres"))
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("album_sid"), F.col("l_partkey").cast("string").alias("artist_sid"))
    return jobs.attach_genres(spark.createDataFrame([], "album_sid string, slug string"), links, artists, genres)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path_extract(spark, d):
    e = table(spark, d, "events").withColumn("props", variants.parsed("props"))
    return e.select("event_id", variants.field("props", "$.k", "bigint").alias("k"))


@query("""
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS alias FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 3 = 0""")
def explode_outer_alias(spark, d):
    names = F.when(F.col("p_partkey") % 3 != 0, F.split("p_name", " ")).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "part").select("p_partkey", F.explode_outer(names).alias("alias"))


@query("""
SELECT n_nationkey, nullif(concat_ws(', ', CASE WHEN n_nationkey % 2 = 0 THEN n_name END, CASE WHEN n_nationkey % 3 = 0 THEN r_name END), '') AS names FROM nation JOIN region ON n_regionkey = r_regionkey""")
def concat_names_null(spark, d):
    j = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select("n_nationkey", T.joined_names(F.array(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")), F.when(F.col("n_nationkey") % 3 == 0, F.col("r_name")), F.lit(""))).alias("names"))


@query("""
WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 0 END AS rank, 'u' || l_partkey || '-' || l_suppkey AS url FROM lineitem WHERE l_partkey % 5 <> 0)
SELECT l_orderkey, url FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY rank DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS r FROM i) WHERE r = 1""")
def pick_best_image_ties_later(spark, d):
    sizes = F.element_at(F.array(F.lit("small"), F.lit("large"), F.lit("mega"), F.lit("huge")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    url = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("u"), "l_partkey", F.lit("-"), "l_suppkey")).otherwise("")
    li = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", sizes.alias("size"), url.alias("url")).alias("im"))
    images = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("im")).alias("images"))
    return images.select("l_orderkey", T.best_image(F.col("images")).alias("url")).where("url is not null")


@query("""
WITH t AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Album' WHEN 1 THEN 'EP' WHEN 2 THEN 'single' WHEN 3 THEN 'Broadcast' WHEN 4 THEN '' END AS raw, p_name || CASE p_partkey % 4 WHEN 0 THEN ' - Single' WHEN 1 THEN ' - EP' WHEN 2 THEN ' - single' ELSE '' END AS name FROM part)
SELECT p_partkey, CASE WHEN raw IN ('Album', 'EP', 'single') THEN lower(raw) WHEN raw = 'Broadcast' THEN 'other' END AS kind,
  CASE WHEN name LIKE '% - Single' THEN 'single' WHEN name LIKE '% - EP' THEN 'ep' ELSE 'album' END AS store FROM t""")
def release_type_map(spark, d):
    p, of = table(spark, d, "part"), lambda n, *v: F.try_element_at(F.array(*map(F.lit, v)), (F.col("p_partkey") % n + 1).cast("int"))
    return p.select("p_partkey", T.release_type(of(6, "Album", "EP", "single", "Broadcast", "")).alias("kind"), T.store_release_type(F.concat("p_name", of(4, " - Single", " - EP", " - single", ""))).alias("store"))


@query("""
WITH f AS (SELECT *, substr(strftime(o_orderdate, '%Y-%m-%d') || '-01-01', 1, 10) >= '2000-01-01' AS fresh FROM orders),
n AS (SELECT f.*, o_custkey % 4 = 0 AS held FROM f WHERE fresh)
SELECT (SELECT count(*) FROM orders) AS seen, (SELECT count(*) FROM f WHERE fresh) AS fresh, (SELECT count(DISTINCT o_custkey) FROM n WHERE NOT held) AS novel,
  (SELECT count(DISTINCT o_custkey) FROM n JOIN customer ON o_custkey = c_custkey WHERE NOT held AND c_acctbal >= 5000) AS passed,
  least(greatest(0, 400 - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 4 = 0)), (SELECT count(DISTINCT o_custkey) FROM n JOIN customer ON o_custkey = c_custkey WHERE NOT held AND c_acctbal >= 5000)) AS queued""")
def ingest_funnel(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    seen = o.select(F.col("o_custkey").cast("string").alias("album_sid"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"), F.col("o_orderkey").alias("ord"))
    held = o.where("o_custkey % 4 = 0").select(F.col("o_custkey").cast("string").alias("spotify_id")).distinct()
    rated = c.select(F.col("c_custkey").cast("string").alias("album_sid"), F.col("c_acctbal").alias("popularity"))
    return jobs.ingest_albums(seen, held, rated, "2000-01-01", 5000, 400)["counts"]


@query("""
SELECT l_orderkey, max(l_partkey) AS track FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) AS r FROM lineitem) WHERE r = 1 GROUP BY l_orderkey""")
def last_wins_by_ordinal(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("track"), F.struct("l_linenumber", "l_partkey").alias("ord"))
    return merge.last_wins(li, ["l_orderkey"], "ord").select("l_orderkey", "track")


@query("""
SELECT o_custkey AS artist_id, CASE WHEN count(*) FILTER (WHERE r <= 2 AND o_orderstatus = 'F') > 0 THEN 'upc' ELSE 'not_found' END AS resolved_via
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR)) AS r FROM orders) GROUP BY o_custkey
UNION ALL SELECT c_custkey, 'no_upc' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def source_id_resolution(spark, d):
    o = table(spark, d, "orders")
    upcs = o.select(F.col("o_custkey").alias("artist_id"), F.col("o_orderkey").cast("string").alias("upc"), F.col("o_orderdate").alias("release_date"))
    answers = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("upc"), F.col("o_orderkey").cast("string").alias("source_artist_id"))
    held = spark.createDataFrame([], "artist_id long, source string, source_artist_id string, resolved_via string, resolved_at timestamp")
    watch = table(spark, d, "customer").select(F.col("c_custkey").alias("artist_id"))
    return jobs.resolve_source_ids(watch, upcs, answers, held, F.to_timestamp(F.lit("2024-01-01"))).select("artist_id", "resolved_via")


@query("SELECT count(*) AS n_events, CAST(floor(epoch(greatest(max(CASE WHEN event_type = 'view' THEN ts END), max(CASE WHEN event_type = 'purchase' THEN ts END)))) AS BIGINT) AS last_write FROM events")
def last_write_age(spark, d):
    e = table(spark, d, "events")
    newest = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts").cast("timestamp")))
    return e.agg(F.count("*").alias("n_events"), F.unix_timestamp(F.greatest(newest("view"), newest("purchase"))).alias("last_write"))
