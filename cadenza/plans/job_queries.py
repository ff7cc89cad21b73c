"""Registered queries of whole jobs, selections, flattening and small rules, on the supplied tables in the roles of payloads and catalogue tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import dates
from cadenza.functions import text as T
from cadenza.operators import calendar, joins, merge, rank, reconcile, resolve
from cadenza.plans import dispatch, jobs
from cadenza.plans.catalogue import query, second, table
from cadenza.sources import flatten, landed

_NOW = "2024-02-01 00:00:00"


def now():
    return F.to_timestamp(F.lit(_NOW))


def text_of(name):
    return F.col(name).cast("string")


def instant(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def none(kind: str):
    return F.lit(None).cast(kind)


# selections


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 0 ORDER BY c_name DESC, c_custkey LIMIT 200")
def null_pool_selection(spark, d):
    c = table(spark, d, "customer").withColumn("photo_url", F.when(F.col("c_custkey") % 3 == 1, "").when(F.col("c_custkey") % 3 == 2, "not_found"))
    return jobs.untried(c, "photo_url", [F.col("c_name").desc(), "c_custkey"], 200).select("c_custkey", "c_name")


_CONNECTED = "SELECT c_custkey AS user_id FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 5 <> 0 ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END NULLS FIRST, c_custkey LIMIT 300"


def _integrations(spark, d):
    k, c = F.col("c_custkey"), table(spark, d, "customer")
    stamp = F.when(k % 3 != 0, F.timestamp_seconds(F.col("c_acctbal") + 20_000))
    return c.select(k.alias("user_id"), F.when(k % 4 == 0, "expired").otherwise("connected").alias("status"), F.when(k % 5 != 0, "name").alias("username"), F.when(k % 5 != 0, "{}").alias("payload"), stamp.alias("last_synced_at"))


@query(f"""
SELECT u.user_id, m.since FROM ({_CONNECTED}) u LEFT JOIN (SELECT user_id, CAST(floor(epoch(max(ts))) AS BIGINT) + 1 AS since FROM events WHERE event_type <> 'view' GROUP BY user_id) m USING (user_id)""")
def connected_users_with_cursor(spark, d):
    held = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("played_at"), (F.col("event_type") == "view").alias("is_now_playing"))
    return jobs.scrobble_cursors(_integrations(spark, d), held, 300).select("user_id", "since")


@query("SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS spotify_id FROM lineitem WHERE l_quantity > 49 AND l_suppkey % 3 = 0 AND l_suppkey IN (SELECT s_suppkey FROM supplier)")
def photoless_in_batch(spark, d):
    artists = table(spark, d, "supplier").select(text_of("s_suppkey").alias("spotify_id"), F.when(F.col("s_suppkey") % 3 != 0, "").alias("photo_url"))
    batch = table(spark, d, "lineitem").where("l_quantity > 49").select(text_of("l_suppkey").alias("spotify_id"))
    return jobs.photoless(artists, batch)


@query("""
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN (SELECT min(CAST(o_orderdate AS DATE)) - 7 FROM orders WHERE o_totalprice > 480000) AND (SELECT max(CAST(o_orderdate AS DATE)) + 7 FROM orders WHERE o_totalprice > 480000)""")
def events_in_reach(spark, d):
    o = table(spark, d, "orders").withColumn("release_date", F.to_date("o_orderdate"))
    return calendar.in_reach(o, o.where("o_totalprice > 480000"), 7).select("o_orderkey")


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2024-02-01' - INTERVAL 9000 DAY AS again, o_orderstatus <> 'F' AS answered, coalesce(o_totalprice >= 200000, false) AS watch FROM orders""")
def stale_answers_and_watch(spark, d):
    o = table(spark, d, "orders").withColumn("answer", F.when(F.col("o_orderstatus") == "F", "not_found").otherwise("an id"))
    again = jobs.stale(F.col("answer"), F.col("o_orderdate").cast("timestamp"), now(), 9000)
    return o.select("o_custkey", "o_orderkey", again.alias("again"), jobs.answered(F.col("answer")).alias("answered"), jobs.watched(F.col("o_totalprice"), 200000).alias("watch"))


@query("""
WITH t AS (SELECT l_orderkey, min(p_brand) AS search_artist, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS artists, string_agg(DISTINCT CASE WHEN p_partkey % 4 <> 0 THEN p_type END, ',' ORDER BY CASE WHEN p_partkey % 4 <> 0 THEN p_type END) AS aliases
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT t.* REPLACE (coalesce(aliases, '') AS aliases) FROM t WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)""")
def uncorpused_tracks(spark, d):
    li = table(spark, d, "lineitem")
    artists = table(spark, d, "part").select(F.col("p_partkey").alias("artist_id"), F.col("p_brand").alias("name"), F.when(F.col("p_partkey") % 4 != 0, F.array("p_type")).alias("aliases"))
    tracks, links = li.select(F.col("l_orderkey").alias("track_id")).distinct(), li.select(F.col("l_orderkey").alias("track_id"), F.col("l_partkey").alias("artist_id")).distinct()
    got = jobs.search_key(jobs.uncorpused(tracks, links, artists, li.where("l_discount > 0.08").select(F.col("l_orderkey").alias("track_id"))))
    return got.select(F.col("track_id").alias("l_orderkey"), "search_artist", F.array_join("artist_names", ",").alias("artists"), F.array_join("aliases", ",").alias("aliases"))


@query("""
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY r) AS upcs FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS r FROM orders) WHERE r <= 4 GROUP BY o_custkey""")
def upcs_in_order(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_totalprice", F.col("o_orderkey").alias("upc"))
    return rank.listed(o, "o_custkey", F.col("o_totalprice"), "upc", 4).select("o_custkey", F.array_join(F.transform("upcs", lambda u: u.cast("string")), ",").alias("upcs"))


@query("""
SELECT o_custkey, 'held' AS via FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
UNION ALL SELECT o_custkey, 'new' FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY o_custkey""")
def lookup_union(spark, d):
    o = table(spark, d, "orders")
    known = lambda df, via: df.select("o_custkey", F.lit(via).alias("via")).distinct()
    return joins.either(known(o.where("o_orderstatus = 'F'"), "held"), known(o, "new"), ["o_custkey"])


@query("SELECT user_id, min(event_id) AS ord FROM events GROUP BY user_id")
def ordered_distinct_users(spark, d):
    return rank.ordered_distinct(table(spark, d, "events").select("user_id", F.col("event_id").alias("ord")), "user_id", "ord")


@query("SELECT 1 AS id, event_type, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def singleton_newest(spark, d):
    e = table(spark, d, "events").withColumn("id", F.lit(1))
    held = e.where("event_id = 0").select("id", "event_type", "user_id", "ts")
    return merge.singleton(held, e, F.struct("ts", "event_id")).select("id", "event_type", "user_id", second("ts").alias("updated_at"))


# landed payloads


def _named(ids, names):
    return F.struct(ids.alias("id"), names.alias("name"))


def _albums(spark, d):
    """Orders as albums: their lines are tracks, parts the tracks' artists, and suppliers of the first line the album's."""
    li = table(spark, d, "lineitem").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), "l_partkey")
    track = F.struct(
        F.when(F.col("l_linenumber") != 3, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("id"), F.col("p_name").alias("name"), F.col("l_linenumber").alias("track_number"),
        F.when(F.col("l_linenumber") != 2, (F.col("l_quantity") * 1500).cast("bigint")).alias("duration_ms"), F.array(_named(F.col("p_brand"), F.concat(F.lit("by "), "p_brand"))).alias("artists"),
    )
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(track)).alias("items"), F.max("p_brand").alias("brand"))
    o = table(spark, d, "orders").join(per, F.col("o_orderkey") == F.col("l_orderkey"))
    urls = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.struct(F.concat(F.lit("u"), text_of("o_orderkey")).alias("url")))).otherwise(F.array().cast("array<struct<url: string>>"))
    return o.select(
        text_of("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.date_format("o_orderdate", "yyyy-MM").alias("release_date"), F.col("o_orderstatus").alias("album_type"), F.size("items").alias("total_tracks"), none("string").alias("label"),
        none("int").alias("popularity"), F.array(_named(F.col("brand"), F.concat(F.lit("by "), "brand"))).alias("artists"), urls.alias("images"), F.struct(F.when(F.col("o_orderkey") % 3 == 0, text_of("o_orderkey")).alias("spotify")).alias("external_urls"),
        F.struct(text_of("o_custkey").alias("upc")).alias("external_ids"), F.struct("items").alias("tracks"), F.col("o_orderkey").alias("ord"),
    )


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, p_name, p_brand, l_quantity, CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS sid FROM lineitem JOIN part ON l_partkey = p_partkey),
tr AS (SELECT * FROM t WHERE l_linenumber <> 3),
al AS (SELECT o_orderkey, o_orderpriority, o_orderdate, o_custkey, max(p_brand) AS brand FROM orders JOIN t ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT 'artists' AS relation, count(DISTINCT p_brand) AS n, NULL AS total FROM (SELECT p_brand FROM tr UNION ALL SELECT brand FROM al)
UNION ALL SELECT 'albums', count(*), sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END + CAST(strftime(o_orderdate, '%Y%m') AS BIGINT)) FROM al
UNION ALL SELECT 'album_artists', count(*), NULL FROM al
UNION ALL SELECT 'tracks', count(DISTINCT sid), sum(CASE WHEN l_linenumber = 2 THEN 0 ELSE floor(l_quantity * 1.5) END) FROM (SELECT sid, l_linenumber, arg_max(l_quantity, (p_name, CASE WHEN l_linenumber <> 2 THEN l_quantity END)) AS l_quantity FROM tr GROUP BY ALL)
UNION ALL SELECT 'track_artists', count(*), NULL FROM (SELECT DISTINCT sid, p_brand FROM tr)""")
def album_sync_tables(spark, d):
    from cadenza import schemas

    names = ("artists", "albums", "tracks", "album_artists", "track_artists")
    flat = jobs.sync_albums({n: schemas.empty(spark, n) for n in names}, _albums(spark, d))
    totals = {"albums": F.sum(F.col("cover_url").isNotNull().cast("long") + F.size("ext_refs") + F.replace(F.substring("release_date", 1, 7), F.lit("-"), F.lit("")).cast("long")), "tracks": F.sum("duration_sec")}
    rows = [flat[n].agg(F.count("*").alias("n"), totals.get(n, F.max(none("long"))).cast("double").alias("total")).select(F.lit(n).alias("relation"), "n", "total") for n in names]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def _play_items(spark, d):
    e = table(spark, d, "events")
    artists = F.array(_named(F.lit("a"), F.col("event_type")), _named(F.lit("b"), F.when(F.col("event_id") % 2 == 0, "").otherwise("second")))
    album = F.struct(F.when(F.col("event_id") % 7 != 0, text_of("user_id")).alias("id"), F.lit("album").alias("name"), F.array().cast("array<struct<url: string>>").alias("images"))
    track = F.struct(F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("t"), (F.col("event_id") % 50).cast("string"))).alias("id"), F.col("event_type").alias("name"), none("bigint").alias("duration_ms"), artists.alias("artists"), album.alias("album"))
    played = F.when(F.col("event_id") % 13 == 0, "no time").otherwise(instant("ts"))
    return e.select(text_of("user_id").alias("user_id"), (-F.col("event_id")).alias("ord"), played.alias("played_at"), track.alias("track"))


@query("""
SELECT -event_id AS ord, 't' || event_id % 50 AS track, event_type || CASE WHEN event_id % 2 = 0 THEN '' ELSE ', second' END AS artist_name, CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS album_sid, strftime(ts, '%Y-%m-%d %H:%M:%S') AS played
FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""")
def flattened_plays(spark, d):
    return flatten.plays(_play_items(spark, d)).select("ord", F.col("spotify_track_id").alias("track"), "artist_name", "album_sid", second("played_at").alias("played"))


@query("""
WITH p AS (SELECT event_id, 't' || event_id % 50 AS track, CASE WHEN event_id % 7 <> 0 THEN user_id END AS album, ts FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0),
k AS (SELECT * FROM p WHERE album IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))
SELECT 'recent_albums' AS part, count(DISTINCT album) AS n, sum(last) AS total FROM (SELECT album, CAST(floor(epoch(arg_max(ts, event_id))) AS BIGINT) AS last FROM k GROUP BY album)
UNION ALL SELECT 'recent_tracks', count(*), sum(CAST(floor(epoch(ts)) AS BIGINT)) FROM (SELECT ts FROM p ORDER BY ts DESC, track DESC LIMIT 50)
UNION ALL SELECT 'album_events', count(*), NULL FROM (SELECT DISTINCT album, ts FROM k)
UNION ALL SELECT 'track_events', count(*), NULL FROM (SELECT DISTINCT track, ts FROM p)
UNION ALL SELECT 'unknown', count(DISTINCT album), NULL FROM p WHERE album NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def recent_plays_sync(spark, d):
    from cadenza import schemas

    held = {n: schemas.empty(spark, n) for n in ("recent_albums", "recent_tracks", "play_events", "track_play_events")}
    albums = table(spark, d, "customer").where("c_custkey % 2 = 0").select(text_of("c_custkey").alias("spotify_id"))
    got = jobs.sync_recent(held["recent_albums"], held["recent_tracks"], held["play_events"], held["track_play_events"], albums, _play_items(spark, d))
    totals = {"recent_albums": F.sum(F.unix_timestamp("last_played_at")), "recent_tracks": F.sum(F.unix_timestamp("played_at"))}
    rows = [df.agg(F.count("*").alias("n"), totals.get(n, F.max(none("long"))).alias("total")).select(F.lit(n).alias("part"), "n", "total") for n, df in got.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id % 3 <> 0 AND event_type = 'click' AS is_playing, CASE WHEN event_id % 3 <> 0 THEN 't' || event_id ELSE 'held' END AS track, CASE WHEN event_id % 3 <> 0 THEN event_type END AS artist FROM l WHERE r = 1""")
def player_state_sync(spark, d):
    from cadenza import schemas

    e = rank.best_per_key(table(spark, d, "events"), ["user_id"], F.col("event_id"), descending=True)
    item = F.struct(F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("t"), text_of("event_id"))).alias("id"), F.lit("x").alias("name"), F.lit(9).cast("bigint").alias("duration_ms"), F.array(_named(F.lit("a"), F.col("event_type"))).alias("artists"), F.struct(none("string").alias("id"), none("string").alias("name")).alias("album"))
    polled = e.select(text_of("user_id").alias("user_id"), (F.col("event_type") == "click").alias("is_playing"), F.lit(1).cast("bigint").alias("progress_ms"), item.alias("item"))
    state = schemas.empty(spark, "now_playing")
    before = e.where("event_id % 3 = 0").select(*(text_of("user_id").alias(c) if c == "user_id" else F.lit("held").alias(c) if c == "spotify_track_id" else F.lit(None).cast(state.schema[c].dataType).alias(c) for c in state.columns))
    return jobs.sync_now_playing(before, polled, now()).select("user_id", "is_playing", F.col("spotify_track_id").alias("track"), F.col("artist_name").alias("artist"))


@query(f"""
WITH u AS ({_CONNECTED}), p AS (SELECT DISTINCT user_id, 't' || event_id % 50 AS track, ts FROM events JOIN u USING (user_id) WHERE event_id % 11 <> 0 AND event_id % 13 <> 0)
SELECT user_id, count(*) AS n FROM p GROUP BY user_id""")
def member_plays_sync(spark, d):
    from cadenza import schemas

    held, state = schemas.empty(spark, "member_tracks"), schemas.empty(spark, "now_playing")
    polled = spark.createDataFrame([], "user_id string, is_playing boolean, progress_ms long, item struct<id: string, name: string, duration_ms: bigint, artists: array<struct<id: string, name: string>>, album: struct<id: string, name: string>>")
    users = _integrations(spark, d).withColumn("user_id", text_of("user_id"))
    limited = jobs.connected(_integrations(spark, d), "payload", 300).select(text_of("user_id").alias("user_id"))
    got = jobs.sync_member(held, state, _play_items(spark, d), polled, now(), users.join(limited, "user_id", "left_semi"))["tracks"]
    return got.groupBy(F.col("user_id").cast("long").alias("user_id")).agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT s_suppkey, s_suppkey % 5 AS k, s_acctbal FROM supplier)
SELECT CAST(s_suppkey AS VARCHAR) AS spotify_id, CASE k WHEN 0 THEN '' WHEN 1 THEN 'u' || s_suppkey WHEN 3 THEN '' WHEN 4 THEN 'old' END AS photo_url, CASE WHEN k IN (0, 1, 2) THEN s_suppkey * 10 END AS followers FROM a""")
def artist_enrichment(spark, d):
    s, k = table(spark, d, "supplier"), F.col("s_suppkey") % 5
    artists = s.select(text_of("s_suppkey").alias("spotify_id"), F.when(k == 4, "old").alias("photo_url"), none("array<string>").alias("genres"), none("bigint").alias("followers"), none("int").alias("popularity"))
    url = F.struct(F.when(k == 1, F.concat(F.lit("u"), text_of("s_suppkey"))).alias("url"))
    images = F.when(k == 0, F.array().cast("array<struct<url: string>>")).otherwise(F.array(url))  # k = 2: an image without a url
    details = s.where(k < 3).select(text_of("s_suppkey").alias("id"), images.alias("images"), F.array(F.lit("rock")).alias("genres"), F.struct((F.col("s_suppkey") * 10).alias("total")).alias("followers"), F.lit(5).alias("popularity"))
    return jobs.enrich_artists(artists, details, artists.where("photo_url is null")).select("spotify_id", "photo_url", "followers")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS spotify_id, CASE p_partkey % 4 WHEN 0 THEN 'code' || p_partkey WHEN 1 THEN 'no_isrc' WHEN 2 THEN 'not_found' END AS isrc FROM part""")
def isrc_backfill(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey") % 4
    tracks = p.select(text_of("p_partkey").alias("spotify_id"), none("string").alias("isrc"))
    codes = F.when(k == 0, F.concat(F.lit("code"), text_of("p_partkey"))).otherwise("")
    returned = p.where(k < 2).select(text_of("p_partkey").alias("id"), F.struct(codes.alias("isrc")).alias("external_ids"))
    return jobs.backfill_isrc(tracks, returned, p.where(k < 3).select(text_of("p_partkey").alias("spotify_id")))


@query("""
SELECT 'link' AS what, CAST(c_custkey AS VARCHAR) AS value FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'fetch', string_agg(s, ',' ORDER BY s) FROM (SELECT s, row_number() OVER (ORDER BY s) - 1 AS r FROM (SELECT CAST(c_custkey AS VARCHAR) AS s FROM customer WHERE c_custkey % 3 = 1)) GROUP BY r // 10""")
def follow_import(spark, d):
    c = table(spark, d, "customer")
    users = spark.createDataFrame([("me",)], "id string")
    followed = c.where("c_custkey % 3 < 2").select(text_of("c_custkey").alias("id"), F.col("c_name").alias("name"))
    artists = c.where("c_custkey % 3 = 0").select(text_of("c_custkey").alias("spotify_id"), text_of("c_custkey").alias("id"))
    got = jobs.import_follows("me", users, followed, artists, spark.createDataFrame([], "user_id string, artist_id string"))
    return got["links"].select(F.lit("link").alias("what"), F.col("artist_id").alias("value")).union(got["fetch"].select(F.lit("fetch"), F.array_join("keys", ",")))


@query("""
SELECT n_nationkey AS artist_id, CASE WHEN n_nationkey % 2 = 0 THEN 'own' || n_nationkey WHEN n_nationkey % 5 = 1 THEN 'shared1' WHEN n_nationkey = 3 THEN 'shared2' ELSE 'not_found' END AS mbid FROM nation
WHERE n_nationkey % 2 = 0 OR n_nationkey NOT IN (11, 21)
UNION ALL SELECT n_nationkey, 'not_found' FROM nation WHERE n_nationkey IN (11, 21)""")
def artist_identification(spark, d):
    """Even artists have an id of their own; 1, 11 and 21 share one, which the first gets; 3 comes to its second choice; others' candidates score too low or are in another country."""
    n, k = table(spark, d, "nation"), F.col("n_nationkey")
    pending = n.select(k.alias("artist_id"), F.col("n_name").alias("name"), F.when(k == 7, F.array(F.lit("k-pop"))).otherwise(F.array(F.lit("rock"))).alias("genres"), k.alias("ord"))
    of = lambda rows, mbid, score, country=None, at=0: rows.select(k.alias("artist_id"), mbid.alias("mbid"), F.lit(score).alias("score"), F.lit(country).cast("string").alias("country"), F.array(F.lit("other name")).alias("aliases"), F.lit(at).alias("ord"))
    found = of(n.where("n_nationkey % 2 = 0"), F.concat(F.lit("own"), k.cast("string")), 95)
    found = found.union(of(n.where("n_nationkey % 10 = 1"), F.lit("shared1"), 100)).union(of(n.where("n_nationkey = 3"), F.lit("shared1"), 100)).union(of(n.where("n_nationkey = 3"), F.lit("shared2"), 91, at=1))
    found = found.union(of(n.where("n_nationkey = 5"), F.lit("low"), 89)).union(of(n.where("n_nationkey = 7"), F.lit("abroad"), 99, "JP")).union(of(n.where("n_nationkey = 9"), F.lit("taken"), 99))
    return jobs.identify_artists(pending, found, spark.createDataFrame([("taken",)], "mbid string")).select("artist_id", "mbid")


@query("""
WITH x AS (SELECT o_orderkey, o_custkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders WHERE o_orderkey % 2 = 0),
n AS (SELECT * FROM x WHERE length(raw) = 10 AND CAST(raw AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-01' + 90),
old AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 10 = 0)
SELECT coalesce(n.o_orderkey, old.o_orderkey) AS key, coalesce(n.raw, 'old') AS release_date, CASE WHEN old.o_orderkey IS NOT NULL THEN 'released' ELSE 'announced' END AS status FROM n FULL JOIN old ON n.o_orderkey = old.o_orderkey""")
def release_poll(spark, d):
    o = table(spark, d, "orders")
    day, month = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM")
    found = o.select(F.col("o_custkey").alias("artist_id"), F.when(F.col("o_orderkey") % 2 == 0, "itunes").otherwise("musicbrainz").alias("source"), text_of("o_orderkey").alias("source_key"), F.lit("t").alias("title"), F.lit("album").alias("release_type"), F.when(F.col("o_orderkey") % 3 == 1, month).otherwise(day).alias("release_date"), F.col("o_orderkey").alias("ord"))
    events = o.where("o_orderkey % 10 = 0").select(F.col("o_custkey").alias("artist_id"), F.lit("itunes").alias("source"), text_of("o_orderkey").alias("source_key"), F.lit("t").alias("title"), F.lit("album").alias("release_type"), F.lit("old").alias("release_date"), F.lit("released").alias("status"))
    watch = o.select(F.col("o_custkey").alias("artist_id")).distinct()
    got = jobs.poll_releases(watch, found, events, "itunes", 3, 10_000_000, F.to_date(F.lit("1998-01-01")), 90)
    return got.select(F.col("source_key").cast("long").alias("key"), "release_date", "status")


@query("""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderkey % 3 AS k FROM orders)
SELECT o_orderkey AS id, CASE WHEN k = 2 THEN 'announced' ELSE 'released' END AS status, CASE WHEN k = 2 THEN NULL ELSE o_orderkey + 1 END AS album, k = 0 AS changed FROM a""")
def confirmation_applied(spark, d):
    a, k = table(spark, d, "orders"), F.col("o_orderkey") % 3
    album = F.col("o_orderkey") + 1
    events = a.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("artist_id"), F.lit("itunes").alias("source"), text_of("o_orderkey").alias("source_key"), F.lit("t").alias("title"), F.lit("album").alias("release_type"), F.to_date("o_orderdate").alias("release_date"), F.when(k == 1, "released").otherwise("announced").alias("status"), F.when(k == 1, album).alias("spotify_album_id"))
    flips = a.where(k < 2).select(F.col("o_orderkey").alias("id"), album.alias("spotify_album_id"))
    return calendar.apply_confirmation(events, flips, events.where("false")).select("id", "status", F.col("spotify_album_id").alias("album"), "changed")


@query("""
WITH s AS (SELECT c_custkey AS key, c_custkey % 4 AS k FROM customer)
SELECT key, CASE k WHEN 0 THEN 'ours' WHEN 1 THEN 'preexisting' WHEN 2 THEN 'ours' ELSE 'preexisting' END AS source, CASE WHEN k = 0 AND key % 5 = 0 THEN 'failed' WHEN k IN (0, 1) THEN 'synced' WHEN k = 2 THEN 'synced' ELSE 'pending' END AS state,
  CASE WHEN k = 0 AND key % 5 = 0 THEN NULL WHEN k = 0 THEN true WHEN k = 1 THEN true WHEN k = 2 THEN false ELSE true END AS in_library, CASE WHEN k = 0 AND key % 5 = 0 THEN 'boom' WHEN k = 3 THEN 'before' END AS last_error FROM s""")
def library_state(spark, d):
    c, k = table(spark, d, "customer"), F.col("key") % 4
    c = c.select(F.col("c_custkey").alias("key"))
    op = F.when(k == 0, "ADD").when(k == 1, "PULL").when(k == 2, "REMOVE")
    planned = c.where(k < 3).select("key", op.alias("op"), F.when((k == 0) & (F.col("key") % 5 == 0), "boom").alias("error"))
    state = c.where(k > 1).select("key", F.when(k == 2, reconcile.OURS).otherwise(reconcile.BEFORE).alias("source"), F.lit("pending").alias("state"), F.lit(True).alias("in_library"), F.lit("before").alias("last_error"), none("timestamp").alias("last_synced_at"))
    return reconcile.next_state(state, planned, True, _NOW).select("key", "source", "state", "in_library", "last_error")


@query("""
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 OR p_partkey % 3 = 2 THEN 'not_found' WHEN p_partkey % 5 = 3 THEN 'no_lyrics' WHEN p_partkey % 5 = 2 THEN 'review_required' ELSE 'matched' END AS match_status FROM part)
SELECT p_partkey AS track_id, match_status, CASE match_status WHEN 'matched' THEN 'words' WHEN 'no_lyrics' THEN '' END AS lyric_plain FROM t WHERE p_partkey % 2 = 0 OR (p_partkey % 4 = 1 AND match_status = 'matched')""")
def lyrics_evaluation(spark, d):
    """Odd tracks hold an outcome: those that leave 1 by 4 a match promoted from a review, which a stronger basis replaces, the rest one by its recording."""
    from cadenza.plans.catalogue import _tracks

    held = table(spark, d, "part").where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("track_id"), F.lit("matched").alias("match_status"), F.when(F.col("p_partkey") % 4 == 1, "best-of-review").otherwise("mb-recording").alias("basis"))
    return jobs.evaluate_lyrics(*_tracks(spark, d), held)["write"].select("track_id", "match_status", "lyric_plain")


@query("""
SELECT CASE WHEN p_partkey % 5 = 4 OR p_partkey % 3 = 2 THEN 'not_found' WHEN p_partkey % 5 = 3 THEN 'no_lyrics' WHEN p_partkey % 5 = 2 THEN 'review_required' ELSE 'matched' END AS match_status, count(*) AS n, 0 AS promoted FROM part GROUP BY ALL""")
def lyrics_evaluation_counts(spark, d):
    from cadenza.plans.catalogue import _tracks

    return jobs.evaluate_lyrics(*_tracks(spark, d))["counts"].select("match_status", "n", "promoted")


@query("""
SELECT o_orderkey AS track_id, l_partkey AS id, r - 1 AS place FROM (
  SELECT o_orderkey, l_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(q - 20.0) NULLS FIRST, l_partkey) AS r
  FROM orders JOIN (SELECT l_suppkey, l_partkey, min(CASE WHEN l_partkey % 10 <> 0 THEN l_quantity END) AS q FROM lineitem GROUP BY ALL) ON o_custkey = l_suppkey) WHERE r <= 3""")
def dump_retrieval(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    artist = lambda c: F.concat(F.lit("The Artist "), c.cast("string"))
    tracks = o.select(F.col("o_orderkey").alias("track_id"), F.lit("t").alias("title"), F.array(artist(F.col("o_custkey"))).alias("artist_names"), none("array<string>").alias("aliases"), F.lit(20.0).alias("duration_sec"))
    dump = li.groupBy("l_suppkey", "l_partkey").agg(F.min(F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity"))).alias("duration"))
    dump = dump.select(F.col("l_partkey").alias("id"), F.lit("t").alias("name"), F.replace(artist(F.col("l_suppkey")), F.lit("The "), F.lit("")).alias("artist_name"), none("string").alias("album_name"), "duration", F.lit(1).alias("last_lyrics_id"))
    lyrics = spark.createDataFrame([(1, "la", None, False)], "id int, plain_lyrics string, synced_lyrics string, instrumental boolean")
    got = resolve.retrieve(tracks, dump, lyrics, most=3)
    order = F.array_sort(F.collect_list(F.struct(F.coalesce(F.abs(F.col("duration_sec") - 20.0), F.lit(-1.0)).alias("gap"), "id")))
    return got.groupBy("track_id").agg(order.alias("c")).select("track_id", F.posexplode("c").alias("place", "x")).select("track_id", F.col("x.id").alias("id"), F.col("place").cast("long").alias("place"))


@query("""
WITH r AS (SELECT event_id, user_id, event_type, event_id % 5 AS k FROM events)
SELECT CAST(event_id AS VARCHAR) AS message_id, CASE k WHEN 0 THEN 'album_sync' WHEN 1 THEN 'follow_import' WHEN 2 THEN 'follow_import' END AS job, k = 2 AS rerun FROM r""")
def queue_routing(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id") % 5
    body = F.when(k == 0, '{"album_ids": ["a"]}').when(k == 1, '{"job": "follow_import", "user_id": "u"}').when(k == 2, '{"job": "follow_import", "user_id": "u", "rerun": true}').when(k == 3, '{"job": "odd"}').otherwise("not json")
    good, bad = dispatch.route(e.select(text_of("event_id").alias("message_id"), body.alias("body")))
    return good.select("message_id", "job", "rerun").unionByName(bad.select("message_id", none("string").alias("job"), F.lit(False).alias("rerun")))


@query("""
SELECT 'lyrics' AS job, NULL AS user_id, false AS rerun, '2024-02-01 00:00:00' AS not_before
UNION ALL SELECT DISTINCT 'follow_import', CAST(user_id AS VARCHAR), true, '2024-02-01 00:15:00' FROM events WHERE event_type = 'click'""")
def queue_follow_ups(spark, d):
    e = table(spark, d, "events").where("event_type in ('click', 'view', 'error')")
    job = F.when(F.col("event_type") == "view", "album_sync").otherwise("follow_import")
    done = e.select(job.alias("job"), text_of("user_id").alias("user_id"), (F.col("event_type") == "error").alias("rerun"))
    return dispatch.follow_ups(done, now()).select("job", "user_id", "rerun", second("not_before").alias("not_before"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'playing' ELSE 'done' END AS kind, 'artist ' || event_type AS artist, CASE WHEN event_id % 4 = 0 THEN 'big' END AS image,
  CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS uts FROM events WHERE (event_type = 'view' AND event_id % 2 = 0) OR event_id % 3 <> 0""")
def scrobble_pages(spark, d):
    """Each event a page: one track as an object or a list of one; a page of three has no number in its time."""
    e = table(spark, d, "events")
    playing = (F.col("event_type") == "view") & (F.col("event_id") % 2 == 0)
    uts = F.when(F.col("event_id") % 3 == 0, "soon").otherwise(F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string"))
    track = F.struct(
        text_of("event_id").alias("name"), F.lit("").alias("mbid"), F.struct(F.concat(F.lit("artist "), "event_type").alias("#text")).alias("artist"), F.struct(F.lit("").alias("#text")).alias("album"),
        F.array(F.struct(F.when(F.col("event_id") % 4 == 0, "big").otherwise("").alias("#text"), F.lit("large").alias("size"))).alias("image"), F.when(~playing, F.struct(uts.alias("uts"))).alias("date"), F.when(playing, F.struct(F.lit("true").alias("nowplaying"))).alias("@attr"),
    )
    one, many = (F.to_json(F.struct(F.struct(x.alias("track")).alias("recenttracks"))) for x in (track, F.array(track)))
    done, shown = landed.scrobbles(e.select("user_id", F.when(F.col("event_id") % 5 == 0, one).otherwise(many).alias("page")))
    pick = lambda df, kind: df.select(F.col("track_name").cast("long").alias("event_id"), F.lit(kind).alias("kind"), F.col("artist_name").alias("artist"), F.col("image_url").alias("image"), F.unix_timestamp("played_at").alias("uts"))
    return pick(done, "done").union(pick(shown, "playing"))


@query("""
WITH s AS (SELECT event_id, user_id, event_type, ts, CASE WHEN event_id % 2 = 0 THEN 'held' ELSE 'new' END AS origin FROM events WHERE event_type <> 'view')
SELECT event_id, origin FROM s
UNION ALL SELECT event_id, 'playing' FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events WHERE event_type = 'view') WHERE r = 1""")
def scrobble_sync(spark, d):
    """Even events are held already, and every user has an old now-playing row, which the newest poll replaces."""
    e = table(spark, d, "events").withColumns({"played_at": F.col("ts").cast("timestamp"), "is_now_playing": F.col("event_type") == "view", "ord": F.col("event_id")})
    columns = ["user_id", "event_id", "origin", "played_at", "is_now_playing"]
    done, shown = e.where("event_type <> 'view'"), e.where("event_type = 'view'").withColumn("origin", F.lit("playing"))
    held = done.where("event_id % 2 = 0").withColumn("origin", F.lit("held")).select(*columns)
    old = shown.withColumns({"event_id": F.lit(-1).cast("long"), "origin": F.lit("old")}).select(*columns)
    users = e.select("user_id").distinct()
    return jobs.sync_scrobbles(users, held.union(old), done.withColumn("origin", F.lit("new")), shown, now())["tracks"].select("event_id", "origin")


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'found' WHEN 1 THEN 'none' WHEN 2 THEN 'none' ELSE 'failed' END AS status FROM part""")
def lyric_fetch_status(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey") % 4
    code, body = F.when(k == 1, 404).when(k == 3, F.when(F.col("p_partkey") % 8 == 3, 503)).otherwise(200), F.when(k == 0, "[]").otherwise("{}")
    return p.select("p_partkey", landed.fetch_status(code, body).alias("status"))


@query("""
SELECT p_partkey AS id, p_name AS title, p_brand AS artist, CAST(p_size AS DOUBLE) AS duration_sec, coalesce(p_partkey % 3 = 1, false) AS instrumental FROM part""")
def lyric_candidate_shape(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey") % 3
    pages = p.select(F.lit("t").alias("track_id"), F.col("p_partkey").alias("id"), F.col("p_name").alias("trackName"), F.col("p_brand").alias("artistName"), none("string").alias("albumName"), F.col("p_size").cast("double").alias("duration"), F.when(k == 0, False).when(k == 1, True).alias("instrumental"), F.lit("x").alias("plainLyrics"), none("string").alias("syncedLyrics"))
    return landed.lyric_candidates(pages).select("id", "title", "artist", "duration_sec", "instrumental")


@query("""
SELECT o_custkey AS artist_id, o_orderkey AS album, r - 1 AS ord FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y') || '------' END DESC, CAST(o_orderkey AS VARCHAR)) AS r FROM orders) WHERE r <= 5""")
def newest_releases(spark, d):
    o = table(spark, d, "orders")
    day = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy"))
    got = landed.newest_releases(o.select(F.col("o_custkey").alias("artist_id"), text_of("o_orderkey").alias("album_sid"), day.alias("release_date")), 5)
    return got.select("artist_id", F.col("album_sid").cast("long").alias("album"), F.col("ord").cast("long").alias("ord"))


@query("SELECT o_custkey AS artist_id, CAST(o_orderkey AS VARCHAR) AS source_key, strftime(o_orderdate, '%Y-%m-%d') AS release_date FROM orders WHERE o_orderkey % 4 <> 0")
def storefront_collections(spark, d):
    o = table(spark, d, "orders")
    kind = F.when(F.col("o_orderkey") % 4 == 0, "artist").otherwise("collection")
    rows = o.select(F.col("o_custkey").alias("artist_id"), kind.alias("wrapperType"), F.col("o_orderkey").alias("collectionId"), F.lit("x").alias("collectionName"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("releaseDate"))
    return landed.collections(rows).select("artist_id", "source_key", "release_date")


@query("""
SELECT l_orderkey AS artist_id, mbid, CASE WHEN n % 2 = 0 THEN n END AS score FROM (
  SELECT l_orderkey, 'm' || l_partkey || '-' || l_linenumber AS mbid, l_partkey AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r FROM lineitem) WHERE r <= 10""")
def artist_search_top10(spark, d):
    li = table(spark, d, "lineitem")
    one = F.struct("l_linenumber", "l_partkey")
    hits = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("hits"))
    listed = F.transform("hits", lambda h: F.struct(F.concat(F.lit("m"), h["l_partkey"].cast("string"), F.lit("-"), h["l_linenumber"].cast("string")).alias("id"), F.lit("n").alias("name"), F.lit("GB").alias("country"), F.when(h["l_partkey"] % 2 == 0, h["l_partkey"].cast("string")).otherwise("high").alias("ext:score"), F.array().cast("array<struct<alias: string>>").alias("alias-list")))
    return landed.artist_candidates(hits.select(F.col("l_orderkey").alias("query_id"), listed.alias("artist-list"))).select("artist_id", "mbid", F.col("score").cast("long").alias("score"))


@query("""
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS held FROM customer""")
def library_membership(spark, d):
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    library = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return landed.membership(asked, library).select(F.col("id").alias("c_custkey"), "held")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)")
def unavailable_ids(spark, d):
    got = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return landed.missing(table(spark, d, "part"), got, "p_partkey")


# small rules


@query("""
SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'KR' WHEN 1 THEN 'GB' WHEN 2 THEN 'US' END AS hint,
  NOT (n_nationkey % 4 <> 3 AND n_nationkey % 3 <> 0 AND CASE n_nationkey % 4 WHEN 0 THEN 'KR' WHEN 1 THEN 'GB' WHEN 2 THEN 'US' END <> 'GB') AS plausible, n_nationkey % 5 = 0 AS hangul FROM nation""")
def country_rules(spark, d):
    k = F.col("n_nationkey")
    genres = F.when(k % 4 == 0, F.array(F.lit("Rock"), F.lit("Korean indie"), F.lit("british"))).when(k % 4 == 1, F.array(F.lit("UK garage"))).when(k % 4 == 2, F.array(F.lit("american folk"))).otherwise(F.array(F.lit("jazz")))
    n = table(spark, d, "nation").select("n_nationkey", T.country_hint(genres).alias("hint"), F.when(k % 3 != 0, "GB").otherwise("").alias("country"), F.when(k % 5 == 0, "x 가").otherwise("ᄀx").alias("name"))
    return n.select("n_nationkey", "hint", T.country_plausible(F.col("hint"), F.col("country")).alias("plausible"), T.has_hangul(F.col("name")).alias("hangul"))


@query(r"""
SELECT doc_id, regexp_replace(text, '([+\-&|!(){}\[\]^"~*?:\\/])', '\\\1', 'g') AS escaped, length(replace(text, 'e', '')) AS rest FROM documents""")
def escaped_and_stripped(spark, d):
    docs = table(spark, d, "documents")
    with_nul = F.struct(F.array(F.replace("text", F.lit("e"), F.lit("\0"))).alias("texts"))
    docs = docs.select("doc_id", "text", with_nul.alias("v"))
    return docs.select("doc_id", T.escape_query(F.col("text")).alias("escaped"), F.char_length(T.strip_nul(F.col("v"), docs.schema["v"].dataType)["texts"][0]).alias("rest"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_type || ',' || p_name END AS aliases FROM part""")
def cleaned_aliases(spark, d):
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name"))
    aliases = F.array(F.concat(F.lit(" "), "p_type", F.lit(" ")), F.lit("  "), "p_name")
    return table(spark, d, "part").select("p_partkey", F.array_join(T.clean_aliases(aliases, name), ",").alias("aliases"))


@query("""
WITH w AS (SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS w FROM part UNION ALL SELECT p_partkey, 'red' FROM part UNION ALL SELECT p_partkey, 'bolt' FROM part),
o AS (SELECT p_partkey, w FROM w GROUP BY ALL HAVING count(*) = 1)
SELECT p_partkey, string_agg(w, ',' ORDER BY w) AS words FROM o GROUP BY p_partkey""")
def words_apart(spark, d):
    apart = T.symmetric_difference(F.array_distinct(F.split("p_name", " ")), F.array(F.lit("red"), F.lit("bolt")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(apart), ",").alias("words")).where("words <> ''")


@query("""
SELECT p_partkey, p_partkey % 3 IN (0, 1) OR p_partkey % 4 = 1 AS ok FROM part""")
def consistency_rule(spark, d):
    k = F.col("p_partkey")
    status, basis = F.when(k % 3 == 0, "ambiguous").otherwise("matched"), F.when(k % 3 == 1, "exact-title").otherwise("best-of-review")
    return table(spark, d, "part").select("p_partkey", resolve.consistent(status, basis, F.lit(True), F.when(k % 4 == 1, "promoted")).alias("ok"))


@query("SELECT l_orderkey, l_linenumber, l_linenumber % 2 = 0 AS inside FROM lineitem")
def parsed_instants(spark, d):
    raw = F.when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("20x4-01-01")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", dates.parse_instant(raw).isNotNull().alias("inside"))
