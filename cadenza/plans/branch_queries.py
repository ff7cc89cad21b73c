"""Registered queries of branches that the others don't reach: batch limits and guards of the lyrics jobs, alias filling, landed files, plan-only runs, whole rows of the sync jobs, and streams over slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.functions import dates
from cadenza.operators import joins, reconcile, resolve
from cadenza.plans import jobs
from cadenza.plans.catalogue import _DECIDED, _tracks, query, second, table
from cadenza.plans.job_queries import _CONNECTED, _NOW, _albums, _integrations, _named, _play_items, none, now, text_of
from cadenza.plans.table_queries import fresh
from cadenza.sources import landed
from cadenza.streaming import logs

# lyrics and aliases


def _lyrics_tables(spark, d):
    """tracks (with created_at), track_artists, artists and candidates of the parts; a few parts have no artist."""
    tracks, cands = _tracks(spark, d)
    artists = tracks.select(F.col("track_id").alias("artist_id"), F.col("artist_names")[0].alias("name"), none("array<string>").alias("aliases"))
    links = tracks.where("track_id % 11 <> 0").select("track_id", F.col("track_id").alias("artist_id"))
    made = table(spark, d, "part").select(F.col("p_partkey").alias("track_id"), F.col("p_retailprice").alias("created_at"))
    return tracks.drop("artist_names", "aliases").join(made, "track_id"), links, artists, cands


@query(f"""
WITH s AS (SELECT * FROM part WHERE p_partkey % 3 <> 1 AND p_partkey % 11 <> 0 ORDER BY p_retailprice DESC, p_partkey LIMIT 150)
SELECT p_partkey AS track_id, {_DECIDED.format('')} AS match_status, p_partkey % 7 = 1 AS kept FROM s""")
def lyrics_collect(spark, d):
    """Parts that leave 1 by 3 have a row; those that leave 1 by 7 get one from another run meanwhile."""
    *tables, cands = _lyrics_tables(spark, d)
    held, now_held = (table(spark, d, "part").where(w).select(F.col("p_partkey").alias("track_id")) for w in ("p_partkey % 3 = 1", "p_partkey % 3 = 1 or p_partkey % 7 = 1"))
    out = jobs.collect_lyrics(*tables, held, cands, 150, now_held)
    rows = [out[name].select("track_id", "match_status", F.lit(name == "kept").alias("kept")) for name in ("write", "kept")]
    return rows[0].union(rows[1])


@query(f"""
WITH l AS (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'not_found' WHEN 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE p_partkey % 4 WHEN 2 THEN 'best-of-review' WHEN 3 THEN 'exact-title' END AS basis FROM part WHERE p_partkey % 11 <> 0),
s AS (SELECT * FROM l WHERE status <> 'matched' OR basis = 'best-of-review' ORDER BY CASE status WHEN 'ambiguous' THEN 0 WHEN 'matched' THEN 1 ELSE 2 END, p_size, p_partkey LIMIT (SELECT count(*) * 6 // 10 FROM part)),
o AS (SELECT p_partkey AS track_id, status AS was, {_DECIDED.format('')} AS match_status FROM s)
SELECT track_id, was, match_status, was <> 'matched' OR match_status = 'matched' AS written FROM o""")
def lyrics_reassess(spark, d):
    *tables, cands = _lyrics_tables(spark, d)
    p, k = table(spark, d, "part"), F.col("p_partkey") % 4
    lyrics = p.select(F.col("p_partkey").alias("track_id"), F.when(k == 0, "not_found").when(k == 1, "ambiguous").otherwise("matched").alias("match_status"), F.when(k == 2, "best-of-review").when(k == 3, "exact-title").alias("basis"), F.col("p_size").alias("updated_at"))
    out = jobs.reassess_lyrics(*tables, lyrics, cands, p.count() * 6 // 10)
    wrote = out["write"].select("track_id", F.lit(True).alias("written"))
    every = jobs.evaluate_lyrics(out["selected"].drop("match_status", "basis"), cands)["write"].select("track_id", "match_status")
    return out["selected"].select("track_id", F.col("match_status").alias("was")).join(every, "track_id").join(wrote, "track_id", "left").withColumn("written", F.coalesce("written", F.lit(False)))


@query("""
WITH p AS (SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0 ORDER BY c_name LIMIT 100)
SELECT c_name AS spotify_id, CASE WHEN c_custkey IN (FROM p) THEN CASE WHEN c_custkey % 10 = 0 THEN 'new' || c_custkey // 10 WHEN c_custkey % 3 = 0 THEN 'own' || c_custkey ELSE 'not_found' END WHEN c_custkey % 5 = 1 THEN 'not_found' WHEN c_custkey % 5 <> 0 THEN 'mb' || c_custkey END AS musicbrainz_id,
  CASE WHEN c_custkey IN (FROM p) AND (c_custkey % 10 = 0 OR c_custkey % 3 = 0) THEN 'alias' END AS aliases FROM customer""")
def alias_fill(spark, d):
    """Each artist of the pool first wants the id of one that has it, then one that its neighbour wants, too; some have a third choice."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    artists = c.select(F.col("c_name").alias("spotify_id"), F.concat(F.lit("name "), k.cast("string")).alias("name"), none("array<string>").alias("genres"), F.when(k % 5 == 1, "not_found").when(k % 5 != 0, F.concat(F.lit("mb"), k.cast("string"))).alias("musicbrainz_id"), none("array<string>").alias("aliases"))
    of = lambda rows, mbid, score: rows.select(F.col("c_name").alias("artist_id"), mbid.alias("mbid"), F.lit(score).alias("score"), none("string").alias("country"), F.array(F.lit("alias"), F.lit(" ")).alias("aliases"), F.lit(0).alias("ord"))
    pool = c.where(k % 5 == 0)
    found = of(pool, F.concat(F.lit("mb"), (k + 2).cast("string")), 99).union(of(pool, F.concat(F.lit("new"), F.floor(k / 10).cast("string")), 95)).union(of(pool.where(k % 3 == 0), F.concat(F.lit("own"), k.cast("string")), 90)).union(of(pool, F.lit("low"), 89))
    return jobs.fill_aliases(artists, found, 100)["artists"].select("spotify_id", "musicbrainz_id", F.nullif(F.array_join("aliases", ","), F.lit("")).alias("aliases"))


@query("SELECT n_nationkey AS artist_id, CASE n_nationkey % 4 WHEN 0 THEN 'kr' || n_nationkey WHEN 2 THEN 'kr' || n_nationkey WHEN 3 THEN 'kr' || n_nationkey ELSE 'not_found' END AS mbid FROM nation")
def korean_identification(spark, d):
    """The hint says Korea for all but those that leave 2 by 4; without a country only a Hangul alias counts, with one (3 by 4) it isn't needed."""
    n, k = table(spark, d, "nation"), F.col("n_nationkey")
    pending = n.select(k.alias("artist_id"), F.col("n_name").alias("name"), F.array(F.when(k % 4 == 2, "rock").otherwise("k-pop")).alias("genres"), k.alias("ord"))
    found = n.select(k.alias("artist_id"), F.concat(F.lit("kr"), k.cast("string")).alias("mbid"), F.lit(95).alias("score"), F.when(k % 4 == 3, "KR").otherwise("").alias("country"), F.array(F.when(k % 4 == 0, "알파").otherwise("alpha")).alias("aliases"), F.lit(0).alias("ord"))
    return jobs.identify_artists(pending, found, spark.createDataFrame([], "mbid string")).select("artist_id", "mbid")


# sweeps, plans and guards


@query("""
WITH e AS (SELECT c_custkey, coalesce(c_acctbal >= 5000, false) AS watch FROM customer WHERE c_acctbal >= 5000 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 = 0)),
p AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS position, count(*) OVER () AS n FROM e),
b AS (SELECT *, CAST(greatest(1, ceil(n / 30.0)) AS BIGINT) AS buckets FROM p), s AS (SELECT *, (17 % buckets) * 30 AS start FROM b), z AS (SELECT *, least(30, n - start) AS size FROM s)
SELECT c_custkey AS artist_id, watch, ((position - start - (CAST(floor(17 / buckets) AS BIGINT) % size)) % size + size) % size AS visit FROM z WHERE position >= start AND position < start + size""")
def ingest_sweep_day(spark, d):
    artists = table(spark, d, "customer").select(F.col("c_custkey").alias("artist_id"), F.col("c_acctbal").alias("popularity"))
    tracked = table(spark, d, "orders").where("o_orderkey % 50 = 0").select(F.col("o_custkey").alias("artist_id")).distinct()
    return jobs.ingest_sweep(artists, tracked, 30, 17, 5000).select("artist_id", "watch", "visit")


@query("""
SELECT c_custkey AS key, CASE WHEN c_custkey % 4 = 0 THEN 'ours' WHEN c_custkey % 4 = 1 THEN 'preexisting' WHEN c_custkey % 4 = 2 THEN 'ours' ELSE 'preexisting' END AS source,
  CASE WHEN c_custkey % 4 = 0 AND c_custkey % 5 = 0 THEN 'failed' WHEN c_custkey % 4 < 3 THEN 'planned' ELSE 'pending' END AS state, CASE WHEN c_custkey % 4 > 1 THEN true END AS in_library FROM customer""")
def library_plan_only(spark, d):
    """With writes off rows only say what is planned; flags and stamps stay."""
    c, k = table(spark, d, "customer").select(F.col("c_custkey").alias("key")), F.col("key") % 4
    planned = c.where(k < 3).select("key", F.when(k == 0, "ADD").when(k == 1, "PULL").otherwise("REMOVE").alias("op"), F.when((k == 0) & (F.col("key") % 5 == 0), "boom").alias("error"))
    state = c.where(k > 1).select("key", F.when(k == 2, reconcile.OURS).otherwise(reconcile.BEFORE).alias("source"), F.lit("pending").alias("state"), F.lit(True).alias("in_library"), none("string").alias("last_error"), none("timestamp").alias("last_synced_at"))
    return reconcile.next_state(state, planned, False, _NOW).where("last_synced_at is null").select("key", "source", "state", "in_library")


@query("""
SELECT 'me' AS who, count(*) FILTER (WHERE c_custkey % 2 = 0) AS links, CAST(ceil(count(*) FILTER (WHERE c_custkey % 2 = 1) / 10.0) AS BIGINT) AS chunks FROM customer UNION ALL SELECT 'nobody', 0, 0""")
def follow_import_users(spark, d):
    """The same follows for a user that is known and for one that isn't."""
    c, out = table(spark, d, "customer"), []
    followed = c.select(text_of("c_custkey").alias("id"), F.col("c_name").alias("name"))
    artists = c.where("c_custkey % 2 = 0").select(text_of("c_custkey").alias("spotify_id"), text_of("c_custkey").alias("id"))
    for who in ("me", "nobody"):
        got = jobs.import_follows(who, spark.createDataFrame([("me",)], "id string"), followed, artists, spark.createDataFrame([], "user_id string, artist_id string"))
        counts = [got["links"].agg(F.count("*").alias("links"), F.lit(0).cast("long").alias("chunks")), got["fetch"].agg(F.lit(0).cast("long").alias("links"), F.count("*").alias("chunks"))]
        out.append(counts[0].union(counts[1]).agg(F.sum("links").alias("links"), F.sum("chunks").alias("chunks")).select(F.lit(who).alias("who"), "links", "chunks"))
    return out[0].union(out[1])


# landed files


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders WHERE o_orderkey % 13 <> 0)
SELECT artist_id, source_key, release_date FROM (SELECT CAST(o_custkey AS VARCHAR) AS artist_id, CAST(o_orderkey AS VARCHAR) AS source_key, day AS release_date, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM r WHERE day BETWEEN '1995-01-01' AND '1998-12-31') WHERE r <= 2""")
def upcoming_release_groups(spark, d):
    """Orders as release groups, landed as JSON lines and read back; a thirteenth of the lines is malformed."""
    o, path = table(spark, d, "orders"), fresh(spark, "groups")
    day = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = F.to_json(F.struct(text_of("o_custkey").alias("artist_id"), text_of("o_orderkey").alias("id"), F.lit("t").alias("title"), F.lit("Album").alias("primary-type"), day.alias("first-release-date")))
    landed.land(o.select(F.when(F.col("o_orderkey") % 13 == 0, "{broken").otherwise(line).alias("value")), path)
    rows = landed.read(spark, "release_groups", path).withColumn("ord", F.col("id").cast("long"))
    return landed.upcoming_groups(rows, "1995-01-01", "1998-12-31", 2).select("artist_id", "source_key", "release_date")


@query("""
SELECT 'albums' AS kind, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'artists', count(*), CAST(sum(s_suppkey * 10) AS BIGINT) FROM supplier
UNION ALL SELECT 'tracks', count(*), CAST(count(*) FILTER (WHERE p_partkey % 2 = 0) AS BIGINT) FROM part
UNION ALL SELECT 'plays', count(*), count(*) FILTER (WHERE event_id % 11 <> 0) FROM events
UNION ALL SELECT 'saved_albums', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'follows', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer""")
def landed_files(spark, d):
    """Payloads of six kinds landed as files and read with their schemas."""
    o, s = table(spark, d, "orders"), table(spark, d, "supplier")
    made = {
        "albums": (_albums(spark, d).drop("ord"), F.sum(F.col("id").cast("long"))),
        "artists": (s.select(text_of("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array(F.struct(F.lit("u").alias("url"))).alias("images"), F.array(F.lit("rock")).alias("genres"), F.struct((F.col("s_suppkey") * 10).alias("total")).alias("followers"), F.lit(1).alias("popularity")), F.sum("followers.total")),
        "tracks": (table(spark, d, "part").select(text_of("p_partkey").alias("id"), F.struct(F.when(F.col("p_partkey") % 2 == 0, F.lit("code")).alias("isrc")).alias("external_ids")), F.count("external_ids.isrc")),
        "plays": (_play_items(spark, d).select("played_at", "track"), F.count("track.id")),
        "saved_albums": (o.select(F.lit("2024-01-01T00:00:00Z").alias("added_at"), _named(text_of("o_orderkey"), F.lit("x")).alias("album")), F.sum(F.col("album.id").cast("long"))),
        "follows": (table(spark, d, "customer").select(text_of("c_custkey").alias("id"), F.col("c_name").alias("name")), F.sum(F.col("id").cast("long"))),
    }
    out = None
    for kind, (rows, total) in made.items():
        path = fresh(spark, kind)
        landed.land(rows, path)
        one = landed.read(spark, kind, path).agg(F.count("*").alias("n"), total.cast("long").alias("total")).select(F.lit(kind).alias("kind"), "n", "total")
        out = one if out is None else out.union(one)
    return out


# whole rows of the sync jobs


@query("""
WITH t AS (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(o_orderkey AS VARCHAR) AS spotify_id, o_orderpriority AS title, strftime(o_orderdate, '%Y-%m') || '-01' AS release_date, CASE WHEN o_orderkey % 2 = 0 THEN 'u' || o_orderkey END AS cover_url, o_orderstatus AS album_type, count(*) AS total_tracks,
  CASE WHEN o_orderkey % 3 = 0 THEN 'spotify_url=' || o_orderkey || ',' ELSE '' END || 'upc=' || o_custkey AS refs FROM orders JOIN t ON o_orderkey = l_orderkey GROUP BY ALL""")
def album_rows(spark, d):
    new = jobs.sync_albums({n: schemas.empty(spark, n) for n in ("artists", "albums", "tracks", "album_artists", "track_artists")}, _albums(spark, d))["albums"]
    refs = F.array_join(F.transform(F.array_sort(F.map_entries("ext_refs")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    return new.select("spotify_id", "title", F.rpad(F.col("release_date").cast("string"), 10, "-01").alias("release_date"), "cover_url", "album_type", F.col("total_tracks").cast("long").alias("total_tracks"), refs.alias("refs"))


@query("""
WITH p AS (SELECT event_id, 't' || event_id % 50 AS track, event_type, ts FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0),
f AS (SELECT track, ts, arg_min(event_type, -event_id) AS name FROM p GROUP BY track, ts)
SELECT track, name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS played FROM f ORDER BY ts DESC, track DESC LIMIT 50""")
def recent_track_rows(spark, d):
    held = [schemas.empty(spark, n) for n in ("recent_albums", "recent_tracks", "play_events", "track_play_events")]
    albums = table(spark, d, "customer").select(text_of("c_custkey").alias("spotify_id"))
    got = jobs.sync_recent(*held, albums, _play_items(spark, d))["recent_tracks"]
    return got.select(F.col("spotify_track_id").alias("track"), F.col("track_name").alias("name"), second("played_at").alias("played"))


@query(f"""
WITH u AS ({_CONNECTED})
SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, 't' || event_id % 50 AS track, strftime(ts, '%Y-%m-%d %H:%M:%S') AS played FROM events JOIN u USING (user_id) WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""")
def member_play_rows(spark, d):
    limited = jobs.connected(_integrations(spark, d), "payload", 300).select(text_of("user_id").alias("user_id"))
    users = joins.with_keys(_integrations(spark, d).withColumn("user_id", text_of("user_id")), limited, ["user_id"])
    polled = spark.createDataFrame([], "user_id string, is_playing boolean, progress_ms long, item struct<id: string, name: string, duration_ms: bigint, artists: array<struct<id: string, name: string>>, album: struct<id: string, name: string>>")
    got = jobs.sync_member(schemas.empty(spark, "member_tracks"), schemas.empty(spark, "now_playing"), _play_items(spark, d), polled, now(), users)["tracks"]
    return got.select("user_id", F.col("spotify_track_id").alias("track"), second("played_at").alias("played")).distinct()


# tables that batches build up


def _batches(spark, d, n: int = 4):
    """Events in ``n`` batches by id, each with a part of the one before again."""
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("at"))
    return [e.where((F.col("event_id") % n == k) | ((F.col("event_id") % n == k - 1) & (F.col("event_id") % 8 < 2))) for k in range(n)]


@query("""
SELECT user_id, event_type, arg_min(event_id, (event_id % 4, ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type""")
def log_of_batches(spark, d):
    """The first event of each user and type over four batches of a log, two of them delivered twice; within a batch the first by time."""
    held = logs.Snapshots(spark, fresh(spark, "log"), "user_id long, event_type string, at timestamp, event_id long", parts=8)
    step = logs.append_log(held, ["user_id", "event_type"])
    for number, batch in enumerate(_batches(spark, d)):
        for _ in range(1 + number % 2):
            step(batch, number)
    return held.read().select("user_id", "event_type", "event_id")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events ORDER BY ts DESC, event_id DESC LIMIT 40")
def window_of_batches(spark, d):
    held = logs.Snapshots(spark, fresh(spark, "window"), "event_id long, at timestamp")
    step = logs.rolling_window(held, ["event_id"], "at", "event_id", 40)
    for number, batch in enumerate(_batches(spark, d)):
        step(batch, number)
    return held.read().select("event_id", second("at").alias("at"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def states_of_batches(spark, d):
    held = logs.Snapshots(spark, fresh(spark, "states"), "user_id long, at timestamp, event_id long", parts=4)
    step = logs.latest_state(held, "user_id", "at")
    for number, batch in enumerate(_batches(spark, d)):
        step(batch, number)
    return held.read().select("user_id", "event_id")


# shapes of titles and times


@query("""
SELECT p_partkey AS track_id, CASE WHEN k IN (0, 1, 4, 9) THEN 'matched' WHEN k IN (2, 3, 7, 10) THEN 'review_required' ELSE 'not_found' END AS match_status,
  CASE WHEN k IN (2, 3, 10) THEN 'version_token_mismatch' WHEN k = 7 THEN 'title_fuzzy_only' WHEN k IN (5, 6, 8, 11) THEN 'no_plausible_candidate' END AS reason,
  CASE k WHEN 2 THEN '라이브' WHEN 3 THEN '라이브' WHEN 10 THEN 'remastered' END AS tokens, CASE WHEN k = 7 THEN round(2.0 * length(p_name) / (2 * length(p_name) + 1), 3) END AS similarity
FROM (SELECT *, p_partkey % 12 AS k FROM part)""")
def match_title_shapes(spark, d):
    """One candidate a track: the same title, with a guest, two Korean renditions, a track number, none, an empty one, one letter more, another one, capitals with accents, a remaster, another artist."""
    k, p = F.col("p_partkey") % 12, table(spark, d, "part")
    shapes = [
        F.col("p_name"), F.concat("p_name", F.lit(" (feat. 아이유)")), F.concat("p_name", F.lit(" (라이브)")), F.concat("p_name", F.lit(" - 라이브")), F.concat(F.lit("01. "), "p_name"), none("string"), F.lit(""), F.concat("p_name", F.lit("s")),
        F.lit("zzzz qqqq"), F.translate(F.upper("p_name"), "AEIO", "ÀÉÎÖ"), F.concat("p_name", F.lit(" [Remastered]")), F.col("p_name"),
    ]
    title = none("string")
    for at, shape in enumerate(shapes):
        title = F.when(k == at, shape).otherwise(title)
    artist = F.concat(F.lit("Ártist "), F.col("p_partkey").cast("string"))
    tracks = p.select(F.col("p_partkey").alias("track_id"), F.col("p_name").alias("title"), F.array(artist).alias("artist_names"), none("array<string>").alias("aliases"), F.lit(200.0).alias("duration_sec"))
    cands = p.select(F.col("p_partkey").alias("id"), title.alias("title"), F.when(k == 11, F.concat(artist, F.lit(" band"))).otherwise(F.lower(artist)).alias("artist"), none("string").alias("album"), F.lit(201.5).alias("duration_sec"), F.lit(False).alias("instrumental"), F.lit("la").alias("plain_lyrics"), none("string").alias("synced_lyrics"), F.col("p_partkey").alias("ord"))
    got = resolve.decide(tracks, cands)
    return got.select("track_id", "match_status", "reason", F.nullif(F.array_join("candidate_tokens", ","), F.lit("")).alias("tokens"), "similarity")


@query("""
SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(CAST(l_shipdate AS TIMESTAMP) + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d 00:00:00') END AS at FROM lineitem""")
def instant_values(spark, d):
    """Times in UTC, at noon nine hours ahead of it, as a day alone, and malformed."""
    k, day = F.col("l_linenumber") % 4, lambda form: F.date_format("l_shipdate", form)
    raw = F.when(k == 0, day("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.concat(day("yyyy-MM-dd"), F.lit("T12:00:00+09:00"))).when(k == 2, day("yyyy-MM-dd")).otherwise("20x4-01-01")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", second(dates.parse_instant(raw)).alias("at"))
