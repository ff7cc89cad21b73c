import json
import re

import pytest
from pyspark.sql import functions as F

from cadenza.plans import jobs
from cadenza.sources import flatten, landed

NOW = "2026-01-01 00:00:00"


def landed_json(spark, tmp_path, kind, items):
    path = tmp_path / f"{kind}.json"
    path.write_text("\n".join(json.dumps(i) for i in items))
    return landed.read(spark, kind, str(path))


def album(i, upc="u", title="T"):
    tracks = [{"id": f"t{i}{k}", "name": f"n{k}", "track_number": k, "duration_ms": ms, "artists": [{"id": "a1", "name": "A"}]} for k, ms in ((1, 284000), (2, None))]
    return {"id": f"al{i}", "name": title, "release_date": "2024", "album_type": "album", "total_tracks": 2, "label": "L", "popularity": 5, "artists": [{"id": "a1", "name": "A"}, None], "images": [{"url": "img"}], "external_urls": {"spotify": "s"}, "tracks": {"items": tracks}} | ({"external_ids": {"upc": upc}} if upc else {})


@pytest.fixture
def tables(spark):
    empty = lambda s: spark.createDataFrame([], s)
    return {
        "artists": empty("spotify_id string, name string, genres array<string>"),
        "albums": empty("spotify_id string, title string, release_date string, cover_url string, album_type string, total_tracks int, label string, popularity int, ext_refs map<string,string>"),
        "tracks": empty("spotify_id string, album_sid string, title string, track_no int, duration_sec int"),
        "album_artists": empty("album_sid string, artist_sid string"), "track_artists": empty("track_sid string, artist_sid string"), "album_genres": empty("album_sid string, slug string"),
    }


def test_album_sync_is_idempotent_and_keeps_references(spark, tmp_path, tables):
    payloads = landed_json(spark, tmp_path, "albums", [album(1), None, album(2)])
    once = jobs.sync_albums(tables, payloads)
    assert {n: once[n].count() for n in ("artists", "albums", "tracks", "album_artists", "track_artists")} == {"artists": 1, "albums": 2, "tracks": 4, "album_artists": 2, "track_artists": 4}
    assert {r.track_no: r.duration_sec for r in once["tracks"].where("album_sid = 'al1'").collect()} == {1: 284, 2: 0}
    (tmp_path / "second").mkdir()
    second = landed_json(spark, tmp_path / "second", "albums", [album(1, upc=None, title="New")])
    twice = jobs.sync_albums(once, second)
    row = twice["albums"].where("spotify_id = 'al1'").first()
    assert (row.title, row.release_date, row.ext_refs["upc"], twice["albums"].count(), twice["tracks"].count()) == ("New", "2024-01-01", "u", 2, 4)


def test_landed_files_are_compressed(spark, tmp_path):
    objects = spark.range(500).selectExpr("cast(id as string) as id", "named_struct('isrc', if(id % 2 = 0, 'code', null)) as external_ids")
    landed.land(objects, str(tmp_path / "objects"))
    landed.land(spark.createDataFrame([('{"id": "1"}',), ("{broken",)], "value string"), str(tmp_path / "lines"))
    files = [f for kind in ("objects", "lines") for f in (tmp_path / kind).glob("part-*")]
    assert files and all(f.name.endswith(".gz") for f in files)
    got = landed.read(spark, "tracks", str(tmp_path / "objects"))
    assert got.count() == 500 and got.where("external_ids.isrc = 'code'").count() == 250
    assert landed.read(spark, "follows", str(tmp_path / "lines")).where("id = '1'").count() == 1


def test_genres(spark, tables):
    artists = spark.createDataFrame([("a1", ["한국 랩", "케이팝"]), ("a2", ["케이팝", ""]), ("a3", [])], "spotify_id string, genres array<string>")
    links = spark.createDataFrame([("x", "a1"), ("y", "a2"), ("z", "a3")], "album_sid string, artist_sid string")
    mapping = spark.createDataFrame([("한국 랩", "hip-hop", False), ("케이팝", "k-pop", True)], "genre string, slug string, arbitration_only boolean")
    once = jobs.attach_genres(tables["album_genres"], links, artists, mapping)
    assert sorted(map(tuple, once.collect())) == [("x", "hip-hop"), ("y", "k-pop")]
    assert jobs.attach_genres(once, links, artists, mapping).count() == 2


def test_genre_links_may_repeat_and_no_task_hashes_them(spark, tables):
    artists = spark.createDataFrame([("a1", ["rap", "pop"]), ("a2", ["pop"]), ("a3", ["none"])], "spotify_id string, genres array<string>")
    links = spark.createDataFrame([("x", "a1"), ("x", "a1"), ("x", "a2"), ("y", "a2"), ("y", "a2"), ("z", "a3"), ("y", "gone")], "album_sid string, artist_sid string")
    mapping = spark.createDataFrame([("rap", "hip-hop", False), ("pop", "k-pop", True)], "genre string, slug string, arbitration_only boolean")
    got = jobs.attach_genres(tables["album_genres"], links, artists, mapping)
    assert sorted(map(tuple, got.collect())) == [("x", "hip-hop"), ("y", "k-pop")]
    hashed = re.findall(r"\bHashAggregate\(keys=\[([^\]]*)\]", got._jdf.queryExecution().executedPlan().toString())
    assert hashed and not [keys for keys in hashed if "album_sid" in keys and ("artist_sid" in keys or "genre" in keys)]


def play(track, album, at):
    return {"played_at": at, "track": {"id": track, "name": "n", "duration_ms": 1, "artists": [{"name": "A"}, {"name": "B"}], "album": {"id": album, "name": "al", "images": []}}}


def test_listening(spark, tmp_path):
    items = [play("t1", "al1", "2024-01-03T00:00:00Z"), play("t2", "al2", "2024-01-02T00:00:00Z"), play("t1", "al1", "2024-01-01T00:00:00Z"), play(None, "al1", "2024-01-01T00:00:00Z"), play("t9", "al1", "soon")]
    rows = landed_json(spark, tmp_path, "plays", items).coalesce(1).withColumn("ord", F.monotonically_increasing_id())
    empty = lambda s: spark.createDataFrame([], s)
    args = [empty("album_sid string, last_played_at timestamp"), empty("spotify_track_id string, track_name string, played_at timestamp"), empty("album_sid string, played_at timestamp"), empty("spotify_track_id string, album_sid string, played_at timestamp")]
    albums = spark.createDataFrame([("al1",)], "spotify_id string")
    out = jobs.sync_recent(*args, albums, rows, window=2)
    assert [(r.album_sid, str(r.last_played_at)) for r in out["recent_albums"].collect()] == [("al1", "2024-01-03 00:00:00")]
    assert out["recent_tracks"].count() == 2 and out["track_events"].count() == 3 and out["album_events"].count() == 2
    assert [r.album_sid for r in out["unknown"].collect()] == ["al2"]
    again = jobs.sync_recent(*(out[k] for k in ("recent_albums", "recent_tracks", "album_events", "track_events")), albums, rows, window=2)
    assert again["track_events"].count() == 3 and again["album_events"].count() == 2
    assert flatten.plays(rows).first().artist_name == "A, B"


def test_now_playing(spark, tmp_path):
    state = spark.createDataFrame([], "user_id string, is_playing boolean, spotify_track_id string, track_name string, artist_name string, album_name string, album_sid string, progress_ms long, duration_ms long, updated_at timestamp")
    on = landed_json(spark, tmp_path, "player", [{"user_id": "u", "is_playing": True, "progress_ms": 5, "item": {"id": "t", "name": "n", "duration_ms": 9, "artists": [{"name": "A"}], "album": {"id": "al", "name": "x"}}}])
    now = F.to_timestamp(F.lit(NOW))
    once = jobs.sync_now_playing(state, on, now)
    (tmp_path / "idle").mkdir()
    idle = landed_json(spark, tmp_path / "idle", "player", [{"user_id": "u", "is_playing": False, "item": None}])
    row = jobs.sync_now_playing(once, idle, F.to_timestamp(F.lit("2026-01-01 00:00:30"))).first()
    assert (row.is_playing, row.spotify_track_id, row.artist_name) == (False, "t", "A")
    due = lambda cron, at: jobs.should_poll(once, F.to_timestamp(F.lit(at)), cron).first().due
    assert (due(False, "2026-01-01 00:00:59"), due(False, "2026-01-01 00:01:00"), due(True, NOW)) == (False, True, True)
    assert jobs.should_poll(state, now, False).first().due


def test_unknown_modes(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        jobs.sync_saved_tracks(None, None, None, None, "partial")
    with pytest.raises(ValueError, match="unknown mode"):
        jobs.poll_releases(None, None, None, "radio", 0, 1, None, 1)


def test_scrobbles(spark):
    one = {"name": "X", "artist": {"#text": "A"}, "album": {"#text": ""}, "image": [{"#text": "s", "size": "small"}, {"#text": "l", "size": "large"}], "date": {"uts": "1700000000"}}
    live = {"name": "Y", "artist": {"#text": "A"}, "@attr": {"nowplaying": "true"}}
    bad = one | {"date": {"uts": "soon"}}
    pages = spark.createDataFrame([("u", json.dumps({"recenttracks": {"track": [live, one, bad]}})), ("v", json.dumps({"recenttracks": {"track": one}})), ("w", json.dumps({"recenttracks": {}})), ("x", None)], "user_id string, page string")
    done, playing = landed.scrobbles(pages)
    assert sorted((r.user_id, r.track_name, r.image_url, r.album_name) for r in done.collect()) == [("u", "X", "l", None), ("v", "X", "l", None)]
    assert [(r.user_id, r.track_name) for r in playing.collect()] == [("u", "Y")]
    columns = [c for c in done.columns if c != "ord"]
    users = spark.createDataFrame([("u", "connected", None), ("v", "connected", None), ("z", "off", None)], "user_id string, status string, last_synced_at timestamp")
    empty = done.select(columns).where("false")
    out = jobs.sync_scrobbles(users, empty, done, playing, F.to_timestamp(F.lit(NOW)))
    assert out["tracks"].count() == 3
    assert jobs.sync_scrobbles(users, out["tracks"], done, playing.where("false"), F.to_timestamp(F.lit(NOW)))["tracks"].count() == 2
    assert {r.user_id: r.since for r in jobs.scrobble_cursors(users, out["tracks"]).collect()} == {"u": 1700000001, "v": 1700000001}


def test_artist_details(spark, tmp_path):
    artists = spark.createDataFrame([("a", None, None, None, None), ("b", None, None, None, None)], "spotify_id string, photo_url string, genres array<string>, followers long, popularity int")
    details = landed_json(spark, tmp_path, "artists", [{"id": "a", "images": [], "genres": ["g"], "followers": {"total": 3}, "popularity": 1}])
    out = {r.spotify_id: r.photo_url for r in jobs.enrich_artists(artists, details, artists).collect()}
    assert out == {"a": "", "b": ""}


def test_isrc(spark, tmp_path):
    tracks = spark.createDataFrame([("a", None), ("b", None), ("c", None), ("d", "kept")], "spotify_id string, isrc string")
    got = landed_json(spark, tmp_path, "tracks", [{"id": "a", "external_ids": {"isrc": "X"}}, {"id": "b", "external_ids": {}}])
    out = {r.spotify_id: r.isrc for r in jobs.backfill_isrc(tracks, got, tracks.where("isrc is null")).collect()}
    assert out == {"a": "X", "b": "no_isrc", "c": "not_found", "d": "kept"}


def test_identification_is_sequential(spark):
    pending = spark.createDataFrame([(1, "A", ["k-pop"], 1), (2, "B", [], 2), (3, "C", [], 3), (4, "D", ["한국 록"], 4)], "artist_id int, name string, genres array<string>, ord int")
    found = spark.createDataFrame([(1, "m1", 100, "KR", ["알파", "a"], 0), (2, "m1", 100, None, [], 0), (2, "m2", 95, None, ["Bee"], 1), (3, "m2", 99, None, [], 0), (3, "m9", 80, None, [], 1), (4, "m4", 99, "US", [], 0), (4, "m5", 98, None, ["latin"], 1)], "artist_id int, mbid string, score int, country string, aliases array<string>, ord int")
    taken = spark.createDataFrame([("m7",)], "mbid string")
    out = {r.artist_id: (r.mbid, r.aliases) for r in jobs.identify_artists(pending, found, taken).collect()}
    assert out == {1: ("m1", ["알파"]), 2: ("m2", ["Bee"]), 3: ("not_found", []), 4: ("not_found", [])}


def test_follows(spark):
    users = spark.createDataFrame([("u",)], "id string")
    followed = spark.createDataFrame([(f"s{i:02d}",) for i in range(25)], "id string")
    artists = spark.createDataFrame([("s00", "A0"), ("s01", "A1")], "spotify_id string, id string")
    held = spark.createDataFrame([("u", "A0")], "user_id string, artist_id string")
    out = jobs.import_follows("u", users, followed, artists, held)
    assert out["links"].count() == 2 and sorted(len(r["keys"]) for r in out["fetch"].collect()) == [3, 10, 10]
    assert jobs.import_follows("nobody", users, followed, artists, held)["fetch"].count() == 0


def test_dump_guard(spark, tmp_path):
    spark.createDataFrame([(1,)], "id int").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="lack"):
        landed.read_dump(spark, str(tmp_path / "t"), str(tmp_path / "t"))


def test_routing(spark):
    from cadenza.plans import dispatch

    bodies = [("1", '{"album_ids": ["a"]}'), ("2", '{"job": "follow_import", "user_id": "u"}'), ("3", '{"job": "follow_import", "user_id": "v", "rerun": true}'), ("4", "nonsense"), ("5", '{"job": "dance"}'), ("6", None)]
    good, bad = dispatch.route(spark.createDataFrame(bodies, "message_id string, body string"))
    assert {(r.message_id, r.job) for r in good.collect()} == {("1", "album_sync"), ("2", "follow_import"), ("3", "follow_import")}
    assert {r.message_id for r in bad.collect()} == {"4", "5", "6"}
    sent = {(r.job, r.user_id, r.rerun, str(r.not_before)) for r in dispatch.follow_ups(good, F.to_timestamp(F.lit(NOW))).collect()}
    assert sent == {("lyrics", None, False, NOW), ("follow_import", "u", True, "2026-01-01 00:15:00")}


def test_schemas(spark):
    from cadenza import schemas

    assert all(set(key) <= set(schemas.empty(spark, name).columns) for name, (_, key) in schemas.TABLES.items())
