"""The jobs of the catalogue: each takes tables and a batch, and returns new tables, plans or both.

Clocks, ticks and modes are parameters.  Nothing is written here; remote calls appear as rows of a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import dates
from cadenza.functions import text as T
from cadenza.operators import assign, calendar, joins, merge, rank, reconcile, resolve
from cadenza.operators.merge import Rule
from cadenza.session import durable, observed
from cadenza.sources import flatten

ALBUM_RULES = dict.fromkeys(("title", "release_date", "cover_url", "album_type", "total_tracks", "label", "popularity"), Rule.OVERWRITE) | {"ext_refs": Rule.MAP_MERGE}


def sync_albums(tables: dict[str, DataFrame], payloads: DataFrame, genre_map: DataFrame | None = None) -> dict[str, DataFrame]:
    """Album payloads into artists, albums, tracks, their link tables and genres.  Keys of new rows are their source ids."""
    flat = flatten.albums(durable(payloads, "payloads"))  # five relations read their columns of it, none parses a payload again
    new = dict(tables)
    new["artists"] = merge.upsert(tables["artists"], merge.last_wins(flat["artists"], ["spotify_id"], "ord"), ["spotify_id"], {"name": Rule.OVERWRITE})
    new["albums"] = merge.upsert(tables["albums"], merge.last_wins(flat["albums"], ["spotify_id"], "ord"), ["spotify_id"], ALBUM_RULES)
    new["tracks"] = merge.upsert(tables["tracks"], merge.last_wins(flat["tracks"], ["spotify_id"], "ord"), ["spotify_id"], dict.fromkeys(("album_sid", "title", "track_no", "duration_sec"), Rule.OVERWRITE))
    for name, keys in (("album_artists", ["album_sid", "artist_sid"]), ("track_artists", ["track_sid", "artist_sid"])):
        new[name] = merge.insert_ignore(tables[name], flat[name], keys)
    if genre_map is not None:
        new["album_genres"] = attach_genres(tables["album_genres"], flat["album_artists"], new["artists"], genre_map)
    return new


def attach_genres(held: DataFrame, album_artists: DataFrame, artists: DataFrame, genre_map: DataFrame) -> DataFrame:
    """Genre links of albums by their artists' genre strings.  ``genre_map``: genre, slug, arbitration_only; a slug that only arbitrates is attached when no
    other one is.  Links may repeat.  Artists meet the genre map before their albums, so links without a slug go no further."""
    says = artists.select(F.col("spotify_id").alias("artist_sid"), F.explode("genres").alias("genre")).join(genre_map, "genre").select("artist_sid", "slug", "arbitration_only").distinct()
    said = album_artists.select("album_sid", "artist_sid").join(says, "artist_sid")  # the sets below drop repeated links
    slugs = said.groupBy("album_sid").agg(F.collect_set(F.when(~F.col("arbitration_only"), F.col("slug"))).alias("firm"), F.collect_set("slug").alias("all"))
    chosen = slugs.select("album_sid", F.explode(F.when(F.size("firm") > 0, F.col("firm")).otherwise(F.col("all"))).alias("slug"))  # each once
    return held.unionByName(joins.without_keys(chosen, held, ["album_sid", "slug"]).select(*held.columns))


def sync_recent(recent_albums: DataFrame, recent_tracks: DataFrame, album_events: DataFrame, track_events: DataFrame, albums: DataFrame, items: DataFrame, window: int = 50) -> dict[str, DataFrame]:
    """The recently played window: both logs grow by what they lack, both caches show the newest window.  ``items`` are newest first by ``ord``.

    Albums that the catalogue lacks are returned as ``unknown`` and leave the album cache as it is, if none is known.
    """
    rows = flatten.plays(items)
    known = rows.join(albums.select(F.col("spotify_id").alias("album_sid")).distinct(), "album_sid", "left_semi")
    latest = known.groupBy("album_sid").agg(F.min_by("played_at", "ord").alias("last_played_at"))
    cached = merge.upsert(recent_albums, latest, ["album_sid"], {"last_played_at": Rule.OVERWRITE})
    kept = cached if latest.isEmpty() else merge.prune(cached, latest, ["album_sid"])
    tracks = merge.insert_ignore(recent_tracks, rows.select(*recent_tracks.columns, "ord"), ["spotify_track_id", "played_at"], "ord")
    return {
        "recent_albums": kept,
        "recent_tracks": rank.newest(tracks, "played_at", "spotify_track_id", window),
        "album_events": merge.insert_ignore(album_events, known.select("album_sid", "played_at", "ord"), ["album_sid", "played_at"], "ord"),
        "track_events": merge.insert_ignore(track_events, rows.select(*track_events.columns, "ord"), ["spotify_track_id", "played_at"], "ord"),
        "unknown": rows.where(F.col("album_sid").isNotNull()).select("album_sid").distinct().join(albums.select(F.col("spotify_id").alias("album_sid")), "album_sid", "left_anti"),
    }


def sync_now_playing(state: DataFrame, polled: DataFrame, now: Column) -> DataFrame:
    """The latest state of each user; an idle poll keeps the last track's fields."""
    rows = flatten.player_state(polled).withColumn("updated_at", now)
    fields = ["spotify_track_id", "track_name", "artist_name", "album_name", "album_sid", "progress_ms", "duration_ms"]
    full = merge.upsert(state, rows.where(~F.col("is_idle")), ["user_id"], dict.fromkeys(["is_playing", *fields, "updated_at"], Rule.OVERWRITE))
    return merge.upsert(full, rows.where("is_idle"), ["user_id"], {"is_playing": Rule.OVERWRITE, "updated_at": Rule.OVERWRITE})


def should_poll(state: DataFrame, now: Column, cron: bool, seconds: int = 60) -> DataFrame:
    """One row: whether a run is due.  Scheduled runs always are; others not within ``seconds`` of the last write."""
    last = state.agg(F.max("updated_at").alias("last"))
    return last.select((F.lit(cron) | ~dates.debounced(now, F.col("last"), seconds)).alias("due"))


def since_cursor(rows: DataFrame, held: DataFrame, at: str, keys: list[str] | None = None) -> DataFrame:
    """Rows newer than the newest held one (of their ``keys``); all rows where nothing is held."""
    if keys is None:
        since = held.agg(F.max(at)).first()[0]  # one value, which prunes the scan of the rows
        return rows if since is None else rows.where(F.col(at) > F.lit(since))
    newest = held.groupBy(*keys).agg(F.max(at).alias("_since"))
    return rows.join(newest, keys, "left").where(F.col("_since").isNull() | (F.col(at) > F.col("_since"))).select(*rows.columns)


def sync_saved_tracks(held: DataFrame, items: DataFrame, tracks: DataFrame, albums: DataFrame, mode: str) -> DataFrame:
    """Saved tracks.  ``full`` also drops what is no longer saved; ``incremental`` takes what is newer than the newest held row."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = flatten.saved_tracks(items)
    rows = rank.best_per_key(rows, ["spotify_track_id"], F.struct("added_at", *(c for c in rows.columns if c not in ("spotify_track_id", "added_at"))), descending=True)
    rows = since_cursor(rows, held, "added_at") if mode == "incremental" else rows
    rows = joins.lookup(joins.lookup(rows, tracks, "spotify_track_id", "spotify_id", "id", "track_id"), albums, "album_sid", "spotify_id", "id", "album_id")
    merged = merge.upsert(held, rows, ["spotify_track_id"], {c: Rule.OVERWRITE for c in held.columns if c != "spotify_track_id"})
    return merge.prune(merged, rows, ["spotify_track_id"]) if mode == "full" else merged


def sync_library(bucket: DataFrame, library: DataFrame, state: DataFrame, writes_enabled: bool, now: str) -> dict[str, DataFrame]:
    """Two-way reconcile of a wanted bucket with the remote library: the plan (written), its counts, the new side rows, and pulls to append to the bucket."""
    planned, n = observed(reconcile.plan(bucket, library, state), "plan", reconcile.counts())
    funnel = planned.sparkSession.createDataFrame([tuple(n[c] for c in reconcile.counts())], ", ".join(f"`{c}` long" for c in reconcile.counts()))
    return {"plan": planned, "funnel": funnel, "state": reconcile.next_state(state, planned, writes_enabled, now), "append": planned.where(F.col("op") == "PULL").select("key")}


def sync_scrobbles(integrations: DataFrame, held: DataFrame, completed: DataFrame, playing: DataFrame, now: Column) -> dict[str, DataFrame]:
    """Completed scrobbles into the log by (user, time), now-playing rows replaced per polled user, and the users' stamps."""
    columns = [c for c in held.columns]
    log = merge.insert_ignore(held, completed.select(*columns, "ord"), ["user_id", "played_at"], "ord", within=~F.col("is_now_playing"))
    users = integrations.select("user_id").distinct()
    one = rank.best_per_key(playing.select(*columns, "ord"), ["user_id"], F.col("ord")).select(*columns)
    stays = log.where(~F.col("is_now_playing")).unionByName(log.where("is_now_playing").join(users, "user_id", "left_anti"))
    return {"tracks": stays.unionByName(one.join(users, "user_id", "left_semi")), "integrations": integrations.withColumn("last_synced_at", now)}


def connected(integrations: DataFrame, needs: str, limit: int | None = None) -> DataFrame:
    """Connected users that have ``needs`` (a user name, a payload), longest unsynced first, never synced before all, so that bounded runs come round to everyone."""
    found = integrations.where((F.col("status") == "connected") & F.col(needs).isNotNull())
    return found if limit is None else found.orderBy(F.col("last_synced_at").asc_nulls_first(), "user_id").limit(limit)


def scrobble_cursors(integrations: DataFrame, held: DataFrame, limit: int | None = None) -> DataFrame:
    """Connected users (at most ``limit``, longest unsynced first) with the second after their newest completed scrobble (null: everything)."""
    users = connected(integrations, "username", limit) if "username" in integrations.columns else integrations.where(F.col("status") == "connected")
    newest = held.where(~F.col("is_now_playing")).groupBy("user_id").agg((F.unix_timestamp(F.max("played_at")) + 1).alias("since"))
    return users.join(newest, "user_id", "left")


def sync_member(held: DataFrame, state: DataFrame, items: DataFrame, polled: DataFrame, now: Column, integrations: DataFrame | None = None, limit: int | None = None) -> dict[str, DataFrame]:
    """Members' plays by (user, time, track) and their now-playing rows; of the connected users alone if ``integrations`` are given."""
    rows = flatten.plays(items)
    if integrations is not None:
        users = connected(integrations, "payload", limit)
        rows, polled = joins.with_keys(rows, users, ["user_id"]), joins.with_keys(polled, users, ["user_id"])
    fresh = rank.best_per_key(rows.select(*held.columns), ["user_id", "played_at", "spotify_track_id"], F.struct(*(c for c in held.columns if c not in ("user_id", "played_at", "spotify_track_id"))))
    return {"tracks": merge.insert_ignore(held, fresh, ["user_id", "played_at", "spotify_track_id"]), "state": sync_now_playing(state, polled, now)}


def untried(df: DataFrame, column: str, order: list[str], limit: int) -> DataFrame:
    """The pool of a backfill: rows in which ``column`` was never tried (null; a sentinel is an answer), the first ``limit`` in a stable order."""
    return df.where(F.col(column).isNull()).orderBy(*order).limit(limit)


def photoless(artists: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of the batch's artists that have no photo yet."""
    return joins.with_keys(artists.where(F.col("photo_url").isNull()), batch, ["spotify_id"]).select("spotify_id")


def ingest_sweep(artists: DataFrame, tracked: DataFrame, per_day: int, day: int, watch_min: int) -> DataFrame:
    """The day's slice of artists that are popular enough or tracked, with ``watch`` and ``visit``."""
    eligible = joins.passes_or_exists(artists, F.col("popularity") >= watch_min, tracked, ["artist_id"])
    flagged = eligible.withColumn("watch", watched(F.col("popularity"), watch_min))
    return rank.rotation(flagged, ["artist_id"], per_day, day)


def ingest_albums(discography: DataFrame, albums: DataFrame, popularity: DataFrame, since: str, album_min: int, cap: int) -> dict[str, DataFrame]:
    """The funnel of one sweep: fresh, novel, above the bar, within the room that the catalogue's rows leave below ``cap``; and its counts, taken while the steps are written.
    ``discography``: album_sid, release_date (text), ord."""
    room, is_fresh = max(0, cap - albums.count()), F.coalesce(dates.freshness_key(F.col("release_date")) >= since, F.lit(False))
    fresh, swept = observed(discography, "fresh", {"seen": F.count("*"), "fresh": F.count_if(is_fresh)}, is_fresh)
    distinct = rank.best_per_key(fresh, ["album_sid"], F.col("ord"))
    novel = distinct.join(albums.select(F.col("spotify_id").alias("album_sid")).distinct(), "album_sid", "left_anti")
    rated = novel.join(popularity.select("album_sid", "popularity"), "album_sid", "left").withColumn("passes_gate", F.coalesce("popularity", F.lit(0)) >= album_min)
    rated, judged = observed(rated, "rated", {"novel": F.count("*"), "passed": F.count_if("passes_gate")})
    chosen = rated.where("passes_gate").orderBy("ord", "album_sid").limit(room)
    row = (swept["seen"], swept["fresh"], judged["novel"], judged["passed"], min(judged["passed"], room))
    return {"rated": rated, "queued": chosen, "counts": discography.sparkSession.createDataFrame([row], "seen long, fresh long, novel long, passed long, queued long")}


def poll_releases(watchlist: DataFrame, found: DataFrame, events: DataFrame, mode: str, tick: int, per_tick: int, today: Column, horizon_days: int) -> DataFrame:
    """Events after the announcements of a tick's artists.  ``mode``: musicbrainz or itunes."""
    if mode not in ("musicbrainz", "itunes"):
        raise ValueError(f"unknown mode {mode!r}")
    swept = rank.rotation(watchlist, ["artist_id"], per_tick, tick)
    rows = joins.with_keys(found.where(F.col("source") == mode), swept, ["artist_id"])
    return calendar.observe(events, calendar.announce(rows, today, horizon_days))


def resolve_source_ids(watch: DataFrame, upcs: DataFrame, answers: DataFrame, held: DataFrame, now: Column) -> DataFrame:
    """Storefront ids by each artist's two newest UPCs, the newer answer first; sentinels where there is no UPC or no answer."""
    hits = rank.ladder(upcs.join(answers, "upc", "left"), ["artist_id"], [F.col("release_date").desc_nulls_last(), F.col("upc").asc()], F.col("source_artist_id").isNotNull())
    some = upcs.select("artist_id").distinct().withColumn("_some", F.lit(True))
    rows = watch.select("artist_id").join(hits.select("artist_id", "source_artist_id"), "artist_id", "left").join(some, "artist_id", "left")
    via = F.when(F.col("source_artist_id").isNotNull(), "upc").when(F.col("_some").isNull(), "no_upc").otherwise("not_found")
    new = rows.select("artist_id", F.lit("itunes").alias("source"), F.coalesce("source_artist_id", F.lit("not_found")).alias("source_artist_id"), via.alias("resolved_via"), now.alias("resolved_at"))
    return merge.upsert(held, new, ["artist_id", "source"], dict.fromkeys(("source_artist_id", "resolved_via", "resolved_at"), Rule.OVERWRITE))


def answered(sentinel: Column) -> Column:
    """Whether there is an answer other than "not found"."""
    return sentinel.isNotNull() & (sentinel != "not_found")


def watched(popularity: Column, watch_min: int) -> Column:
    """The flag of rows above the bar; a missing value is below it."""
    return F.coalesce(popularity >= watch_min, F.lit(False))


def stale(sentinel: Column, resolved_at: Column, now: Column, days: int) -> Column:
    """Whether a "not found" answer is old enough to be asked again."""
    return (sentinel == "not_found") & (resolved_at < now - F.make_dt_interval(F.lit(days)))


def backfill_isrc(tracks: DataFrame, returned: DataFrame, asked: DataFrame) -> DataFrame:
    """Codes of asked tracks: the code, ``no_isrc`` if the source has the track without one, ``not_found`` if it lacks the track."""
    got = returned.select(F.col("id").alias("spotify_id"), F.coalesce(F.nullif(F.col("external_ids.isrc"), F.lit("")), F.lit("no_isrc")).alias("isrc"))
    got = rank.best_per_key(got, ["spotify_id"], F.struct(F.col("isrc") == "no_isrc", "isrc"))  # a code, if any row has one
    rows = asked.select("spotify_id").distinct().join(got, "spotify_id", "left").withColumn("isrc", F.coalesce("isrc", F.lit("not_found")))
    return merge.update_keyed(tracks, rows, ["spotify_id"], ["isrc"])


def enrich_artists(artists: DataFrame, details: DataFrame, asked: DataFrame) -> DataFrame:
    """Photos, genres and counts of asked artists; one that the source lacks gets an empty photo, so it isn't asked for ever again."""
    new = merge.update_keyed(artists, flatten.artist_details(details), ["spotify_id"], ["photo_url", "genres", "followers", "popularity"])
    lost = asked.select("spotify_id").distinct().join(details.select(F.col("id").alias("spotify_id")), "spotify_id", "left_anti").withColumn("photo_url", F.lit(""))
    return merge.update_keyed(new, lost, ["spotify_id"], ["photo_url"])


def import_follows(user_id: str, users: DataFrame, followed: DataFrame, artists: DataFrame, held: DataFrame) -> dict[str, DataFrame]:
    """Links of a user to known followed artists, and chunks of ten unknown ids to fetch.  An unknown user gets neither."""
    known_user = not users.where(F.col("id") == user_id).isEmpty()
    rows = followed.where(F.lit(known_user)).select(F.col("id").alias("spotify_id"), F.lit(user_id).alias("user_id")).distinct()
    known = rows.join(artists.select("spotify_id", F.col("id").alias("artist_id")), "spotify_id")
    unknown = rows.join(artists.select("spotify_id"), "spotify_id", "left_anti").select("spotify_id")
    return {"links": merge.insert_ignore(held, known.select("user_id", "artist_id"), ["user_id", "artist_id"]), "fetch": rank.chunks(unknown, "spotify_id", 10)}


def identify_artists(pending: DataFrame, found: DataFrame, taken: DataFrame, least_score: int = 90) -> DataFrame:
    """MusicBrainz ids of artists: artist_id, mbid (or ``not_found``) and aliases.

    ``pending``: artist_id, name, genres, ord; ``found``: artist_id, mbid, score, country, aliases, ord.  Candidates need the score and a plausible country; one whose country
    is missing while the hint says Korea needs a Hangul alias.  An id goes to one artist, as if artists chose one after another in the order of ``ord``
    (``operators.assign``: rounds follow the logarithm of the longest chain of artists that displace each other).
    """
    hint = T.country_hint(F.col("genres"))
    c = found.where(F.col("score") >= least_score).join(pending.select("artist_id", "name", hint.alias("hint"), F.col("ord").alias("artist_ord")), "artist_id")
    korean = F.exists(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: T.has_hangul(a))
    missing = F.coalesce("country", F.lit("")) == ""
    c = c.where(T.country_plausible(F.col("hint"), F.col("country")) & (~F.coalesce(F.col("hint") == "KR", F.lit(False)) | ~missing | korean))
    c = c.join(taken.select("mbid").distinct(), "mbid", "left_anti")
    c = c.select("artist_id", "artist_ord", "mbid", (-F.col("score")).alias("rank"), F.col("ord").alias("at"), T.clean_aliases(F.coalesce("aliases", F.array().cast("array<string>")), F.col("name")).alias("aliases"))
    c = durable(c, "asking")
    place = F.struct("rank", "at", "mbid")
    given, _ = assign.assign(c.select(F.col("artist_id").alias("who"), F.col("artist_ord").alias("ord"), F.col("mbid").alias("what"), place.alias("place")))
    given = given.select(F.col("who").alias("artist_id"), F.col("what").alias("mbid"))
    given = rank.best_per_key(c.join(given, ["artist_id", "mbid"]), ["artist_id"], place)
    rows = pending.select("artist_id").join(given.select("artist_id", "mbid", "aliases"), "artist_id", "left")
    return rows.select("artist_id", F.coalesce("mbid", F.lit("not_found")).alias("mbid"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))


def evaluate_lyrics(tracks: DataFrame, candidates: DataFrame, existing: DataFrame | None = None) -> dict[str, DataFrame]:
    """Outcomes of a batch after promotion, split into rows to write and rejects that break the invariant, with counts.

    ``existing`` (track_id, match_status, basis) turns on the guard against downgrades.
    """
    pairs = durable(resolve.plausible(tracks, candidates), "pairs")  # both steps and all outputs read them
    done = resolve.promote(resolve.decide(tracks, candidates, pairs), pairs).withColumn("matcher", F.when(F.col("promotion").isNotNull(), "match-1+best-1").otherwise("match-1"))
    done = done.withColumn("lyric_plain", resolve.persistable(F.col("match_status"), F.col("lyric_plain"))).withColumn("lyric_synced", T.strip_nul(F.col("lyric_synced")))
    is_ = {s: F.col("match_status") == s for s in resolve.STATUSES}
    metrics = {f"n_{s}": F.count_if(c) for s, c in is_.items()} | {f"promoted_{s}": F.count_if(c & (F.col("promotion") == "promoted")) for s, c in is_.items()}
    done, n = observed(done.withColumn("evidence", resolve.evidence(done)), "outcomes", metrics)
    ok = resolve.consistent(F.col("match_status"), F.col("basis"), F.col("version_agrees"), F.col("promotion"))
    good, writable = done.where(ok), done.where(ok)
    if existing is not None:
        old = existing.select("track_id", F.col("match_status").alias("_status"), F.col("basis").alias("_basis"))
        allowed = F.col("_status").isNull() | resolve.should_replace(F.col("_status"), F.col("_basis"), F.col("match_status"), F.col("basis"))
        writable = good.join(old, "track_id", "left").where(allowed).drop("_status", "_basis")
    counts = done.sparkSession.createDataFrame([(s, n[f"n_{s}"], n[f"promoted_{s}"]) for s in is_ if n[f"n_{s}"]], "match_status string, n long, promoted long")
    return {"write": writable, "rejects": done.where(~ok), "counts": counts}


def search_key(rows: DataFrame) -> DataFrame:
    """``rows`` with the artist to search by: the first of the sorted names (null without one)."""
    return rows.withColumn("search_artist", F.try_element_at("artist_names", F.lit(1)))


def with_names(tracks: DataFrame, track_artists: DataFrame, artists: DataFrame) -> DataFrame:
    """Tracks that have artists, with sorted distinct artist names and aliases."""
    links = track_artists.join(tracks.select("track_id").distinct(), "track_id", "left_semi")
    names = links.join(artists.select("artist_id", "name", F.explode_outer("aliases").alias("alias")), "artist_id")
    sets = names.groupBy("track_id").agg(F.array_sort(F.collect_set("name")).alias("artist_names"), F.array_sort(F.collect_set("alias")).alias("aliases"))
    return tracks.join(sets, "track_id")


def uncorpused(tracks: DataFrame, track_artists: DataFrame, artists: DataFrame, lyrics: DataFrame, limit: int | None = None) -> DataFrame:
    """Tracks without a lyrics row, with sorted distinct artist names and aliases; with a ``limit`` the newest by created_at, of equals those with smaller ids.  Names are only
    gathered for what is left."""
    open_ = tracks.join(lyrics.select("track_id").distinct(), "track_id", "left_anti")
    if limit is not None:
        known = joins.with_keys(track_artists, artists, ["artist_id"])
        open_ = joins.with_keys(open_, known, ["track_id"]).orderBy(F.col("created_at").desc_nulls_last(), "track_id").limit(limit)
    return with_names(open_, track_artists, artists)


def collect_lyrics(tracks: DataFrame, track_artists: DataFrame, artists: DataFrame, lyrics: DataFrame, candidates: DataFrame, limit: int, lyrics_now: DataFrame | None = None) -> dict[str, DataFrame]:
    """A first outcome for the newest tracks without one: selection, resolution and what to write.  ``lyrics_now``: the table as it is when writing; a track that has got a row meanwhile is left as it is (``kept``)."""
    chosen = durable(uncorpused(tracks, track_artists, artists, lyrics, limit), "chosen")
    out = evaluate_lyrics(chosen, candidates)
    held = (lyrics if lyrics_now is None else lyrics_now).select("track_id").distinct()
    return out | {"write": out["write"].join(held, "track_id", "left_anti"), "kept": out["write"].join(held, "track_id", "left_semi"), "selected": chosen}


def reassess_lyrics(tracks: DataFrame, track_artists: DataFrame, artists: DataFrame, lyrics: DataFrame, candidates: DataFrame, limit: int) -> dict[str, DataFrame]:
    """Another try for tracks whose outcome may get better (``unresolved``), with the guard against downgrades."""
    pool = unresolved(with_names(lyrics.join(tracks, "track_id"), track_artists, artists), limit)
    chosen = durable(pool, "chosen")
    existing = chosen.select("track_id", "match_status", "basis")
    return evaluate_lyrics(chosen.drop("match_status", "basis"), candidates, existing) | {"selected": chosen}


def fill_aliases(artists: DataFrame, found: DataFrame, limit: int = 10, least_score: int = 90) -> dict[str, DataFrame]:
    """MusicBrainz ids and aliases for the first ``limit`` artists that were never looked up, by id: the new table of artists, and counts.  An id that another artist has, before or in this batch, isn't
    given twice; an artist without one gets ``not_found``, so it leaves the pool."""
    pool = durable(untried(artists, "musicbrainz_id", ["spotify_id"], limit), "pool")
    taken = artists.where(answered(F.col("musicbrainz_id"))).select(F.col("musicbrainz_id").alias("mbid"))
    pending = pool.select(F.col("spotify_id").alias("artist_id"), "name", F.coalesce("genres", F.array().cast("array<string>")).alias("genres"), F.col("spotify_id").alias("ord"))
    given, n = observed(identify_artists(pending, found, taken, least_score), "aliases", {"looked_up": F.count("*"), "given": F.count_if(F.col("mbid") != "not_found")})
    new = merge.update_keyed(artists, given.select(F.col("artist_id").alias("spotify_id"), F.col("mbid").alias("musicbrainz_id"), "aliases"), ["spotify_id"], ["musicbrainz_id", "aliases"])
    counts = artists.sparkSession.createDataFrame([(n["looked_up"], n["given"], n["looked_up"] - n["given"])], "looked_up long, given long, not_found long")
    return {"artists": new, "counts": counts}


def unresolved(lyrics: DataFrame, limit: int) -> DataFrame:
    """Rows worth another try: unresolved ones and promoted matches; never found last, stalest first."""
    again = F.col("match_status").isin(*resolve.UNRESOLVED) | ((F.col("match_status") == "matched") & F.coalesce(F.col("basis").startswith("best-of-"), F.lit(False)))
    tier = F.when(F.col("match_status").isin("ambiguous", "review_required"), 0).when(F.col("match_status") == "matched", 1).otherwise(2)
    return lyrics.where(again).orderBy(tier, F.col("updated_at").asc_nulls_first(), "track_id").limit(limit)
