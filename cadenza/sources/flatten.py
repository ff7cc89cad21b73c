"""Nested payloads to relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import normalize_release_date, parse_instant
from cadenza.functions.text import joined_names


def _first_url(images: Column) -> Column:
    return F.try_element_at(images, F.lit(1))["url"]


def ext_refs(album: Column | None = None) -> Column:
    """The references that are there, by name."""
    pairs = F.create_map(F.lit("spotify_url"), F.col("external_urls.spotify"), F.lit("upc"), F.col("external_ids.upc"))
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def albums(payloads: DataFrame) -> dict[str, DataFrame]:
    """artists, albums, album_artists, tracks and track_artists of album payloads; null albums and rows without an id are skipped.

    ``ord`` keeps the order of arrival for last-wins merges: input order is a column of ``payloads`` or, without one, the id and a hash of the whole payload.
    """
    p = payloads.where(F.col("id").isNotNull())
    p = p if "ord" in p.columns else p.withColumn("ord", F.struct("id", F.xxhash64(F.to_json(F.struct(*p.columns)))))
    tracks = p.select(F.col("id").alias("album_sid"), "ord", F.posexplode("tracks.items").alias("at", "t")).where(F.col("t.id").isNotNull())
    by_album = p.select(F.col("id").alias("album_sid"), "ord", F.explode("artists").alias("a")).where(F.col("a.id").isNotNull())
    by_track = tracks.select(F.col("t.id").alias("track_sid"), "ord", F.explode("t.artists").alias("a")).where(F.col("a.id").isNotNull())
    named = by_album.select("a.id", "a.name", "ord").union(by_track.select("a.id", "a.name", "ord"))
    return {
        "artists": named.select(F.col("id").alias("spotify_id"), "name", "ord"),
        "albums": p.select(F.col("id").alias("spotify_id"), F.col("name").alias("title"), normalize_release_date(F.col("release_date")).alias("release_date"), _first_url(F.col("images")).alias("cover_url"), "album_type", "total_tracks", "label", "popularity", ext_refs().alias("ext_refs"), "ord"),
        "album_artists": by_album.select("album_sid", F.col("a.id").alias("artist_sid")).distinct(),
        "tracks": tracks.select(F.col("t.id").alias("spotify_id"), "album_sid", F.col("t.name").alias("title"), F.col("t.track_number").alias("track_no"), F.floor(F.coalesce("t.duration_ms", F.lit(0)) / 1000).cast("int").alias("duration_sec"), "ord"),
        "track_artists": by_track.select("track_sid", F.col("a.id").alias("artist_sid")).distinct(),
    }


def plays(items: DataFrame) -> DataFrame:
    """Play rows; without a track id or with a malformed time they are dropped."""
    names = joined_names(F.transform("track.artists", lambda a: a["name"]))
    rows = items.select(*(c for c in ("user_id", "ord") if c in items.columns), F.col("track.id").alias("spotify_track_id"), F.col("track.name").alias("track_name"), names.alias("artist_name"), F.col("track.album.name").alias("album_name"), F.col("track.album.id").alias("album_sid"), _first_url(F.col("track.album.images")).alias("image_url"), parse_instant(F.col("played_at")).alias("played_at"))
    return rows.where(F.col("spotify_track_id").isNotNull() & F.col("played_at").isNotNull())


def player_state(items: DataFrame) -> DataFrame:
    """One row per user and poll; ``is_idle`` where nothing is loaded."""
    idle = F.col("item.id").isNull()
    names = joined_names(F.transform("item.artists", lambda a: a["name"]))
    return items.select("user_id", idle.alias("is_idle"), (~idle & F.coalesce("is_playing", F.lit(False))).alias("is_playing"), F.col("item.id").alias("spotify_track_id"), F.col("item.name").alias("track_name"), F.when(~idle, names).alias("artist_name"), F.col("item.album.name").alias("album_name"), F.col("item.album.id").alias("album_sid"), "progress_ms", F.col("item.duration_ms").alias("duration_ms"))


def saved_tracks(items: DataFrame) -> DataFrame:
    names = joined_names(F.transform("track.artists", lambda a: a["name"]))
    rows = items.select(F.col("track.id").alias("spotify_track_id"), F.col("track.name").alias("track_name"), names.alias("artist_name"), F.col("track.album.name").alias("album_name"), F.col("track.album.id").alias("album_sid"), parse_instant(F.col("added_at")).alias("added_at"), F.col("track.duration_ms").alias("duration_ms"))
    return rows.where(F.col("spotify_track_id").isNotNull())


def artist_details(items: DataFrame) -> DataFrame:
    """Update rows; no image at all is an empty url, an image without a url is null."""
    photo = F.when(F.size(F.coalesce("images", F.array().cast("array<struct<url: string>>"))) == 0, "").otherwise(_first_url(F.col("images")))
    return items.select(F.col("id").alias("spotify_id"), photo.alias("photo_url"), "genres", F.col("followers.total").alias("followers"), "popularity")
