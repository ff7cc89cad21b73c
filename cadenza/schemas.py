"""The tables of the catalogue, with their keys.  Sentinels are data: null is "never tried", ``not_found`` and ``no_isrc`` are "tried, nothing there"."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (columns, key)
TABLES: dict[str, tuple[str, list[str]]] = {
    "artists": ("id string, spotify_id string, name string, photo_url string, genres array<string>, followers long, popularity int, musicbrainz_id string, aliases array<string>", ["spotify_id"]),
    "albums": ("id string, spotify_id string, title string, release_date string, cover_url string, album_type string, total_tracks int, label string, popularity int, ext_refs map<string,string>", ["spotify_id"]),
    "tracks": ("id string, spotify_id string, album_sid string, title string, track_no int, duration_sec int, isrc string, created_at timestamp", ["spotify_id"]),
    "album_artists": ("album_sid string, artist_sid string", ["album_sid", "artist_sid"]),
    "track_artists": ("track_sid string, artist_sid string", ["track_sid", "artist_sid"]),
    "album_genres": ("album_sid string, slug string", ["album_sid", "slug"]),
    "track_lyrics": ("track_id string, match_status string, basis string, evidence string, lyric_plain string, lyric_synced string, matcher string, updated_at timestamp", ["track_id"]),
    "recent_albums": ("album_sid string, last_played_at timestamp", ["album_sid"]),
    "recent_tracks": ("spotify_track_id string, track_name string, artist_name string, album_name string, album_sid string, played_at timestamp", ["spotify_track_id", "played_at"]),
    "play_events": ("album_sid string, played_at timestamp", ["album_sid", "played_at"]),
    "track_play_events": ("spotify_track_id string, album_sid string, played_at timestamp", ["spotify_track_id", "played_at"]),
    "now_playing": ("user_id string, is_playing boolean, spotify_track_id string, track_name string, artist_name string, album_name string, album_sid string, progress_ms long, duration_ms long, updated_at timestamp", ["user_id"]),
    "saved_tracks": ("spotify_track_id string, track_name string, artist_name string, album_name string, album_sid string, track_id string, album_id string, added_at timestamp, duration_ms long", ["spotify_track_id"]),
    "library": ("key string, source string, state string, in_library boolean, last_error string, last_synced_at timestamp", ["key"]),
    "bucket_items": ("key string, position long, status string", ["key"]),
    "user_artist_tracks": ("user_id string, artist_id string", ["user_id", "artist_id"]),
    "integrations": ("user_id string, provider string, status string, username string, last_synced_at timestamp", ["user_id", "provider"]),
    "scrobbles": ("user_id string, artist_name string, track_name string, album_name string, artist_mbid string, track_mbid string, album_mbid string, image_url string, played_at timestamp, is_now_playing boolean", ["user_id", "played_at"]),
    "member_tracks": ("user_id string, spotify_track_id string, track_name string, artist_name string, album_name string, image_url string, played_at timestamp", ["user_id", "played_at", "spotify_track_id"]),
    "release_events": ("id string, artist_id string, source string, source_key string, title string, release_type string, release_date string, status string, spotify_album_id string", ["source", "source_key"]),
    "source_ids": ("artist_id string, source string, source_artist_id string, resolved_via string, resolved_at timestamp", ["artist_id", "source"]),
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name][0])
