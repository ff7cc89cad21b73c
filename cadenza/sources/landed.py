"""Readers of landed payloads.

Remote calls are out of scope: whatever fetches pages lands them as JSON lines (``land``), and these readers take it from there
with explicit schemas.  A page that is missing or malformed yields no rows, never a guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_NAMED = "array<struct<id: string, name: string>>"
_IMAGES = "array<struct<url: string>>"
_TRACK = f"struct<id: string, name: string, duration_ms: bigint, artists: {_NAMED}, album: struct<id: string, name: string, images: {_IMAGES}>>"
SCHEMAS = {
    "albums": (
        f"id string, name string, release_date string, album_type string, total_tracks int, label string, popularity int, artists {_NAMED}, images {_IMAGES}, external_urls struct<spotify: string>, "
        f"external_ids struct<upc: string>, tracks struct<items: array<struct<id: string, name: string, track_number: int, duration_ms: bigint, artists: {_NAMED}>>>"
    ),
    "artists": f"id string, name string, images {_IMAGES}, genres array<string>, followers struct<total: bigint>, popularity int",
    "tracks": "id string, external_ids struct<isrc: string>",
    "plays": f"played_at string, track {_TRACK}",
    "player": f"user_id string, is_playing boolean, progress_ms bigint, item {_TRACK}",
    "saved_tracks": f"added_at string, track {_TRACK}",
    "saved_albums": "added_at string, album struct<id: string, name: string>",
    "follows": "id string, name string",
    "release_groups": "artist_id string, id string, title string, `primary-type` string, `first-release-date` string",
    "collections": "artist_id string, wrapperType string, collectionId bigint, collectionName string, releaseDate string",
    "lyric_search": "track_id string, id bigint, trackName string, artistName string, albumName string, duration double, instrumental boolean, plainLyrics string, syncedLyrics string",
    "artist_search": "query_id string, `artist-list` array<struct<id: string, name: string, country: string, `ext:score`: string, `alias-list`: array<struct<alias: string>>>>",
}
_SCROBBLE = "struct<name: string, mbid: string, artist: struct<`#text`: string, name: string, mbid: string>, album: struct<`#text`: string, mbid: string>, image: array<struct<`#text`: string, size: string>>, date: struct<uts: string>, `@attr`: struct<nowplaying: string>>"
DUMP_COLUMNS = {
    "tracks": {"id", "name", "artist_name", "album_name", "duration", "last_lyrics_id"},
    "lyrics": {"id", "plain_lyrics", "synced_lyrics", "instrumental"},
}


def land(rows: DataFrame, path: str) -> None:
    """Lands payloads as JSON lines: ``rows`` as objects, or as they are if their only column is the line ``value``.  Files are compressed, as names of fields repeat in every line."""
    lines = rows.columns == ["value"]
    rows.write.option("compression", "gzip").format("text" if lines else "json").save(path)


def read(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Landed JSON lines of a kind."""
    return spark.read.schema(SCHEMAS[kind]).json(path)


def missing(asked: DataFrame, got: DataFrame, key: str = "id") -> DataFrame:
    """Ids that a source was asked for and did not return."""
    return asked.select(key).distinct().join(got.select(key), key, "left_anti")


def membership(asked: DataFrame, library: DataFrame, key: str = "id") -> DataFrame:
    """Each asked id with whether the library holds it."""
    return asked.select(key).join(library.select(key).distinct().withColumn("held", F.lit(True)), key, "left").withColumn("held", F.coalesce("held", F.lit(False)))


def scrobbles(pages: DataFrame, column: str = "page") -> tuple[DataFrame, DataFrame]:
    """(completed, now playing) of scrobble pages with user_id and the page as JSON text.

    One track may come as an object instead of a list.  Completed rows without a whole number of seconds are dropped.
    """
    from cadenza.functions.text import best_image

    many = F.from_json(column, f"struct<recenttracks: struct<track: array<{_SCROBBLE}>>>")["recenttracks"]["track"]
    one = F.from_json(column, f"struct<recenttracks: struct<track: {_SCROBBLE}>>")["recenttracks"]["track"]
    is_list = F.trim(F.get_json_object(column, "$.recenttracks.track")).startswith("[")
    rows = pages.select("user_id", F.posexplode(F.coalesce(F.when(is_list, many), F.when(one["name"].isNotNull(), F.array(one)), F.array().cast(f"array<{_SCROBBLE}>"))).alias("ord", "t"))
    flat = rows.select(
        "user_id", "ord", F.coalesce("t.artist.#text", "t.artist.name").alias("artist_name"), F.col("t.name").alias("track_name"), F.nullif(F.col("t.album.#text"), F.lit("")).alias("album_name"),
        F.nullif(F.col("t.artist.mbid"), F.lit("")).alias("artist_mbid"), F.nullif(F.col("t.mbid"), F.lit("")).alias("track_mbid"), F.nullif(F.col("t.album.mbid"), F.lit("")).alias("album_mbid"),
        best_image(F.col("t.image"), "#text").alias("image_url"), F.timestamp_seconds(F.col("t.date.uts").try_cast("bigint")).alias("played_at"), (F.col("t.@attr.nowplaying") == "true").alias("is_now_playing"),
    ).withColumn("is_now_playing", F.coalesce("is_now_playing", F.lit(False)))
    return flat.where(~F.col("is_now_playing") & F.col("played_at").isNotNull()), flat.where("is_now_playing")


def fetch_status(code: Column, body: Column) -> Column:
    """What an answer means: ``found``, ``none`` (404, or a body that isn't a list), or ``failed`` for anything that is worth another try."""
    return F.when(code == 404, "none").when(F.coalesce(code.between(200, 299), F.lit(False)), F.when(F.coalesce(F.trim(body).startswith("["), F.lit(False)), "found").otherwise("none")).otherwise("failed")


def newest_releases(pages: DataFrame, limit: int = 50) -> DataFrame:
    """The first page of each artist's discography: artist_id, album_sid, release_date (text), newest first, ``ord`` from 0."""
    order = [F.rpad(F.coalesce("release_date", F.lit("")), 10, "-").desc(), F.col("album_sid").asc()]
    ranked = pages.withColumn("ord", F.row_number().over(Window.partitionBy("artist_id").orderBy(*order)) - 1)
    return ranked.where(F.col("ord") < limit).select("artist_id", "album_sid", "release_date", "ord")


def upcoming_groups(rows: DataFrame, low: str, high: str, limit: int = 100) -> DataFrame:
    """Release groups of a search whose date text lies between two dates (a partial date lies before the days it holds), the first ``limit`` of each artist's page: artist_id, source_key, title, kind,
    release_date, ord.  ``rows``: landed release groups with ord, their place in the page."""
    inside = rows.where(F.col("first-release-date").between(low, high) & F.col("id").isNotNull())
    ranked = inside.withColumn("_place", F.row_number().over(Window.partitionBy("artist_id").orderBy("ord", "id"))).where(F.col("_place") <= limit)
    return ranked.select("artist_id", F.col("id").alias("source_key"), "title", F.col("primary-type").alias("kind"), F.col("first-release-date").alias("release_date"), "ord")


def collections(rows: DataFrame) -> DataFrame:
    """Storefront look-ups without the artist's own row."""
    return rows.where(F.col("wrapperType") == "collection").select("artist_id", F.col("collectionId").cast("string").alias("source_key"), F.col("collectionName").alias("title"), F.substring("releaseDate", 1, 10).alias("release_date"))


def artist_candidates(pages: DataFrame, most: int = 10) -> DataFrame:
    """Search results, the first ``most`` of each query: artist_id, mbid, score, country, aliases, ord."""
    rows = pages.select(F.col("query_id").alias("artist_id"), F.posexplode("artist-list").alias("ord", "a")).where(F.col("ord") < most)
    return rows.select("artist_id", F.col("a.id").alias("mbid"), F.col("a.ext:score").try_cast("int").alias("score"), F.col("a.country").alias("country"), F.transform(F.col("a.alias-list"), lambda x: x["alias"]).alias("aliases"), "ord")


def lyric_candidates(pages: DataFrame) -> DataFrame:
    """API results in the shape that resolution takes."""
    return pages.select("track_id", "id", F.col("trackName").alias("title"), F.col("artistName").alias("artist"), F.col("albumName").alias("album"), F.col("duration").alias("duration_sec"), F.coalesce("instrumental", F.lit(False)).alias("instrumental"), F.col("plainLyrics").alias("plain_lyrics"), F.col("syncedLyrics").alias("synced_lyrics"), F.col("id").alias("ord"))


def read_dump(spark: SparkSession, tracks: str, lyrics: str) -> tuple[DataFrame, DataFrame]:
    """A landed lyric dump; ValueError if a column that is read is gone."""
    held = {"tracks": spark.read.parquet(tracks), "lyrics": spark.read.parquet(lyrics)}
    for name, df in held.items():
        if lost := DUMP_COLUMNS[name] - set(df.columns):
            raise ValueError(f"the dump's {name} lack {sorted(lost)}")
    return held["tracks"], held["lyrics"]
