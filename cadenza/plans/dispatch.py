"""Records of a queue: routed by job, with dead letters and follow-up records as rows.  Running a handler is the caller's part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Jobs that records may name; records without one carry album ids.
JOBS = ("album_sync", "follow_import", "follow_ingest", "lyrics", "saved_tracks", "listening", "library", "scrobbles", "member", "releases", "ingest", "isrc_backfill", "artist_photos", "aliases")
_BODY = "job string, album_ids array<string>, track_ids array<string>, user_id string, artist_ids array<string>, rerun boolean"


def route(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with job and fields, failures) of message_id and body; a body that isn't JSON, or names no known job and no albums, fails by its id."""
    parsed = records.select("message_id", F.from_json("body", _BODY).alias("b"))
    job = F.coalesce("b.job", F.when(F.size(F.coalesce("b.album_ids", F.array().cast("array<string>"))) > 0, "album_sync"))
    rows = parsed.select("message_id", job.alias("job"), "b.album_ids", "b.track_ids", "b.user_id", "b.artist_ids", F.coalesce("b.rerun", F.lit(False)).alias("rerun"))
    known = F.coalesce(F.col("job").isin(*JOBS), F.lit(False))
    return rows.where(known), rows.where(~known).select("message_id")


def follow_ups(done: DataFrame, now: Column, delay_seconds: int = 900) -> DataFrame:
    """Records to send after handled ones: lyrics for synced albums at once; an import that isn't a rerun comes again once, later."""
    lyrics = done.where(F.col("job") == "album_sync").select(F.lit("lyrics").alias("job"), F.lit(None).cast("string").alias("user_id"), F.lit(False).alias("rerun"), now.alias("not_before")).distinct()
    again = done.where((F.col("job") == "follow_import") & ~F.col("rerun")).select(F.lit("follow_import").alias("job"), "user_id", F.lit(True).alias("rerun"), (now + F.make_dt_interval(secs=F.lit(delay_seconds))).alias("not_before"))
    return lyrics.union(again.distinct())
