"""Upcoming releases: announcements from sources, and their confirmation by what a catalogue sweep finds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import dates
from cadenza.functions import text as T
from cadenza.operators.joins import band_join
from cadenza.operators.merge import Rule, upsert
from cadenza.operators.rank import best_per_key
from cadenza.session import durable


def announce(found: DataFrame, today: Column, horizon_days: int) -> DataFrame:
    """Events inside the window with full dates, one per (source, source_key), the first by ``ord``.  ``found``: artist_id, source, source_key, title,
    release_type, release_date (text), ord."""
    inside = found.where(dates.in_window(F.col("release_date"), today, horizon_days))
    return best_per_key(inside, ["source", "source_key"], F.col("ord"))


def observe(events: DataFrame, announced: DataFrame) -> DataFrame:
    """Upsert observations; status and the confirmed album are never touched, new rows are announced."""
    rules = {"title": Rule.OVERWRITE, "release_type": Rule.OVERWRITE, "release_date": Rule.OVERWRITE, "artist_id": Rule.KEEP, "status": Rule.KEEP}
    return upsert(events, announced.withColumn("status", F.lit("announced")), ["source", "source_key"], rules)


def in_reach(events: DataFrame, candidates: DataFrame, days: int) -> DataFrame:
    """Events between the candidates' first and last date, ``days`` further on both sides: two dates, which prune the scan of the events."""
    low, high = candidates.agg(F.date_sub(F.min("release_date"), days), F.date_add(F.max("release_date"), days)).first()
    return events.where(F.lit(False)) if low is None else events.where(F.col("release_date").between(F.lit(low), F.lit(high)))


def confirm(candidates: DataFrame, events: DataFrame, days: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(flips, inserts, skipped).

    A candidate confirms events of its artist with the same title key within ``days``.  An event confirmed by several candidates goes to the last by album id,
    once, so a second run changes nothing.  Unconfirmed candidates are inserted if they pass the gate (a missing flag doesn't) and skipped otherwise.
    Candidates: artist_id, spotify_album_id, title, release_type, release_date (date), passes_gate, ord.
    """
    c = durable(best_per_key(candidates, ["artist_id", "spotify_album_id"], F.col("ord")).withColumn("_title", T.confirm_title("title")), "candidates")  # four readers
    e = in_reach(events, c, days).select("id", "artist_id", F.col("release_date").alias("_day"), T.confirm_title("title").alias("_title"))
    hits = durable(band_join(c.select("artist_id", "spotify_album_id", "_title", "release_date"), e, ["artist_id", "_title"], "release_date", "_day", days), "hits")
    flips = hits.groupBy("id").agg(F.max("spotify_album_id").alias("spotify_album_id"))
    rest = c.drop("_title").join(hits.select("artist_id", "spotify_album_id").distinct(), ["artist_id", "spotify_album_id"], "left_anti")
    gate = F.coalesce("passes_gate", F.lit(False))
    return flips, rest.where(gate), rest.where(~gate)


def apply_confirmation(events: DataFrame, flips: DataFrame, inserts: DataFrame) -> DataFrame:
    """Events after confirmation, with ``changed`` for rows that really did change."""
    f = flips.select("id", F.col("spotify_album_id").alias("_album"))
    joined = events.join(f, "id", "left")
    hit = F.col("_album").isNotNull()
    changed = hit & (~F.col("status").eqNullSafe("released") | ~F.col("spotify_album_id").eqNullSafe(F.col("_album")))
    flipped = joined.select(*(F.when(hit, F.lit("released")).otherwise(F.col(c)).alias(c) if c == "status" else F.when(hit, F.col("_album")).otherwise(F.col(c)).alias(c) if c == "spotify_album_id" else F.col(c) for c in events.columns), changed.alias("_flipped"))
    new = inserts.select("artist_id", F.lit("spotify").alias("source"), F.col("spotify_album_id").alias("source_key"), "title", "release_type", "release_date", F.lit("released").alias("status"), "spotify_album_id")
    rules = dict.fromkeys(("title", "release_type", "release_date", "status", "spotify_album_id"), Rule.OVERWRITE) | {"artist_id": Rule.KEEP}
    differs = ~F.col("t_status").eqNullSafe("released") | ~F.col("t_spotify_album_id").eqNullSafe(F.col("s_spotify_album_id"))
    out = upsert(flipped, best_per_key(new, ["source", "source_key"], F.col("artist_id"), descending=True), ["source", "source_key"], rules, when=differs, changed_flag="_merged")
    return out.withColumn("changed", F.coalesce("_flipped", F.lit(False)) | F.col("_merged")).drop("_flipped", "_merged")
