"""Conservative entity resolution of tracks with candidates, a promotion step, and a guard against downgrades.

Tracks: track_id, title, artist_names (array), aliases (array), duration_sec.  Candidates: id, title, artist, album, duration_sec, instrumental,
plain_lyrics, synced_lyrics, and ord (their order at the source, for ties).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.nearest import by_gap, nearest
from cadenza.operators.rank import best_per_key, top_per_key
from cadenza.operators.similar import bound, characters
from cadenza.session import durable

#: Strength of the basis of a match; an unknown basis has none.
BASIS = {"fuzzy-title": 1, "best-of-ambiguous": 2, "best-of-review": 2, "exact-title": 3, "mb-recording": 4, "isrc": 5}
UNRESOLVED = ("not_found", "ambiguous", "review_required")
STATUSES = ("matched", "no_lyrics", *UNRESOLVED)


def _forms(df: DataFrame, title: str, prefix: str) -> DataFrame:
    """Normal form, rendition words and both base titles, made once per distinct title."""
    titles = df.select(F.coalesce(F.col(title), F.lit("")).alias("_raw")).distinct()
    titles = titles.withColumn("_normal", T.normalize_title("_raw")).withColumn("_clean", T.clean_title("_raw"))
    made = titles.select("_raw", F.col("_normal").alias(f"{prefix}normal"), T.version_tokens(F.col("_normal")).alias(f"{prefix}tokens"), T.base_title(F.col("_normal")).alias(f"{prefix}plain"), T.base_title(F.col("_clean")).alias(f"{prefix}base"))
    return df.join(made, F.coalesce(F.col(title), F.lit("")) == F.col("_raw"), "left").drop("_raw")


def plausible(tracks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs that agree in artist, title (exact or fuzzy) and duration.

    Blocked on the artist key and a two-second bin of the duration with its neighbours, which loses nothing: other pairs can't pass the artist and duration
    rules.  The fuzzy ratio is computed only for blocked pairs that aren't exact and have enough characters in common.
    """
    t = _forms(tracks, "title", "t_").select("track_id", F.col("duration_sec").cast("double").alias("t_sec"), "artist_names", "aliases", "t_tokens", "t_plain", "t_base")
    names = F.filter(F.concat(F.coalesce("artist_names", F.array().cast("array<string>")), F.coalesce("aliases", F.array().cast("array<string>"))), lambda n: n.isNotNull() & (n != ""))
    t = t.where(F.size(F.coalesce("artist_names", F.array())) > 0).withColumn("_name", F.explode(F.array_distinct(names)))
    t = t.withColumn("_normal", T.normalize_title("_name")).where(F.col("_normal") != "").withColumn("_artist", T.artist_key(F.col("_normal"))).drop("_name", "_normal", "artist_names", "aliases").distinct()
    t = t.withColumn("_bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.col("t_sec") / 2) + i)))
    c = _forms(candidates, "title", "c_").where(F.col("c_normal") != "").withColumn("_who", T.normalize_title("artist")).where(F.col("_who") != "")
    c = c.withColumn("_artist", T.artist_key(F.col("_who"))).withColumn("_bin", F.floor(F.col("duration_sec").cast("double") / 2)).drop("_who")
    pairs = t.join(c, ["_artist", "_bin"]).where(T.duration_matches(F.col("t_sec"), F.col("duration_sec"))).drop("_artist", "_bin").dropDuplicates(["track_id", "id", "ord"])
    exact = (F.col("t_base") != "") & ((F.col("c_base") == F.col("t_base")) | ((F.col("t_plain") != "") & (F.col("c_plain") == F.col("t_plain"))))
    same = pairs.where(exact).withColumns({"kind": F.lit("exact"), "similarity": F.lit(1.0), "base": F.col("t_base")})
    near = pairs.where(~exact & (F.col("t_plain") != "") & (F.col("c_plain") != "")).where(bound(characters(F.col("t_plain")), characters(F.col("c_plain"))) >= T.FUZZY).withColumn("similarity", T.similarity("t_plain", "c_plain")).where(F.col("similarity") >= T.FUZZY)
    return same.unionByName(near.withColumns({"kind": F.lit("fuzzy"), "base": F.col("c_base")}).select(*same.columns))


def _full(value: str) -> Column:
    return F.coalesce(F.col(value) != "", F.lit(False))


def decide(tracks: DataFrame, candidates: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One outcome per track: match_status, reason, basis, candidate_id, the lyrics, both sides' rendition words, version_agrees, n_groups, similarity."""
    pairs = plausible(tracks, candidates) if pairs is None else pairs
    agrees = F.size(T.symmetric_difference(F.col("t_tokens"), F.col("c_tokens"))) == 0
    rank = F.struct(agrees.alias("a"), (F.col("kind") == "exact").alias("e"), (F.col("c_plain") == F.col("t_plain")).alias("f"), _full("synced_lyrics").alias("s"), _full("plain_lyrics").alias("p"), (-F.col("ord")).alias("o"))
    reps = best_per_key(pairs.withColumn("agrees", agrees), ["track_id", "base"], rank, descending=True)
    groups = reps.groupBy("track_id").agg(F.count("*").alias("n_groups"), F.min_by(F.struct("id", "kind", "similarity", "c_tokens", "agrees", "instrumental", "plain_lyrics", "synced_lyrics"), F.col("ord")).alias("r"))
    own = _forms(tracks, "title", "t_").select("track_id", "t_tokens", F.size(F.coalesce("artist_names", F.array())).alias("_artists"))
    rows = own.join(groups, "track_id", "left")
    single = F.col("n_groups") == 1
    empty = F.coalesce(F.col("r.instrumental"), F.lit(False)) | ~(_full("r.plain_lyrics") | _full("r.synced_lyrics"))
    status = (
        F.when((F.col("_artists") == 0) | F.col("n_groups").isNull(), "not_found").when(~single, "ambiguous").when(empty, "no_lyrics")
        .when(~F.col("r.agrees") | (F.col("r.kind") == "fuzzy"), "review_required").otherwise("matched")
    )
    reason = (
        F.when(F.col("_artists") == 0, "no_artist_data").when(F.col("n_groups").isNull(), "no_plausible_candidate").when(~single, "multiple_plausible").when(empty, "instrumental_or_empty")
        .when(~F.col("r.agrees"), "version_token_mismatch").when(F.col("r.kind") == "fuzzy", "title_fuzzy_only")
    )
    rows = rows.withColumns({"match_status": status, "reason": reason})
    matched = F.col("match_status") == "matched"
    shown = single & F.col("match_status").isin("matched", "no_lyrics", "review_required")
    return rows.select(
        "track_id", "match_status", "reason", F.when(matched, "exact-title").alias("basis"), F.when(shown, F.col("r.id")).alias("candidate_id"),
        F.when(matched, F.col("r.plain_lyrics")).when(F.col("match_status") == "no_lyrics", "").alias("lyric_plain"), F.when(matched, F.col("r.synced_lyrics")).alias("lyric_synced"),
        F.col("t_tokens").alias("track_tokens"), F.when(shown, F.col("r.c_tokens")).alias("candidate_tokens"), F.when(shown, F.col("r.agrees")).alias("version_agrees"),
        F.coalesce("n_groups", F.lit(0)).alias("n_groups"), F.when(F.col("reason") == "title_fuzzy_only", F.round("r.similarity", 3)).alias("similarity"),
    )


def promote(outcomes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Best-of promotion of ambiguous and review outcomes; others pass unchanged.

    Among plausible candidates with a body, exact titles with the same rendition words; of those the richest lyrics, then the least gap in duration, then the
    id as text.  If all plausible candidates are instrumental the track has no lyrics.  ``promotion`` tells what happened.
    """
    body = ~F.coalesce(F.col("instrumental"), F.lit(False)) & (_full("plain_lyrics") | _full("synced_lyrics"))
    first = body & (F.col("kind") == "exact") & (F.size(T.symmetric_difference(F.col("t_tokens"), F.col("c_tokens"))) == 0)
    gap = F.coalesce(F.abs(F.col("t_sec") - F.col("duration_sec")), F.lit(float("inf")))
    rank = F.struct((~_full("synced_lyrics")).alias("a"), (~_full("plain_lyrics")).alias("b"), gap.alias("c"), F.col("id").cast("string").alias("d"))
    found = pairs.groupBy("track_id").agg(
        F.count("*").alias("_n"), F.count_if(body).alias("_bodies"), F.bool_and(F.coalesce("instrumental", F.lit(False))).alias("_silent"),
        F.min_by(F.when(first, F.struct("id", "plain_lyrics", "synced_lyrics", "c_tokens")), F.when(first, rank)).alias("_best"),
    )
    rows = outcomes.join(found, "track_id", "left")
    tried = F.col("match_status").isin("ambiguous", "review_required")
    did = (
        F.when(~tried, F.lit(None).cast("string")).when(F.col("_n").isNull(), "no_plausible_candidate").when((F.col("_bodies") == 0) & F.col("_silent"), "all_instrumental")
        .when(F.col("_bodies") == 0, "no_body_candidate").when(F.col("_best.id").isNull(), "no_tier1_candidate").otherwise("promoted")
    )
    rows = rows.withColumn("promotion", did)
    won, silent = F.coalesce(F.col("promotion") == "promoted", F.lit(False)), F.coalesce(F.col("promotion") == "all_instrumental", F.lit(False))
    best_of = F.when(F.col("match_status") == "ambiguous", "best-of-ambiguous").otherwise("best-of-review")
    new = {
        "basis": F.when(won | silent, best_of).otherwise(F.col("basis")),
        "candidate_id": F.when(won, F.col("_best.id")).otherwise(F.col("candidate_id")),
        "lyric_plain": F.when(won, F.col("_best.plain_lyrics")).when(silent, "").otherwise(F.col("lyric_plain")),
        "lyric_synced": F.when(won, F.col("_best.synced_lyrics")).when(silent, F.lit(None)).otherwise(F.col("lyric_synced")),
        "candidate_tokens": F.when(won, F.col("_best.c_tokens")).otherwise(F.col("candidate_tokens")),
        "version_agrees": F.when(won, True).otherwise(F.col("version_agrees")),
        "match_status": F.when(won, "matched").when(silent, "no_lyrics").otherwise(F.col("match_status")),
    }
    return rows.select(*(new.get(c, F.col(c)).alias(c) for c in outcomes.columns), "promotion")


def strength(basis: Column) -> Column:
    known = F.create_map(*(x for k, v in BASIS.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.try_element_at(known, F.coalesce(basis, F.lit(""))), F.lit(0))


def should_replace(old_status: Column, old_basis: Column, new_status: Column, new_basis: Column) -> Column:
    """Unresolved rows always; a resolved one only by a match on a strictly stronger basis."""
    return old_status.isin(*UNRESOLVED) | ((new_status == "matched") & (strength(new_basis) > strength(old_basis)))


def consistent(status: Column, basis: Column, version_agrees: Column, promotion: Column) -> Column:
    """A match must agree in rendition words, one by promotion must say so."""
    ok = F.when(F.coalesce(basis, F.lit("")).startswith("best-of-"), promotion.isNotNull()).otherwise(F.coalesce(version_agrees, F.lit(True)))
    return (status != "matched") | ok


def persistable(status: Column, lyric: Column) -> Column:
    """The stored text: never null for a resolved outcome, always null for an unresolved one, no NUL characters."""
    return F.when(status.isin("matched", "no_lyrics"), T.strip_nul(F.coalesce(lyric, F.lit(""))))


def evidence(outcomes: DataFrame) -> Column:
    """What led to an outcome, as JSON without nulls and NUL characters."""
    fields = ("reason", "candidate_id", "basis", "similarity", "version_agrees", "promotion")
    fields = [c for c in fields if c in outcomes.columns]
    return T.strip_nul(F.to_json(F.struct(*fields, F.when(F.col("n_groups") > 1, F.col("n_groups")).alias("count"), F.col("track_tokens"), F.col("candidate_tokens"))))


def _keyed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the artist key of a name, made once per distinct name."""
    made = rows.select(F.col(name).alias("_of")).distinct().withColumn("key", T.artist_key(T.normalize_title("_of")))
    return rows.join(made, F.col(name).eqNullSafe(F.col("_of"))).drop("_of")


def retrieve(tracks: DataFrame, dump: DataFrame, lyrics: DataFrame, most: int = 200) -> DataFrame:
    """Candidates of each track from a landed dump, nearest in duration first, at most ``most`` (the source's own limit; null durations come first).

    Blocked on the artist key instead of substring search, which would compare all pairs.  The nearest of an artist's recordings come from ``nearest``, so a distinct duration
    forms few pairs, however many recordings the artist has.  Keys are made once per distinct name.  Of rows of the dump that share artist and id, the one with the least duration (null first) counts.
    """
    t = tracks.select("track_id", F.col("duration_sec").cast("double").alias("of"), F.explode(F.array_distinct(F.concat(F.coalesce("artist_names", F.array().cast("array<string>")), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("_name"))
    t = durable(_keyed(t, "_name").select("track_id", "of", "key").distinct(), "names")  # read twice
    kept = _keyed(dump.select("id", "name", "artist_name", "album_name", "duration", "last_lyrics_id"), "artist_name")
    d = durable(best_per_key(kept, ["key", "id"], F.struct(F.col("duration").isNotNull(), "duration", "name", "artist_name", "album_name", "last_lyrics_id")), "dump")
    near = nearest(t.select("key", "of"), d.select("key", F.col("duration").alias("value"), F.col("id").alias("tie")), most, once=True)
    near = near.withColumnsRenamed({"key": "_key", "of": "_of"})
    pairs = t.join(near, (F.col("key") == F.col("_key")) & F.col("of").eqNullSafe(F.col("_of"))).select("track_id", "key", "tie", "gap")
    one = best_per_key(pairs, ["track_id", "tie"], F.struct(F.col("gap").isNotNull(), "gap", "key"))  # by the nearest of a track's names
    chosen = top_per_key(one, ["track_id"], by_gap(), most).join(d.withColumnRenamed("id", "tie"), ["key", "tie"])
    body = lyrics.select(F.col("id").alias("last_lyrics_id"), "plain_lyrics", "synced_lyrics", "instrumental")
    near = chosen.join(body, "last_lyrics_id", "left").withColumn("id", F.col("tie"))
    return near.select("track_id", "id", F.col("name").alias("title"), F.col("artist_name").alias("artist"), F.col("album_name").alias("album"), F.col("duration").alias("duration_sec"), F.coalesce("instrumental", F.lit(False)).alias("instrumental"), "plain_lyrics", "synced_lyrics", F.col("id").alias("ord"))
