"""Golden cases of resolution, promotion and the guard."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import resolve
from cadenza.plans import jobs

TRACK = "track_id int, title string, artist_names array<string>, aliases array<string>, duration_sec double"
CAND = "id int, title string, artist string, album string, duration_sec double, instrumental boolean, plain_lyrics string, synced_lyrics string, ord int"


def cand(i, title="Song", artist="IU", sec=200.0, plain="la", synced=None, instrumental=False, order=None):
    return (i, title, artist, None, sec, instrumental, plain, synced, i if order is None else order)


def decide(spark, track, cands):
    tracks = spark.createDataFrame([track], TRACK)
    c = spark.createDataFrame(cands, CAND)
    pairs = resolve.plausible(tracks, c)
    first = resolve.decide(tracks, c, pairs)
    return first.first(), resolve.promote(first, pairs).first()


def track(title="Song", artists=("IU",), aliases=(), sec=200.0):
    return (1, title, list(artists), list(aliases), sec)


CASES = [
    ("exact", track(), [cand(1)], "matched", None, 1),
    ("duration edge", track(), [cand(1, sec=202.0)], "matched", None, 1),
    ("beyond the edge", track(), [cand(1, sec=202.1)], "not_found", "no_plausible_candidate", None),
    ("no duration", track(sec=None), [cand(1)], "not_found", "no_plausible_candidate", None),
    ("no artists", track(artists=()), [cand(1)], "not_found", "no_artist_data", None),
    ("alias", track(aliases=("아이유",)), [cand(1, artist="아이유")], "matched", None, 1),
    ("articles only", track(artists=("The Beatles",)), [cand(1, artist="Beatles")], "matched", None, 1),
    ("longer artist", track(artists=("Drake",)), [cand(1, artist="Drake Miller Band")], "not_found", "no_plausible_candidate", None),
    ("instrumental", track(), [cand(1, instrumental=True)], "no_lyrics", "instrumental_or_empty", 1),
    ("empty body", track(), [cand(1, plain="")], "no_lyrics", "instrumental_or_empty", 1),
    ("version", track(), [cand(1, title="Song (Live)")], "review_required", "version_token_mismatch", 1),
    ("noise", track(), [cand(1, title="01 - Song (feat. X)")], "matched", None, 1),
    ("fuzzy", track(title="Wonderful day"), [cand(1, title="Wonderful days")], "review_required", "title_fuzzy_only", 1),
    ("two songs", track(title="Wonderful day"), [cand(1, title="Wonderful days"), cand(2, title="Wonderful day")], "ambiguous", "multiple_plausible", None),
    ("version that agrees first", track(), [cand(1, title="Song (Live)", synced="x"), cand(2)], "matched", None, 2),
    ("richest", track(), [cand(1), cand(2, synced="x")], "matched", None, 2),
    ("first of equals", track(), [cand(1, order=5), cand(2, order=4)], "matched", None, 2),
    ("meaningful parenthesis", track(title="Freestyle ('99)"), [cand(1, title="Freestyle ('99)")], "matched", None, 1),
]


@pytest.mark.parametrize(("name", "track", "cands", "status", "reason", "chosen"), CASES, ids=[c[0] for c in CASES])
def test_decision(spark, name, track, cands, status, reason, chosen):
    out, _ = decide(spark, track, cands)
    assert (out.match_status, out.reason, out.candidate_id) == (status, reason, chosen)
    assert (out.basis == "exact-title") == (status == "matched")
    assert (out.lyric_plain is not None) == (status in ("matched", "no_lyrics"))


def test_promotion(spark):
    _, out = decide(spark, track(title="Wonderful day"), [cand(1, title="Wonderful days"), cand(2, title="Wonderful day"), cand(3, title="Wonderful day", sec=201.0, synced="s")])
    assert (out.match_status, out.basis, out.candidate_id, out.promotion) == ("matched", "best-of-ambiguous", 3, "promoted")
    _, out = decide(spark, track(), [cand(1, title="Song (Live)")])
    assert (out.match_status, out.promotion) == ("review_required", "no_tier1_candidate")
    _, out = decide(spark, track(title="Wonderful day"), [cand(1, title="Wonderful days", instrumental=True), cand(2, title="Wonderful day", instrumental=True)])
    assert (out.match_status, out.basis, out.lyric_plain, out.promotion) == ("no_lyrics", "best-of-ambiguous", "", "all_instrumental")
    _, out = decide(spark, track(), [cand(1)])
    assert (out.match_status, out.promotion) == ("matched", None)


def test_guard(spark):
    cases = [("not_found", None, "not_found", None, True), ("matched", "best-of-review", "matched", "exact-title", True), ("matched", "exact-title", "matched", "exact-title", False), ("matched", "best-of-review", "matched", "best-of-ambiguous", False), ("no_lyrics", None, "review_required", None, False), ("matched", "odd", "matched", "fuzzy-title", True)]
    df = spark.createDataFrame(cases, "a string, b string, c string, d string, want boolean")
    assert df.where(resolve.should_replace(F.col("a"), F.col("b"), F.col("c"), F.col("d")) == F.col("want")).count() == len(cases)


def test_evaluation_respects_what_is_held(spark):
    tracks = spark.createDataFrame([track(), (2, "Other", ["IU"], [], 100.0)], TRACK)
    cands = spark.createDataFrame([cand(1), cand(2, title="Other", sec=100.0)], CAND)
    existing = spark.createDataFrame([(1, "matched", "isrc"), (2, "ambiguous", None)], "track_id int, match_status string, basis string")
    out = jobs.evaluate_lyrics(tracks, cands, existing)
    assert [r.track_id for r in out["write"].collect()] == [2]
    assert out["rejects"].count() == 0 and '"candidate_id":2' in out["write"].first().evidence
    assert {r.match_status: r.n for r in out["counts"].collect()} == {"matched": 2}


def test_dump_retrieval(spark):
    tracks = spark.createDataFrame([track()], TRACK)
    dump = spark.createDataFrame([(i, "Song", "IU", None, 200.0 + i, 7) for i in range(1, 6)] + [(9, "Song", "Other", None, 200.0, 7)], "id int, name string, artist_name string, album_name string, duration double, last_lyrics_id int")
    lyrics = spark.createDataFrame([(7, "la", None, False)], "id int, plain_lyrics string, synced_lyrics string, instrumental boolean")
    got = resolve.retrieve(tracks, dump, lyrics, most=3)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]
