import pytest
from pyspark.sql import functions as F

from cadenza.functions import dates
from cadenza.functions import text as T


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_release_dates(spark):
    cases = {
        "1999": "1999-01-01", "0000": None, "19a9": None, "1999-05": "1999-05-01", "2024-13": "2024-13-01", "2024/05": None, "0000-05": None, "2024-00": None, "2024-05-06": "2024-05-06",
        "2024-1-1": "2024-1-1", "2024-00-01": None, "199-01-01": None, "": None, None: None, "2024-05-06T00": None,
    }
    assert column(spark, list(cases), dates.normalize_release_date) == list(cases.values())


def test_windows_and_keys(spark):
    today = F.to_date(F.lit("2026-06-01"))
    values = ["2026-06-01", "2026-06-11", "2026-06-12", "2026-05-31", "2026-06", "2026", "2026-06-31", None]
    assert column(spark, values, lambda c: dates.in_window(c, today, 10)) == [True, True, False, False, False, False, False, False]
    assert column(spark, ["2020", "2020-05", "", None], dates.freshness_key) == ["2020-01-01", "2020-05-01", "0000-01-01", "0000-01-01"]


def test_debounce_is_strict(spark):
    now = F.to_timestamp(F.lit("2026-01-01 00:01:00"))
    values = ["2026-01-01 00:00:00", "2026-01-01 00:00:01", None]
    assert column(spark, values, lambda c: dates.debounced(now, F.to_timestamp(c))) == [False, True, False]


def test_normal_form(spark):
    values = ["Beyoncé - Déjà Vu!", "좋은날", "Don't  Stop", "re-recording", "", None, "ÀÉ·ß"]
    assert column(spark, values, T.normalize_title) == ["beyonce deja vu", "좋은날", "don't stop", "re recording", "", "", "ae ß"]


def test_noise(spark):
    values = ["01 - Title", "1999", "7 rings", "Song (feat. X)", "Song (Live)", 'Song - From "Movie"', "Song - Remastered 2011", "(feat. X)", None, "A [Club Mix] (x)"]
    assert column(spark, values, T.strip_noise) == ["Title", "1999", "7 rings", "Song", "Song (Live)", "Song", "Song - Remastered 2011", "(feat. X)", None, "A [Club Mix]"]


def test_version_words(spark):
    both = lambda c: F.concat_ws("|", F.array_join(T.version_tokens(T.normalize_title(c)), ","), T.base_title(T.normalize_title(c)))
    assert column(spark, ["Crazy (Live Remix)", "Crazy", "노래 (라이브)"], both) == ["live,remix|crazy", "|crazy", "라이브|노래"]


def test_titles_hold_what_they_should(spark):
    """Nested and open brackets, several tails, odd white space, marks with accents, and one title that is noise alone."""
    cases = {
        "1 - A (x (Live)) y": "A (x (Live)) y", "A ((Live) x": "A ((Live) x", "A (b": "A (b", "A [b] (c) [Rémix]": "A [Rémix]", "A - b - Live - c": "A - Live", " - b": " - b", "12.\u3000Song": "Song", "7 - ": "7 - ", "A\u00a0–\u2003b": "A",
        "99 Luftballons": "99 Luftballons", "A (데모) – x": "A (데모)", "1. (x)": "1. (x)", "A (l\u0301ive)": "A (l\u0301ive)", "(a\nb) C": "C",
    }
    assert column(spark, list(cases), T.strip_noise) == list(cases.values())
    normal = ["좋은날 (Feat. 아이유)", "ΟΔΟΣ İ", "A\u0301\u0301b", "½ x²", "'99", "日本 ٣", " \t "]
    assert column(spark, normal, T.normalize_title) == ["좋은날 feat 아이유", "οδος i", "ab", "½ x²", "'99", "日本 ٣", ""]


def test_nul_goes_from_nested_values(spark):
    kind = "struct<a: string, b: array<struct<c: string, n: int>>, m: map<string, string>>"
    df = spark.createDataFrame([(("x\0", [("\0y", 1), None], {"k\0": "\0"}),), (None,)], f"v {kind}")
    got = df.select(T.strip_nul(F.col("v"), df.schema["v"].dataType).alias("v")).collect()
    assert got[0].v.asDict(True) == {"a": "x", "b": [{"c": "y", "n": 1}, None], "m": {"k": ""}} and got[1].v is None


def test_artist_key(spark):
    keys = column(spark, ["the beatles", "beatles", "a the", "drake", "drake miller band", "beatles the"], T.artist_key)
    assert keys[0] == keys[1] == keys[5] and keys[2] == "" and keys[3] != keys[4]


def test_confirm_title(spark):
    assert column(spark, ["Song - Single", "SONG  - EP", "Straße", "x - Single - EP", None], T.confirm_title) == ["song", "song", "strasse", "x - single", ""]


@pytest.mark.parametrize(("a", "b", "ratio"), [("abcd", "abcd", 1.0), ("abcd", "bcde", 0.75), ("", "", 1.0)])
def test_similarity(spark, a, b, ratio):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(T.similarity("a", "b")).first()[0] == ratio


def test_hints_and_countries(spark):
    hints = column(spark, [["한국 랩", "british pop"], ["uk garage"], ["rock"], [], None], T.country_hint, "array<string>")
    assert hints == ["KR", "GB", None, None, None]
    df = spark.createDataFrame([(h, c) for h in (None, "KR") for c in (None, "", "KR", "US")], "h string, c string")
    assert [r[0] for r in df.select(T.country_plausible(F.col("h"), F.col("c"))).collect()] == [True] * 7 + [False]


def test_small_rules(spark):
    assert column(spark, ["a+b", "x:y", "plain"], T.escape_query) == [r"a\+b", r"x\:y", "plain"]
    assert column(spark, ["a\0b", None], T.strip_nul) == ["ab", None]
    assert column(spark, ["Album", "EP", "Broadcast", "", None], T.release_type) == ["album", "ep", "other", None, None]
    assert column(spark, ["X - Single", "X - single", "X - EP"], T.store_release_type) == ["single", "album", "ep"]
    assert column(spark, [[" IU ", "", "아이유", "iu"]], lambda c: T.clean_aliases(c, F.lit("IU")), "array<string>") == [["아이유"]]
    assert column(spark, [["x"], None], lambda c: T.clean_aliases(c, F.lit(None).cast("string")), "array<string>") == [["x"], None]
    images = [[{"url": "a", "size": "large"}, {"url": "b", "size": "large"}, {"url": "", "size": "mega"}, {"url": "c", "size": "odd"}], [], None]
    assert column(spark, images, T.best_image, "array<struct<url:string,size:string>>") == ["b", None, None]
    assert column(spark, [["a", "", None, "b"], [], None], T.joined_names, "array<string>") == ["a, b", None, None]


def test_clean_titles_in_one_call(spark):
    """The same as both steps one after the other."""
    import random

    rnd = random.Random(13)
    bits = ["Song", "Été", "(Live)", "(feat. X)", "[Remix]", " - ", " – ", "-", "Remastered 2011", "한글", "(라이브)", "01. ", "7 - ", "( (Demo) x)", "[", ")", "  ", "\t", "'s", "İ", "ﬁn", "é", "Ω", "Radio Edit", "ΟΔΟΣ", "café (Á)"]
    titles = ["".join(rnd.choice(bits) + rnd.choice(["", " "]) for _ in range(rnd.randrange(7))) for _ in range(1500)] + [None, "", " ", "()", "(x)", "[Live]", "- - -"]
    df = spark.createDataFrame([(t,) for t in titles], "t string").select("t", T.clean_title("t").alias("a"), T.normalize_title(T.strip_noise("t")).alias("b"))
    assert [r for r in df.collect() if r.a != r.b] == []
