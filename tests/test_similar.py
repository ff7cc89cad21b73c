"""The similarity join of titles against comparing all pairs."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators import similar


def changed(rnd, title):
    title = list(title)
    for _ in range(rnd.randrange(4)):
        at, how = rnd.randrange(len(title) + 1), rnd.random()
        if how < 0.4:
            title.insert(at, rnd.choice("abcxyz\U0001f600é"))
        elif title and how < 0.8:
            title.pop(min(at, len(title) - 1))
        elif title:
            title[min(at, len(title) - 1)] = rnd.choice("qrs")
    return "".join(title)


@pytest.mark.parametrize("least", [0.8, 0.6, 1.0])
def test_join_equals_comparing_all(spark, least):
    rnd = random.Random(3)
    first = ["".join(rnd.choice("abcde fgh") for _ in range(rnd.randrange(1, 30))) for _ in range(50)]
    titles = [*first, *(changed(rnd, t) for t in first for _ in range(3)), "", None, "a", "a", "ab" * 150]
    df = spark.createDataFrame([(t,) for t in titles], "title string").selectExpr("title", "1 as n", "'x' as a").repartition(3)
    distinct = sorted({t for t in titles if t})
    want = {(a, b): r for a in distinct for b in distinct if a != b and (r := SequenceMatcher(None, a, b).ratio()) >= least}
    assert {(r.a, r.b): r.ratio for r in similar.similar(df, least).collect()} == want
    if least == 0.8:
        assert similar.candidates(df, least).count() < len(distinct) ** 2 / 20


def test_the_bound_is_one(spark):
    rnd = random.Random(8)
    rows = [("".join(rnd.choice("abc d") for _ in range(rnd.randrange(12))), "".join(rnd.choice("abc d") for _ in range(rnd.randrange(12)))) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.where(similar.bound(similar.characters(F.col("a")), similar.characters(F.col("b"))) < T.similarity("a", "b") - 1e-9).count() == 0


def test_no_titles(spark):
    assert similar.similar(spark.createDataFrame([(None,), ("",), ("one",)], "title string")).collect() == []
    with pytest.raises(ValueError, match="least"):
        similar.similar(spark.createDataFrame([("a",)], "title string"), 0.0)


def test_titles_of_the_same_characters_are_no_candidates(spark):
    rnd = random.Random(5)
    letters = list("the thanedble attion thereouhe anea in ern")
    titles = ["".join(rnd.sample(letters, len(letters))) for _ in range(120)]
    titles += [t[:7] + t[9:] + "xy" for t in titles[:10]]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    found = {(r.a, r.b) for r in similar.candidates(df).collect()}
    assert all(len(a) <= len(b) for a, b in found) and len(found) < 60  # characters alone leave more than 7,000
    want = {(a, b) for a in titles for b in titles if a != b and SequenceMatcher(None, a, b).ratio() >= 0.8}
    assert {(r.a, r.b) for r in similar.similar(df).collect()} == want


def test_cells_and_long_titles(spark, monkeypatch):
    monkeypatch.setattr(similar, "CELL", 6)
    monkeypatch.setattr(similar, "COLUMNS", 16)
    monkeypatch.setattr(similar, "LONG", 150)
    rnd = random.Random(6)
    first = ["".join(rnd.choice("abcde f\U0001f600é") for _ in range(n)) for n in (1, 2, 3, 9, 20, 40, 63, 64, 65, 66, 90, 129, 140, 160, 190)]
    titles = sorted({*first, *(changed(rnd, t) for t in first for _ in range(4))} - {""})
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    want = {(a, b): r for a in titles for b in titles if a != b and (r := SequenceMatcher(None, a, b).ratio()) >= 0.8}
    assert {(r.a, r.b): r.ratio for r in similar.similar(df).collect()} == want
