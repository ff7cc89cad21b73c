"""The nearest points of a line against a plain search, with ties, nulls and one key that holds a third of the points."""

import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import nearest, resolve


def plain(queries, points, k):
    out = set()
    for key, of in set(queries):
        near = sorted(((v is not None and of is not None, abs(v - of) if v is not None and of is not None else 0.0, tie) for kk, v, tie in set(points) if kk == key))[:k]
        out |= {(key, of, tie, gap if known else None) for known, gap, tie in near}
    return out


@pytest.mark.parametrize("k", [1, 3, 50])
def test_nearest_equals_search(spark, k):
    rnd = random.Random(k)
    points = [(rnd.choice(["hot"] * 4 + list("abcdefgh")), rnd.choice([None, *map(float, range(30))]), i) for i in range(900)]
    points += points[:10] + [(None, 1.0, 9_000), ("few", None, 1), ("few", None, 2), ("one", 5.0, 3)]
    queries = [(rnd.choice(["hot", "a", "b", "none"]), rnd.choice([None, *(x / 2 for x in range(-6, 66))])) for _ in range(300)] + [("few", 1.0), ("few", None), ("one", 5.0), (None, 1.0)]
    got = nearest.nearest(spark.createDataFrame(queries, "key string, of double"), spark.createDataFrame(points, "key string, value double, tie long").repartition(3), k)
    rows = [tuple(r) for r in got.select("key", "of", "tie", "gap").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain([q for q in queries if q[0]], points, k)


def test_a_hot_artist_forms_few_pairs(spark):
    """One artist owns a third of the dump and most tracks: no join makes more than 2k rows a distinct query, and no range holds most of the line."""
    n, k = 6_000, 4
    dump = spark.range(n).select(F.col("id"), F.lit("t").alias("name"), F.concat(F.lit("Artist "), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string")).alias("artist_name"), F.lit(None).cast("string").alias("album_name"), (F.col("id") % 400).cast("double").alias("duration"), F.lit(1).alias("last_lyrics_id"))
    tracks = spark.range(900).select(F.col("id").alias("track_id"), F.array(F.lit("The Artist 0")).alias("artist_names"), F.lit(None).cast("array<string>").alias("aliases"), (F.col("id") % 300).cast("double").alias("duration_sec"))
    lyrics = spark.createDataFrame([(1, "la", None, False)], "id int, plain_lyrics string, synced_lyrics string, instrumental boolean")
    got = resolve.retrieve(tracks, dump, lyrics, most=k)
    assert got.groupBy("track_id").count().where(f"count <> {k}").count() == 0 and got.select("track_id").distinct().count() == 900
    one = {(r.track_id, r.id) for r in got.where("track_id = 7").collect()}
    want = sorted((abs(i % 400 - 7), i) for i in range(0, n, 3))[:k]
    assert one == {(7, i) for _, i in want}
    queries = spark.range(300).select(F.lit("hot").alias("key"), F.col("id").cast("double").alias("of"), F.col("id").cast("double").alias("value"))
    points = dump.where("id % 3 = 0").select(F.lit("hot").alias("key"), F.col("duration").alias("value"), F.col("id").alias("tie"))
    pairs = nearest.following(queries, points, k, True)
    assert pairs.count() <= 300 * k


def test_keys_with_few_queries_sort_no_line(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a line is sorted")

    rnd = random.Random(4)
    points = [(f"k{i % 40}", rnd.choice([None, *map(float, range(20))]), i) for i in range(800)]
    queries = [(f"k{i % 60}", rnd.choice([None, 3.0, 7.5, 19.0])) for i in range(200)]
    frames = spark.createDataFrame(queries, "key string, of double"), spark.createDataFrame(points, "key string, value double, tie long")
    monkeypatch.setattr(nearest, "following", refuse)
    got = nearest.nearest(*frames, 5)
    assert {tuple(r) for r in got.select("key", "of", "tie", "gap").collect()} == plain(queries, points, 5)
    monkeypatch.undo()
    monkeypatch.setattr(nearest, "FEW", 3)  # some keys by the line
    got = nearest.nearest(*frames, 5)
    assert {tuple(r) for r in got.select("key", "of", "tie", "gap").collect()} == plain(queries, points, 5)


def test_names_without_an_artist_key_are_kept_apart(spark):
    dump = spark.createDataFrame([(1, "t", None, None, 5.0, 1), (2, "t", "The Who", None, 5.0, 1), (3, "t", "who", None, 6.0, 1)], "id long, name string, artist_name string, album_name string, duration double, last_lyrics_id int")
    tracks = spark.createDataFrame([(1, ["The Who", None], None, 5.0), (2, ["Nobody"], ["who", "Who"], 6.0)], "track_id long, artist_names array<string>, aliases array<string>, duration_sec double")
    lyrics = spark.createDataFrame([(1, "la", None, False)], "id int, plain_lyrics string, synced_lyrics string, instrumental boolean")
    got = {(r.track_id, r.id) for r in resolve.retrieve(tracks, dump, lyrics, most=3).collect()}
    assert got >= {(1, 2), (1, 3), (2, 2), (2, 3)} and (2, 1) not in got
