import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import calendar, joins, merge, rank, reconcile
from cadenza.operators.merge import Rule


def got(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_upsert_rules(spark):
    target = spark.createDataFrame([(1, "a", {"x": "1", "y": "2"}), (2, "b", None), (3, "c", {})], "k int, v string, m map<string,string>")
    source = spark.createDataFrame([(1, None, {"y": "3", "z": "4"}), (4, "d", {"q": "1"})], "k int, v string, m map<string,string>")
    out = {r.k: (r.v, r.m) for r in merge.upsert(target, source, ["k"], {"v": Rule.OVERWRITE, "m": Rule.MAP_MERGE}).collect()}
    assert out == {1: (None, {"x": "1", "y": "3", "z": "4"}), 2: ("b", None), 3: ("c", {}), 4: ("d", {"q": "1"})}
    kept = {r.k: r.v for r in merge.upsert(target, source, ["k"], {"v": Rule.COALESCE}).collect()}
    assert kept == {1: "a", 2: "b", 3: "c", 4: "d"}


def test_upsert_is_idempotent_and_flags_real_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    source = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "k int, v string")
    once = merge.upsert(target, source, ["k"], {"v": Rule.OVERWRITE}, changed_flag="c")
    assert got(once) == [(1, "a", False), (2, "x", True), (3, None, True)]
    assert not merge.upsert(once.drop("c"), source, ["k"], {"v": Rule.OVERWRITE}, changed_flag="c").where("c").count()


def test_guarded_upsert(spark):
    target = spark.createDataFrame([(1, "released", "a"), (2, "announced", "b")], "k int, status string, v string")
    source = spark.createDataFrame([(1, "z"), (2, "z")], "k int, v string")
    out = merge.upsert(target, source, ["k"], {"v": Rule.OVERWRITE}, when=F.col("t_status") != "released")
    assert got(out, "k", "v") == [(1, "a"), (2, "z")]


def test_insert_ignore_and_partial_key(spark):
    target = spark.createDataFrame([(1, "a", False), (2, "b", True)], "k int, v string, playing boolean")
    source = spark.createDataFrame([(1, "z", False, 0), (2, "n", False, 1), (3, "late", False, 5), (3, "first", False, 2)], "k int, v string, playing boolean, ord int")
    assert got(merge.insert_ignore(target, source, ["k"], "ord"), "k", "v") == [(1, "a"), (2, "b"), (3, "first")]
    assert got(merge.insert_ignore(target, source, ["k"], "ord", within=~F.col("playing")), "k", "v") == [(1, "a"), (2, "b"), (2, "n"), (3, "first")]


def test_prune_replace_update(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    assert got(merge.prune(target, target.where("k = 1"), ["k"])) == [(1, "a")]
    assert got(merge.prune(target, target.where("false"), ["k"])) == []
    batch = spark.createDataFrame([(1, "new")], "k int, v string")
    replaced = merge.replace_where(target, batch, ["k"], F.lit(True))
    assert {(r.k, r.v) for r in replaced.collect()} == {(1, "new"), (2, "b"), (None, "n")}
    assert {(r.k, r.v) for r in merge.update_keyed(target, batch, ["k"], ["v"]).collect()} == {(1, "new"), (2, "b"), (None, "n")}


def test_positions_do_not_depend_on_partitions(spark):
    values = list(range(200))
    random.Random(3).shuffle(values)
    for parts in (1, 7):
        df = spark.createDataFrame([(v,) for v in values], "k int").repartition(parts)
        assert {(r.k, r.position) for r in rank.positions(df, ["k"]).collect()} == {(v, v) for v in values}


def test_append_positions_on_an_empty_table(spark):
    held = spark.createDataFrame([], "k string, position long")
    new = spark.createDataFrame([("b", 2), ("a", 1), ("b", 0)], "k string, ord int")
    assert got(merge.append_positions(held, new, "k", "ord"), "k", "position") == [("a", 1), ("b", 0)]


@pytest.mark.parametrize("tick", range(12))
def test_rotation_covers_everything_and_rotates(spark, tick):
    items, per = 7, 3
    df = spark.createDataFrame([(i,) for i in range(items)], "k int")
    out = [r.k for r in rank.rotation(df, ["k"], per, tick).orderBy("visit").collect()]
    buckets = -(-items // per)
    want = list(range(items))[tick % buckets * per :][:per]
    shift = tick // buckets % len(want) if len(want) > 1 else 0
    assert out == want[shift:] + want[:shift]


@pytest.mark.parametrize("tick", [0, 3, 77])
def test_a_bucket_is_selected_not_sorted(spark, monkeypatch, tick):
    """Of a large table only a few rows beside the bucket are written, whatever the order's columns hold."""
    written = []
    durable = rank.durable
    monkeypatch.setattr(rank, "durable", lambda df, tag: (written.append(df.count()), durable(df, tag))[1])
    n, per = 40_000, 50
    df = spark.range(n).selectExpr("if(id % 10 = 0, null, cast(id % 700 as string)) as name", "id as k")
    got = [(r.position, r.name, r.k) for r in rank.rotation(df, ["name", "k"], per, tick).collect()]
    every = sorted(((i % 10 != 0, str(i % 700) if i % 10 else "", i) for i in range(n)))
    start = tick % (n // per) * per
    assert sorted(got) == [(p, every[p][1] if every[p][0] else None, every[p][2]) for p in range(start, start + per)]
    assert sum(written) <= 5 * per


def test_a_range_of_equal_keys(spark):
    df = spark.range(500).selectExpr("1 as k", "id % 2 as v")
    held, start, stop = rank.rank_range(df, ["k"], lambda n: (n // 2, n // 2 + 10))
    assert (start, stop) == (250, 260) and sorted(r.position for r in held.collect()) == list(range(250, 260))


def test_rotation_of_nothing(spark):
    assert rank.rotation(spark.createDataFrame([], "k int"), ["k"], 3, 5).count() == 0


def test_ladder_and_best(spark):
    df = spark.createDataFrame([(1, 1, False), (1, 2, True), (1, 3, True), (2, 1, False), (2, 2, False), (2, 3, True)], "k int, at int, ok boolean")
    assert got(rank.ladder(df, ["k"], [F.col("at").asc()], F.col("ok")), "k", "at") == [(1, 2)]
    assert got(rank.best_per_key(df, ["k"], F.col("at"), descending=True), "k", "at") == [(1, 3), (2, 3)]
    assert got(rank.chunks(df, "at", 2), "keys") == [([1, 2],), ([3],)]


def test_band_join_edges(spark):
    left = spark.createDataFrame([(1, "2024-01-10")], "k int, a string").withColumn("a", F.to_date("a"))
    right = spark.createDataFrame([(1, f"2024-01-{d:02d}") for d in range(1, 21)] + [(2, "2024-01-10")], "k int, b string").withColumn("b", F.to_date("b"))
    days = [r.b.day for r in joins.band_join(left, right, ["k"], "a", "b", 7).collect()]
    assert sorted(days) == list(range(3, 18))


def test_null_keys_do_not_empty_an_anti_join(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    assert got(joins.without_keys(df, keys, ["k"])) == [(2,)]
    assert got(joins.with_keys(df, keys, ["k"])) == [(1,)]


def test_reconcile(spark):
    one = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    state = spark.createDataFrame([("b", "ours", "synced", True, None, None), ("c", "preexisting", "synced", True, "old", None)], "key string, source string, state string, in_library boolean, last_error string, last_synced_at timestamp")
    planned = reconcile.plan(one("a", "x"), one("b", "c", "d", "x"), state)
    assert got(planned) == [("a", "ADD"), ("b", "REMOVE"), ("c", "PULL"), ("d", "PULL")]
    assert reconcile.funnel(planned).first().asDict() == {"add": 1, "remove": 1, "pull": 2}
    errors = planned.withColumn("error", F.when(F.col("key") == "a", "boom"))
    after = {r.key: (r.source, r.state, r.in_library, r.last_error, r.last_synced_at is not None) for r in reconcile.next_state(state, errors, True, "2026-01-01").collect()}
    assert after == {"a": ("ours", "failed", None, "boom", False), "b": ("ours", "synced", False, None, True), "c": ("preexisting", "synced", True, None, True), "d": ("preexisting", "synced", True, None, True)}
    dry = {r.key: (r.state, r.in_library) for r in reconcile.next_state(state, planned, False, "2026-01-01").collect()}
    assert dry["b"] == ("planned", True) and dry["a"] == ("planned", None)


def test_confirm(spark):
    events = spark.createDataFrame([(1, "A", "mb", "k1", "Song", "2024-05-01", "announced", None), (2, "A", "mb", "k2", "Other", "2024-05-01", "announced", None)], "id int, artist_id string, source string, source_key string, title string, release_date string, status string, spotify_album_id string")
    events = events.withColumn("release_date", F.to_date("release_date")).withColumn("release_type", F.lit("album"))
    found = [("A", "s1", "SONG - Single", "2024-05-08", True, 0), ("A", "s2", "song", "2024-05-01", False, 1), ("A", "s3", "Song", "2024-05-09", True, 2), ("A", "s4", "New", "2024-05-01", None, 3), ("B", "s5", "Song", "2024-05-01", True, 4)]
    cands = spark.createDataFrame(found, "artist_id string, spotify_album_id string, title string, release_date string, passes_gate boolean, ord int").withColumn("release_date", F.to_date("release_date")).withColumn("release_type", F.lit("album"))
    flips, inserts, skipped = calendar.confirm(cands, events)
    assert got(flips, "id", "spotify_album_id") == [(1, "s2")]
    assert got(inserts, "spotify_album_id") == [("s3",), ("s5",)]
    assert got(skipped, "spotify_album_id") == [("s4",)]
    after = calendar.apply_confirmation(events, flips, inserts)
    assert got(after.where("changed"), "source_key") == [("k1",), ("s3",), ("s5",)]
    again = calendar.apply_confirmation(after.drop("changed"), flips, inserts)
    assert again.where("changed").count() == 0 and again.count() == after.count()


def test_announce_and_observe(spark):
    found = spark.createDataFrame([("A", "mb", "1", "T", "album", "2024-06-10", 1), ("B", "mb", "1", "U", "album", "2024-06-10", 0), ("A", "mb", "2", "V", "ep", "2024-06", 2), ("A", "mb", "3", "W", "ep", "2024-09-01", 3)], "artist_id string, source string, source_key string, title string, release_type string, release_date string, ord int")
    rows = calendar.announce(found, F.to_date(F.lit("2024-06-01")), 30)
    assert got(rows, "source_key", "artist_id") == [("1", "B")]
    events = spark.createDataFrame([("A", "mb", "1", "old", "album", "2024-06-01", "released", "s1")], "artist_id string, source string, source_key string, title string, release_type string, release_date string, status string, spotify_album_id string")
    assert got(calendar.observe(events, rows), "artist_id", "title", "status", "spotify_album_id") == [("A", "U", "released", "s1")]
