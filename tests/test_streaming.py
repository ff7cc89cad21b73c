from pyspark.sql import functions as F

from cadenza.streaming import logs

SCHEMA = "k string, at timestamp, v int"


def feed(spark, tmp_path, number, rows):
    spark.createDataFrame(rows, "k string, at string, v int").withColumn("at", F.to_timestamp("at")).coalesce(1).write.parquet(str(tmp_path / f"in/{number}"))


def run(spark, tmp_path, step):
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    logs.start(stream, step, str(tmp_path / "ck")).start().awaitTermination()


def test_log_and_repeated_batches(spark, tmp_path):
    table = logs.Snapshots(spark, str(tmp_path / "log"), SCHEMA)
    step = logs.append_log(table, ["k", "at"])
    feed(spark, tmp_path, 0, [("a", "2024-01-01", 1), ("b", "2024-01-02", 2)])
    run(spark, tmp_path, step)
    feed(spark, tmp_path, 1, [("a", "2024-01-01", 9), ("c", "2023-01-01", 3)])
    run(spark, tmp_path, step)
    want = {("a", 1), ("b", 2), ("c", 3)}
    assert {(r.k, r.v) for r in table.read().collect()} == want
    again = spark.createDataFrame([("c", "2023-01-01", 3)], "k string, at string, v int").withColumn("at", F.to_timestamp("at"))
    step(again, 1)  # delivered twice
    assert {(r.k, r.v) for r in table.read().collect()} == want


def test_window_and_state(spark, tmp_path):
    window, state = (logs.Snapshots(spark, str(tmp_path / n), SCHEMA) for n in ("window", "state"))
    batch = spark.createDataFrame([("a", f"2024-01-0{d}", d) for d in range(1, 6)] + [("b", "2024-01-01", 7)], "k string, at string, v int").withColumn("at", F.to_timestamp("at"))
    logs.rolling_window(window, ["k", "at"], "at", "k", 3)(batch, 0)
    logs.latest_state(state, "k", "at")(batch, 0)
    assert sorted(r.v for r in window.read().collect()) == [3, 4, 5]
    assert {(r.k, r.v) for r in state.read().collect()} == {("a", 5), ("b", 7)}


def test_dead_letters_and_dedup(spark, tmp_path):
    batch = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    good, bad = logs.split_bad(batch, F.col("v") > 0)
    assert (good.count(), bad.count()) == (1, 2)
    feed(spark, tmp_path, 0, [("a", "2024-01-01", 1), ("a", "2024-01-01", 1)])
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    for n, out in enumerate((logs.distinct_events(stream, ["k"]), logs.distinct_events(stream, ["k"], "at", "1 day"))):
        q = out.writeStream.format("memory").queryName(f"d{n}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"d{n}").count() == 1


def rows(spark, *values):
    return spark.createDataFrame(values, "k string, at string, v int").withColumn("at", F.to_timestamp("at"))


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    table = logs.Snapshots(spark, str(tmp_path / "log"), SCHEMA)
    step = logs.append_log(table, ["k", "at"], F.to_date("at"))
    step(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("b", "2024-01-02", 1)), 0)
    step(rows(spark, ("a", "2024-01-01", 9), ("c", "2023-01-01", 3), (None, None, 4)), 1)
    step(rows(spark), 2)
    step(rows(spark, ("a", "2024-01-01", 9), ("c", "2023-01-01", 3), (None, None, 4)), 1)  # again
    assert {(r._batch, r._part, r.v) for r in table.slices().collect()} == {(0, "2024-01-01", 1), (0, "2024-01-02", 1), (1, "2023-01-01", 3), (1, None, 4)}
    step(rows(spark, ("c", "2023-01-01", 5), ("d", "2024-01-02", 6)), 3)
    small = table.compacted(str(tmp_path / "small"))
    assert {(r._batch, r.v) for r in small.slices().collect()} == {(2, 1), (2, 3), (2, 4), (3, 6)}
    logs.append_log(small, ["k", "at"], F.to_date("at"))(rows(spark, ("a", "2024-01-01", 7), ("e", "2024-01-02", 8)), 3)  # the newest again, with other rows
    assert sorted(r.v for r in small.read().collect()) == [1, 1, 3, 4, 8]


def test_windows_and_states_over_batches(spark, tmp_path):
    window, state = (logs.Snapshots(spark, str(tmp_path / n), SCHEMA) for n in ("window", "state"))
    steps = logs.rolling_window(window, ["k", "at"], "at", "k", 2), logs.latest_state(state, "k", "at")
    assert window.read().count() == state.read().count() == 0
    for number, batch in enumerate(([("a", "2024-01-03", 3), ("a", "2024-01-01", 1)], [("a", "2024-01-02", 2), ("b", "2024-01-05", 5), ("b", "2024-01-04", 4)], [("b", "2024-01-05", 9), ("a", "2024-01-01", 7)])):
        for step in steps:
            step(rows(spark, *batch), number)
    assert sorted(r.v for r in window.read().collect()) == [4, 5]
    assert {(r.k, r.v) for r in state.read().collect()} == {("a", 3), ("b", 9)}
    assert {(r.k, r.v) for r in state.read(before=2).collect()} == {("a", 3), ("b", 5)}
    assert sorted(r.v for r in window.slices().where("_batch = 2").collect()) == []
    for table in (window, state):
        small = table.compacted(f"{table.path}-small")
        assert sorted(small.read().collect()) == sorted(table.read().collect())
    assert small.slices().where("_batch = 1").count() == 2


def test_slices_without_a_key_stay_closed(spark, tmp_path, monkeypatch):
    """With parts by hash, a batch that repeats nothing opens no old slice; one that repeats opens those that may hold its keys, and a filter that lets too much pass changes nothing."""
    table = logs.Snapshots(spark, str(tmp_path / "log"), SCHEMA, parts=4)
    step, opened = logs.append_log(table, ["k", "at"]), []
    monkeypatch.setattr(table, "opened", lambda found, f=table.opened: (opened.append(found), f(found))[1])
    many = lambda low, high: [(f"k{i:04d}", "2024-01-01", i) for i in range(low, high)]
    for number in range(4):
        step(rows(spark, *many(number * 200, number * 200 + 200)), number)
    assert sum(map(len, opened)) <= 1  # of 24 pairs of a batch's part and an earlier slice
    opened.clear()
    step(rows(spark, *many(250, 252), ("new", "2024-01-01", -1)), 4)
    assert {b for b, _ in opened[0]} >= {1} and len(opened[0]) <= 3
    assert table.read().count() == 801
    monkeypatch.setattr(logs, "may_hold", lambda filters, keys: F.lit(True))
    step(rows(spark, *many(0, 3), ("newer", "2024-01-01", -2), (None, "2024-01-01", -3)), 5)
    assert table.read().count() == 803 and table.read().where("v < 0").count() == 3


def test_merged_levels(spark, tmp_path):
    """Windows and states of many batches are read from few slices; repeated batches and compaction change nothing."""
    window, state = (logs.Snapshots(spark, str(tmp_path / n), SCHEMA, parts=2) for n in ("window", "state"))
    steps = logs.rolling_window(window, ["k", "at"], "at", "k", 3), logs.latest_state(state, "k", "at")
    rnd, every = __import__("random").Random(5), []
    for number in range(13):
        batch = [(rnd.choice("abcd"), f"2024-01-{rnd.randrange(1, 29):02d}", number * 10 + k) for k in range(3)]
        every += batch
        for step in steps:
            for _ in range(1 + (number in (3, 5, 12))):  # delivered twice
                step(rows(spark, *batch), number)
        if number not in (3, 6, 12):
            continue
        first = {}
        for k, at, v in sorted(every, key=lambda r: r[2] // 10):
            first.setdefault((k, at), set()).add((v // 10, v))
        top = sorted(first, key=lambda x: (x[1], x[0]), reverse=True)[:3]
        for table in (window, window.compacted(f"{window.path}-{number}")):
            got = {(r.k, str(r.at)[:10]): r.v for r in table.read().collect()}
            assert set(got) == set(top) and all(v in {x for b, x in first[k] if b == min(first[k])[0]} for k, v in got.items())
        newest = {k: max((at, v) for kk, at, v in every if kk == k) for k, _, _ in every}
        for table in (state, state.compacted(f"{state.path}-{number}")):
            assert {r.k: (str(r.at)[:10], r.v) for r in table.read().collect()} == newest
    assert len(logs.merged_slices(13)) == 3 and all(len(logs.merged_slices(c)) <= 10 for c in range(1001))
    assert window.held().count() <= 3 * 3 and not {f"{state.path}/_batch={b}" for b in logs.merged_slices(13)} & set(state.spent()) and len(state.spent()) >= 6


def test_parts_of_any_name(spark, tmp_path):
    """Parts whose names are escaped in paths are known again."""
    table = logs.Snapshots(spark, str(tmp_path / "log"), SCHEMA)
    step = logs.append_log(table, ["k"], F.concat(F.col("k"), F.lit(":/ =%é")))
    step(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-01", 2)), 0)
    step(rows(spark, ("b", "2024-01-02", 3), ("c", "2024-01-02", 4)), 1)
    assert {(r.k, r.v) for r in table.read().collect()} == {("a", 1), ("b", 2), ("c", 4)}
    assert (0, "b:/ =%é") in table.names()
    step(rows(spark, (None, "2024-01-02", 5), ("c", "2024-01-03", 6)), 2)
    assert table.read().count() == 4
