"""Keyed state of a stream: restarts, late rows, ties, idle keys and a seed, against the batch result."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cadenza.operators import rank
from cadenza.streaming import logs, states

SCHEMA = "user_id long, at timestamp, track string, n int"


def at(minute):
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def test_newest_rows(spark, tmp_path):
    states.rocksdb(spark)
    landed, ends, changes = str(tmp_path / "in"), str(tmp_path / "checkpoint"), str(tmp_path / "out")
    seed = spark.createDataFrame([(1, at(-30), "seed", 1), (9, at(-20), "seed", 9), (9, at(-25), "older", 9), (None, at(0), "none", 0)], SCHEMA)
    batches = [
        [(1, at(0), "a", 1), (1, at(0), "b", None), (2, at(1), "x", 1), (3, at(0), None, None)],
        [(1, at(-5), "late", 1), (2, at(2), "y", 2), (2, at(2), "y", 1), (None, at(3), "none", 0), (4, None, "none", 0)],
        [(2, at(2), "y", 2), (5, at(60), "p", 1)],
        [(5, at(61), "q", 1), (1, at(-50), "very late", 1), (6, at(200), "end", 0)],
        [(6, at(201), "end", 0)],
    ]

    def step(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{changes}/batch={number}")

    for rows in batches:  # one run each: every run but the first restarts from the checkpoint
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
        run = logs.start(states.newest_rows(stream, "user_id", "at", "30 minutes", timedelta(minutes=45), seed), step, ends).outputMode("update").start()
        run.awaitTermination(180)
        assert run.exception() is None and not run.isActive
    got = spark.read.parquet(changes).withColumn("batch", F.col("batch").cast("int"))
    said = [(r.user_id, r.at, r.track, r.n) for r in got.where("not idle").collect()]
    assert len(said) == len(set(said))  # a row that changes nothing says nothing
    last = {r.user_id: (r.at, r.track, r.n) for r in rank.best_per_key(got, ["user_id"], F.struct("at", F.col("track"), "n"), descending=True).collect()}
    every = seed.unionByName(spark.createDataFrame([r for b in batches for r in b], SCHEMA)).where("user_id is not null and at is not null")
    want = {r.user_id: (r.at, r.track, r.n) for r in rank.best_per_key(every, ["user_id"], F.struct("at", "track", "n"), descending=True).collect()}
    assert last == want
    assert {r.user_id for r in got.where("idle").collect()} == {1, 2, 3, 5, 9}
