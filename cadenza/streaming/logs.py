"""Micro-batches into tables in a folder: append-only logs by key, rolling windows, latest states, and a dead-letter split.

A table is a folder with a slice for each batch number, cut into parts.  A batch writes the rows that it adds or changes and nothing else; reading puts the slices
together.  A batch that runs again replaces its own slice and looks at earlier ones only, so delivery may repeat.  Batch numbers are those of one checkpoint, from 0 on.  The folder must be
one that all executors share.

Logs keep a filter beside each slice and part: the least and the greatest key and a Bloom filter.  A batch opens only what may hold one of its keys.  Windows and states are merged as they grow, like the digits of
a binary counter: batch number b writes what the last 2 ** k batches come to, where 2 ** k is the largest power that divides b + 1, so a table of b batches is read from log2(b) slices.
Merged slices are left behind (``Snapshots.spent`` names them).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import ArrayType, LongType, StructType

from cadenza.operators import merge, rank


#: Bits of a filter for each key, the most bits of one filter, and hashes of a key.
KEY_BITS, MOST_BITS, HASHES = 16, 1 << 23, 4


def merged_slices(count: int) -> list[int]:
    """The slices that hold all of the first ``count`` batches, the newest first."""
    found = []
    while count > 0:
        found.append(count - 1)
        count -= count & -count
    return found


def _places(keys: list[str], bits: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(i)), bits) for i in range(HASHES)]


def key_filters(rows: DataFrame, keys: list[str]) -> DataFrame:
    """_part, low, high and words (the Bloom filter, 64 bits each) of the keys without nulls in each part of ``rows``."""
    known = rows.select("_part", *keys).where(" and ".join(f"`{k}` is not null" for k in keys))
    key = F.struct(*keys)
    size = F.least(F.lit(MOST_BITS), F.greatest(F.lit(64), F.pow(F.lit(2.0), F.ceil(F.log2(F.count("*") * KEY_BITS))))).cast("long")
    parts = known.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"), size.alias("bits"))
    one = F.lit(1).cast("long")
    sized = known.join(parts.select("_part", "bits"), "_part")
    hits = sized.select("_part", F.explode(F.array(*_places(keys, F.col("bits")))).alias("at"))
    hits = hits.groupBy("_part", F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", one, (F.col("at") % 64).cast("int"))).alias("set"))
    every = parts.select("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright("bits", 6) - 1)).alias("word"))
    words = every.join(hits, ["_part", "word"], "left").groupBy("_part").agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("long")).alias("set")))).alias("words"))
    return parts.join(words, "_part").select("_part", "low", "high", F.transform("words", lambda w: w["set"]).alias("words"))


def may_hold(filters: DataFrame, keys: list[str]) -> Column:
    """Whether the filter beside a row's keys (``words``, ``low``, ``high``) lets them pass."""
    key, passes = F.struct(*keys), F.lit(True)
    for at in _places(keys, F.size("words").cast("long") * 64):
        word = F.element_at("words", (F.shiftright(at, 6) + 1).cast("int"))
        passes &= F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    return (key >= F.col("low")) & (key <= F.col("high")) & passes


class Snapshots:
    """The table under ``path``.  ``combine`` makes its rows of those of all slices (None: they are its rows); the functions below set it.  Rows are dealt to ``parts``
    parts by a hash of their keys where no other part is given."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, combine: Callable[[DataFrame], DataFrame] | None = None, parts: int = 64):
        self.spark, self.path, self.combine, self.parts = spark, path.rstrip("/"), combine, parts
        self.empty = spark.createDataFrame([], schema)
        #: Whether slices are merged by levels, and the keys that slices are filtered by; the functions below set them.
        self.levels, self.keys = False, None

    def part(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.parts)).cast("string")

    def slices(self) -> DataFrame:
        """All rows ever written, with ``_batch`` and ``_part``."""
        laid = StructType(self.empty.schema.fields[:]).add("_batch", "long").add("_part", "string")
        self.empty.withColumns({"_batch": F.lit(0), "_part": F.lit("")}).write.partitionBy("_batch", "_part").mode("ignore").parquet(self.path)
        return self.spark.read.schema(laid).parquet(self.path)

    def names(self) -> set[tuple[int, str]]:
        """Batch and part of every file, from the listing alone."""
        found = (re.search(r"/_batch=(\d+)/_part=([^/]+)/", f) for f in self.slices().inputFiles())
        return {(int(m[1]), unquote(unquote(m[2]))) for m in found if m}  # an escaped name in an encoded path

    def count(self) -> int:
        """One more than the newest batch that wrote something."""
        return max((b for b, _ in self.names()), default=-1) + 1

    def held(self, before: int | None = None) -> DataFrame:
        """The rows of the slices that make the table (before a batch), with ``_batch`` and ``_part``."""
        if self.levels:
            return self.slices().where(F.col("_batch").isin(merged_slices(self.count() if before is None else before)))
        return self.slices() if before is None else self.slices().where(F.col("_batch") < before)

    def spent(self) -> list[str]:
        """Folders of merged slices, which nothing reads any more once the newest batch is done with."""
        if not self.levels:
            return []
        count = self.count()
        used = {*merged_slices(count), *merged_slices(count - 1)}
        return sorted(f"{self.path}/_batch={b}" for b in {b for b, _ in self.names()} - used)

    def read(self, before: int | None = None) -> DataFrame:
        """The table, or what it was before a batch; of a table with levels, the newest or the next batch."""
        rows = self.held(before).drop("_batch", "_part")
        return self.combine(rows) if self.combine else rows

    def filters(self) -> DataFrame:
        """_batch, _part, low, high and words of every slice and part."""
        kinds = StructType([f for k in self.keys for f in self.empty.schema.fields if f.name == k])
        laid = StructType().add("low", kinds).add("high", kinds).add("words", ArrayType(LongType())).add("_batch", "long").add("_part", "string")
        self.spark.createDataFrame([], laid).write.partitionBy("_batch", "_part").mode("ignore").parquet(f"{self.path}-filters")
        return self.spark.read.schema(laid).parquet(f"{self.path}-filters")

    def may_hold(self, keys: DataFrame, number: int) -> set[tuple[int, str]]:
        """Batch and part of what may hold one of ``keys`` (_part and the table's keys, without nulls), of batches before ``number``: what its filter lets pass, and what has none."""
        parts = {r[0] for r in keys.select("_part").distinct().collect() if r[0] is not None}  # names
        there = {(b, p) for b, p in self.names() if b < number and p in parts}
        if not there:
            return set()
        filters = self.filters().where((F.col("_batch") < number) & F.col("_part").isin(sorted(parts)))
        said = filters.select("_batch", "_part").distinct().collect()  # names
        passed = keys.join(filters, "_part").where(may_hold(filters, self.keys)).select("_batch", "_part").distinct().collect()
        return there & ({tuple(r) for r in passed} | (there - {tuple(r) for r in said}))

    def opened(self, found: set[tuple[int, str]]) -> DataFrame:
        """The rows of some batches' parts; others aren't opened."""
        by_batch: dict[int, list[str]] = {}
        for b, p in sorted(found):
            by_batch.setdefault(b, []).append(p)
        wanted = F.lit(False)
        for b, parts in by_batch.items():
            wanted |= (F.col("_batch") == b) & F.col("_part").isin(parts)
        return self.slices().where(wanted)

    def write(self, df: DataFrame, number: int, part: Column) -> None:
        """The slice of batch ``number``; other slices stay."""
        placed = df.select(*self.empty.columns, F.lit(number).cast("long").alias("_batch"), part.cast("string").alias("_part"))
        if self.keys:  # filters first: a slice without one is opened, a filter without a slice does no harm
            self.filters()
            made = key_filters(placed, self.keys).withColumn("_batch", F.lit(number).cast("long"))
            made.write.partitionBy("_batch", "_part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}-filters")
        placed.hint("rebalance", "_part").write.partitionBy("_batch", "_part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def compacted(self, path: str) -> Snapshots:
        """The same table in a new folder: all but the newest slice as one, and the newest, which may be delivered again, as it is.  The caller swaps folders."""
        other, rows = Snapshots(self.spark, path, self.empty.schema, self.combine, self.parts), self.slices()
        other.levels, other.keys = self.levels, self.keys
        last = rows.agg(F.max("_batch")).first()[0] if not self.levels else self.count() - 1  # one number
        if last is not None and last >= 0:
            whole = self.combine or (lambda df: df)
            old = whole(self.held(before=last).drop("_batch"))
            size = (last + 1) & -(last + 1) if self.levels else 1
            for number in {last - 1, last - size}:  # what the newest batch reads, and what is read beside it
                if number >= 0:
                    other.write(old, number, F.col("_part") if "_part" in old.columns else self.part(old.columns))
            other.write(rows.where(F.col("_batch") == last), last, F.col("_part"))
        return other


def append_log(table: Snapshots, keys: list[str], part: Column | None = None) -> Callable[[DataFrame, int], None]:
    """First row of each key ever seen, late ones included.  A batch is compared with the keys in those parts of those slices that may hold one of its keys, by their filters; ``part`` places rows by something
    that equal keys share, such as the day of a time among the keys, so that batches of recent rows look at few filters.  A key with a null, or without a part, is never seen before."""
    place = table.part(keys) if part is None else part.cast("string")
    table.keys = keys

    def run(batch: DataFrame, number: int) -> None:
        batch = batch.select(*table.empty.columns).persist()
        known = batch.select(place.alias("_part"), *keys).where(" and ".join(f"`{k}` is not null" for k in keys)).distinct()
        held = table.opened(table.may_hold(known, number)).select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi")
        table.write(merge.new_rows(held, batch, keys), number, place)
        batch.unpersist()

    return run


def rolling_window(table: Snapshots, keys: list[str], at: str, tie: str, n: int) -> Callable[[DataFrame, int], None]:
    """The newest ``n`` rows of distinct keys (which tell the time, or else a key that left the window may come back); the first row of a key stays.  A batch without a row for the window writes
    nothing; others write the window of as many batches as their level holds."""
    table.levels, columns = True, table.empty.columns

    def newest(rows: DataFrame) -> DataFrame:
        return rank.newest(rank.best_per_key(rows, keys, F.struct("_batch", *columns)) if "_batch" in rows.columns else rows, at, tie, n)

    table.combine = lambda rows: rank.newest(rank.best_per_key(rows, keys, F.struct(*columns)), at, tie, n)

    def run(batch: DataFrame, number: int) -> None:
        held, count = table.held(before=number).drop("_part"), number + 1
        fresh = merge.new_rows(held, batch.select(*columns), keys).withColumn("_batch", F.lit(number).cast("long"))
        window = newest(held.select(*columns, "_batch").unionByName(fresh.select(*columns, "_batch")))
        level = window.where(F.col("_batch") >= count - (count & -count))  # what a later batch may still read in one slice
        table.write(level.drop("_batch"), number, F.lit("0"))

    return run


def latest_state(table: Snapshots, key: str, at: str) -> Callable[[DataFrame, int], None]:
    """The newest row of each key by (``at``, then the rest of the row).  A batch writes the newest rows of as many batches as its level holds; ``states.newest_rows`` keeps them in a state store instead."""
    rest = [c for c in table.empty.columns if c not in (key, at)]

    def newest(rows: DataFrame) -> DataFrame:
        return rank.best_per_key(rows.select(*table.empty.columns), [key], F.struct(at, *rest), descending=True)

    table.levels, table.combine = True, newest

    def run(batch: DataFrame, number: int) -> None:
        count = number + 1
        lower = table.held(before=number).where(F.col("_batch") >= count - (count & -count))
        table.write(newest(batch.select(*table.empty.columns).unionByName(lower.select(*table.empty.columns))), number, table.part([key]))

    return run


def split_bad(batch: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to process, dead letters)."""
    ok = F.coalesce(good, F.lit(False))
    return batch.where(ok), batch.where(~ok)


def distinct_events(stream: DataFrame, keys: list[str], at: str | None = None, late: str | None = None) -> DataFrame:
    """A stream without repeated keys; state is kept for ever, or within a watermark if ``at`` and ``late`` bound it."""
    if at and late:
        return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def start(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """A writer that runs ``step`` for each micro-batch of what is available."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)
