"""First, last and best rows by key, newest windows, stable rotation and chunks.  Every order is total and passed in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import durable


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; Spark limits groups before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def best_per_key(df: DataFrame, keys: list[str], order: Column, descending: bool = False) -> DataFrame:
    """One row of each key with the least (or greatest) ``order``, a struct for several columns: combined before the shuffle, so a hot key is no hot task."""
    pick = F.max_by if descending else F.min_by
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def ordered_distinct(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Distinct keys with the place of their first occurrence."""
    return df.groupBy(key).agg(F.min(ordinal).alias(ordinal))


def newest(df: DataFrame, at: str, tie: str, n: int) -> DataFrame:
    """The newest ``n`` rows: each task keeps ``n``, the last step sees only those."""
    return df.orderBy(F.col(at).desc_nulls_last(), F.col(tie).desc()).limit(n)


def positions(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Row numbers from 0 in a total order, without one task that sorts all rows: ranges are sorted apart and start after the sizes of those before.

    Ranges are sampled, so the rows are written once with their range; sizes and numbers then speak of the same ranges.
    """
    parts = durable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    numbered = parts.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))  # a row for each range
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return numbered.join(F.broadcast(starts.select("_part", "_start")), "_part").withColumn(name, F.col("_start") + F.col("_in")).drop("_part", "_in", "_start")


def _part_of(key: Column, cuts: list[Column], low: int = 0, high: int | None = None) -> Column:
    """How many of ``cuts`` (ascending) are at or below ``key``, by halving."""
    high = len(cuts) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key < cuts[middle], _part_of(key, cuts, low, middle)).otherwise(_part_of(key, cuts, middle + 1, high))


def rank_range(df: DataFrame, order: list[str], pick: Callable[[int], tuple[int, int]], name: str = "position", parts: int = 128, rounds: int = 4) -> tuple[DataFrame, int, int]:
    """Rows of ranks ``start`` to ``stop`` - 1 in a total order, with their rank as ``name``, and both bounds.  ``pick`` gives the bounds for the number of rows.

    A selection, not a sort: keys with the least hashes cut the order into ``parts``, one pass counts each part, and only the parts that hold wanted ranks are looked at again, until
    they hold little besides (or ``rounds`` are over, or equal keys can't be cut).  What is left is numbered; nothing else is shuffled or written.
    """
    left, before, bounds, size = df, 0, None, None
    key, kinds = F.struct(*order), {f.name: f.dataType for f in df.schema.fields}
    literal = lambda r: F.struct(*(F.lit(r[c]).cast(kinds[c]).alias(c) for c in order))
    for _ in range(rounds):
        cut = left.select(*order).orderBy(F.xxhash64(*order), *order).limit(parts - 1).distinct().orderBy(*order).collect()
        cuts = [literal(r) for r in cut]
        held = {r["part"]: r["count"] for r in left.groupBy(_part_of(key, cuts).alias("part")).count().collect()}  # ``parts`` rows
        if bounds is None:
            bounds = pick(sum(held.values()))
        start, stop = bounds
        low, high, at = None, None, before
        for part in sorted(held):
            if at < stop and at + held[part] > start:
                low, high, first = (part if low is None else low), part, (at if low is None else first)
            at += held[part]
        if low is None:
            return df.limit(0).withColumn(name, F.lit(0).cast("long")), start, stop
        inside = F.lit(True)
        if low > 0:
            least = cut[low - 1][order[0]]
            inside &= (key >= cuts[low - 1]) & (F.lit(True) if least is None else F.col(order[0]) >= F.lit(least))
        if high < len(cuts):
            most = cut[high][order[0]]
            inside &= (key < cuts[high]) & (F.lit(True) if most is None else F.col(order[0]).isNull() | (F.col(order[0]) <= F.lit(most)))
        left, before, now = left.where(inside), first, sum(n for p, n in held.items() if low <= p <= high)
        if now <= 4 * max(1, stop - start) or now == size:
            break
        size = now
    numbered = positions(left, order, name).withColumn(name, F.col(name) + before)
    return numbered.where((F.col(name) >= start) & (F.col(name) < stop)), start, stop


def rotation(df: DataFrame, order: list[str], per_tick: int, tick: int) -> DataFrame:
    """The rows of a tick's bucket with ``visit``, their rank in it.

    Buckets are slices of the stable order; each cycle over all buckets starts one place later inside them.  The clock is a parameter, no
    state is kept.  Rows outside the bucket are counted, never numbered or written.
    """
    offset = 0

    def bucket(total: int) -> tuple[int, int]:
        nonlocal offset
        buckets = max(1, -(-total // per_tick))
        start = tick % buckets * per_tick
        size = max(0, min(per_tick, total - start))
        offset = tick // buckets % size if size > 1 else 0
        return start, start + size

    held, start, stop = rank_range(df, order, bucket)
    return held.withColumn("visit", F.pmod(F.col("position") - start - offset, F.lit(max(stop - start, 1))))


def chunks(df: DataFrame, key: str, size: int) -> DataFrame:
    """Sorted distinct keys in chunks: chunk and keys (an array)."""
    held = positions(df.select(key).distinct(), [key]).withColumn("chunk", F.floor(F.col("position") / size))
    return held.groupBy("chunk").agg(F.array_sort(F.collect_list(key)).alias("keys"))


def listed(df: DataFrame, key: str, order: Column, value: str, n: int | None = None) -> DataFrame:
    """``key`` and its values (at most ``n``) in an order, as an array."""
    rows = df if n is None else top_per_key(df, [key], [order.asc_nulls_last(), F.col(value).asc()], n)
    pairs = F.array_sort(F.collect_list(F.struct(order.isNull().alias("a"), order.alias("b"), F.col(value).alias("v"))))
    return rows.groupBy(key).agg(pairs.alias("_p")).select(key, F.transform("_p", lambda p: p["v"]).alias(f"{value}s"))


def ladder(df: DataFrame, keys: list[str], order: list[Column], passes: Column, n: int = 2) -> DataFrame:
    """Chained fallback: of each key's first ``n`` rows, the first that passes."""
    w = Window.partitionBy(*keys).orderBy(*order)
    tried = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).where(passes)
    return best_per_key(tried, keys, F.col("_rank")).drop("_rank")
