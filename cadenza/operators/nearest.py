"""The nearest k points of a number line, by key: a one-dimensional nearest-neighbour join.

Queries and points of a key stand in one order by value.  What is nearest to a query are the first points at or above it and the first below it, so each direction
sorts the stream once (descending values for the one below), numbers the points, and gives every query the numbers of the k that follow; those are joined by number.
The order is cut into ranges, so a key with a third of all points is spread over many tasks, and a query forms 2k pairs at most, however many points its key has.

Most keys have few points, or few queries of their own; those are compared directly (``FEW`` queries a key and ``POINTS`` points at most, so pairs are ``FEW`` times the points at most), which needs one
join instead of two sorted streams.  Keys without queries or without points go nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.rank import top_per_key
from cadenza.session import durable, scratch

#: Queries and points of a key up to which all of them are compared.
FEW, POINTS = 8, 50_000


def following(queries: DataFrame, points: DataFrame, k: int, inclusive: bool) -> DataFrame:
    """(key, of, tie) of the first ``k`` points of the query's key from its value on, by (value, tie); points that equal it count if ``inclusive``, and values ascend.
    ``queries``: key, of, value, each once; ``points``: key, value, tie."""
    both = points.select("key", "value", F.lit(1).alias("side"), "tie", F.lit(None).cast(queries.schema["of"].dataType).alias("of"))
    none = F.lit(None).cast(points.schema["tie"].dataType).alias("tie")
    both = both.unionByName(queries.select("key", "value", F.lit(0 if inclusive else 2).alias("side"), none, "of"))
    order = ["key", "value", "side", "tie", "of"]
    ranges, drop = scratch(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "line")
    sizes = ranges.groupBy("_part").agg(F.count_if(F.col("side") == 1).alias("_n"))  # a row for each range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = F.count_if(F.col("side") == 1).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    numbered = ranges.withColumn("_in", inside).join(F.broadcast(starts), "_part").withColumn("at", F.col("_start") + F.col("_in"))  # points so far
    numbered, drop_numbered = scratch(numbered.select("key", "side", "tie", "of", "at"), "numbered")
    drop()
    asks = numbered.where("side <> 1").select("key", "of", F.explode(F.sequence(F.col("at") + 1, F.col("at") + k)).alias("at"))
    held = numbered.where("side = 1").select("key", "at", "tie")
    found, _ = scratch(asks.join(held, ["at", "key"]).select("key", "of", "tie"), "following")
    drop_numbered()
    return found


def nearest(queries: DataFrame, points: DataFrame, k: int, once: bool = False) -> DataFrame:
    """key, of, tie and gap of the ``k`` points of each query's key with the least distance.

    ``queries``: key and of (a number or null), ``points``: key, value (a number or null) and tie, which tells a key's points apart.  Gaps that are null come first, then
    ties in their order: points without a value are nearest to every query, and to a query without a number the first points in the order of ties.  Repeated queries are answered once, and so are repeated points unless ``once`` says that there are none;
    null keys have no points.
    """
    q = queries.select("key", F.col("of").cast("double").alias("of")).where(F.col("key").isNotNull()).distinct()
    p = points.select("key", F.col("value").cast("double").alias("value"), "tie").where(F.col("key").isNotNull())
    asked, had = q.groupBy("key").agg(F.count("*").alias("_q")), p.groupBy("key").agg(F.count("*").alias("_p"))
    keys = durable(asked.join(had, "key").select("key", ((F.col("_q") <= FEW) & (F.col("_p") <= POINTS)).alias("_few")), "keys")
    p = p if once else p.distinct()
    few, many = keys.where("_few").select("key"), keys.where("not _few").select("key")
    all_pairs = q.join(few, "key").join(p, "key").select("key", "of", "tie", F.abs(F.col("value") - F.col("of")).alias("gap"))
    direct = top_per_key(all_pairs, ["key", "of"], by_gap(), k)
    if many.isEmpty():
        return direct
    return direct.union(by_line(q.join(many, "key", "left_semi"), p.join(many, "key", "left_semi"), k))


def by_line(q: DataFrame, p: DataFrame, k: int) -> DataFrame:
    """``nearest`` by two sorted streams, for distinct queries and points with keys."""
    known, there = q.where("of is not null"), p.where("value is not null")
    above = following(known.withColumn("value", F.col("of")), there, k, True)
    below = following(known.withColumn("value", -F.col("of")), there.withColumn("value", -F.col("value")), k, False)
    sides = above.union(below).join(there.select("key", "tie", "value"), ["key", "tie"]).select("key", "of", "tie", F.abs(F.col("value") - F.col("of")).alias("gap"))
    silent = top_per_key(p.where("value is null"), ["key"], [F.col("tie").asc()], k).join(known, "key").select("key", "of", "tie", F.lit(None).cast("double").alias("gap"))
    first = top_per_key(p, ["key"], [F.col("tie").asc()], k).join(q.where("of is null"), "key").select("key", "of", "tie", F.lit(None).cast("double").alias("gap"))
    return top_per_key(sides.union(silent), ["key", "of"], by_gap(), k).union(first)


def by_gap() -> list[Column]:
    return [F.col("gap").asc_nulls_first(), F.col("tie").asc()]
