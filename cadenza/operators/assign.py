"""Ordered assignment of things that only one may have: the result of letting everyone choose in turn, without taking turns.

All ask for their first wish at once.  A thing goes to the earliest who asks; who loses goes on to the next wish that nobody earlier holds, which may displace a later holder,
who goes on in turn.  Whoever displaces whom is known before anything moves: each holder points to the one that its own next wish would displace.  So a round follows
these pointers from all losers at once, by doubling them (to the one after, the fourth, the eighth ...), and moves everybody on the way by one wish.  A chain of n displacements takes one round of log2(n)
doublings instead of n rounds.  A thing's holder only ever gets earlier, so the order of moves changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import scratch


def assign(wishes: DataFrame, rounds: int = 64) -> tuple[DataFrame, int]:
    """(who, what) of everyone that gets something, and how many rounds and doublings it took.

    ``wishes``: who, ord (the turn; of equals the smaller who), what, place (the order of one's wishes, of equals the smaller what).  Rows with a null who or what wish nothing.  RuntimeError if
    ``rounds`` rounds do not settle it.
    """
    by_place = Window.partitionBy("who").orderBy("place", "what")
    listed = wishes.select("who", "ord", "what", "place").where(F.col("who").isNotNull() & F.col("what").isNotNull())
    listed, _ = scratch(listed.withColumn("place", F.row_number().over(by_place)), "wishes")
    held, drop_held = scratch(listed.where("place = 1"), "held")
    turn, steps = F.struct("ord", "who"), 0
    for _ in range(rounds):
        steps += 1
        first, drop_first = scratch(held.groupBy("what").agg(F.min(turn).alias("by")), "first")
        reached, drop_reached = scratch(held.join(first, "what").where(turn != F.col("by")).select("who"), "reached")
        if reached.isEmpty():
            drop_first()
            drop_reached()
            return held.select("who", "what"), steps
        later = held.select("who", F.col("place").alias("now")).join(listed, "who").where(F.col("place") > F.col("now")).join(first, "what", "left")
        open_ = later.where(F.col("by").isNull() | (F.col("by") > turn)).groupBy("who", "ord").agg(F.min(F.struct("place", "what", F.col("by.who").alias("to"))).alias("next"))
        following, drop_following = scratch(open_.select("who", "ord", "next.*"), "following")
        jump, drop_jump = following.where("to is not null").select("who", "to"), lambda: None
        while True:  # the logarithm of the longest chain
            steps += 1
            more = reached.join(jump, "who").select(F.col("to").alias("who")).distinct().join(reached, "who", "left_anti")
            wider, drop_wider = scratch(reached.withColumn("new", F.lit(False)).unionByName(more.withColumn("new", F.lit(True))), "reached")
            drop_reached()
            reached, drop_reached = wider.select("who"), drop_wider
            if wider.where("new").isEmpty():
                break
            doubled, drop_doubled = scratch(jump.alias("a").join(jump.alias("b"), F.col("a.to") == F.col("b.who")).select("a.who", "b.to"), "jump")
            drop_jump()
            jump, drop_jump = doubled, drop_doubled
        moved = held.join(reached, "who", "left_anti").unionByName(following.select("who", "ord", "what", "place").join(reached, "who", "left_semi"))
        after, drop_after = scratch(moved, "held")
        for drop in (drop_first, drop_reached, drop_following, drop_jump, drop_held):
            drop()
        held, drop_held = after, drop_after
    raise RuntimeError(f"not settled in {rounds} rounds")
