"""Two-way reconciliation of a wanted set with a held set that knows where its members came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OURS, BEFORE = "ours", "preexisting"


def plan(wanted: DataFrame, held: DataFrame, provenance: DataFrame, key: str = "key") -> DataFrame:
    """``key`` and op: ADD what is wanted and not held; REMOVE what is held, no longer wanted and ours; PULL what is held, not wanted and anyone
    else's, unknown provenance included.  Keys in both sets need nothing."""
    w, h = wanted.select(key).distinct(), held.select(key).distinct()
    add = w.join(h, key, "left_anti").withColumn("op", F.lit("ADD"))
    rest = h.join(w, key, "left_anti").join(provenance.groupBy(key).agg(F.min("source").alias("source")), key, "left")
    return add.unionByName(rest.select(key, F.when(F.col("source").eqNullSafe(OURS), "REMOVE").otherwise("PULL").alias("op")))


def counts() -> dict[str, Column]:
    """Aggregates that count each branch of a plan."""
    return {op.lower(): F.count_if(F.col("op") == op) for op in ("ADD", "REMOVE", "PULL")}


def funnel(planned: DataFrame) -> DataFrame:
    """Counts of each branch in one row."""
    return planned.agg(*(c.alias(n) for n, c in counts().items()))


def next_state(state: DataFrame, planned: DataFrame, writes_enabled: bool, now: str, key: str = "key") -> DataFrame:
    """Side rows after a run: provenance never changes once set, membership flags are kept where the run says nothing, the last error always
    follows the run, and the stamp follows success.  ``planned`` rows may carry ``error``.  With writes off, rows only say ``planned``."""
    errors = F.col("error") if "error" in planned.columns else F.lit(None).cast("string")
    run = planned.select(key, "op", errors.alias("run_error"))
    joined = state.join(run, key, "full_outer")
    ok = F.col("op").isNotNull() & F.col("run_error").isNull()
    held = F.when(ok & F.col("op").isin("ADD", "PULL"), True).when(ok & (F.col("op") == "REMOVE"), False)
    return joined.select(
        key,
        F.coalesce("source", F.when(F.col("op") == "ADD", OURS).when(F.col("op") == "PULL", BEFORE)).alias("source"),
        F.coalesce(F.when(F.col("run_error").isNotNull(), "failed").when(ok & F.lit(writes_enabled), "synced").when(F.col("op").isNotNull() & F.lit(not writes_enabled), "planned"), "state", F.lit("pending")).alias("state"),
        F.coalesce(held if writes_enabled else F.lit(None).cast("boolean"), "in_library").alias("in_library"),
        F.when(F.col("op").isNotNull(), F.col("run_error")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(ok & F.lit(writes_enabled), F.to_timestamp(F.lit(now))).otherwise(F.col("last_synced_at")).alias("last_synced_at"),
    )
