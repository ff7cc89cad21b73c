"""Keyed merges: functions of a target and a source to a new target, with a rule for each column.

Plain tables can't be updated in place, so the caller writes the new target and swaps it in.  A source that repeats a key is
reduced to its last row by ``ordinal`` first.  Presence is a flag, never a null test: a rule that overwrites also
copies nulls.
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.rank import best_per_key


class Rule(Enum):
    OVERWRITE = "the source's value, null included"
    KEEP = "the target's value once its row is there"
    COALESCE = "the source's value unless it is null"
    MAP_MERGE = "both maps, the source's entries first"
    STAMP = "the source's value if another column changed, else the target's"


def last_wins(source: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return best_per_key(source, keys, F.col(ordinal), descending=True)


def _merged(rule: Rule, old: Column, new: Column, both: Column, has_new: Column, changed: Column) -> Column:
    if rule is Rule.MAP_MERGE:
        extra = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
        value = F.coalesce(F.map_concat(extra, new), old, new)
    else:
        value = {Rule.OVERWRITE: new, Rule.KEEP: old, Rule.COALESCE: F.coalesce(new, old), Rule.STAMP: F.when(changed, new).otherwise(old)}[rule]
    return F.when(both, value).when(has_new, new).otherwise(old)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, Rule], when: Column | None = None, changed_flag: str | None = None) -> DataFrame:
    """Rows of either side by key.  ``rules``: of the columns that the source has; other columns of the target stay, and are null in new rows.

    ``when`` (over columns t_<name> and s_<name>) limits updates of rows on both sides.  ``changed_flag`` names a boolean column that tells rows which
    this merge inserted or changed.
    """
    t = target.select(*(F.col(c).alias(f"t_{c}") for c in target.columns), F.lit(True).alias("_t"))
    s = source.select(*(F.col(c).alias(f"s_{c}") for c in (*keys, *rules)), F.lit(True).alias("_s"))
    on = [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys]
    joined = t.join(s, on, "full_outer")
    has_old, has_new = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    both = has_old & has_new & (F.lit(True) if when is None else F.coalesce(when, F.lit(False)))
    plain = [c for c in rules if rules[c] not in (Rule.STAMP, Rule.KEEP)]
    changed = F.lit(False)
    for c in plain:
        new = _merged(rules[c], F.col(f"t_{c}"), F.col(f"s_{c}"), both, has_new & ~has_old, F.lit(True))
        if rules[c] is Rule.MAP_MERGE:
            entries = lambda m: F.array_sort(F.map_entries(m))
            changed = changed | ~entries(new).eqNullSafe(entries(F.col(f"t_{c}")))
        else:
            changed = changed | ~new.eqNullSafe(F.col(f"t_{c}"))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(has_old, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
        elif c in rules:
            out.append(_merged(rules[c], F.col(f"t_{c}"), F.col(f"s_{c}"), both, has_new & ~has_old, changed).alias(c))
        else:
            out.append(F.col(f"t_{c}").alias(c))
    if changed_flag:
        out.append((has_new & (~has_old | (both & changed))).alias(changed_flag))
    return joined.select(*out)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], ordinal: str | None = None, within: Column | None = None) -> DataFrame:
    """The target and the first row of each key that it lacks.  ``within``: only target rows for which it holds block an insert."""
    return target.unionByName(new_rows(target, source, keys, ordinal, within).select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, keys: list[str], ordinal: str | None = None, within: Column | None = None) -> DataFrame:
    """What ``insert_ignore`` would insert (and a database would return)."""
    rest = [c for c in source.columns if c not in keys]
    first = best_per_key(source, keys, F.col(ordinal) if ordinal else F.struct(*rest)) if ordinal or rest else source.select(*keys).distinct()
    held = target if within is None else target.where(within)
    return first.join(held.select(*keys).distinct(), keys, "left_anti")


def prune(target: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in ``keep``; none for an empty one."""
    return target.join(keep.select(*keys).distinct(), keys, "left_semi")


def replace_where(target: DataFrame, batch: DataFrame, keys: list[str], scope: Column) -> DataFrame:
    """Delete the target's rows in ``scope`` with a key of the batch, then add the batch."""
    doomed = target.where(scope).join(batch.select(*keys).distinct(), keys, "left_semi")
    stays = target.where(~F.coalesce(scope, F.lit(False))).unionByName(target.where(scope).join(doomed.select(*keys).distinct(), keys, "left_anti"))
    return stays.unionByName(batch.select(*target.columns))


def singleton(target: DataFrame, source: DataFrame, order: Column) -> DataFrame:
    """A table of one row: the source's newest one with all its fields, or what was there if it has none."""
    newest = source.agg(F.max_by(F.struct(*target.columns), order).alias("new")).where("new is not null").select("new.*")
    none = newest.agg((F.count("*") == 0).alias("_none"))  # one row
    return newest.unionByName(target.join(F.broadcast(none), F.col("_none")).drop("_none"))


def update_keyed(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Overwrite ``columns`` of rows with a key in the source; never inserts."""
    s = source.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = target.join(s, keys, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns))


def append_positions(items: DataFrame, source: DataFrame, key: str, ordinal: str, position: str = "position") -> DataFrame:
    """The source's rows that ``items`` lacks, numbered after its highest position in the order of ``ordinal``."""
    from cadenza.operators.rank import positions

    fresh = positions(new_rows(items, source, [key], ordinal), [ordinal, key], position)
    base = items.agg(F.coalesce(F.max(position), F.lit(-1)) + 1).first()[0]  # one number
    return fresh.withColumn(position, F.col(position) + base)
