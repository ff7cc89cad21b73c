"""Exact similarity join of titles by the standard library's ratio: all pairs above a threshold, with two bounds in place of the ratio for nearly all pairs.

The ratio is 2m / (n_a + n_b), where the m matched characters are a common subsequence of both sides.  So titles as similar as ``least`` = r

* differ in length by a factor of (2 - r) / r at most: bins of the length's logarithm to that base only meet themselves and the next;
* have r (n_a + n_b) / 2 characters in common, counted with multiplicity: a product of two matrices of counts, in which rare characters share columns, is no less than that number;
* have a common subsequence as long as that, which is computed bit by bit in parallel.

Characters alone tell titles of one language hardly apart, so no key that a pair must share is rare, and pairs are not sent anywhere: a bin is dealt into cells of bounded size, the titles of two
cells meet in one task, and only pairs that pass all bounds leave it.  What is sent grows with titles times cells, what is written with similar pairs.

The ratio itself, which is not symmetric, is computed for what is left, in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.session import durable

_SLACK = 1e-9
#: Titles and characters of a cell, columns of the matrices of counts, and cells' pairs that get a partition of their own.
CELL, CELL_CHARS, COLUMNS, PARTS = 2000, 1 << 18, 512, 960
#: Characters of titles whose masks stand side by side, pairs of one step, and characters above which a title's subsequences are left to the ratio.
MASKED, STEP, LONG = 1 << 13, 1 << 15, 2048


def characters(title: Column) -> Column:
    """The characters of a text with their number of occurrence: a set that stands for the multiset."""
    each = F.regexp_extract_all(title, F.lit("(?s)."), F.lit(0))
    numbered = F.transform(F.array_distinct(each), lambda c: F.transform(F.sequence(F.lit(1), F.size(F.filter(each, lambda x: x == c))), lambda k: F.concat(c, k.cast("string"))))
    return F.flatten(numbered)


def bound(a: Column, b: Column) -> Column:
    """An upper bound of the ratio of two texts, by their ``characters``."""
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def counts(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of counts for each title, so that the product of two rows is no less than the number of characters in common.  ``flat``: the titles' characters end to end.  The most frequent characters,
    numbered by occurrence, have columns of their own, the rest share some."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((flat, rows))
    first = np.r_[True, (np.diff(rows[order]) != 0) | (np.diff(flat[order].astype(np.int64)) != 0)]
    at = np.arange(len(order))
    nth = at - np.maximum.accumulate(np.where(first, at, 0))
    _, symbol, often = np.unique(flat[order].astype(np.int64) << 32 | nth, return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
    own = COLUMNS * 3 // 4
    column = np.where(rank < own, rank, own + rank % (COLUMNS - own))[symbol]
    width = min(COLUMNS, len(often))
    column = column if len(often) > COLUMNS else rank[symbol]
    return np.bincount(rows[order] * width + column, minlength=len(sizes) * width).reshape(len(sizes), width).astype(np.float32)


def subsequences(left: list[np.ndarray], right: np.ndarray, i: np.ndarray, j: np.ndarray, symbols: int) -> np.ndarray:
    """Lengths of the longest common subsequences of ``left[i]`` and ``right[j]``: bits of a word stand for the left title's characters, and each character of the right one updates all of them.
    ``right`` is padded with ``symbols``, one above all characters' numbers."""
    held = np.unique(np.concatenate(left))
    local = np.full(symbols + 1, len(held))
    local[held] = np.arange(len(held))
    sizes = np.array([len(x) for x in left])
    words = -(-int(sizes.max()) // 64)
    at = np.concatenate([np.arange(n) for n in sizes])
    masks = np.zeros((words, len(left), len(held) + 1), np.uint64)
    np.bitwise_or.at(masks, (at // 64, np.repeat(np.arange(len(left)), sizes), local[np.concatenate(left)]), np.uint64(1) << (at % 64).astype(np.uint64))
    out = []
    for start in range(0, len(i), STEP):
        row, texts = i[start : start + STEP], local[right[j[start : start + STEP]]].T
        states = [np.full(len(row), ~np.uint64(0)) for _ in range(words)]
        for text in texts:
            carry = np.zeros(len(row), np.uint64)
            for w, state in enumerate(states):
                hit = state & masks[w, row, text]
                total = state + hit
                more = total + carry
                carry = ((total < state) | (more < total)).astype(np.uint64)
                states[w] = more | (state & ~hit)
        out.append(64 * words - sum(np.bitwise_count(state).astype(np.int64) for state in states))
    return np.concatenate(out)


def alike(left: list[str], right: list[str] | None, least: float) -> Iterator[tuple[str, str]]:
    """The pairs of a title of each side, or of two of the left ones, that pass all bounds."""
    both = left + (right or [])
    sizes = np.array([len(t) for t in both])
    symbols, flat = np.unique(np.frombuffer("".join(both).encode("utf-32-le"), "<u4"), return_inverse=True)
    rows, ends = counts(flat, sizes), np.cumsum(sizes)
    chars = [flat[e - n : e] for e, n in zip(ends, sizes)]
    low = len(left) if right is not None else 0
    short = np.flatnonzero(sizes[low:] <= LONG)
    padded = np.full((len(both) - low, int(sizes[low:][short].max(initial=0))), len(symbols))
    for k in short:
        padded[k, : sizes[low + k]] = chars[low + k]
    others, start = rows[low:].T.copy(), 0
    while start < len(left):
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start : len(left)]), MASKED, "right")))
        asked = least * (sizes[start:stop, None] + sizes[None, low:]) / 2 - _SLACK
        i, j = np.nonzero((rows[start:stop] @ others >= asked) & (np.minimum(sizes[start:stop, None], sizes[None, low:]) >= asked))
        if right is None:
            i, j = i[i + start < j], j[i + start < j]
        known = (sizes[start + i] <= LONG) & (sizes[low + j] <= LONG)
        good = ~known
        if known.any():
            table = [chars[k] if sizes[k] <= LONG else chars[k][:1] for k in range(start, stop)]
            good[known] = subsequences(table, padded, i[known], j[known], len(symbols)) >= asked[i[known], j[known]]
        for a, b in zip(start + i[good], low + j[good]):
            yield (both[a], both[b]) if (sizes[a], both[a]) < (sizes[b], both[b]) else (both[b], both[a])
        start = stop


def candidates(titles: DataFrame, least: float = T.FUZZY) -> DataFrame:
    """(a, b), each unordered pair of distinct non-empty titles once, that passes all bounds at ``least``; a has no more characters than b."""
    size = F.length("title")
    bin_ = F.floor(F.log(size.cast("double")) / math.log((2 - least) / least) + _SLACK).cast("int") if least < 1 else size
    held = titles.select("title").where(F.coalesce(F.col("title") != "", F.lit(False))).distinct().withColumn("bin", bin_)
    held = durable(held, "titles")
    cells = held.groupBy("bin").agg(F.ceil(F.greatest(F.count("*") / CELL, F.sum(size) / CELL_CHARS)).cast("int").alias("cells"))
    many = {r.bin: r.cells for r in cells.collect()}  # a row for each length's bin
    groups = sum(n * (n + 1) // 2 + n * many.get(b + 1, 0) for b, n in many.items())
    for name, step in (("cells", 0), ("above", -1), ("below", 1)):
        held = held.join(F.broadcast(cells.select((F.col("bin") + step).alias("bin"), F.col("cells").alias(name))), "bin", "left")
    cell, none = F.pmod(F.xxhash64("title"), F.col("cells")).cast("int"), F.array().cast("array<int>")
    upto = lambda first, end: F.when(end > first, F.sequence(first, end - 1)).otherwise(none)
    meet = lambda low, left, high, right, is_left: F.struct(low.alias("low"), left.alias("left"), high.alias("high"), right.alias("right"), F.lit(is_left).alias("is_left"))
    own, zero = F.col("bin"), F.lit(0)
    dealt = held.withColumn("cell", cell)
    cell = F.col("cell")
    meets = F.concat(
        F.transform(upto(cell, F.col("cells")), lambda k: meet(own, cell, own, k, True)), F.transform(upto(zero, F.col("above")), lambda k: meet(own, cell, own + 1, k, True)),
        F.transform(upto(zero, cell), lambda k: meet(own, k, own, cell, False)), F.transform(upto(zero, F.col("below")), lambda k: meet(own - 1, k, own, cell, False)),
    )
    keys = ["low", "left", "high", "right"]
    dealt = dealt.select("title", F.explode(meets).alias("m")).select(*(f"m.{k}" for k in keys), "m.is_left", "title").repartition(max(1, min(groups, PARTS)), *keys)

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        left = table.filter(table["is_left"])["title"].to_pylist()
        alone = key[0] == key[2] and key[1] == key[3]
        right = None if alone else table.filter(pc.invert(table["is_left"]))["title"].to_pylist()
        pairs = list(alike(left, right, least)) if left and (alone or right) else []
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.string()), "b": pa.array([b for _, b in pairs], pa.string())})

    return dealt.groupBy(*keys).applyInArrow(compare, "a string, b string")


def similar(titles: DataFrame, least: float = T.FUZZY) -> DataFrame:
    """(a, b, ratio) of all ordered pairs of distinct titles with at least that ratio; null and empty titles have no partner.  ``titles``: a column title; repeated ones count once."""
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    pairs = durable(candidates(titles, least), "pairs")
    both = pairs.union(pairs.select("b", "a"))
    return both.withColumn("ratio", T.similarity("a", "b")).where(F.col("ratio") >= least)
