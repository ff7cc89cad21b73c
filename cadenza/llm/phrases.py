"""Phrase collocations by hierarchical pair naming.

Texts are cut into blocks of one language, about ``BLOCK_BYTES`` each, and a block's words are numbered inside it.  Level by level:

1. What occurs at a place is a k-gram: at level 1 a word, above it the pair of the (k-1)-grams at the place and the next one.  A block sends each
   of its distinct k-grams once, with a count; counts are summed over all blocks.
2. K-grams with ``least`` occurrences or more are given an id where all their rows meet, and the ids come back to the blocks that hold
   them, as numbers of the block's own k-grams.  A pair (left id, right id) with a part that isn't frequent can't be frequent, so nothing is lost.
3. A frequent k-gram's row keeps left and right, which are its parents: its first and last k-1 words.  Along them it gets its words and the counts of all its
   beginnings and ends, so every cut of a phrase is looked up in its own row; and what a longer phrase subsumes are its two parents, as a phrase that holds
   a shorter one also holds one that is longer by one word, with a count between theirs.

So what is shuffled are distinct k-grams of blocks, never the words at all places, and no task sees more than a block's or one k-gram's rows (those are summed
before the shuffle).  A block is written as a row for each distinct k-gram and rows of ``CHUNK`` numbers each, as a row that held a whole block would be a page of its own in Parquet, which Spark keeps
several times over in an executor's memory.  Scores are exact: decimals of 38 digits, enough for counts up to 10 ** 16.

A piece never crosses a text or one of ``SEPARATORS``; A-Z are lower-cased, words are ``[^\\x20\\x09]+``.  Null texts are empty, a null language is
``und``; repeated rows count each; ids aren't looked at and extra columns are ignored.  A long text is a block of its own.  Without frequent phrases the result is empty.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, long_rows, output, scratch, steps, word_spans

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
LONGEST, LEAST, SUBSUMED, TOP = 3, 10, 50, 2000
#: Text in a block, and text that a task holds for unfinished blocks.
BLOCK_BYTES, HELD_BYTES = 4 << 20, 16 << 20
#: Numbers of places in a row.
CHUNK = 4096
#: Parts of a language that are cut to their first rows apart, before the last cut.
SALTS = 64
_LOWER = np.frombuffer(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)), np.uint8)
_CUTS = np.isin(np.arange(256), np.frombuffer(SEPARATORS, np.uint8))
_WORD = ~_CUTS & ~np.isin(np.arange(256), [9, 32])


def coded(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, how often each occurs, and the words' numbers place by place, with -1 between pieces."""
    data = _LOWER[data]
    starts, ends, owner = word_spans(data, offsets, _WORD)
    inside = np.r_[0, np.cumsum(ends - starts)]
    if inside[-1] >= 1 << 31:
        raise ValueError("a text of 2 GB or more")
    words = pa.StringArray.from_buffers(starts.size, pa.py_buffer(inside.astype(np.int32)), pa.py_buffer(data[_WORD[data]])).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int32)
    piece = np.searchsorted(np.flatnonzero(_CUTS[data]), starts)
    apart = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
    return words.dictionary, np.bincount(codes, minlength=len(words.dictionary)), np.insert(codes, np.flatnonzero(apart) + 1, -1)


def rows_of(schema: pa.Schema, block: int, codes: np.ndarray, grams: dict, **same) -> Iterator[pa.RecordBatch]:
    """A block's rows: one for each distinct k-gram, with its number and ``grams``, then the numbers place by place, ``CHUNK`` in a row, with the row's number among these."""
    n = len(grams["count"])
    for size, own in ((n, grams), (-(-codes.size // CHUNK), {"codes": pa.ListArray.from_arrays(pa.array(np.r_[0 : codes.size : CHUNK, codes.size], pa.int32()), pa.array(codes, pa.int32()))})):
        if size:
            first = {"block": np.full(size, block, np.int64), "number": np.arange(size, dtype=np.int32)} | {k: pa.repeat(v, size) for k, v in same.items()}
            yield output(schema, **{f.name: pa.nulls(size, f.type) for f in schema} | first | own)


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, lang, number, word and count of every distinct word of a block, and block, lang, number and codes of its places (see ``rows_of``)."""
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("number", pa.int32()), ("word", pa.string()), ("count", pa.int64()), ("codes", pa.list_(pa.int32()))])

    def made(block: int, name: str, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        words, counts, codes = coded(*column_bytes(pa.concat_arrays(texts)))
        return rows_of(schema, block, codes, {"word": words, "count": counts}, lang=name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}
        block = itertools.count(TaskContext.get().partitionId() << 33)
        for part in steps(batches, "text", block_bytes):
            names = part.column("lang").dictionary_encode()
            for k, name in enumerate(names.dictionary.to_pylist()):
                texts = part.column("text").filter(pa.compute.equal(names.indices, k))
                held.setdefault(name, []).append(texts)
                size[name] = size.get(name, 0) + int(np.diff(column_bytes(texts)[1][[0, -1]])[0])
                if size[name] >= block_bytes:
                    yield from made(next(block), name, held.pop(name))
                    del size[name]
            if sum(size.values()) > HELD_BYTES:  # many languages
                for name in [*held]:
                    yield from made(next(block), name, held.pop(name))
                size = {}
        for name in [*held]:
            yield from made(next(block), name, held.pop(name))

    picked = long_rows(docs).select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return picked.mapInArrow(run, "block long, lang string, number int, word string, count long, codes array<int>")


def paired(codes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left and right ids, counts, and the numbers place by place (-1 between runs) of the pairs of neighbours; ``ids`` by number, -1 without one."""
    known = np.full(codes.size, -1, np.int64)
    known[codes >= 0] = np.where(ids[codes[codes >= 0]] >= 0, codes[codes >= 0], -1)
    both = (known[:-1] >= 0) & (known[1:] >= 0)
    pair = known[:-1][both] * (ids.size + 1) + known[1:][both]
    distinct, numbers, counts = np.unique(pair, return_inverse=True, return_counts=True)
    at = np.flatnonzero(both)
    gap = np.flatnonzero(np.diff(at) > 1) + 1
    return ids[distinct // (ids.size + 1)], ids[distinct % (ids.size + 1)], counts, np.insert(numbers.astype(np.int32), gap, -1)


def next_level(held: DataFrame, hits: DataFrame) -> DataFrame:
    """block, number, left, right and count of every distinct pair of a block, and block, number and codes of its places (see ``rows_of``); ``hits``: block, number and id of frequent k-grams, no more of a block than it has distinct ones."""
    schema = pa.schema([("block", pa.int64()), ("number", pa.int32()), ("left", pa.int64()), ("right", pa.int64()), ("count", pa.int64()), ("codes", pa.list_(pa.int32()))])

    def pairs(block: pa.Table, named: pa.Table) -> pa.Table:
        if not block.num_rows or not named.num_rows:
            return schema.empty_table()
        codes = block.sort_by("place").column("codes").combine_chunks().flatten().to_numpy()
        ids = np.full(int(codes.max(initial=-1)) + 1, -1, np.int64)
        ids[named.column("number").to_numpy()] = named.column("id").to_numpy()
        left, right, counts, after = paired(codes, ids)
        return pa.Table.from_batches(rows_of(schema, block.column("block")[0].as_py(), after, {"left": left, "right": right, "count": counts}), schema)

    both = held.where("codes IS NOT NULL").select("block", F.col("number").alias("place"), "codes").groupBy("block").cogroup(hits.select(F.col("block").alias("of"), "number", "id").groupBy("of"))
    return both.applyInArrow(pairs, "block long, number int, left long, right long, count long, codes array<int>")


def numbered(wide: DataFrame, key: list[str], least: int) -> DataFrame:
    """block, number, key, a and id of the k-grams with ``least`` occurrences or more in all blocks, a row for each block that holds one; at: the row's own number, which is the id in one of a k-gram's rows.

    The rows are dealt once, for the count as well as for the ids; a k-gram has no more of them than there are blocks."""
    same = Window.partitionBy(*key)
    dealt = wide.repartition(*key).withColumn("at", F.monotonically_increasing_id())
    return dealt.select("block", "number", *key, "at", F.sum("count").over(same).alias("a"), F.min("at").over(same).alias("id")).where(F.col("a") >= least)


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, block_bytes: int = BLOCK_BYTES) -> tuple[list[DataFrame], DataFrame, list]:
    """By length from 1 on, the frequent k-grams (id, lang, words, a, heads, tails and, above words, left and right); lang and n of all languages; and what empties the tables.

    heads and tails: the counts of the first and last 1, 2, ... words."""
    held, drop_held = scratch(blocks(docs, text, lang, block_bytes), "blocks")
    wide = held.where("codes IS NULL").drop("codes")
    totals, drop_totals = scratch(wide.groupBy("lang").agg(F.sum("count").alias("n")), "totals")
    levels, drops, one = [], [drop_totals], F.array(F.col("a"))
    for k in range(1, longest + 1):
        key = ["lang", "word"] if k == 1 else ["left", "right"]
        named, drop_named = scratch(numbered(wide, key, least), "named") if k < longest else (wide.groupBy(*key).agg(F.sum("count").alias("a")).where(F.col("a") >= least).withColumn("id", F.monotonically_increasing_id()), None)
        found = named.where("id = at").select("id", *key, "a") if k < longest else named
        if k == 1:
            found = found.select("id", "lang", F.array("word").alias("words"), "a", one.alias("heads"), one.alias("tails"))
        else:
            parents = [levels[-1].select(F.col("id").alias(side), *more) for side, more in (("left", ["lang", F.col("words").alias("words_l"), "heads"]), ("right", [F.element_at("words", -1).alias("word_r"), "tails"]))]
            found = found.join(parents[0], "left").join(parents[1], "right")
            found = found.select("id", "left", "right", "lang", F.concat("words_l", F.array("word_r")).alias("words"), "a", F.concat("heads", one).alias("heads"), F.concat("tails", one).alias("tails"))
        level, drop = scratch(found, "level")
        levels.append(level)
        drops.append(drop)
        if k < longest:
            after, drop_after = scratch(next_level(held, named.select("block", "number", "id")), "pairs")
            drop_held()
            drop_named()
            held, drop_held = after, drop_after
            wide = held.where("codes IS NULL").drop("codes")
    drop_held()
    return levels, totals, drops


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    exact = lambda c: c.cast("decimal(19,0)")
    over = (exact(a) * exact(a)).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), (exact(left) * exact(right)).cast("decimal(38,0)"))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n and score of the first ``top`` phrases of every language, written."""
    levels, totals, drops = frequent(docs, text, lang, longest, least, block_bytes)
    rows = []
    for k, level in enumerate(levels[1:], 2):
        cuts = F.array(*(F.struct(cut_score(F.col("a"), F.col("heads")[i - 1], F.col("tails")[k - i - 1]).alias("score"), F.lit(i).alias("cut"), F.col("heads")[i - 1].alias("l"), F.col("tails")[k - i - 1].alias("r")) for i in range(1, k)))
        scored = level.select("id", "lang", F.array_join("words", " ").alias("phrase"), "a", F.array_min(cuts).alias("cut"))
        if k < len(levels):
            longer = levels[k]
            most = longer.select(F.col("left").alias("id"), F.col("a").alias("of")).union(longer.select("right", "a")).groupBy("id").agg(F.max("of").alias("of"))
            scored = scored.join(most, "id", "left").where(F.coalesce(100 * F.col("of") < subsumed * F.col("a"), F.lit(True)))
        rows.append(scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    every = rows[0]
    for more in rows[1:]:
        every = every.union(more)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    every = every.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    every = every.withColumn("rank", place("lang", "salt")).where(F.col("rank") <= top).withColumn("rank", place("lang")).where(F.col("rank") <= top)
    found, _ = scratch(every.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    for drop in drops:
        drop()
    return found
