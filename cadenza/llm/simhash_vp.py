"""SimHash near-duplicates: exact pairs by vantage-point trees over the distinct fingerprints.

1. A fingerprint per text: a bit is set if it is set in over half of the XXH64 (seed 42) of its word shingles.
2. Documents with one fingerprint are one class, so groups of copies collapse before anything is compared.
3. A vantage-point tree over a bounded, hashed sample of fingerprints cuts Hamming space into shards.  A fingerprint
   goes to each shard that the ball of radius ceil(limit / 2) around it touches (triangle bound).  Two fingerprints
   within ``limit`` have a midpoint within that radius of both, so they meet in the midpoint's shard.  Splits are
   chosen among several vantage points for few boundary rows.
4. In a shard the same recursion goes on down to small leaves, where all pairs are compared.  A leaf emits, for each
   fingerprint with a partner, a link to the smallest of its local component, so links stay linear in the rows.
5. Components of the links by large-star and small-star rounds, each written to the shared folder.

Null, empty and blank texts have fingerprint zero and link like any other.  Repeated rows with one id are one
document if their texts agree; else each row has its own fingerprint and is judged by it.  Null ids are kept, and never become
the smallest id of a component unless all its ids are null.  Extra columns are ignored.

``similar_documents`` links by the Jaccard similarity of shingle sets instead.  Texts with one set are one class.  Links of the
tree above and shared shingles give candidates, and only pairs whose sets are similar enough stay:

1. Two sets of similarity t share one of the first n - ceil(t n) + 1 shingles of each in any common order (n is the
   set's size), so the classes that share such a shingle (a block) hold all pairs.  Shingles frequent in a sample come last in the
   order, which keeps blocks small; it changes no result.
2. Of a pair, the counts of its sets' shingles in a few hundred cells differ by no more than there are shingles in
   one set only; that drops most pairs whose sets aren't similar before the sets are fetched and compared.
3. Links of the tree, and of each class to the smallest of the few of its blocks that share most with it, are verified and give components.
4. In blocks that hold several components, pairs across components are verified, unless counts in a few coarse cells tell them apart, or what follows their first common shingle in
   the order can't be enough: the smaller of two similar sets has it among its first n - ceil(2 t / (1 + t) n) + 1.  So components are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, long_rows, materialize, mix, output, own_name, scratch, span_hashes, steps, word_spans
from cadenza.operators import rank

SHINGLE, LIMIT = 3, 2
#: Fingerprints that the driver sees (about so many, chosen by a hash) to place the shards' vantage points, how many (of all) a shard is to get, and the least of the
#: sample in a shard.
SAMPLE, PER_SHARD, LEAST = 32_768, 1_024, 8
#: A leaf of this size or less compares all its pairs.
LEAF = 256
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: One of so many classes is in the sample of shingles; those in so many sampled classes are frequent, and so many of them are told apart.
SHINGLES_OF, FREQUENT, MOST_FREQUENT = 8, 4, 1 << 18
#: Smallest classes of its blocks that a class is compared with first, those of the most blocks; the rest is up to the step that compares across components.
HUBS = 4
#: Cells of a class in which its shingles are counted, and coarse ones for a first look.
CELLS, COARSE = 256, 64
_WORD_BYTE = np.array([not bytes([b]).isspace() for b in range(256)])


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Of one text's UTF-8 bytes; zero without a word."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    last = max(1, len(words) - size + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(last)), np.uint64, last)
    votes = np.zeros(64, np.int64)
    for low in range(0, last, 1 << 16):
        votes += np.unpackbits(hashes[low : low + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > last, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """``key``, ``fp`` (64 bits as a signed long) and a hash of the text for every row."""
    schema = pa.schema([(key, pa.int64()), ("fp", pa.int64()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            values = np.array([fingerprint((t or "").encode(), size) for t in part.column("text").to_pylist()], np.uint64)
            yield output(schema, **{key: part.column(key), "fp": values.view(np.int64), "text_hash": part.column("text_hash")})

    return long_rows(docs).select(F.col(key).cast("long").alias(key), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).mapInArrow(run, f"{key} long, fp long, text_hash long")


def split(values: np.ndarray, radius: int, rng: np.random.Generator, tries: int = 12) -> tuple[int, int] | None:
    """A vantage point and the largest distance that counts as inside: few rows near the boundary, no side under a quarter if it can be."""
    best = None
    for vantage in values[rng.integers(0, values.size, tries)]:
        below = np.cumsum(np.bincount(np.bitwise_count(values ^ vantage), minlength=65)) / values.size
        for most in np.flatnonzero((below >= 0.2) & (below <= 0.8)):
            crossing = below[min(64, most + radius)] - (below[most - radius] if most >= radius else 0)
            cost = crossing + 0.25 * abs(below[most] - 0.5)
            if best is None or cost < best[0]:
                best = cost, int(vantage), int(most)
    return best and best[1:]


def shard_tree(sample: np.ndarray, radius: int, per_shard: int = PER_SHARD, seed: int = 7) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, inside up to, child inside, child outside); a negative child -k - 1 is shard k.  Empty: one shard."""
    rng, nodes, shards = np.random.default_rng(seed), [], 0

    def grow(values: np.ndarray) -> int:
        nonlocal shards
        cut = split(values, radius, rng) if values.size > per_shard else None
        if cut is None:
            shards += 1
            return -shards
        near = np.bitwise_count(values ^ np.uint64(cut[0])) <= cut[1]
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        nodes[at] = (*cut, grow(values[near]), grow(values[~near]))
        return at

    grow(sample)
    return nodes


def route(values: np.ndarray, nodes: list[tuple[int, int, int, int]], radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions in ``values``) for every shard that a ball of ``radius`` around a value touches."""
    todo = [(0 if nodes else -1, np.arange(values.size))]
    while todo:
        at, rows = todo.pop()
        if not rows.size:
            continue
        if at < 0:
            yield -at - 1, rows
            continue
        vantage, most, inside, outside = nodes[at]
        d = np.bitwise_count(values[rows] ^ np.uint64(vantage)).astype(np.int64)
        todo += [(inside, rows[d - radius <= most]), (outside, rows[d + radius > most])]


def leaf_pairs(values: np.ndarray, limit: int, rng: np.random.Generator, leaf: int = LEAF) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs of ``values`` within ``limit`` (some more than once), by vantage-point recursion."""
    radius = -(-limit // 2)
    todo = [np.arange(values.size)]
    while todo:
        rows = todo.pop()
        cut = split(values[rows], radius, rng, 6) if rows.size > leaf else None
        if cut is not None:
            d = np.bitwise_count(values[rows] ^ np.uint64(cut[0])).astype(np.int64)
            near, far = rows[d - radius <= cut[1]], rows[d + radius > cut[1]]
            if max(near.size, far.size) < 0.95 * rows.size:
                todo += [near, far]
                continue
        for low in range(0, rows.size, 256):
            block = rows[low : low + 256]
            i, j = np.nonzero(np.bitwise_count(values[block][:, None] ^ values[rows[low:]][None, :]) <= limit)
            apart = i < j
            yield block[i[apart]], rows[low:][j[apart]]


def local_links(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, smallest value of its component among ``values``) for each value that has a partner and isn't the smallest."""
    values = np.unique(values)
    parent, rng = np.arange(values.size), np.random.default_rng(11)
    for a, b in leaf_pairs(values.view(np.uint64), limit, rng):
        while a.size:  # hook the larger root to the smaller, then compress, until both sides agree
            ra, rb = parent[a], parent[b]
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := parent[parent], parent):
                parent = up
    child = np.flatnonzero(parent != np.arange(values.size))
    return values[child], values[parent[child]]


def links(distinct: DataFrame, limit: int = LIMIT, sample: int = SAMPLE, per_shard: int = PER_SHARD) -> DataFrame:
    """Links (a, b), b < a, that connect exactly the distinct fingerprints of column ``fp`` joined by chains of pairs within ``limit``."""
    spark, radius = distinct.sparkSession, -(-limit // 2)
    n = distinct.count()
    chosen = F.pmod(F.xxhash64("fp"), F.lit(1 << 40)) < math.ceil((1 << 40) * min(1.0, sample / max(1, n)))  # so about ``sample`` of all, whatever the number of partitions
    seen = np.sort(distinct.where(chosen).select("fp").toArrow().column("fp").to_numpy())
    few = max(LEAST, math.ceil(seen.size * per_shard / max(1, n)))
    nodes = shard_tree(seen.view(np.uint64), radius, few)
    tree = spark.sparkContext.broadcast(nodes)
    routed, linked = pa.schema([("shard", pa.int32()), ("fp", pa.int64())]), pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for shard, rows in route(values.view(np.uint64), tree.value, radius):
                yield output(routed, shard=np.full(rows.size, shard, np.int32), fp=values[rows])

    def pairs(table: pa.Table) -> pa.Table:
        a, b = local_links(table.column("fp").to_numpy(), limit)
        return pa.table({"a": a, "b": b}, linked)

    return distinct.select("fp").mapInArrow(deal, "shard int, fp long").groupBy("shard").applyInArrow(pairs, "a long, b long").distinct()


def _stamp(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) with the smallest reachable node, for every node of the links (a, b); alternating large and small stars."""
    edges, drop = scratch(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    stamp = _stamp(edges)
    for _ in range(rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        after, drop_after = scratch(small.distinct(), "stars")
        before, stamp = stamp, _stamp(after)
        drop()
        edges, drop = after, drop_after
        if stamp == before:
            break
    else:
        raise RuntimeError("the components have not settled")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _fingerprint_components(docs: DataFrame, text: str, key: str, size: int, limit: int, sample: int) -> DataFrame:
    """``key``, fp, text_hash and component_id of every row."""
    marked = materialize(fingerprints(docs, text, key, size), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = components(links(distinct, limit, sample))
    classes = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(key, "fp", "text_hash", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE, limit: int = LIMIT, sample: int = SAMPLE) -> DataFrame:
    """``key``, fp and component_id (smallest ``key`` reachable over links of at most ``limit`` bits) for every row."""
    return _fingerprint_components(docs, text, key, size, limit, sample).drop("text_hash")


def _first_of_each(docs: DataFrame, found: DataFrame, text: str, key: str) -> DataFrame:
    """``docs`` without the rows (by id and text) that ``found`` puts into a component under another id."""
    of_key, of_hash = own_name(docs, "of_key"), own_name(docs, "of_hash")
    gone = found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(of_key), F.col("text_hash").alias(of_hash)).distinct()
    return docs.join(gone, (F.col(key).cast("long") == F.col(of_key)) & (F.xxhash64(text) == F.col(of_hash)), "left_anti")


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE, limit: int = LIMIT, sample: int = SAMPLE) -> DataFrame:
    """The document with the smallest id of each component, in the columns of ``docs``.  Rows with a null id stay.  Rows that repeat an id with one text stay or go
    together; rows of one id with different texts are judged apart."""
    return _first_of_each(docs, _fingerprint_components(docs, text, key, size, limit, sample), text, key)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles' hashes of each text, ascending, and the n + 1 bounds; a text of fewer words has one shingle."""
    data, offsets = column_bytes(column)
    data = np.frombuffer(_LOWER, np.uint8)[data]
    starts, ends, owner = word_spans(data, offsets, _WORD_BYTE)
    words, bounds = span_hashes(data, starts, ends), np.searchsorted(owner, np.arange(len(column) + 1))
    hashes = np.zeros(max(0, words.size - size + 1), np.uint64)
    for k in range(size):
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[k : k + hashes.size])
    fits = np.flatnonzero(np.arange(hashes.size) + size <= bounds[owner[: hashes.size] + 1])
    short = np.flatnonzero(np.diff(bounds) < size)
    lone = np.zeros(short.size, np.uint64)
    for at, i in enumerate(short):
        for word in words[bounds[i] : bounds[i + 1]]:
            lone[at : at + 1] = mix(lone[at : at + 1] * np.uint64(0x9E3779B97F4A7C15) + word)
    hashes, owner = np.r_[hashes[fits], lone], np.r_[owner[fits], short]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(hashes.size, bool)
    first[1:] = (np.diff(owner) > 0) | (hashes[1:] != hashes[:-1])
    return hashes[first], np.searchsorted(owner[first], np.arange(len(column) + 1))


def set_classes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set, as a signed long."""
    return mix(np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds[:-1]) + np.diff(bounds).astype(np.uint64)).view(np.int64)


def cell_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, CELLS) bytes: how many of the set's shingles fall into a cell, modulo 256."""
    owner, cell = np.repeat(np.arange(bounds.size - 1), np.diff(bounds)), (hashes >> np.uint64(32)) % np.uint64(CELLS)
    return np.bincount(owner * CELLS + cell.astype(np.int64), minlength=(bounds.size - 1) * CELLS).astype(np.uint8).reshape(-1, CELLS)


def coarse_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, COARSE) counts of the set's shingles by coarse cell, 127 for more."""
    owner, cell = np.repeat(np.arange(bounds.size - 1), np.diff(bounds)), (hashes >> np.uint64(20)) % np.uint64(COARSE)
    return np.minimum(np.bincount(owner * COARSE + cell.astype(np.int64), minlength=(bounds.size - 1) * COARSE), 127).astype(np.int8)


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    ends = np.arange(rows.shape[0] + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), rows.shape[0], [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def prefixes(hashes: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles are among the first of their set that a similar set can't miss, and the place of every shingle in its set; ``frequent`` (ascending) come last.  A place
    p is given as -p - 1 where no similar set that is as large or larger has its first common shingle there."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(sizes.size), sizes)
    order = np.lexsort((hashes, np.isin(hashes, frequent), owner))
    least = lambda share: (sizes - np.ceil(share * sizes - 1e-9).astype(np.int64) + 1)[owner]
    place = np.arange(hashes.size) - bounds[owner]
    inside, at = np.zeros(hashes.size, bool), np.zeros(hashes.size, np.int32)
    inside[order] = place < least(similarity)
    at[order] = np.where(place < least(2 * similarity / (1 + similarity)), place, -place - 1)
    return inside, at


def _marks(picked: DataFrame, size: int) -> DataFrame:
    """(key, text_hash, fp, class, n, cells, coarse) of every row of (key, text_hash, text)."""
    schema = pa.schema([("key", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64()), ("class", pa.int64()), ("n", pa.int64()), ("cells", pa.binary()), ("coarse", pa.list_(pa.int8()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            hashes, bounds = shingle_sets(part.column("text"), size)
            values = np.array([fingerprint((t or "").encode(), size) for t in part.column("text").to_pylist()], np.uint64)
            yield output(schema, **{"key": part.column("key"), "text_hash": part.column("text_hash"), "fp": values.view(np.int64), "class": set_classes(hashes, bounds), "n": np.diff(bounds), "cells": _fixed(cell_counts(hashes, bounds)), "coarse": pa.ListArray.from_arrays(pa.array(np.arange(bounds.size) * COARSE, pa.int32()), pa.array(coarse_counts(hashes, bounds)))})

    return picked.mapInArrow(run, "key long, text_hash long, fp long, class long, n long, cells binary, coarse array<byte>")


def _shingles(picked: DataFrame, size: int, similarity: float, frequent: np.ndarray | None) -> DataFrame:
    """(hash, class, at): the prefixes of all sets with their places, or the whole sets of the sample if ``frequent`` is None."""
    schema = pa.schema([("hash", pa.int64()), ("class", pa.int64()), ("at", pa.int32())])
    common = None if frequent is None else picked.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            hashes, bounds = shingle_sets(part.column("text"), size)
            of = set_classes(hashes, bounds)
            once = np.zeros(of.size, bool)
            once[np.unique(of, return_index=True)[1]] = True
            owner = np.repeat(of, np.diff(bounds))
            keep, at = (owner % SHINGLES_OF == 0, np.zeros(hashes.size, np.int32)) if common is None else prefixes(hashes, bounds, common.value, similarity)
            keep &= np.repeat(once, np.diff(bounds))
            yield output(schema, **{"hash": hashes[keep].view(np.int64), "class": owner[keep], "at": at[keep]})

    return picked.mapInArrow(run, "hash long, class long, at int")


def _sets(picked: DataFrame, size: int) -> DataFrame:
    """(class, shingles) of every row of (key, text)."""
    schema = pa.schema([("class", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            hashes, bounds = shingle_sets(part.column("text"), size)
            yield output(schema, **{"class": set_classes(hashes, bounds), "shingles": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))})

    return picked.mapInArrow(run, "class long, shingles array<long>")


def _near_enough(pairs: DataFrame, similarity: float) -> DataFrame:
    """Of (a, b, n_a, n_b, cells_a, cells_b), the pairs that may be similar: a shingle of one set only changes one cell by one, so counts differ by no more than such
    shingles are allowed (modulo 256 a difference only looks smaller)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (column_bytes(batch.column(f"cells_{s}"))[0].reshape(-1, CELLS) for s in "ab")
            differ = np.abs((a - b).view(np.int8).astype(np.int16)).sum(1, dtype=np.int64)
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(differ <= (1 - similarity) / (1 + similarity) * both + 1e-9)).cast(schema)

    return pairs.select("a", "b", "n_a", "n_b", "cells_a", "cells_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, classes: DataFrame, picked: DataFrame, size: int, similarity: float) -> DataFrame:
    """Of the pairs (a, b) of classes, those whose sets are similar."""
    sized = [classes.select(F.col("class").alias(s), F.col("n").alias(f"n_{s}"), F.col("cells").alias(f"cells_{s}")) for s in "ab"]
    fits = F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-9
    pairs, drop_pairs = scratch(_near_enough(pairs.join(sized[0], "a").join(sized[1], "b").where(fits), similarity), "tried")
    wanted, drop_wanted = scratch(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct().join(classes.select("class", "least"), "class"), "wanted")
    texts = picked.join(wanted.select(F.col("least").alias("of")).distinct(), F.col("key").eqNullSafe(F.col("of")), "left_semi")
    sets, drop_sets = scratch(_sets(texts, size).join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"]), "sets")
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("of_a")), "a").join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("of_b")), "b")
    shared = both.select("a", "b", (F.size("of_a") + F.size("of_b")).alias("n"), F.size(F.array_intersect("of_a", "of_b")).alias("shared"))
    similar = materialize(shared.where(F.col("shared") >= similarity * (F.col("n") - F.col("shared")) - 1e-9).select("a", "b"), "similar")
    for drop in (drop_pairs, drop_wanted, drop_sets):
        drop()
    return similar


def _open_blocks(blocks: DataFrame, roots: DataFrame, classes: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """(hash, class, at, part, n, coarse) of the blocks that hold several components, written, and how to empty that table."""
    parts = blocks.join(roots, F.col("class") == F.col("node"), "left").select("hash", "class", "at", F.coalesce("root", "class").alias("part"))
    mixed = parts.groupBy("hash").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("hash")
    return scratch(parts.join(mixed, "hash").join(classes.select("class", "n", "coarse"), "class"), "open")


def _set_components(docs: DataFrame, text: str, key: str, size: int, similarity: float, limit: int, sample: int) -> DataFrame:
    """``key``, fp, text_hash and component_id of every row."""
    picked = long_rows(docs).select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    marked = materialize(_marks(picked, size), "marks")
    classes = materialize(marked.groupBy("class").agg(F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("cells").alias("cells"), F.min("coarse").alias("coarse"), F.min("key").alias("least")), "classes")

    often = _shingles(picked, size, similarity, None).select("hash", "class").distinct().groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "hash").limit(MOST_FREQUENT)
    frequent = np.sort(often.select("hash").toArrow().column("hash").to_numpy().view(np.uint64))
    block = Window.partitionBy("hash")
    first = _shingles(picked, size, similarity, frequent).withColumns({"least": F.min("class").over(block), "most": F.max("class").over(block), "first": F.max("at").over(block)})
    blocks, drop_blocks = scratch(first.where("least <> most and first >= 0").select("hash", "class", "least", "at").distinct(), "blocks")

    by_fp = materialize(classes.groupBy("fp").agg(F.min("class").alias("least")), "distinct")
    near = links(by_fp, limit, sample)
    near = near.join(by_fp.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(by_fp.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b")
    near = near.select(F.col("x").alias("a"), F.col("y").alias("b")).union(classes.join(by_fp, "fp").select("class", by_fp["least"]))
    hubs = rank.top_per_key(blocks.where("class <> least").groupBy("class", "least").count(), ["class"], [F.desc("count"), F.col("least").asc()], HUBS)
    tried = near.union(hubs.select("class", "least")).where("a <> b").distinct()
    sure = _verified(tried, classes, picked, size, similarity)
    open_, drop_open = _open_blocks(blocks, components(sure), classes)
    drop_blocks()
    left, right = (open_.select("hash", *(F.col(c).alias(f"{c}_{side}") for c in ("class", "part", "n", "at", "coarse"))) for side in "ab")
    # of a pair, the set of fewer shingles (of equals the smaller class) stands left; what can follow their first common shingle must be enough
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.when(F.col("at_b") < 0, -F.col("at_b") - 1).otherwise(F.col("at_b")))
    fits = (F.col("part_a") != F.col("part_b")) & (F.struct("n_a", "class_a") < F.struct("n_b", "class_b")) & (F.col("n_a") >= similarity * F.col("n_b") - 1e-9)
    fits &= rest >= similarity / (1 + similarity) * (F.col("n_a") + F.col("n_b")) - 1e-9
    differ = F.aggregate(F.zip_with("coarse_a", "coarse_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda n, x: n + x)
    fits &= differ <= (1 - similarity) / (1 + similarity) * (F.col("n_a") + F.col("n_b")) + 1e-9
    across = left.where("at_a >= 0").join(right, "hash").where(fits).select(F.greatest("class_a", "class_b").alias("a"), F.least("class_a", "class_b").alias("b")).distinct()
    edges = sure.union(_verified(across, classes, picked, size, similarity))
    roots = components(edges)
    drop_open()

    named = classes.join(roots, F.col("class") == F.col("node"), "left").select("class", "least", F.coalesce("root", "class").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(smallest, "root").select("class", "component_id"), "class").select(F.col("key").alias(key), "fp", "text_hash", "component_id")


def similar_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, similarity: float = 0.8, limit: int = LIMIT, sample: int = SAMPLE) -> DataFrame:
    """``key``, fp and component_id (smallest ``key`` reachable over pairs of documents whose shingle sets have at least that Jaccard similarity) for every row."""
    return _set_components(docs, text, key, size, similarity, limit, sample).drop("text_hash")


def drop_similar(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, similarity: float = 0.8, limit: int = LIMIT, sample: int = SAMPLE) -> DataFrame:
    """As ``drop_near_duplicates``, of the components of ``similar_documents``."""
    return _first_of_each(docs, _set_components(docs, text, key, size, similarity, limit, sample), text, key)
