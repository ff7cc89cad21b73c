"""Nearest neighbours by an inverted multi-index, for the largest inner product.

1. Equal vectors are one entry, which keeps the smallest ids that any result can need, so a vector that a third of the rows share is
   searched once and weighs as one.
2. The two halves of a vector are quantised apart, by codebooks fitted on a bounded sample (about ``SAMPLE`` entries, chosen by a hash of
   the id); every entry is indexed under its pair of centroids, its cell.  A codebook has sqrt(n) / 4 centroids, ``MOST_CENTROIDS`` at most, so the table of
   the cells' sizes, which is broadcast, has at most the square of that.
3. A query orders both codebooks by their distance to its halves (minus the inner product) and takes cells by summed distance from a heap,
   until they hold ``share`` of the entries.  The share is measured on the sample: the least that holds ``recall`` of the neighbours
   that a brute-force search of the sample finds.  Of n entries the sample's nearest ``top`` * sample / n (one at least) are looked for, so the measure is as hard as the search.
4. Entries are dealt by first centroid, and within it by a hash into blocks of about ``BLOCK``; a query goes to a first centroid's blocks once, with all its second
   centroids there.  If many queries come to one, they are dealt as well.  In a block the visited cells are scored at once, and
   what may be among the first ``top`` of a query is scored again on the original vectors, component after component in double precision.

Results hold the nearest first, of equal scores the smaller id.  Vectors that are null, zero or hold a null or a component that isn't finite take no part, nor do those of another
length than most (of lengths equally frequent, the shorter), nor rows without an id.  Rows that share an id are one vector, the least of
them in array order.  An empty table has an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import materialize, output
from cadenza.operators import rank

TOP, EVERY = 20, 20
#: Entries that the driver sees to fit codebooks, queries among them that measure the share, and what share of their neighbours is to be found there.
SAMPLE, ASKED, RECALL = 16_384, 512, 0.97
MOST_CENTROIDS, STEPS = 256, 12
#: Entries and queries of a block, and queries whose cells one task looks for.
BLOCK, QUERIES, WALKS = 8_192, 1_024, 512


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """id and x of the vectors that take part, one of each id."""
    kind = vectors.schema[vector].dataType.elementType.typeName()
    x = F.col(vector) if kind in ("float", "double") else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), x.alias("x")).where("id is not null and x is not null")
    finite = F.forall("x", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = rows.where(finite & F.exists("x", lambda c: c != 0))
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("x") == (sizes[0]["n"] if sizes else 0))
    return rows.groupBy("id").agg(F.min("x").alias("x"))


def entries(rows: DataFrame, top: int = TOP) -> DataFrame:
    """x, id (the smallest) and ids (the ``top`` + 1 smallest, ascending) of every distinct vector."""
    few = rank.top_per_key(rows, ["x"], [F.col("id").asc()], top + 1)
    return few.groupBy("x").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"))


def codebook(data: np.ndarray, k: int, seed: int = 3, steps: int = STEPS) -> np.ndarray:
    """(up to ``k``, dim) centroids of Lloyd's rounds."""
    rng = np.random.default_rng(seed)
    data = np.unique(data, axis=0)
    book = data[rng.permutation(data.shape[0])[:k]].copy()
    for _ in range(steps):
        own = nearest(data, book)
        n = np.bincount(own, minlength=book.shape[0])
        sums = np.zeros_like(book)
        np.add.at(sums, own, data)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


def nearest(data: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book**2).sum(1)[None, :] - 2 * (data @ book.T)).argmin(1)


@dataclass
class Index:
    first: np.ndarray
    second: np.ndarray
    #: Entries of each cell.
    counts: np.ndarray
    #: Share of the entries that a query visits.
    share: float = 1.0

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return nearest(x[:, :half], self.first), nearest(x[:, half:], self.second)

    def visits(self, x: np.ndarray, need: int) -> dict[int, list[int]]:
        """Second centroids by first centroid of the cells with entries that a query visits, taken from a heap until they hold ``need`` entries."""
        half, found, held = self.first.shape[1], {}, 0
        by_first, by_second = -(self.first @ x[:half]), -(self.second @ x[half:])
        rows, columns = by_first.argsort(kind="stable"), by_second.argsort(kind="stable")
        a, b = by_first[rows].tolist(), by_second[columns].tolist()
        counts = self.counts[rows][:, columns].tolist()
        rows, columns = rows.tolist(), columns.tolist()
        heap = [(a[0] + b[0], 0, 0)]
        while heap and held < need:
            _, i, j = heapq.heappop(heap)
            if n := counts[i][j]:
                found.setdefault(rows[i], []).append(columns[j])
                held += n
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if not j and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return found


def fitted(sample: np.ndarray, n: int, top: int = TOP, recall: float = RECALL, asked: int = ASKED) -> Index:
    """Codebooks and the share of entries to visit, from a sample of ``n`` entries; cell sizes are the sample's."""
    half, k = sample.shape[1] // 2, int(min(MOST_CENTROIDS, max(2, round(math.sqrt(n) / 4))))
    made = Index(codebook(sample[:, :half], k), codebook(sample[:, half:], k), np.zeros((0, 0), np.int64))
    a, b = made.cells(sample)
    made.counts = np.zeros((made.first.shape[0], made.second.shape[0]), np.int64)
    np.add.at(made.counts, (a, b), 1)
    wanted = max(1, min(top, round(top * sample.shape[0] / n)))
    at = np.unique(np.linspace(0, sample.shape[0] - 1, asked).astype(int))
    needed = []
    for i in at:
        scores = sample @ sample[i]
        scores[i] = -np.inf
        near = scores.argpartition(-wanted)[-wanted:] if wanted < scores.size else np.arange(scores.size)
        summed = (made.first @ sample[i, :half])[:, None] + (made.second @ sample[i, half:])[None, :]
        order = summed.ravel().argsort()[::-1]
        reached = np.zeros(order.size, np.int64)
        reached[order] = np.cumsum(made.counts.ravel()[order])
        needed.append(reached.reshape(summed.shape)[a[near], b[near]])
    made.share = float(np.quantile(np.concatenate(needed), recall)) / sample.shape[0]
    return made


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component after component."""
    total = np.zeros(a.shape[0])
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def block_best(q: np.ndarray, seconds: list[np.ndarray], x: np.ndarray, second: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query and entry numbers and exact scores of at least the ``top`` best entries in visited cells of each query, and of all that rounding can't tell from them."""
    order = second.argsort(kind="stable")
    x, cut = x[order], np.flatnonzero(np.r_[True, np.diff(second[order]) != 0])
    asks: dict[int, list[int]] = {}
    for i, cells in enumerate(seconds):
        for c in cells.tolist():
            asks.setdefault(c, []).append(i)
    scores = np.full((q.shape[0], x.shape[0]), -np.inf)
    for low, high, cell in zip(cut, np.r_[cut[1:], x.shape[0]], second[order][cut].tolist(), strict=True):
        if who := asks.get(cell):
            scores[who, low:high] = q[who] @ x[low:high].T
    least = np.partition(scores, -top, 1)[:, -top] if top < x.shape[0] else np.full(q.shape[0], -np.inf)
    slack = 1e-12 * np.sqrt((q**2).sum(1)) * math.sqrt((x**2).sum(1).max())
    i, j = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
    return i, order[j], exact_scores(q[i], x[j])


def search(vectors: DataFrame, queries, vector: str = "embedding", key: str = "vec_id", top: int = TOP, recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK, asked: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), ``key`` and score of the ``top`` nearest found of each row for which ``queries`` (a condition on column id) holds, the row itself left out."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, vector, key), "vectors")
    held = materialize(entries(rows, top), "entries")
    n = held.count()
    chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < math.ceil((1 << 40) * min(1.0, sample / max(1, n)))
    seen = held.where(chosen).select("id", "x").toArrow().sort_by("id")
    if not seen.num_rows:  # by chance, of a few entries
        seen = held.orderBy("id").limit(sample).select("id", "x").toArrow()
    empty = rows.where("false").select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(key), F.lit(0.0).alias("score"))
    if not seen.num_rows:
        return empty
    index = fitted(_matrix(seen.column("x").combine_chunks()), n, top, recall)
    placed = spark.sparkContext.broadcast(index)
    kind = held.schema["x"].dataType
    item = {"float": pa.float32(), "double": pa.float64()}[kind.elementType.typeName()]
    deal = pa.schema([("id", pa.int64()), ("x", pa.list_(item)), ("first", pa.int32()), ("second", pa.int32())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = placed.value.cells(_matrix(batch.column("x")))
                yield output(deal, id=batch.column("id"), x=batch.column("x").cast(pa.list_(item)), first=a.astype(np.int32), second=b.astype(np.int32))

    indexed = materialize(held.select("id", "x").mapInArrow(place, f"id long, x {kind.simpleString()}, first int, second int"), "index")
    counts = np.zeros_like(index.counts)
    for r in indexed.groupBy("first", "second").count().collect():  # a row for each cell with entries
        counts[r["first"], r["second"]] = r["count"]
    index.counts = counts
    walked = spark.sparkContext.broadcast(index)
    need = min(n, max(top + 1, math.ceil(index.share * n)))

    asking = rows.where(queries).select(F.col("id").alias("query_id"), "x")
    asking = materialize(asking.join(held.select("x", "id"), "x").select("query_id", "id", "x"), "asking")
    route = pa.schema([("id", pa.int64()), ("x", pa.list_(item)), ("first", pa.int32()), ("seconds", pa.list_(pa.int32()))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, seconds = [], [], []
            for i, x in enumerate(_matrix(batch.column("x")) if batch.num_rows else ()):
                found = walked.value.visits(x, need)
                row += [i] * len(found)
                first += found.keys()
                seconds += found.values()
            of = batch.take(pa.array(row, pa.int64()))
            yield output(route, id=of.column("id"), x=of.column("x").cast(pa.list_(item)), first=first, seconds=seconds)

    distinct = asking.groupBy("id").agg(F.first("x").alias("x"))  # equal by their id
    distinct = distinct.repartition(max(1, math.ceil(asking.count() / WALKS)), "id")  # few bytes, but a walk each
    visits = materialize(distinct.mapInArrow(walk, f"id long, x {kind.simpleString()}, first int, seconds array<int>"), "visits")
    asked_of = {r["first"]: r["count"] for r in visits.groupBy("first").count().collect()}  # a row for each centroid
    parts = spark.createDataFrame([(int(c), max(1, math.ceil(int(counts[c].sum()) / block)), max(1, math.ceil(asked_of[c] / asked))) for c in asked_of], "first int, parts int, shares int")
    dealt = lambda df, own, own_n, other, other_n: df.join(F.broadcast(parts), "first").withColumn(own, F.pmod(F.xxhash64("id"), F.col(own_n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))  # noqa: E731  (a row for each centroid)
    keys = ["first", "part", "share"]
    left = dealt(visits, "share", "shares", "part", "parts").select(*keys, "id", "x", "seconds")
    right = dealt(indexed, "part", "parts", "share", "shares").select(*keys, "id", "x", "second")
    pairs = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def score(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            return pairs.empty_table()
        q, x = q.combine_chunks(), x.combine_chunks()
        wide = lambda t, c: t.column(c).combine_chunks()
        seconds = wide(q, "seconds")
        lists = np.split(seconds.flatten().to_numpy(), np.cumsum(seconds.value_lengths().to_numpy())[:-1])
        i, j, s = block_best(_matrix(wide(q, "x")), lists, _matrix(wide(x, "x")), wide(x, "second").to_numpy(), top + 1)
        return pa.table({"query": wide(q, "id").take(pa.array(i)), "id": wide(x, "id").take(pa.array(j)), "score": s}, pairs)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "query long, id long, score double")
    best = [F.col("score").desc(), F.col("id").asc()]
    near = rank.top_per_key(found, ["query"], best, top + 1)
    near = near.join(held.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("id"))
    near = rank.top_per_key(near, ["query"], best, top + 1)
    near = asking.select("query_id", F.col("id").alias("query")).join(near, "query").where("query_id <> id")
    place_ = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    return near.withColumn("rank", place_).where(F.col("rank") <= top).select("query_id", "rank", F.col("id").alias(key), "score")
