"""Removal of repeated byte strings by per-shard suffix arrays.

A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a document with a smaller id, or
earlier in its own.  Verdicts are on the input, matches never cross documents, and overlaps count.

1. Sharding.  Each window of ``length`` bytes belongs to its anchor: the k-gram with the least hash in it, first of
   equals.  Equal windows have equal anchors at equal places, so windows need only be compared within one anchor
   hash.  The windows of one anchor are a run; runs whose hash occurs once in the corpus hold no repeat and end here.
   Runs equal in content collapse to the first of them: all windows of the others are repeats.
2. Shards.  The text of the remaining runs (those whose anchor hash has different contents) is dealt by anchor hash; a hash with
   many is salted over several shards.  A shard's suffix array is refined as by Larsson and Sadakane (only groups that are
   still tied are sorted again, by the ranks of what follows, at depths 8, 16, 32, 64 and ``length``).  Kasai's bound on
   neighbouring positions, taken in blocks of positions, gives common prefixes; windows with a common prefix
   of ``length`` are one class, and all but its first are repeats.
3. Cross-shard merging.  Only shards of a salted hash can share windows.  Each sends its classes' first windows, by
   ranges of a 64-bit window hash, and within a range each shard's sorted run is merged with the others by binary search.
4. The repeats' bytes are cut from their documents.

Runs are equal in content if two independent 64-bit hashes of them agree, and windows of one anchor in different shards if a 64-bit hash of them does; within a shard bytes are compared.

Null and short texts have no windows.  Rows that repeat an id with the same text are one document, and all keep the
same bytes; rows of one id with other texts are documents of their own, in the order of a hash of their texts.  A row with a null id is neither compared nor cut.  Extra columns pass through ``apply``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, long_rows, materialize, output, own_name, span_hashes, steps
from cadenza.operators import rank

LENGTH, GRAM = 100, 24
#: Bytes of a shard's text, different contents of one anchor hash in a shard, and first windows in a range of the merge.
SHARD_BYTES, SHARD_RUNS, RANGE_ROWS = 1 << 19, 256, 1 << 15
#: Bytes of text in one numpy step; its arrays then stay in a core's cache.
STEP_BYTES = 1 << 19
_PLACE = np.uint64((1 << 23) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 24 bytes from each position on."""
    a = data.astype(np.uint64) + np.uint64(1)
    for size in (1, 2, 4):
        a = mix_pair(a[:-size], a[size:])
    return mix_pair(mix_pair(a[:-8], a[8:])[:-8], a[16:])


def mix_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, owner text, first window (in ``data``) and number of windows of each run.  At most 2 ** 23 bytes."""
    none = np.zeros(0, np.int64)
    if data.size < length:
        return none.view(np.uint64), none, none, none
    hashes = gram_hashes(data)
    least, width, span = (hashes & ~_PLACE) | np.arange(hashes.size, dtype=np.uint64), length - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: least.size - (width - span)], least[width - span :])
    place = (least & _PLACE).astype(np.int64)
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    stops = np.cumsum(sizes)
    window = np.arange(stops[-1]) + np.repeat(offsets[:-1] - (stops - sizes), sizes)
    at = place[window]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if window.size else none
    owner = np.searchsorted(stops, first, "right")
    return hashes[at[first]], owner, window[first], np.diff(np.r_[first, window.size])


def pieces(part: pa.RecordBatch, length: int = LENGTH, limit: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(data, offsets, row numbers, place of the first byte in its text): all texts of a slice, or parts of one long text that share ``length`` - 1 bytes."""
    data, offsets = column_bytes(part.column("text"))
    if data.size <= limit:
        yield data, offsets, np.arange(part.num_rows), 0
        return
    for low in range(0, data.size, limit):
        piece = data[low : low + limit + length - 1]
        yield piece, np.array([0, piece.size]), np.array([0]), low


def _texts(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame | None]:
    """doc and text of the rows with an id.  doc is the id where no id has several texts; else it numbers the pairs of id and text hash in their order, and the pairs (doc, id, th) come, too."""
    picked = long_rows(docs).where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    pairs = picked.select("id", "th").distinct()
    if pairs.groupBy("id").count().where("count > 1").isEmpty():
        return picked.select(F.col("id").alias("doc"), "text"), None
    numbered = materialize(rank.positions(pairs, ["id", "th"], "doc"), "numbered")
    return materialize(picked.join(numbered, ["id", "th"]).select("doc", "text"), "texts"), numbered


def anchor_counts(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Hashes of anchors that occur twice or more."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP_BYTES):
            for data, offsets, _, _ in pieces(part, length):
                h, n = np.unique(anchor_runs(data, offsets, length)[0].view(np.int64), return_counts=True)
                yield output(schema, h=h, n=n)

    return texts.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def all_runs(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """h, s (a hash of the run's content), doc, at (first window) and n (windows) of every run."""
    schema = pa.schema([("h", pa.int64()), ("s", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP_BYTES):
            ids = part.column("doc").to_numpy()
            for data, offsets, rows, base in pieces(part, length):
                h, owner, first, n = anchor_runs(data, offsets, length)
                s = span_hashes(data, first, first + n + length - 1)
                yield output(schema, h=h.view(np.int64), s=s.view(np.int64), doc=ids[rows[owner]], at=(first - offsets[owner] + base).astype(np.int32), n=n.astype(np.int32))

    return texts.mapInArrow(run, "h long, s long, doc long, at int, n int")


def suffix_array(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Positions in the order of the ``length`` bytes from each on (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(data.size, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + data.size]
    order = np.argsort(key, kind="stable")
    fresh = np.r_[True, np.diff(key[order]) != 0]
    rank = np.zeros(data.size + length, np.int64)  # 0 is past the end
    slots, starts = np.arange(data.size), np.flatnonzero(fresh)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, data.size])) + 1
    depth = 8
    while depth < length:
        skip = min(depth, length - depth)
        alone = fresh & np.r_[fresh[1:], True]
        slots = slots[~alone]  # what is still tied
        if not slots.size:
            break
        tied = order[slots]
        pair = rank[tied] * (data.size + 2) + rank[tied + skip]
        by = np.argsort(pair, kind="stable")
        order[slots], pair = tied[by], pair[by]
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        starts = np.flatnonzero(fresh)
        rank[order[slots]] = np.repeat(slots[starts], np.diff(np.r_[starts, slots.size])) + 1
        depth += skip
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, length: int = LENGTH, block: int = 8) -> np.ndarray:
    """By slot of ``order``: bytes in common with the slot before, ``length`` at most.  The first position of each block of the text is compared
    from its first byte; the next ones start from Kasai's bound, one less than the position before (no bound holds after a capped value)."""
    n = data.size
    before = np.zeros(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[:1]] = -1
    padded = np.concatenate([data.astype(np.int16), np.full(length, -1, np.int16)])
    common = np.zeros(n, np.int64)
    for k in range(min(block, n)):
        at = np.arange(k, n, block)
        held = common[at - 1] if k else np.zeros(at.size, np.int64)
        same = np.where(held < length, np.maximum(held - 1, 0), 0)
        other = before[at]
        same[other < 0] = 0
        going = np.flatnonzero(other >= 0)
        while going.size:
            going = going[same[going] < length]
            a, b = at[going] + same[going], other[going] + same[going]
            equal = (padded[a] == padded[b]) & (np.maximum(a, b) < n)
            going = going[equal]
            same[going] += 1
        common[at] = same
    return common[order]


def window_classes(data: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Equal numbers for equal windows (positions in ``data``)."""
    order = suffix_array(data, length)
    number = np.zeros(data.size, np.int64)
    number[order] = np.cumsum(common_prefixes(data, order, length) < length)
    return number[windows]


def spans_of(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, first windows and lengths of the maximal runs of windows."""
    by = np.lexsort((at, doc))
    doc, at = doc[by], at[by]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)]) if doc.size else by
    return doc[first], at[first], np.diff(np.r_[first, doc.size])


_FOUND = "h long, range long, shard int, doc long, at int, n int, places array<int>, hashes array<long>"


def shard_repeats(runs: DataFrame, length: int = LENGTH, shard_runs: int = SHARD_RUNS, shard_bytes: int = SHARD_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Repeated windows within shards (runs of n from ``at``), and for salted hashes the first windows of classes (n = 0): by run and range of the merge, their places after
    ``at`` and a hash of each.  ``runs``: h, runs (how many of the hash), doc, at, n, bytes."""
    schema = pa.schema([("h", pa.int64()), ("range", pa.int64()), ("shard", pa.int32()), ("doc", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("places", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))])

    def judge(table: pa.Table) -> Iterator[pa.RecordBatch]:
        data, offsets = column_bytes(table.column("bytes").combine_chunks() if table.column("bytes").num_chunks != 1 else table.column("bytes").chunk(0))
        n = table.column("n").to_numpy().astype(np.int64)
        stops = np.cumsum(n)
        inner = np.arange(stops[-1]) - np.repeat(stops - n, n)
        window = inner + np.repeat(offsets[:-1], n)
        doc, at = np.repeat(table.column("doc").to_numpy(), n), inner + np.repeat(table.column("at").to_numpy().astype(np.int64), n)
        number = window_classes(data, window, length)
        by = np.lexsort((at, doc, number))
        opens = np.r_[True, number[by][1:] != number[by][:-1]]
        leader = by[opens][np.cumsum(opens) - 1]
        repeat = by[(doc[by] != doc[leader]) | (at[by] != at[leader])]  # a row that occurs twice brings its windows twice
        d, a, k = spans_of(doc[repeat], at[repeat])
        none, empty = pa.nulls(d.size, pa.int64()), pa.nulls(d.size, pa.list_(pa.int64()))
        yield output(schema, h=none, range=none, shard=none.cast(pa.int32()), doc=d, at=a.astype(np.int32), n=k.astype(np.int32), places=empty.cast(pa.list_(pa.int32())), hashes=empty)
        of = np.repeat(np.arange(n.size), n)
        runs = table.column("runs").to_numpy()
        first = by[opens]
        first = np.sort(first[runs[of[first]] > shard_runs])
        if first.size:
            w, row = span_hashes(data, window[first], window[first] + length), of[first]
            ranges = (w % np.ceil(runs[row] * 64 / range_rows).astype(np.uint64)).astype(np.int64)
            order = np.lexsort((first, ranges, row))
            w, row, ranges, places = w[order], row[order], ranges[order], inner[first][order]
            cut = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (ranges[1:] != ranges[:-1])])
            ends = pa.array(np.r_[cut, w.size].astype(np.int32))
            held = table.select(["h", "shard", "doc", "at"]).take(pa.array(row[cut])).combine_chunks()
            column = lambda c: held.column(c).combine_chunks()
            yield output(
                schema, h=column("h"), range=ranges[cut], shard=column("shard"), doc=column("doc"), at=column("at"), n=np.zeros(cut.size, np.int32),
                places=pa.ListArray.from_arrays(ends, pa.array(places.astype(np.int32))), hashes=pa.ListArray.from_arrays(ends, pa.array(w.view(np.int64))),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in steps(batches, "bytes", shard_bytes):
            held.append(part)
            size += part.column("bytes").nbytes
            if size < shard_bytes:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h, shard = table.column("h").to_numpy(), table.column("shard").to_numpy()
            cut = np.flatnonzero((h[1:] != h[:-1]) | (shard[1:] != shard[:-1]))
            if cut.size:  # whole groups only
                yield from judge(table.slice(0, cut[-1] + 1))
                held = table.slice(cut[-1] + 1).combine_chunks().to_batches()
                size = sum(x.column("bytes").nbytes for x in held)
        if held:
            yield from judge(pa.Table.from_batches(held).combine_chunks())

    shards = F.ceil(F.col("runs") / shard_runs)
    dealt = runs.withColumn("shard", F.pmod(F.xxhash64("doc", "at"), shards).cast("int")).repartition("h", "shard").sortWithinPartitions("h", "shard")
    return dealt.select("h", "runs", "shard", "doc", "at", "n", "bytes").mapInArrow(run, _FOUND)


def merge_shards(found: DataFrame) -> DataFrame:
    """doc, at, n of the first windows of shards that an earlier one of another shard of the same hash equals."""
    schema = pa.schema([("doc", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])

    def merge(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sizes = pc.list_value_length(table.column("places")).to_numpy()
        w, places = (pc.list_flatten(table.column(c)).to_numpy() for c in ("hashes", "places"))
        doc, at, shard = (np.repeat(table.column(c).to_numpy(), sizes) for c in ("doc", "at", "shard"))
        at = at + places
        by = np.lexsort((at, doc, w, shard))
        w, doc, at, shard = w[by], doc[by], at[by], shard[by]
        cuts = np.flatnonzero(np.diff(shard)) + 1
        runs = [np.arange(a, b) for a, b in zip(np.r_[0, cuts], np.r_[cuts, w.size], strict=True)]
        repeat = np.zeros(w.size, bool)
        while len(runs) > 1:  # merge sorted runs two by two; of equal windows the earlier one stays
            merged = []
            for a, b in zip(runs[::2], runs[1::2]):
                at_a = np.searchsorted(w[a], w[b])
                equal = np.flatnonzero((at_a < a.size) & (w[a[np.minimum(at_a, a.size - 1)]] == w[b]))
                x, y = a[at_a[equal]], b[equal]
                later = (doc[x] > doc[y]) | ((doc[x] == doc[y]) & (at[x] > at[y]))
                repeat[x[later]] = True
                repeat[y[~later & ((doc[x] != doc[y]) | (at[x] != at[y]))]] = True
                keep_a, keep_b = np.ones(a.size, bool), np.ones(b.size, bool)
                keep_a[at_a[equal[later]]] = False
                keep_b[equal[~later]] = False
                a, b = a[keep_a], b[keep_b]
                into = np.searchsorted(w[a], w[b])
                merged.append(np.insert(a, into, b))
            runs = merged + runs[len(runs) - len(runs) % 2 :]
        doc, at, n = spans_of(doc[repeat], at[repeat])
        return output(schema, doc=doc, at=at.astype(np.int32), n=n.astype(np.int32))

    rows = found.where("n = 0").select("h", "range", "shard", "doc", "at", "places", "hashes")
    return rows.groupBy("h", "range").applyInArrow(lambda t: pa.Table.from_batches([merge(t)]), "doc long, at int, n int")


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """of_id, of_hash (a text's, or null where the id has one text) and spans (first window, number of windows): all windows that start earlier elsewhere."""
    texts, numbered = _texts(docs, text, key)
    often = materialize(anchor_counts(texts, length), "anchors")
    live = materialize(all_runs(texts, length).join(often, "h"), "runs")
    firsts = materialize(live.groupBy("h", "s").agg(F.min(F.struct("doc", "at", "n")).alias("one")), "contents")
    same = live.join(firsts, ["h", "s"]).where((F.col("doc") != F.col("one.doc")) | (F.col("at") != F.col("one.at"))).select("doc", "at", "n")
    different = firsts.groupBy("h").agg(F.count("*").alias("runs")).where("runs > 1")
    apart = firsts.join(different, "h").select("h", "runs", "one.*")
    wanted = apart.groupBy("doc").agg(F.collect_list(F.struct("h", "runs", "at", "n")).alias("wanted"))
    schema = pa.schema([("h", pa.int64()), ("runs", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("bytes", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP_BYTES):
            data, offsets = column_bytes(part.column("text"))
            lists = part.column("wanted")
            flat, owner = lists.flatten(), np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            h, runs, at, n = (flat.field(i) for i in range(4))
            low = offsets[owner] + at.to_numpy()
            cut = [data[a:b].tobytes() for a, b in zip(low, low + n.to_numpy() + length - 1, strict=True)]
            yield output(schema, h=h, runs=runs, doc=part.column("doc").take(pa.array(owner)), at=at, n=n, bytes=cut)

    found = shard_repeats(texts.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(extract, "h long, runs long, doc long, at int, n int, bytes binary"), length, shard_runs)
    found = materialize(found, "found")
    every = same.union(found.where("n > 0").select("doc", "at", "n")).union(merge_shards(found))
    spans = joined_runs(every).groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    if numbered is None:
        return spans.select(F.col("doc").alias("of_id"), F.lit(None).cast("long").alias("of_hash"), "spans")
    return spans.join(numbered, "doc").select(F.col("id").alias("of_id"), F.col("th").alias("of_hash"), "spans")


def _with_spans(docs: DataFrame, spans: DataFrame, text: str, key: str, name: str) -> DataFrame:
    """``docs`` with their spans as the last column, ``name``."""
    spans = spans.select(F.col("of_id").alias(own_name(docs, "of_id")), F.col("of_hash").alias(own_name(docs, "of_hash")), F.col("spans").alias(name))
    of_id, of_hash = spans.columns[:2]
    same = (F.col(key).cast("long") == F.col(of_id)) & (F.col(of_hash).isNull() | (F.xxhash64(text) == F.col(of_hash)))
    return docs.join(spans, same, "left").drop(of_id, of_hash)


def joined_runs(runs: DataFrame) -> DataFrame:
    """doc, at and n of the fewest runs of windows that are those of ``runs``: what meets or overlaps becomes one, so a document has few, however many windows repeat."""
    schema = pa.schema([("doc", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_doc, open_at, open_end = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last run, which the next batch may lengthen
        for batch in batches:
            doc, at, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc", "at", "n"))
            doc, at, end = np.r_[open_doc, doc], np.r_[open_at, at], np.r_[open_end, at + n]
            if not doc.size:
                continue
            place = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])  # ends of earlier documents lie below those of later ones
            reach = np.maximum.accumulate(end + (place << 32))
            first = np.flatnonzero(np.r_[True, at[1:] + (place[1:] << 32) > reach[:-1]])
            last = np.r_[first[1:], doc.size] - 1
            doc, at, end = doc[first], at[first], reach[last] - (place[last] << 32)
            open_doc, open_at, open_end = doc[-1:], at[-1:], end[-1:]
            yield output(schema, doc=doc[:-1], at=at[:-1].astype(np.int32), n=(end - at)[:-1].astype(np.int32))
        yield output(schema, doc=open_doc, at=open_at.astype(np.int32), n=(open_end - open_at).astype(np.int32))

    return runs.select("doc", "at", "n").repartition("doc").sortWithinPartitions("doc", "at").mapInArrow(run, "doc long, at int, n int")


def keep_mask(size: int, at: np.ndarray, n: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which bytes of a text stay, given its runs of repeated windows."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, np.minimum(at, size), 1)
    np.add.at(edge, np.minimum(at + n + length - 1, size), -1)
    return np.cumsum(edge[:-1]) == 0


def _cut(part: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = column_bytes(part.column("text"))
    lists = part.column("spans")
    at, n = (lists.flatten().field(k).to_numpy().astype(np.int64) for k in (0, 1))
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64))
    for i, (low, high) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
        own = data[offsets[i] : offsets[i + 1]]
        yield own, keep_mask(own.size, at[low:high], n[low:high], length)


def measure_cuts(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """``key``, n_bytes, n_removed, n_spans and kept_sha256 for every row."""
    schema = pa.schema([(key, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP_BYTES):
            rows = [(own.size, own.size - int(keep.sum()), int(np.count_nonzero(np.diff(np.r_[True, keep].astype(np.int8)) < 0)), hashlib.sha256(own[keep].tobytes()).hexdigest()) for own, keep in _cut(part, length)]
            columns = dict(zip(schema.names[1:], zip(*rows, strict=True), strict=True))
            yield output(schema, **{key: part.column("_id")}, **{k: list(v) for k, v in columns.items()})

    picked = long_rows(docs).select(F.col(key).cast("long").alias("_id"), F.col(text).alias("text"))
    joined = _with_spans(picked, repeats(docs, text, key, length, shard_runs), "text", "_id", "spans")
    return joined.mapInArrow(run, f"{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def apply(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """``docs`` with repeats cut from their texts (and the rest of a character that a cut splits); rows that are left without a word go."""
    held = own_name(docs, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            touched = [bool(s) for s in batch.column(held).to_pylist()]
            if any(touched):
                part = pa.RecordBatch.from_arrays([batch.column(at), batch.column(held)], names=["text", "spans"])
                old = batch.column(at).to_pylist()
                texts = [own[keep].tobytes().decode("utf-8", "ignore") if hit else was for (own, keep), hit, was in zip(_cut(part, length), touched, old, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                batch = batch.filter(pa.array([not hit or bool(t.encode().split()) for t, hit in zip(texts, touched, strict=True)]))
            yield batch.drop_columns([held])

    return _with_spans(long_rows(docs), repeats(docs, text, key, length, shard_runs), text, key, held).mapInArrow(run, docs.schema)
