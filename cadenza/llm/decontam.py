"""Benchmark decontamination by spaced seeds.

Texts are lower-cased and cut into tokens, each a 64-bit hash: runs of ASCII letters, digits and other characters
that are neither punctuation nor space nor control, and single characters in scripts written without spaces.  A seed is a
fixed mask over a few tokens that ignores some positions, so it survives substitutions there.  The hashes of all masks at all positions of the training documents are joined with those of the test items:

1. A bitmap of fixed size, set from the test hashes, drops nearly all training positions where they are made.
2. What passes leaves as clusters: the tokens around hits close together, once, and the hits' hashes.
3. The hits are joined with the test hashes natively (Spark broadcasts the test side only if it is small), and
   give (cluster, item) candidates with the diagonals of their hits, once however many seeds they share.
4. A candidate is verified on the tokens: along a diagonal, some segment must hold at least ``least`` matches, or a whole
   shorter item, and ``identity`` of its length.  All segments are judged, not only the best-scoring one.

Items of fewer tokens than the shortest mask have one seed, a mask of ones as long as they are, so they are found where
they occur unchanged; items of up to ``least`` tokens are also found unchanged only.  Null and empty texts hold no tokens.  Repeated rows
of one id give one result.  ``contaminated`` leaves out rows with a null id, as nothing names them; ``clean`` judges them like any other.
Items without an id are left out; items that share one are each searched.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, long_rows, materialize, mix, output, own_name, span_hashes, steps

#: The masks; 1 is a token that counts.
MASKS = ("111111", "1101001011", "10110001101", "110010100011")
LEAST, IDENTITY = 10, 0.7
#: Tokens kept on both sides of a hit, and the bits of the bitmap (2 MB).
AROUND, BITMAP_BITS = 64, 24
_ASCII = np.array([b < 128 and chr(b).isalnum() for b in range(256)], np.uint8)
#: Scripts written without spaces: Thai, Lao, Tibetan, Burmese, Khmer, Tai, Balinese, Javanese, Han, kana, Bopomofo, Yi.
_UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


@functools.cache
def _kinds() -> np.ndarray:
    """Of each code point from 0x80: 0 cuts, 1 is part of a token, 2 is a token of its own."""
    out = np.ones(0x110000, np.uint8)
    for low, high in _UNSPACED:
        out[low : high + 1] = 2
    out[[c for c in range(0x80, 0x20000) if unicodedata.category(chr(c))[0] in "PZ" or unicodedata.category(chr(c)) == "Cc"] + [0x200B]] = 0
    return out


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the tokens in UTF-8 bytes, never across texts."""
    kinds, lead = np.zeros(data.size + 4, np.uint8), np.flatnonzero(data >= 0xC0)
    kinds[: data.size] = _ASCII[data]
    if lead.size:
        padded = np.r_[data, np.zeros(3, np.uint8)]
        more = 1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        points = data[lead].astype(np.int64) & (0x3F >> more)
        for k in (1, 2, 3):
            points = np.where(k <= more, points << 6 | (padded[lead + k] & 0x3F), points)
        kind = _kinds()[np.minimum(points, 0x10FFFF)]
        kinds[lead] = kind
        for k in (1, 2, 3):
            kinds[lead[k <= more] + k] = kind[k <= more]
    kinds = kinds[: data.size + 1]
    kinds[-1] = 0
    inside, alone = kinds > 0, kinds == 2
    fresh = np.ones(data.size + 1, bool)
    fresh[1:-1] = ~inside[:-2] | ((alone[1:-1] | alone[:-2]) & ((data[1:] & 0xC0) != 0x80))
    fresh[offsets] = True
    starts = np.flatnonzero(inside & fresh)
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a string column, and the number of tokens before each text (n + 1)."""
    data, offsets = column_bytes(pc.utf8_lower(column))
    starts, ends, owner = token_spans(data, offsets)
    return span_hashes(data, starts, ends), np.searchsorted(owner, np.arange(len(column) + 1))


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Of a mask at each position where it fits."""
    n = max(0, tokens.size - len(mask) + 1)
    out = np.full(n, len(mask) * 131 + int(mask, 2), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[k : k + n]
            out ^= out >> np.uint64(29)
    return mix(out)


def text_seeds(tokens: np.ndarray, bounds: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions (in ``tokens``) of a mask, none across two texts."""
    hashes = seed_hashes(tokens, mask)
    left = np.repeat(bounds[1:], np.diff(bounds))[: hashes.size] - np.arange(hashes.size)
    fits = np.flatnonzero(left >= len(mask))
    return hashes[fits], fits


def _items(items: DataFrame, text: str, key: str) -> DataFrame:
    """(item, item_hash, text) of the distinct items with an id."""
    return items.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("item"), F.xxhash64(text).alias("item_hash"), F.col(text).alias("text")).dropDuplicates(["item", "item_hash"])


def item_seeds(items: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """(hash, item, item_hash, at, whole) of all masks at all positions of the test items, and of shorter items as a whole; whole is their length, else 0."""
    schema = pa.schema([("hash", pa.int64()), ("item", pa.int64()), ("item_hash", pa.int64()), ("at", pa.int32()), ("whole", pa.int32())])
    shortest = min(map(len, MASKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            tokens, bounds = token_hashes(part.column("text"))
            ids, texts = (part.column(c).to_numpy() for c in ("item", "item_hash"))
            for mask in MASKS:
                hashes, at = text_seeds(tokens, bounds, mask)
                owner = np.searchsorted(bounds, at, "right") - 1
                yield output(schema, hash=hashes.view(np.int64), item=ids[owner], item_hash=texts[owner], at=(at - bounds[owner]).astype(np.int32), whole=np.zeros(at.size, np.int32))
            for size in range(1, shortest):
                owner = np.flatnonzero(np.diff(bounds) == size)
                hashes = seed_hashes(tokens, "1" * size)[bounds[owner]]
                yield output(schema, hash=hashes.view(np.int64), item=ids[owner], item_hash=texts[owner], at=np.zeros(owner.size, np.int32), whole=np.full(owner.size, size, np.int32))

    return _items(items, text, key).mapInArrow(run, "hash long, item long, item_hash long, at int, whole int").distinct()


def item_tokens(items: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    schema = pa.schema([("item", pa.int64()), ("item_hash", pa.int64()), ("item_tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            tokens, bounds = token_hashes(part.column("text"))
            yield output(schema, item=part.column("item"), item_hash=part.column("item_hash"), item_tokens=pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens.view(np.int64))))

    return _items(items, text, key).mapInArrow(run, "item long, item_hash long, item_tokens array<long>")


def bitmap(seeds: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A byte array of 2 ** bits bits, those of the seeds' hashes set; its size doesn't depend on their number."""
    schema = pa.schema([("word", pa.int64()), ("set", pa.int64())])
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(batch.column("hash").to_numpy().view(np.uint64) >> shift)
            yield output(schema, word=(at >> np.uint64(6)).astype(np.int64), set=(np.uint64(1) << (at & np.uint64(63))).view(np.int64))

    words = np.zeros(1 << (bits - 6), np.int64)
    for row in seeds.select("hash").mapInArrow(run, "word long, set long").groupBy("word").agg(F.bit_or("set").alias("set")).toLocalIterator():
        words[row["word"]] = row["set"]
    return words.view(np.uint8)


def clusters(docs: DataFrame, passed: np.ndarray, bits: int = BITMAP_BITS, text: str = "text", key: str = "doc_id", whole: tuple[int, ...] = ()) -> DataFrame:
    """Per cluster of training positions that pass the bitmap: key, text_hash, base (a token's number), tokens from there on, hit hashes and places.
    ``whole`` are the lengths of items shorter than all masks; of their hits, the first of each hash in a text is enough."""
    spark, shift = docs.sparkSession, np.uint64(64 - bits)
    table = spark.sparkContext.broadcast(passed)
    longest = max(map(len, MASKS))
    schema = pa.schema([(key, pa.int64()), ("text_hash", pa.int64()), ("base", pa.int64()), ("tokens", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = table.value
        for part in steps(batches):
            tokens, bounds = token_hashes(part.column("text"))
            found = []
            for mask in (*MASKS, *("1" * n for n in whole)):
                hashes, at = text_seeds(tokens, bounds, mask)
                bit = hashes >> shift
                hit = np.flatnonzero(seen[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                if len(mask) in whole and mask not in MASKS:
                    owner = np.searchsorted(bounds, at[hit], "right") - 1
                    order = np.lexsort((at[hit], hashes[hit], owner))
                    again = (np.diff(owner[order]) == 0) & (np.diff(hashes[hit][order]) == 0)
                    hit = hit[order[np.flatnonzero(np.r_[np.ones(min(1, order.size), bool), ~again])]]
                found.append((hashes[hit], at[hit]))
            hashes, at = (np.concatenate(x) for x in zip(*found, strict=True))
            if not at.size:
                continue
            order = np.argsort(at, kind="stable")
            hashes, at = hashes[order], at[order]
            owner = np.searchsorted(bounds, at, "right") - 1
            cut = np.flatnonzero((np.diff(at) > AROUND) | (np.diff(owner) > 0)) + 1
            low, high = np.r_[0, cut], np.r_[cut, at.size]
            of = pa.array(owner[low])
            first = np.maximum(bounds[owner[low]], at[low] - AROUND)
            last = np.minimum(bounds[owner[low] + 1], at[high - 1] + longest + AROUND)
            yield output(
                schema, **{key: part.column(key).take(of)}, text_hash=part.column("text_hash").take(of), base=first - bounds[owner[low]],
                tokens=[tokens[a:b].view(np.int64) for a, b in zip(first, last, strict=True)],
                hashes=[hashes[a:b].view(np.int64) for a, b in zip(low, high, strict=True)],
                places=[(at[a:b] - f).astype(np.int32) for a, b, f in zip(low, high, first, strict=True)],
            )

    picked = long_rows(docs).select(F.col(key).cast("long").alias(key), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return picked.mapInArrow(run, f"{key} long, text_hash long, base long, tokens array<long>, hashes array<long>, places array<int>")


def best_segment(same: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the segment with the highest sum of +1 a match and -2 a substitution; the first of equals."""
    sums = np.r_[0, np.cumsum(np.where(same, 1, -2))]
    gain = sums - np.minimum.accumulate(sums)
    end = int(gain.argmax())
    return int(gain[end]), int(sums[: end + 1].argmin()), end


def widest_segment(same: np.ndarray, identity: float) -> tuple[int, int]:
    """Start and end of the segment with the most matches of all whose share of matches is at least ``identity``; of equals the shortest, then the first.

    Such a segment is one whose sum of 1 - identity a match and -identity a substitution isn't negative.  From each place the last place with a prefix sum as high
    is the best end, found in the falling sequence of the sums' maxima from the right.
    """
    sums = np.r_[0.0, np.cumsum(np.where(same, 1 - identity, -identity))]
    matches = np.r_[0, np.cumsum(same)]
    highest = np.maximum.accumulate(sums[::-1])  # of the last k + 1 prefixes
    ends = same.size - np.searchsorted(highest, sums - 1e-9)
    opens = np.flatnonzero(same)
    if not opens.size:
        return 0, 0
    closes = np.flatnonzero(same)[matches[np.maximum(ends[opens], opens + 1)] - 1] + 1  # the last match before the end
    gained = matches[closes] - matches[opens]
    at = np.lexsort((opens, closes - opens, -gained))[0]
    return int(opens[at]), int(closes[at])


def verify(tokens: np.ndarray, item: np.ndarray, diagonal: int, least: int = LEAST, identity: float = IDENTITY) -> tuple[int, int] | None:
    """(matches, length) of the overlap of ``tokens[i + diagonal]`` with ``item[i]``, or None if no segment of the diagonal is one.  It is the segment with the best score
    (+1 a match, -2 a substitution) if that is an overlap, else the one with the most matches."""
    low, high = max(0, -diagonal), min(item.size, tokens.size - diagonal)
    if high <= low:
        return None
    same = tokens[low + diagonal : high + diagonal] == item[low:high]
    for start, end in (best_segment(same)[1:], widest_segment(same, identity)):
        matches = int(same[start:end].sum())
        if matches >= min(least, item.size) and matches >= identity * (end - start) - 1e-9:
            return matches, end - start
    return None


def findings(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, identity: float = IDENTITY) -> DataFrame:
    """``key``, text_hash, item_id, n_matches and n_overlap (tokens) of every verified overlap of a cluster with an item, the best of its diagonals."""
    seeds = materialize(item_seeds(items), "seeds")
    whole = tuple(r.whole for r in seeds.where("whole > 0").select("whole").distinct().collect())  # five lengths at most
    found = materialize(clusters(docs, bitmap(seeds), text=text, key=key, whole=whole).withColumn("cluster", F.xxhash64(key, "text_hash", "base")), "clusters")
    hits = found.select("cluster", key, "text_hash", "base", F.explode(F.arrays_zip("hashes", "places")).alias("hit")).select("cluster", key, "text_hash", "base", F.col("hit.hashes").alias("hash"), F.col("hit.places").alias("place"))
    who = ["cluster", key, "text_hash", "base", "item", "item_hash"]
    pairs = hits.join(seeds, "hash").select(*who, (F.col("place") - F.col("at")).alias("diagonal"))
    pairs = pairs.groupBy(*who).agg(F.collect_set("diagonal").alias("diagonals"))  # no more than the cluster and the item have tokens
    same = F.col("p.cluster").eqNullSafe(F.col("t.cluster")) & F.col(f"p.{key}").eqNullSafe(F.col(f"t.{key}")) & (F.col("p.text_hash") == F.col("t.text_hash")) & (F.col("p.base") == F.col("t.base"))
    texts = found.select("cluster", key, "text_hash", "base", "tokens").dropDuplicates(["cluster", key, "text_hash", "base"])
    rows = pairs.alias("p").join(texts.alias("t"), same).select("p.*", "t.tokens").join(item_tokens(items), ["item", "item_hash"])
    schema = pa.schema([(key, pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("n_matches", pa.int64()), ("n_overlap", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, at = [], []
            for i in range(batch.num_rows):
                t, u, d = (batch.column(c)[i].values.to_numpy() for c in ("tokens", "item_tokens", "diagonals"))
                if got := [m for k in d if (m := verify(t, u, int(k), least, identity))]:
                    best.append(max(got, key=lambda m: (m[0], -m[1])))
                    at.append(i)
            of = batch.take(pa.array(at, pa.int32()))
            yield output(schema, **{key: of.column(key)}, text_hash=of.column("text_hash"), item_id=of.column("item"), n_matches=[m for m, _ in best], n_overlap=[n for _, n in best])

    return rows.select(key, "text_hash", "item", "tokens", "item_tokens", "diagonals").mapInArrow(run, f"{key} long, text_hash long, item_id long, n_matches long, n_overlap long")


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, identity: float = IDENTITY) -> DataFrame:
    """``key``, item_id, n_matches and n_overlap (tokens) of the best verified overlap of each pair of document and item that has one; ids that are null are left out."""
    found = findings(docs.where(F.col(key).isNotNull()), items, text, key, least, identity)
    best = found.groupBy(key, "item_id").agg(F.max(F.struct("n_matches", -F.col("n_overlap"))).alias("b"))
    return best.select(key, "item_id", F.col("b.n_matches").alias("n_matches"), (-F.col("b.col2")).alias("n_overlap"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **limits) -> DataFrame:
    """The rows without a verified overlap, in the columns of ``docs``.  A row is known by its id (which may be null) and its text, so rows of one id with other texts are
    judged apart."""
    of_key, of_hash = own_name(docs, "of_key"), own_name(docs, "of_hash")
    leaks = findings(docs, items, text, key, **limits).select(F.col(key).alias(of_key), F.col("text_hash").alias(of_hash)).distinct()
    return docs.join(leaks, F.col(key).cast("long").eqNullSafe(F.col(of_key)) & (F.xxhash64(text) == F.col(of_hash)), "left_anti")
