"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each in a node of the bits before it.  Contexts are the last 0 to 4 bytes.  Every
(context, node) holds a Krichevsky-Trofimov estimator; its weighted probability is half its own and half the product of those
of the contexts one byte longer.  All depths are mixed so, and a text's code length comes from the mixture.

1. Gathering.  Each task counts the words and the 5-byte strings (context and byte) of its training texts; strings of other
   texts go along with count 0.  Spark sums them, combined before the shuffle.
2. Weighting.  Strings that share the three bytes before the last have the whole tree below depth 3 in common, and no more than
   2 ** 16 members.  Sorted by these bytes they stream through numpy, some such groups at a time, and are weighted bottom-up; the sums
   that depth 2 needs are added up by Spark, and what depths 1 and 0 need (at most 256 * 255 sums) meets on the driver.  A second pass,
   in which the nodes of depth 2 go before their strings, gives each string the log-probability of its last byte.  A node that training
   never reached is left out of the mixture, so its context one byte shorter decides.
3. Scoring.  Texts are dealt into blocks of about ``BLOCK_BYTES`` by a hash of their id and text, each block a partition of its own (up to
   ``MOST_PARTS``).  A block asks for each of its distinct words and strings once, gets counts and log-probabilities by a join, and scores its texts.

A text ends with an end mark (byte 0xFF), whose probability counts; 0xFF stands before its start.  The base score is the
add-one unigram score over lower-cased words and one end token.  Null texts count as empty.  Rows with a null id are in
training and scored like any other.  Repeated rows count and are scored each.  Extra columns are ignored.
Without a training text, counts are 0 and each binary decision has probability 1/2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, long_rows, materialize, output, span_hashes, steps, word_spans

DEPTH, BLOCK_BYTES, MARK = 4, 24 << 20, 255
#: Strings weighted together, and the most partitions of blocks (further blocks share them).
CHUNK, MOST_PARTS = 1 << 16, 20_000
#: Bytes of text in one numpy step, whose arrays then stay in a core's cache; bits of a look-up table's slots.
STEP_BYTES, SLOT_BITS = 1 << 18, 22
WORDS, STRINGS, END = 0, 1, 0  # kinds of keys, and the key of the end token
_SPACE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
_LOWER = np.frombuffer(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)), np.uint8)
_LN10, _HALF = math.log(10), math.log(0.5)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of all texts (A-Z lower-cased), and the number of words before each text."""
    data = _LOWER[data]
    starts, ends, owner = word_spans(data, offsets, _SPACE)
    keys = span_hashes(data, starts, ends).view(np.int64)
    return np.where(keys == END, 1, keys), np.searchsorted(owner, np.arange(offsets.size))


def strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end mark, the context and byte as one number; and their number before each text."""
    n = offsets.size - 1
    begins = offsets[:-1] + np.arange(n) * (DEPTH + 1)
    held = np.full(data.size + n * (DEPTH + 1), MARK, np.uint8)
    held[np.arange(data.size) + np.repeat(begins + DEPTH - offsets[:-1], np.diff(offsets))] = data
    keys = np.zeros(max(0, held.size - DEPTH), np.int64)
    for k in range(DEPTH + 1):
        keys = (keys << 8) | held[k : k + keys.size]
    sizes = np.diff(offsets) + 1
    stops = np.cumsum(sizes)
    at = np.arange(stops[-1] if n else 0) + np.repeat(begins - (stops - sizes), sizes)
    return keys[at], np.r_[0, stops]


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(at, np.concatenate(counts), unique.size).astype(np.int64)


class Lookup:
    """Values by key for many queries: a table of 2 ** SLOT_BITS slots answers most, binary search those whose slot another key took."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        by = np.argsort(keys)
        self.keys, self.values = keys[by], values[by]
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(keys.size)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of ``keys``, all of which are held."""
        if not keys.size:
            return self.values[:0]
        at = self.slots[self._slot(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.searchsorted(self.keys, keys[other])
        return self.values[at]


_COUNTED = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("n", pa.int64())])


def gather(rows: DataFrame) -> DataFrame:
    """(kind, key, n) with sums over all training texts; ``rows``: text, trains.  Keys of other texts have n = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list, int]] = {kind: ([], [], 0) for kind in (WORDS, STRINGS)}

        def take(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            ks, ns, size = held[kind]
            ks.append(keys)
            ns.append(counts)
            held[kind] = ks, ns, size + keys.size
            if size + keys.size > 1 << 21:
                keys, counts = _merge(ks, ns)
                held[kind] = [keys], [counts], keys.size
                if keys.size > 1 << 20:  # the table is bounded: send it and start again
                    held[kind] = [], [], 0
                    yield output(_COUNTED, kind=np.full(keys.size, kind, np.int8), key=keys, n=counts)

        for part in steps(batches, "text", STEP_BYTES):
            trains = np.array(part.column("trains").to_pylist(), bool)
            data, offsets = column_bytes(part.column("text"))
            for kind, made in ((WORDS, words), (STRINGS, strings)):
                keys, before = made(data, offsets)
                own = np.repeat(trains, np.diff(before))
                yield from take(kind, *np.unique(keys[own], return_counts=True))
                other = np.unique(keys[~own])
                yield from take(kind, other, np.zeros(other.size, np.int64))
            yield from take(WORDS, np.array([END]), np.array([int(trains.sum())]))
        for kind, (ks, ns, _) in held.items():
            keys, counts = _merge(ks, ns)
            yield output(_COUNTED, kind=np.full(keys.size, kind, np.int8), key=keys, n=counts)

    return rows.select("text", "trains").mapInArrow(run, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of x >= 0.5, by Stirling's series above 8."""
    x = np.asarray(x, float)
    low = np.zeros(x.shape)
    for _ in range(8):
        small = x < 8
        low += np.where(small, np.log(np.where(small, x, 1)), 0)
        x = x + small
    r = 1 / (x * x)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x - low


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-probability that the estimator gives to a sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


def weigh(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    return _HALF + np.logaddexp(own, below)


class Level:
    """The nodes of one depth: ``of`` is each string's node for each of its 8 bits, in rows of bits."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray):
        j = np.arange(8)[:, None]
        node = (1 << j) | (byte[None, :] >> (8 - j))
        self.bit = ((byte[None, :] >> (7 - j)) & 1).astype(bool)
        self.ids, of = np.unique((context[None, :] << 8 | node).ravel(), return_inverse=True)
        self.of = of.reshape(node.shape)
        ones = np.bincount(of, np.where(self.bit, n, 0).ravel(), self.ids.size)
        self.n = np.stack([np.bincount(of, np.broadcast_to(n, node.shape).ravel(), self.ids.size) - ones, ones])
        self.own = log_kt(*self.n)

    def estimate(self) -> np.ndarray:
        """Of each bit of each string."""
        seen = np.where(self.bit, self.n[1][self.of], self.n[0][self.of])
        return (seen + 0.5) / (self.n.sum(0)[self.of] + 1)

    def hang(self, deeper: Level) -> None:
        """Weigh this level over a weighted deeper one."""
        parent = np.zeros(deeper.ids.size, np.int64)
        parent[deeper.of] = self.of
        self.weighted = weigh(self.own, np.bincount(parent, deeper.weighted, self.ids.size))


def tree(key: np.ndarray, n: np.ndarray) -> list[Level]:
    """Depths 3 to DEPTH of whole groups of strings, weighted."""
    byte, context = key & 255, key >> 8
    levels = [Level(context & ((1 << 8 * depth) - 1), byte, n) for depth in range(3, DEPTH + 1)]
    levels[-1].weighted = levels[-1].own
    for upper, deeper in zip(levels[-2::-1], levels[:0:-1]):
        upper.hang(deeper)
    return levels


def mixture(estimates: list[np.ndarray], own: list[np.ndarray], weighted: list[np.ndarray], seen: list[np.ndarray]) -> np.ndarray:
    """Probability of each bit, from the root's depth on; ``seen``: whether training reached the node."""
    p = estimates[-1]
    for depth in range(len(estimates) - 2, -1, -1):
        share = np.where(seen[depth + 1], np.exp(np.minimum(0, _HALF + own[depth] - weighted[depth])), 1.0)
        p = share * estimates[depth] + (1 - share) * p
    return p


def _sum_by(ids: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, at = np.unique(ids, return_inverse=True)
    return unique, *(np.bincount(at, c, unique.size) for c in columns)


def _streamed(rows: DataFrame) -> DataFrame:
    """(third, key, n) with those of one pair of bytes before the last in one partition, in the order of the pairs and the byte before them (``third``)."""
    pair = F.shiftright("key", 8).bitwiseAND(0xFFFF)
    return rows.withColumn("pair", pair).repartition("pair").sortWithinPartitions("pair", "third").select("third", "key", "n")


def _groups(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays third, key and n of about ``size`` rows, cut where the pair or the third byte changes."""
    held, rows = [], 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("third", "key", "n")))
        rows += batch.num_rows
        if rows < size:
            continue
        third, key, n = (np.concatenate(x) for x in zip(*held, strict=True))
        group = (key >> 8 & 0xFFFF) << 16 | np.maximum(third, -1).astype(np.int64) & 0xFFFF  # the kinds of told rows are one group
        changes = np.flatnonzero(group[1:] != group[:-1]) + 1
        if changes.size:
            cut = changes[-1]
            yield third[:cut], key[:cut], n[:cut]
            held, rows = [(third[cut:], key[cut:], n[cut:])], key.size - cut
        else:
            held = [(third, key, n)]
    if rows:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


#: Kinds of rows that tell the sums of a node of depth 2, in the place of the third byte, so that they come before the strings.
ZEROS, ONES, BELOW = -3, -2, -1
_ROW = pa.schema([("third", pa.int16()), ("key", pa.int64()), ("n", pa.int64())])


def log_probabilities(counted: DataFrame) -> DataFrame:
    """(key, value): the natural log-probability of the last byte of each string of ``counted`` (key, n) after the bytes before it."""
    spark = counted.sparkSession
    strings_ = counted.select(F.shiftright("key", 24).bitwiseAND(0xFF).cast("short").alias("third"), "key", "n")
    sums = pa.schema([("node", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("below", pa.float64())])
    tops = pa.schema([("node", pa.int32()), ("zeros", pa.float64()), ("ones", pa.float64()), ("below", pa.float64())])

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, key, n in _groups(batches):
            three = tree(key, n)[0]
            node, zeros, ones, below = _sum_by(three.ids & 0xFFFFFF, three.n[0], three.n[1], three.weighted)
            yield output(sums, node=node, zeros=zeros, ones=ones, below=below)

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, zeros, ones, below = (batch.column(c).to_numpy() for c in sums.names)
            node, zeros, ones, below = _sum_by(node & 0xFFFF, zeros, ones, weigh(log_kt(zeros, ones), below))
            yield output(tops, node=node.astype(np.int32), zeros=zeros, ones=ones, below=below)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, c in ((ZEROS, "zeros"), (ONES, "ones"), (BELOW, "below")):
                yield output(_ROW, third=np.full(batch.num_rows, kind, np.int16), key=batch.column("node"), n=batch.column(c).to_numpy().view(np.int64))

    added = lambda df: df.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below")))
    twos = materialize(added(_streamed(strings_).mapInArrow(up, "node long, zeros double, ones double, below double")), "nodes")
    top = np.zeros((3, 256, 256))  # zeros, ones, and the product below, by the byte before and the node
    for r in added(twos.mapInArrow(upper, "node int, zeros double, ones double, below double")).collect():  # 256 * 255 rows at most
        top[:, r["node"] >> 8, r["node"] & 255] = r["zeros"], r["ones"], r["below"]
    one_own = log_kt(top[0], top[1])
    one_weighted = weigh(one_own, top[2])
    root = top[:2].sum(1)
    root_own = log_kt(*root)
    shared = spark.sparkContext.broadcast((top[:2], one_own, one_weighted, root, root_own, weigh(root_own, one_weighted.sum(0))))
    valued = pa.schema([("key", pa.int64()), ("value", pa.float64())])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, one_own, one_weighted, root, root_own, root_weighted = shared.value
        ids, known = np.zeros(0, np.int64), np.zeros((3, 0))  # nodes of depth 2 that strings to come may need: zeros, ones, below
        for third, key, n in _groups(batches):
            rows = [key[third == kind] for kind in (ZEROS, ONES, BELOW)]
            by = [np.argsort(r) for r in rows]
            fresh = np.array([n[third == kind][b].view(np.float64) for kind, b in zip((ZEROS, ONES, BELOW), by, strict=True)]).reshape(3, -1)
            ids, known = np.r_[ids, rows[0][by[0]]], np.concatenate([known, fresh], axis=1)
            key, n = key[third >= 0], n[third >= 0]
            if not key.size:
                continue
            two_own = log_kt(known[0], known[1])
            two_weighted = weigh(two_own, known[2])
            levels = tree(key, n)
            bit, three = levels[0].bit, levels[0].ids[levels[0].of]
            node, first = three & 255, np.broadcast_to(key >> 8 & 255, three.shape)
            at = np.searchsorted(ids, three & 0xFFFFFF)
            kt = lambda zeros, ones, bit=bit: (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)
            p = mixture(
                [kt(root[0][node], root[1][node]), kt(one[0][first, node], one[1][first, node]), kt(known[0][at], known[1][at]), *(x.estimate() for x in levels)],
                [root_own[node], one_own[first, node], two_own[at], *(x.own[x.of] for x in levels)],
                [root_weighted[node], one_weighted[first, node], two_weighted[at], *(x.weighted[x.of] for x in levels)],
                [root.sum(0)[node] > 0, one.sum(0)[first, node] > 0, known[:2].sum(0)[at] > 0, *(x.n.sum(0)[x.of] > 0 for x in levels)],
            )
            yield output(valued, key=key, value=np.log(p).sum(0))
            keep = ids >> 8 == key[-1] >> 8 & 0xFFFF  # the last pair's strings may go on
            ids, known = ids[keep], known[:, keep]

    both = strings_.unionByName(twos.mapInArrow(told, "third short, key long, n long"))
    return _streamed(both).mapInArrow(down, "key long, value double")


def score(docs: DataFrame, trains: Column, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key``, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability) and bits_per_byte for every row; learns from rows where ``trains``."""
    spark = docs.sparkSession
    rows = long_rows(docs).select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(trains, F.lit(True)).alias("trains"))
    counted = materialize(gather(rows), "counts")
    values = materialize(log_probabilities(counted.where(F.col("kind") == STRINGS)), "values")
    known = counted.where((F.col("kind") == WORDS) & (F.col("n") > 0)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = known["n"], known["v"]
    blocks = math.ceil((rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 1) / block_bytes)
    parts = min(blocks, MOST_PARTS)
    apart = lambda df: df.withColumn("slot", F.pmod("block", F.lit(parts)).cast("int")).repartitionById(parts, "slot")
    dealt = apart(rows.select("id", "text", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int").alias("block")))
    asked = pa.schema([("block", pa.int32()), ("kind", pa.int8()), ("key", pa.int64())])

    def ask(table: pa.Table) -> pa.Table:
        held: dict[int, list] = {WORDS: [np.array([END])], STRINGS: []}
        for part in steps(iter(table.to_batches()), "text", STEP_BYTES):
            data, offsets = column_bytes(part.column("text"))
            held[WORDS].append(np.unique(words(data, offsets)[0]))
            held[STRINGS].append(np.unique(strings(data, offsets)[0]))
            for kind, found in held.items():
                if sum(f.size for f in found) > 1 << 21:
                    held[kind] = [np.unique(np.concatenate(found))]
        keys = {kind: np.unique(np.concatenate(k)) for kind, k in held.items()}
        size = sum(k.size for k in keys.values())
        return pa.table({"block": np.full(size, table.column("block")[0].as_py(), np.int32), "kind": np.repeat(np.array(list(keys), np.int8), [k.size for k in keys.values()]), "key": np.concatenate(list(keys.values()))}, asked)

    table = counted.where(F.col("kind") == WORDS).select("kind", "key", F.col("n").cast("double").alias("value")).union(values.select(F.lit(STRINGS).cast("byte").alias("kind"), "key", "value"))
    answers = apart(dealt.groupBy("slot", "block").applyInArrow(ask, "block int, kind byte, key long").join(table, ["kind", "key"]).select("block", "kind", "key", "value"))
    scored = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    def tell(texts: pa.Table, held: pa.Table) -> pa.Table:
        kind, keys, value = (held.column(c).to_numpy() for c in ("kind", "key", "value"))
        look = {}
        for k in (WORDS, STRINGS):
            look[k] = Lookup(keys[kind == k], value[kind == k])
        log = lambda n: np.log10((n + 1) / (total + distinct + 1))
        end = look[WORDS](np.array([END]))[0]
        done = []
        for part in steps(iter(texts.to_batches()), "text", STEP_BYTES):
            data, offsets = column_bytes(part.column("text"))
            found, before = words(data, offsets)
            n = look[WORDS](found)
            sums = lambda x, before: np.diff(np.r_[0, np.cumsum(x)][before])
            n_words = np.diff(before)
            base, n_known = sums(log(n), before) + log(end), sums((n > 0).astype(np.int64), before) + int(end > 0)
            found, before = strings(data, offsets)
            whole = sums(look[STRINGS](found), before)
            bits = -whole / math.log(2) / np.maximum(np.diff(offsets), 1)
            done.append(output(scored, **{key: part.column("id")}, n_tokens=n_words + 1, n_known=n_known, base_score=base, score=whole / _LN10, bits_per_byte=bits))
        return pa.Table.from_batches(done, scored)

    out = dealt.groupBy("slot", "block").cogroup(answers.groupBy("slot", "block")).applyInArrow(tell, f"{key} long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double")
    return out.withColumn("train_tokens", F.lit(total).cast("long"))
