"""Token ids in binary files by a static range asymmetric numeral system (rANS).

1. Texts become token ids.  The vocabulary's pre-tokenizer drops white space and never joins letters with what is neither
   letter nor digit, and its normaliser lower-cases, so each distinct lower-case word of a batch, without the mark
   after it, is encoded once; an end id follows each document.
2. The ids are counted over the whole corpus; the counts, scaled to a sum of 2 ** 20, are the frequency table that
   all blocks share.  Its size is bounded by the vocabulary.  It is written first, with a checksum.
3. Documents are dealt by ranges of their id, about ``PART`` tokens each, and sorted.  Each part writes blocks of ``BLOCK`` tokens; a
   longer document goes on in the next block.  A block holds ``LANES`` interleaved coders (token i belongs to lane i mod LANES), cut at a
   checkpoint every ``EVERY`` steps.  What lies between two checkpoints is a section of its own: the lanes' states, their 32-bit words
   in reading order and a CRC-32, so a reader may start at any checkpoint of any block and checks only what it reads.
4. Reading back needs the folder alone.  Sections are decoded as rows of their own; the CRC-32 of a document that spans
   several is combined from theirs.  Token numbers before a part come from one sum a part.

A folder holds ``table`` (one Parquet row) and ``blocks`` (a Parquet row for each block), so Spark's committer handles lost executors, in any store.

Null texts are empty: one end id.  Rows are ordered by id, null first, then by a hash of their ids; repeated rows are
written each.  Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, gathered, long_rows, materialize, output, scratch, steps
from cadenza.llm.token_counts import recall_pieces, seen_pieces, tokenizer

SCALE, LANES, BLOCK, EVERY, END = 20, 512, 1 << 18, 256, 1
#: Tokens in a range of ids.
PART = 1 << 21
#: Bytes of text whose words are encoded together.
WORD_BYTES = 12 << 20
_HEAD = struct.Struct("<4sIII")  # mark, lanes, tokens, words
_MARK = b"rANS"
_TABLE = "scale int, ids binary, frequencies binary, crc32 long"
_BLOCKS = "part int, block int, before long, n_tokens long, keys array<long>, lengths array<long>, past long, closes boolean, sections array<long>, data binary"
_LOWER = np.frombuffer(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)), np.uint8)
_LETTERS = np.array([97 <= b < 123 for b in range(256)])
_MARKS = np.array([chr(b) in ".,;:!?" for b in range(256)])
_U32, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def ragged(values: np.ndarray, bounds: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The slices ``values[bounds[p]:bounds[p + 1]]`` for each p of ``picks``, end to end."""
    sizes = bounds[picks + 1] - bounds[picks]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if ends.size else 0) + np.repeat(bounds[picks] - (ends - sizes), sizes)
    return values[at]


def loosen(column: pa.Array) -> pa.Array:
    """The same tokens, fewer distinct words: A-Z lower-cased and a space between an ASCII letter and a mark right after it."""
    data, offsets = column_bytes(column)
    data = _LOWER[data]
    apart = np.flatnonzero(_MARKS[data[1:]] & _LETTERS[data[:-1]]) + 1
    apart = apart[offsets[np.searchsorted(offsets, apart, "right") - 1] < apart]
    offsets = offsets + np.searchsorted(apart, offsets)
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(np.insert(data, apart, 32))])


def word_ids(column: pa.Array, made, seen: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts of a column, and the number of ids before each text."""
    column = pc.fill_null(column, "")
    if not pc.any(pc.match_substring(column, "<|")).as_py():  # else a lower-cased word might become a special token
        column = loosen(column)
    words = pc.ascii_split_whitespace(column)
    coded = words.flatten().dictionary_encode()
    table, bounds = recall_pieces(made, coded.dictionary.to_pylist(), seen)
    picks = coded.indices.to_numpy().astype(np.int64)
    offsets = words.offsets.to_numpy().astype(np.int64)
    before = np.r_[0, np.cumsum(bounds[picks + 1] - bounds[picks])]
    return ragged(table, bounds, picks), before[offsets - offsets[0]]


def tokenize(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", end: int = END) -> DataFrame:
    """``key``, n_tokens and ids (16-bit little-endian, as the vocabulary has fewer than 65,536 entries) with the end id, for every row."""
    schema = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = tokenizer(path)
        if made.get_vocab_size() > 1 << 16:
            raise ValueError("this layout holds vocabularies of up to 65,536 ids")
        for part in steps(gathered(batches, "text", WORD_BYTES), "text", 2 * WORD_BYTES):
            ids, before = word_ids(part.column("text"), made, seen_pieces(path))
            ids = np.insert(ids, before[1:], end).astype("<u2")
            bounds = (before + np.arange(before.size)) * 2
            packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)])
            yield output(schema, **{key: part.column(key)}, n_tokens=np.diff(bounds) // 2, ids=packed)

    return long_rows(docs).select(F.col(key).cast("long").alias(key), F.col(text).alias("text")).mapInArrow(run, f"{key} long, n_tokens long, ids binary")


def token_totals(coded: DataFrame) -> np.ndarray:
    """How often each id occurs in the whole corpus; at most 65,536 sums reach the driver."""
    schema = pa.schema([("id", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << 16, np.int64)
        for batch in batches:
            totals += np.bincount(column_bytes(batch.column("ids"))[0].view("<u2"), minlength=1 << 16)
        used = np.flatnonzero(totals)
        yield output(schema, id=used.astype(np.int32), n=totals[used])

    totals = np.zeros(1 << 16, np.int64)
    for row in coded.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        totals[row["id"]] = row["n"]
    return totals


def scale(totals: np.ndarray, bits: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2 ** bits, at least 1 for every id that occurs; all on id 0 if none does."""
    if not totals.sum():
        return np.r_[1 << bits, np.zeros(totals.size - 1, np.int64)].astype(np.uint64)
    used = totals > 0
    free = (1 << bits) - int(used.sum())
    freq = np.where(used, 1 + (totals.astype(np.float64) / totals.sum() * free).astype(np.int64), 0)
    freq[totals.argmax()] += (1 << bits) - freq.sum()
    return freq.astype(np.uint64)


def encode_block(ids: np.ndarray, freq: np.ndarray, lanes: int = LANES, every: int = EVERY) -> list[bytes]:
    """The sections of one block; states stay in [2 ** 32, 2 ** 64) and shed 32 bits at most once a token."""
    starts = (np.cumsum(freq) - freq).astype(np.uint64)
    rows = -(-ids.size // lanes)
    state = np.full(lanes, 1 << 32, np.uint64)
    words: list[np.ndarray] = []
    sections: list[bytes] = []
    for row in range(rows - 1, -1, -1):
        s = ids[row * lanes : (row + 1) * lanes]
        x, f = state[: s.size], freq[s]
        full = (x >> np.uint64(64 - SCALE)) >= f
        if full.any():
            words.append((x[full] & _LOW).astype("<u4"))
            x = np.where(full, x >> _U32, x)
        q = x // f
        state[: s.size] = (q << np.uint64(SCALE)) + (x - q * f) + starts[s]
        if row % every == 0:
            head = _HEAD.pack(_MARK, lanes, min(ids.size, (row + every) * lanes) - row * lanes, sum(w.size for w in words))
            packed = b"".join([head, state.astype("<u8").tobytes(), *(w.tobytes() for w in reversed(words))])
            sections.append(packed + struct.pack("<I", zlib.crc32(packed)))
            words = []
    return sections[::-1]


def symbols(freq: np.ndarray) -> np.ndarray:
    """The id of each of the 2 ** SCALE slots."""
    return np.repeat(np.arange(freq.size, dtype=np.uint16), freq.astype(np.int64))


def decode_section(section: bytes, freq: np.ndarray, slots: np.ndarray | None = None) -> np.ndarray:
    """The ids of one section; raises ValueError on a wrong checksum or mark."""
    if len(section) < _HEAD.size + 4 or zlib.crc32(memoryview(section)[:-4]) != struct.unpack("<I", section[-4:])[0]:
        raise ValueError("a section's checksum is wrong")
    mark, lanes, n, count = _HEAD.unpack_from(section)
    if mark != _MARK:
        raise ValueError("not a section")
    slots = symbols(freq) if slots is None else slots
    starts = np.cumsum(freq) - freq
    state = np.frombuffer(section, "<u8", lanes, _HEAD.size).copy()
    words = np.frombuffer(section, "<u4", count, _HEAD.size + 8 * lanes).astype(np.uint64)
    out, at, low = [], 0, np.uint64((1 << SCALE) - 1)
    for row in range(-(-n // lanes)):
        size = min(lanes, n - row * lanes)
        x = state[:size]
        slot = x & low
        s = slots[slot]
        x = freq[s] * (x >> np.uint64(SCALE)) + slot - starts[s]
        short = np.flatnonzero(x < (1 << 32))
        x[short] = (x[short] << _U32) | words[at : at + short.size]
        at += short.size
        state[:size] = x
        out.append(s)
    return np.concatenate(out).astype(np.uint32) if out else np.zeros(0, np.uint32)


def write_table(spark: SparkSession, freq: np.ndarray, folder: str) -> None:
    ids = np.flatnonzero(freq).astype("<u4")
    packed = ids.tobytes(), freq[ids].astype("<u4").tobytes()
    spark.createDataFrame([(SCALE, *packed, zlib.crc32(b"".join(packed)))], _TABLE).coalesce(1).write.parquet(f"{folder}/table")


def read_table(spark: SparkSession, folder: str) -> np.ndarray:
    """The frequencies by id; raises ValueError if they aren't what was written."""
    row = spark.read.schema(_TABLE).parquet(f"{folder}/table").first()
    if row is None or row.scale != SCALE or zlib.crc32(bytes(row.ids) + bytes(row.frequencies)) != row.crc32:
        raise ValueError("the frequency table's checksum is wrong")
    freq = np.zeros(1 << 16, np.uint64)
    freq[np.frombuffer(row.ids, "<u4")] = np.frombuffer(row.frequencies, "<u4")
    return freq


def write_blocks(coded: DataFrame, freq: np.ndarray, folder: str, key: str = "doc_id", parts: int | None = None, block: int = BLOCK) -> None:
    """Blocks in ascending order of ``key``: part, block, before (tokens of the part before it), n_tokens, the keys and lengths of its documents or their parts, past
    (tokens of its first document in blocks before), whether its last document closes in it, where its sections begin in data, and data."""
    spark = coded.sparkSession
    table = spark.sparkContext.broadcast(freq)
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("past", pa.int64()), ("closes", pa.bool_()), ("sections", pa.list_(pa.int64())), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, past = TaskContext.get().partitionId(), 0, 0, 0
        keys, lengths, held, size = [], [], [], 0

        def emit(closes: bool) -> pa.RecordBatch:
            nonlocal number, before, past, keys, lengths, held, size
            sections = encode_block(np.concatenate(held), table.value)
            at = np.cumsum([0, *map(len, sections)])
            made = output(schema, part=[part], block=[number], before=[before], n_tokens=[size], keys=[keys], lengths=[lengths], past=[past], closes=[closes], sections=[at], data=[b"".join(sections)])
            past = 0 if closes else lengths[-1] + (past if len(keys) == 1 else 0)
            number, before, keys, lengths, held, size = number + 1, before + size, [], [], [], 0
            return made

        for batch in batches:
            for name, ids in zip(batch.column(key).to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(ids.as_buffer(), "<u2").astype(np.int64)
                while ids.size:
                    held.append(ids[: block - size])
                    keys.append(name)
                    lengths.append(held[-1].size)
                    size += held[-1].size
                    ids = ids[held[-1].size :]
                    if size == block:
                        yield emit(not ids.size)
        if keys:
            yield emit(True)

    n = parts or max(1, -(-int(coded.agg(F.sum("n_tokens")).first()[0] or 0) // PART))
    order = [F.col(key).asc_nulls_first(), F.xxhash64("ids").asc()]
    ordered = coded.select(key, "ids").repartitionByRange(n, *order).sortWithinPartitions(*order, "ids")
    ordered.mapInArrow(run, _BLOCKS).write.parquet(f"{folder}/blocks")


def crc32_shift(crc: int, n: int) -> int:
    """What a CRC-32 becomes when n more bytes follow, without their own part: multiplied by x ** (8 n) in the checksum's field."""

    def times(a: int, b: int) -> int:
        product = 0
        for bit in range(31, -1, -1):
            if a >> bit & 1:
                product ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return product

    power, factor = 1 << 23, 1 << 31  # x ** 8 and 1, lowest degree in the highest bit
    while n:
        if n & 1:
            factor = times(factor, power)
        power = times(power, power)
        n >>= 1
    return times(factor, crc)


def read_sections(folder: str, spark: SparkSession, key: str = "doc_id") -> DataFrame:
    """One row for each document in each section, decoded: ``key``, start (tokens of all documents before), at (tokens of all sections and documents before what is here),
    n_tokens here, crc (their CRC-32), and closes (whether the document ends here)."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    offsets, total = {}, 0
    for row in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():  # a row for each part written, of millions of tokens
        offsets[row["part"]], total = total, total + row["n"]
    table = spark.sparkContext.broadcast((read_table(spark, folder), offsets))
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("crc", pa.int64()), ("closes", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, offsets = table.value
        slots = symbols(freq)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_section(row["section"], freq, slots).astype("<u4")
                low = row["number"] * LANES * EVERY
                if ids.size != min(LANES * EVERY, row["n_tokens"] - low):
                    raise ValueError("a section has lost tokens")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                own = np.flatnonzero((ends > low) & (starts < low + ids.size))
                a, b = np.maximum(starts[own] - low, 0), np.minimum(ends[own] - low, ids.size)
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(a, b, strict=True)]
                base = row["before"] + offsets[row["part"]]
                closes = (ends[own] <= low + ids.size) & ((own < len(row["keys"]) - 1) | row["closes"])
                yield output(schema, **{key: [row["keys"][i] for i in own]}, start=starts[own] + base - np.where(own > 0, 0, row["past"]), at=a + low + base, n_tokens=b - a, crc=crc, closes=closes)

    one = F.expr("substring(data, cast(sections[number] as int) + 1, cast(sections[number + 1] - sections[number] as int))")
    rows = blocks.withColumn("number", F.explode(F.sequence(F.lit(0), F.size("sections") - 2))).select("part", "before", "n_tokens", "keys", "lengths", "past", "closes", "number", one.alias("section"))
    return rows.mapInArrow(run, f"{key} long, start long, at long, n_tokens long, crc long, closes boolean")


def read_blocks(folder: str, spark: SparkSession, key: str = "doc_id") -> DataFrame:
    """``key``, start, n_tokens and ids_crc32 of every document in a folder that ``write`` made."""
    found = materialize(read_sections(folder, spark, key), "sections")
    alone = F.col("closes") & (F.col("at") == F.col("start"))
    whole = found.where(alone).select(key, "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def combine(table: pa.Table) -> pa.Table:  # the sections of one document
        rows, n, crc = table.sort_by("at").to_pylist(), 0, 0
        for row in rows:
            n, crc = n + row["n_tokens"], crc32_shift(crc, 4 * row["n_tokens"]) ^ row["crc"]
        if rows[0]["at"] != rows[0]["start"] or not rows[-1]["closes"] or n != rows[-1]["at"] + rows[-1]["n_tokens"] - rows[0]["start"]:
            raise ValueError("a document has lost a section")
        return pa.table({key: [rows[0][key]], "start": [rows[0]["start"]], "n_tokens": [n], "ids_crc32": [crc]}, schema)

    joined = found.where(~alone).groupBy("start").applyInArrow(combine, f"{key} long, start long, n_tokens long, ids_crc32 long")
    return whole.union(joined)


def write(docs: DataFrame, path: str, folder: str, text: str = "text", key: str = "doc_id") -> None:
    """Encode ``docs`` with the vocabulary at ``path`` and write the table and the blocks to ``folder``."""
    coded, drop = scratch(tokenize(docs, path, text, key), "ids")
    freq = scale(token_totals(coded))
    write_table(docs.sparkSession, freq, folder)
    write_blocks(coded, freq, folder, key)
    drop()


def round_trip(docs: DataFrame, path: str, folder: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``write``, and what reading the folder gives."""
    write(docs, path, folder, text, key)
    return read_blocks(folder, docs.sparkSession, key)
