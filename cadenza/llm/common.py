"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import durable as materialize
from cadenza.session import scratch, shared_dir

#: Bytes that separate words everywhere here: space and \x09 to \x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy step handles; temporaries are a few dozen times that.
STEP_BYTES = 1 << 20


#: Rows in one Arrow batch of texts.  Spark's default of 10,000 makes batches of tens of MB, several of which are alive in a task.
BATCH_ROWS = 1_000


def long_rows(df: DataFrame) -> DataFrame:
    """``df``, after asking the session for Arrow batches of at most ``BATCH_ROWS`` rows, or fewer if it asks for fewer itself."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def own_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_, name__, ... that isn't a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(column: str, parts: int, rest: int):
    """Whether crc32 of the id written as text leaves ``rest`` modulo ``parts``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts == rest, F.lit(False))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and the n + 1 offsets; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if not len(column) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``limit`` bytes in ``column``; a longer text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < batch.num_rows:
            base = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(low, high - low)
            low = high
    pa.default_memory_pool().release_unused()


def gathered(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until ``column`` holds ``least`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def output(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below at least n, kept per worker."""
    held = _POWERS.get(base)
    if held is None or held.size < n:
        held = np.full(max(n, STEP_BYTES + 1), base, np.uint64)
        held[0] = 1
        held = _POWERS[base] = np.cumprod(held)
    return held


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of bytes with ``is_word`` (a table of 256), never across texts."""
    inside = np.zeros(data.size + 2, bool)
    inside[1:-1] = is_word[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < data.size)]
    begins[cuts] = inside[1:-1][cuts]
    stops[cuts - 1] = inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes that depends on its content alone.

    A span of eight bytes and more is the polynomial of its mixed 8-grams (a plain polynomial of bytes modulo 2 ** 64 has long texts of one hash for every base),
    a shorter one is its bytes as a number."""
    if not starts.size:
        return np.zeros(0, np.uint64)
    grams = np.zeros(data.size + 8, np.uint64)
    grams[: data.size] = data
    for k in (1, 2, 4):  # little-endian words of 2, 4 and 8 bytes from each position on
        grams[:-k] |= grams[k:] << np.uint64(8 * k)
    sizes = ends - starts
    short = sizes < 8
    sums = np.zeros(data.size + 1, np.uint64)
    np.cumsum(mix(grams[: data.size]) * _powers(_BASE, data.size + 1)[: data.size], out=sums[1:])
    h = (sums[np.maximum(ends - 7, starts)] - sums[starts]) * _powers(_INVERSE, data.size + 1)[starts]
    h[short] = grams[starts[short]] & ((np.uint64(1) << (8 * sizes[short]).astype(np.uint64)) - np.uint64(1))
    return mix(h ^ (sizes.astype(np.uint64) << np.uint64(48)) ^ np.uint64(0x9E3779B97F4A7C15))


def mix(h: np.ndarray) -> np.ndarray:
    """Murmur's finishing step, modulo 2 ** 64."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
