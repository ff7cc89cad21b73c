"""Quality rules: cross-document line frequency, after a few per-document measures.

Each document is read once.  A pass in Arrow batches returns its measures and, for each distinct normalised line,
a 64-bit hash with the words it holds.  Lines are then counted natively: distinct documents per (host, line), copies
of one text gathered first and all combined before the shuffle.  A line above ``line_docs`` documents of its host is
boilerplate there and is removed from all documents of that host but the first (smallest id), so one copy of
everything stays.  A document that keeps less than ``kept_share`` of its words is depleted and rejected.

A normalised line is its words joined by single spaces, A-Z lower-cased and digits written as 0; lines without a
word are neither counted nor removed.  Null texts have no words and fail the base rules.  A null host is a host of
its own.  A document is an id with a host and a text: rows that repeat all three share a verdict and count once, rows of one id with
different texts (or hosts) are judged apart, and so are rows without an id, which come last in the order of documents.  Extra columns pass through ``apply``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import long_rows, materialize, output, own_name, steps

LINE_DOCS, KEPT_SHARE, LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 0.4, 10, 20, 5
SYMBOLS = "#*$%&|<>"
_PLAIN = bytes(range(48)) + b"0" * 10 + bytes(range(58, 65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_NO_SYMBOLS = SYMBOLS.encode()
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_hash(line: bytes) -> int:
    """Signed 64-bit hash of a normalised line."""
    return xxhash.xxh64_intdigest(b" ".join(line.translate(_PLAIN).split())) - (1 << 63)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words covered by windows of ``size`` words that occur twice or more in the text, first ones included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX + ids[k : k + n]
    _, at, seen = np.unique(mixed, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(seen[at] > 1)
    if not starts.size:
        return 0
    return int(np.minimum(np.diff(starts, append=starts[-1] + size), size).sum())


def measure(text: bytes) -> tuple[tuple[int, int, int, int, int], dict[int, int]]:
    """The measures of one text, and the words of each distinct line (over all its occurrences) by hash."""
    words = text.split()
    spaces = sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    chars = (len(text) if text.isascii() else len(text.decode())) - spaces
    lines = [line for line in text.split(b"\n") if line.strip()]
    held: Counter[int] = Counter()
    for line in lines:
        held[line_hash(line)] += len(line.split())
    symbols = len(text) - len(text.translate(None, _NO_SYMBOLS))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)), held


def measures(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """``key``, host, a hash of the text, the measures, and arrays of the distinct lines' hashes and words."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = pa.schema([(key, pa.int64()), ("host", pa.string()), ("text_hash", pa.int64()), *((n, pa.int64()) for n in names), ("lines", pa.list_(pa.int64())), ("line_words", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            got = [measure((t or "").encode()) for t in part.column("text").to_pylist()]
            counts = zip(*(m for m, _ in got), strict=True)
            yield output(schema, **{key: part.column(key), "host": part.column("host"), "text_hash": part.column("text_hash")} | {n: list(c) for n, c in zip(names, counts, strict=True)}, lines=[list(h) for _, h in got], line_words=[list(h.values()) for _, h in got])

    picked = long_rows(docs).select(F.col(key).cast("long").alias(key), F.col(host).cast("string").alias("host"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return picked.mapInArrow(run, f"{key} long, host string, text_hash long, {_MEASURES}, lines array<long>, line_words array<long>")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def frequent_lines(marked: DataFrame, key: str = "doc_id", line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, line, first): lines in more than ``line_docs`` documents of a host, and the first document that has each, as (without an id, id, text hash)."""
    who = F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("id"), F.col("text_hash").alias("text_hash"))
    n_ids = F.count_distinct(key) + F.max(F.col(key).isNull().cast("long"))
    texts = marked.groupBy("host", "text_hash").agg(n_ids.alias("n"), F.min(F.struct(who.alias("who"), "lines")).alias("one"))
    lines = texts.select("host", "n", F.col("one.who").alias("who"), F.explode("one.lines").alias("line"))
    return lines.groupBy("host", "line").agg(F.sum("n").alias("n_docs"), F.min("who").alias("first")).where(F.col("n_docs") > line_docs)


def boilerplate(marked: DataFrame, frequent: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document (id, host and text hash) with lines to remove: their hashes and how many words go.  Each line of it counts once, however often its row occurs."""
    held = marked.select(key, "host", "text_hash", F.explode(F.arrays_zip("lines", "line_words")).alias("held"))
    is_first = F.col("h." + key).eqNullSafe(F.col("f.first.id")) & (F.col("h.text_hash") == F.col("f.first.text_hash"))
    hits = held.alias("h").join(frequent.alias("f"), F.col("h.host").eqNullSafe(F.col("f.host")) & (F.col("h.held.lines") == F.col("f.line")) & ~is_first)
    found = hits.groupBy(F.col("h." + key).alias("_key"), F.col("h.host").alias("_host"), F.col("h.text_hash").alias("_hash")).agg(F.collect_set("h.held").alias("held"))
    return found.select("_key", "_host", "_hash", F.aggregate("held", F.lit(0).cast("long"), lambda n, x: n + x["line_words"]).alias("n_boilerplate"), F.col("held.lines").alias("gone"))


def verdicts(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source", line_docs: int = LINE_DOCS, kept_share: float = KEPT_SHARE) -> DataFrame:
    """For every row: the measures, base_failed, n_boilerplate (words in removed lines), kept, and gone (hashes of removed lines, or null)."""
    marked = materialize(measures(docs, text, key, host), "quality")
    found = boilerplate(marked, frequent_lines(marked, key, line_docs), key)
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("host").eqNullSafe(F.col("_host")) & (F.col("text_hash") == F.col("_hash"))
    left = F.col("n_words") - F.col("n_boilerplate")
    out = marked.drop("lines", "line_words").join(found, same, "left").drop("_key", "_host", "_hash")
    out = out.withColumn("n_boilerplate", F.coalesce("n_boilerplate", F.lit(0))).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (left >= kept_share * F.col("n_words")))


def drop_lines(text: bytes, gone: set[int]) -> bytes:
    return b"\n".join(line for line in text.split(b"\n") if not line.strip() or line_hash(line) not in gone)


def apply(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source", **limits) -> DataFrame:
    """The kept documents with boilerplate lines removed, in the columns of ``docs``."""
    of_key, of_host, of_hash, lines = (own_name(docs, n) for n in ("of_key", "of_host", "of_hash", "gone"))
    kept = verdicts(docs, text, key, host, **limits).where("kept").groupBy(F.col(key).alias(of_key), F.col("host").alias(of_host), F.col("text_hash").alias(of_hash)).agg(F.first("gone").alias(lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, gone = batch.schema.get_field_index(text), batch.column(lines).to_pylist()
            if any(gone):
                texts = [t if not g or t is None else drop_lines(t.encode(), set(g)).decode() for t, g in zip(batch.column(at).to_pylist(), gone, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch.drop_columns([lines])

    same = F.col(key).cast("long").eqNullSafe(F.col(of_key)) & F.col(host).cast("string").eqNullSafe(F.col(of_host)) & (F.xxhash64(text) == F.col(of_hash))
    joined = long_rows(docs).join(kept, same).drop(of_key, of_host, of_hash)
    return joined.mapInArrow(run, docs.schema)
