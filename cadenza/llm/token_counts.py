"""Token counts: batches of about equal bytes go through the tokenizers library, only lengths come back.

Texts are split at boundaries where the byte-level pre-tokenizer must break anyway, so the counts of the pieces add up to the count of the
whole: before a space that a character other than white space follows (a match starts at that space, whatever white
space comes before it), and between a letter and a mark like a comma, of ASCII or of Chinese, Japanese and Korean (letters and marks never share a match).
An added token holds neither.  So a long text is encoded in many small pieces, in any script that has spaces or such marks; what lies between two
boundaries is one match of the pre-tokenizer, or a few, and can't be cut.  A vocabulary that cuts texts in another way has whole texts encoded.
A piece that comes again, in a batch or among those that a worker remembers, isn't encoded again.

Null texts count as empty.  Repeated rows each give a row, null ids are kept, extra columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, gathered, long_rows, output, steps

#: Bytes of text whose pieces are encoded together, pieces that a worker remembers, and pieces in one text of a call.
BATCH_BYTES, SEEN, RUN = 8 << 20, 400_000, 2_048
_LETTERS = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_MARKS = np.array([chr(b) in ".,;:!?" for b in range(256)])
#: Bytes after which a character other than white space surely stands: ASCII from 0x21 to 0x7E and leads of U+00C0 and up, but for those that white space shares.
_SOLID = np.array([0x21 <= b < 0x7F or (0xC3 <= b < 0xF5 and b not in (0xE1, 0xE2, 0xE3)) for b in range(256)])
#: Second bytes that no white space has after the leads E1 (U+1680), E2 (U+2000 to U+205F) and E3 (U+3000).
_SECOND = {0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}
#: Leads of three-byte characters that are all letters: U+4E00 to U+9FFF (but its first lead, which others share) and Hangul syllables (but the last lead).
_IDEOGRAPHS = np.array([0xE5 <= b <= 0xE9 or b in (0xEB, 0xEC) for b in range(256)])
#: Marks of three bytes after them: U+3001, U+3002 and the full-width ! , : ; ?.
_WIDE_MARKS = ("、", "。", "！", "，", "：", "；", "？")


@contextmanager
def threads(on: bool):
    """Whether the library uses threads of its own for calls in this block."""
    before = os.environ.get("TOKENIZERS_PARALLELISM")
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if on else "false"
    try:
        yield
    finally:
        if before is None:
            del os.environ["TOKENIZERS_PARALLELISM"]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = before


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer for a .json file, once per Python worker."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=4)
def seen_pieces(path: str) -> dict[str, bytes]:
    """Ids of pieces encoded before by this Python worker, up to a bound."""
    return {}


def encode_pieces(made, pieces: list[str], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces end to end and the n + 1 bounds.  An added special token separates the pieces in a text, as the library cuts there first."""
    # tasks run side by side already, so the library's own threads, which spin between short calls, stay off
    with threads(False):
        return _encode_pieces(made, pieces, run)


def _encode_pieces(made, pieces: list[str], run: int) -> tuple[np.ndarray, np.ndarray]:
    special = next(((str(t), i) for i, t in made.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip)), None)
    if special is None or any(special[0] in p for p in pieces):
        lists = [e.ids for e in made.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.fromiter((i for ids in lists for i in ids), np.uint32), np.cumsum([0, *map(len, lists)])
    texts = [special[0].join([*pieces[i : i + run], ""]) for i in range(0, len(pieces), run)]
    ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in made.encode_batch_fast(texts, add_special_tokens=False))])
    stops = np.flatnonzero(ids == special[1])
    return np.delete(ids, stops), np.r_[0, stops - np.arange(stops.size)]


def recall_pieces(made, pieces: list[str], seen: dict[str, bytes], most: int = SEEN) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode_pieces``, but pieces in ``seen`` aren't encoded again."""
    fresh = [p for p in pieces if p not in seen]
    ids, bounds = encode_pieces(made, fresh)
    raw, at = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
    new = {p: raw[a:b] for p, a, b in zip(fresh, at, at[1:])}
    got = [seen[p] if p in seen else new[p] for p in pieces]
    if len(seen) < most:
        seen.update(new)
    return np.frombuffer(b"".join(got), "<u4"), np.cumsum([0, *map(len, got)]) // 4


def byte_level(made) -> bool:
    """Whether the tokenizer cuts texts as ``split_pieces`` takes for granted: the byte-level pattern on the text as it is."""
    parts = json.loads(made.to_str())
    before = parts["pre_tokenizer"] or {}
    return parts["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")


def split_pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts of a column, and the number of pieces before each text (n + 1)."""
    data, offsets = column_bytes(column)
    inner = np.zeros(data.size + 1, bool)
    if data.size > 2:
        solid = _SOLID[data[2:]]
        for lead, seconds in _SECOND.items():
            at = np.flatnonzero((data[2:-1] == lead) & (data[1:-2] == 32))
            solid[at[~np.isin(data[at + 3], seconds)]] = True
        inner[1:-2] = (data[1:-1] == 32) & solid
        inner[1:-1] |= _MARKS[data[1:]] & _LETTERS[data[:-1]]
    if data.size > 5:
        wide = np.zeros(data.size - 2, bool)  # where a mark of three bytes starts
        for mark in map(str.encode, _WIDE_MARKS):
            wide |= (data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])
        starts = np.flatnonzero(wide[3:]) + 3
        inner[starts[_IDEOGRAPHS[data[starts - 3]]]] = True
    inner[offsets] = True
    cuts = np.flatnonzero(inner) if data.size else np.zeros(1, np.int64)
    pieces = pa.Array.from_buffers(pa.large_string(), cuts.size - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces, np.searchsorted(cuts, offsets)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for every row."""
    schema = pa.schema([(key, pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, seen = tokenizer(path), seen_pieces(path)
        splits = byte_level(made)
        for part in steps(gathered(batches, "text", BATCH_BYTES), "text", 2 * BATCH_BYTES):
            column = part.column("text")
            pieces, before = split_pieces(column) if splits else (pc.fill_null(column, ""), np.arange(len(column) + 1))
            coded = pieces.dictionary_encode()
            sizes = np.diff(recall_pieces(made, coded.dictionary.to_pylist(), seen)[1])
            totals = np.r_[0, np.cumsum(sizes[coded.indices.to_numpy()])]
            yield output(schema, **{key: part.column(key), "n_bytes": np.diff(column_bytes(column)[1]), "n_tokens": np.diff(totals[before])})

    ids = long_rows(docs).select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    return ids.mapInArrow(run, f"{key} long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
