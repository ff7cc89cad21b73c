"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here and rebuilt as the library's parts: the normaliser (its character map, the removal of
extra white space and the dummy prefix), the metaspace mark, unigram scores or, for a BPE model, merges in the order of their
scores, and byte fallback.  If no piece holds the mark after another character, no piece crosses a word's start,
so a batch's distinct words are encoded once, a few thousand in a call, and their ids are the result.  A word takes all marks of the run before it but the first; U+2581 in a
text is the same mark as a space, and is made one before texts are cut.  Parity: every distinct word (or text, where words can't be encoded apart) is also encoded by the
sentencepiece library, and so are, as a whole, all texts that hold U+2581; where the two differ, its ids are used and ``same_ids`` is false for the text.  Nothing is decided by a sample: other texts are
their words end to end for that library too, as it has no piece that crosses a word's start.
Decoding joins the pieces' bytes, of all texts of a batch at once; the texts that are compared as a whole are also decoded by the rebuilt tokenizer, and where that gives other text, ``same_ids`` is false, too.

Null texts count as empty, with no ids.  Repeated rows get a row each, null ids are kept, extra columns are ignored.
Text that holds the mark U+2581 itself decodes to a space there, as in the sentencepiece library.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.ans import ragged
from cadenza.llm.common import column_bytes, long_rows, output, steps
from cadenza.llm.token_counts import threads

MARK = "▁"
#: Bytes of text whose words are encoded together, units in one call of a library (each makes objects of a KB or so), and words that a worker remembers, each of so many characters at most.
WORD_BYTES, RUN, SEEN, SEEN_CHARS = 1 << 20, 4_096, 100_000, 64
#: Kinds of pieces and models in the protobuf.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_INNER = re.compile(r"(?:(?<= )|\A) ")
#: A string three times in a row: pieces of it can be made in several ways with one score, and the libraries choose among those in their own ways.
_TIE = re.compile(r"(.{1,8}?)\1\1", re.DOTALL)


def may_tie(unit: str) -> bool:
    """Whether the libraries may choose among equal scores in their own ways; an observation, no condition of what is compared."""
    return not unit or _TIE.search(unit) is not None


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; varints as int, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Spec:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    unk: int = 0


def parse(data: bytes) -> Spec:
    spec = Spec()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            spec.pieces.append((piece.get(1, b"").decode(), float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]), piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
            spec.kind, spec.byte_fallback, spec.unk = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), trainer.get(40, 0)
        elif number == 3:
            norm = dict(fields(value))
            spec.charsmap, spec.dummy_prefix, spec.remove_extra = norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1))
    return spec


def build(spec: Spec):
    """The library's tokenizer."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    ids = {piece: i for i, (piece, _, _) in enumerate(spec.pieces)}
    if spec.kind == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in spec.pieces], spec.unk, spec.byte_fallback)
    elif spec.kind == BPE:
        usable = {p for p, _, kind in spec.pieces if kind in (NORMAL, USER)}
        merges = []
        for piece, score, kind in spec.pieces:
            if kind in (NORMAL, USER):
                merges += [(-score, k, piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in usable and piece[k:] in usable]
        merges.sort(key=lambda m: (m[0], ids[m[2] + m[3]], m[1]))
        model = models.BPE(ids, [(a, b) for _, _, a, b in merges], unk_token=spec.pieces[spec.unk][0], fuse_unk=True, byte_fallback=spec.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    made = Tokenizer(model)
    steps_ = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    steps_ += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()] if spec.remove_extra else []
    steps_ += [normalizers.Prepend(MARK)] if spec.dummy_prefix else []
    made.normalizer = normalizers.Sequence([*steps_, normalizers.Replace(" ", MARK)])
    made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    made.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else [])])
    return made


class Codec:
    """A rebuilt model, the sentencepiece library's own for parity, and the words that this worker has seen."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.spec = parse(data)
        self.fast = build(self.spec)
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.seen: dict[str, tuple[bytes, bool]] = {}
        #: Whether words can be encoded apart: no piece crosses their start, and the normaliser keeps text as it is.
        self.by_word = self.spec.dummy_prefix and not self.spec.charsmap and not self.spec.remove_extra and not any(MARK in p.lstrip(MARK) for p, _, kind in self.spec.pieces if kind in (NORMAL, USER))
        self.alone = self.own.piece_to_id(MARK)
        self.coded = pa.array([self._bytes(p, kind) for p, _, kind in self.spec.pieces], pa.large_binary())

    def _bytes(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def encode_units(self, units: list[str]) -> list[tuple[bytes, bool]]:
        """(ids as bytes, whether they are the rebuilt tokenizer's) of each unit, encoded as a text of its own.

        All units also go through sentencepiece; where it differs, its ids count."""
        fresh, new = [u for u in units if u not in self.seen], {}
        for low in range(0, len(fresh), RUN):
            new |= self._encoded(fresh[low : low + RUN])
        got = [self.seen.get(u) or new[u] for u in units]
        self.seen.update(islice(((u, x) for u, x in new.items() if len(u) <= SEEN_CHARS), max(0, SEEN - len(self.seen))))
        return got

    def _encoded(self, units: list[str]) -> dict[str, tuple[bytes, bool]]:
        # tasks run side by side already, and each thread of the library's own would keep memory of its own
        with threads(False):
            made = [e.ids for e in self.fast.encode_batch_fast(units, add_special_tokens=False)]
        own = self.own.encode(units, num_threads=1)
        if self.by_word and "" in units:  # a mark at a text's end
            at = units.index("")
            made[at], own[at] = [self.fast.token_to_id(MARK)], [self.alone]
        return {u: (struct.pack(f"<{len(ids)}I", *ids), ids == mine) for u, ids, mine in zip(units, own, made, strict=True)}

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts of a column, the number of ids before each text, and whether all of a text's are the rebuilt tokenizer's."""
        column = pc.fill_null(column, "")
        empty = pc.equal(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        texts = column
        if self.by_word:
            column = pc.replace_substring(column, MARK, " ")
            inner = pc.or_(pc.match_substring(column, "  "), pc.starts_with(column, " "))
            if pc.any(inner).as_py():  # of several spaces, all but the first belong to the next word
                column = pa.array([_INNER.sub(MARK, t) if i else t for t, i in zip(column.to_pylist(), inner.to_pylist(), strict=True)], column.type)
            units = pc.split_pattern(column, " ")
            coded, offsets = units.flatten().dictionary_encode(), units.offsets.to_numpy().astype(np.int64)
        else:
            coded, offsets = column.dictionary_encode(), np.arange(len(column) + 1)
        got = self.encode_units(coded.dictionary.to_pylist())
        table = np.frombuffer(b"".join(g for g, _ in got), "<u4")
        bounds = np.cumsum([0, *(len(g) // 4 for g, _ in got)])
        picks = coded.indices.to_numpy().astype(np.int64)
        keep = np.repeat(~empty, np.diff(offsets))  # an empty text has one empty unit and no ids
        picks, offsets = picks[keep], np.r_[0, np.cumsum(keep)][offsets - offsets[0]]
        before = np.r_[0, np.cumsum(bounds[picks + 1] - bounds[picks])]
        wrong = np.r_[0, np.cumsum(~np.array([ok for _, ok in got], bool)[picks])]
        return self._compared(texts, ragged(table, bounds, picks), before[offsets], wrong[offsets[1:]] == wrong[offsets[:-1]])

    def _compared(self, texts: pa.Array, ids: np.ndarray, before: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same after whole texts with U+2581 were compared with the sentencepiece library."""
        at = np.flatnonzero(pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)).tolist()
        if not at:
            return ids, before, same
        whole, same = texts.take(pa.array(at, pa.int32())).to_pylist(), same.copy()
        made = [ids[before[i] : before[i + 1]] for i in at]
        other = {}
        for i, mine, own in zip(at, made, self.own.encode(whole, num_threads=1), strict=True):
            if not np.array_equal(mine, own):
                other[i] = np.array(own, "<u4")
                same[i] = False
        back, ends = self.decode(np.concatenate(made), np.cumsum([0, *map(len, made)]))
        for k, text in enumerate(self.fast.decode_batch([m.tolist() for m in made], skip_special_tokens=False)):
            same[at[k]] &= text.encode() == back[ends[k] : ends[k + 1]].tobytes()
        if other:
            parts = [other.get(i, ids[before[i] : before[i + 1]]) for i in range(len(texts))]
            ids, before = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, before, same

    def decode(self, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts end to end and the n + 1 offsets, without the space that the dummy prefix puts first."""
        data, sizes = column_bytes(self.coded.take(pa.array(ids, pa.uint32())))
        offsets = sizes[before]
        first = offsets[:-1][np.diff(offsets) > 0]
        if self.spec.dummy_prefix and first.size:
            first = first[data[first] == 32]
            data, offsets = np.delete(data, first), offsets - np.searchsorted(first, offsets)
        return data, offsets


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(file.read())


def encode_decode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``key``, n_tokens, ids_crc32 (of 32-bit little-endian ids), same_ids (all ids are the rebuilt tokenizer's) and same_text (decoding gives the text) for every row, and ids if asked for."""
    schema = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("same_ids", pa.bool_()), ("same_text", pa.bool_()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(path)
        for part in steps(batches, "text", WORD_BYTES):
            ids, before, same = made.encode(part.column("text"))
            data, offsets = made.decode(ids, before)
            was, held = column_bytes(part.column("text"))
            equal = [np.array_equal(data[a:b], was[c:d]) for a, b, c, d in zip(offsets, offsets[1:], held, held[1:])]
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(before, before[1:])]
            more = {"ids": pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(ids.astype(np.int32)))} if with_ids else {}
            yield output(schema, **{key: part.column(key)}, n_tokens=np.diff(before), ids_crc32=crc, same_ids=same, same_text=equal, **more)

    picked = long_rows(docs).select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    return picked.mapInArrow(run, f"{key} long, n_tokens long, ids_crc32 long, same_ids boolean, same_text boolean{', ids array<int>' if with_ids else ''}")


def add_pieces(docs: DataFrame, path: str, text: str = "text", ids: str = "piece_ids", decoded: str = "decoded", same: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of each text, what decoding them gives and, under the name ``same`` if there is one, whether all ids are the rebuilt tokenizer's; clashing columns are replaced."""
    docs = long_rows(docs).drop(ids, decoded, *([same] if same else []))
    kept = [f.name for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(path)
        for part in steps(batches, text, WORD_BYTES):
            got, before, equal = made.encode(part.column(text))
            data, offsets = made.decode(got, before)
            lists = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(got.astype(np.int32)))
            back = pa.array([bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists, back, *([pa.array(equal)] if same else [])], names=[*kept, ids, decoded, *([same] if same else [])])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType()), *([T.StructField(same, T.BooleanType())] if same else [])]))
