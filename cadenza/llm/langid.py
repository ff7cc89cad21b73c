"""Language identification of mixed-language text.

1. Training: byte n-grams of words (orders 2 to 4, with the spaces around) are counted per language in tables of a fixed size, over
   a hashed sample of about ``SAMPLE`` labelled documents a language (all of them where there are fewer).  The scripts of the words
   are counted too.  Only the sums reach the driver; they are bounded by languages times table size.
2. Each word of a text has a script, from the range that holds its first character.  Languages that hardly use
   this script in training are no candidates for the word, unless no language uses it.
3. A word's score for a language is the mean over orders of its n-grams' log-likelihood.  The best labels of all words of a
   text, where each change of language costs ``SWITCH``, come from the Viterbi algorithm, run over all texts of a batch at once.
4. Equal neighbours are spans.  The language with most bytes in the text's spans is predicted; its share is the score.

Words are runs of ASCII letters and bytes from 0x80, lower-cased.  A text that is null or has no letter is ``und`` with
score 0 and no spans; so is every text if there is nothing to learn from.  Ties go to the first language in sort order.
Repeated rows get a row each.  Null ids are kept.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import column_bytes, long_rows, output, steps, word_spans

ORDERS, SLOT_BITS, SAMPLE, SWITCH, ALPHA, SHARE = (2, 3, 4), 16, 2_000, 12.0, 0.5, 0.005
#: Bytes of text in one step: the more texts go through Viterbi together, the fewer steps over their words.
STEP_BYTES = 4 << 20
#: First code points of ranges, and their scripts; what lies between ranges is "other".
SCRIPTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x005B, "other"), (0x0061, "latin"), (0x007B, "other"), (0x00AA, "latin"), (0x00AB, "other"), (0x00BA, "latin"), (0x00BB, "other"),
    (0x00C0, "latin"), (0x02B0, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x323B0, "other"),
)
NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for _, name in SCRIPTS])
_WORD = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_SLOTS = len(ORDERS) << SLOT_BITS


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # by language and slot
    candidates: np.ndarray  # by script and language


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a space for each byte of no word and one between texts, word starts and ends in them, and the number of words before each text."""
    data, offsets = column_bytes(pc.utf8_lower(column))
    starts, ends, owner = word_spans(data, offsets, _WORD)
    shift = np.arange(offsets.size) + 1
    spaced = np.full(data.size + offsets.size + max(ORDERS), 32, np.uint8)
    at = np.arange(data.size) + np.repeat(shift[:-1], np.diff(offsets))
    spaced[at] = np.where(_WORD[data], data, 32)
    return spaced, starts + shift[owner], ends + shift[owner], np.searchsorted(owner, np.arange(offsets.size))


def slots(spaced: np.ndarray, order: int) -> np.ndarray:
    """The table slot of the n-gram that starts at each byte."""
    n, gram = spaced.size - order + 1, np.zeros(spaced.size - order + 1, np.uint32)
    for k in range(order):
        gram = (gram << np.uint32(8)) | spaced[k : k + n]
    return ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)) + np.uint32(ORDERS.index(order) << SLOT_BITS)


def scripts(spaced: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The script of the character at each start."""
    b = [spaced[starts + k].astype(np.int64) for k in range(4)]
    tail = [x & 63 for x in b]
    point = np.where(b[0] < 0x80, b[0], np.where(b[0] < 0xE0, (b[0] & 31) << 6 | tail[1], np.where(b[0] < 0xF0, (b[0] & 15) << 12 | tail[1] << 6 | tail[2], (b[0] & 7) << 18 | tail[1] << 12 | tail[2] << 6 | tail[3])))
    return _SCRIPT[np.searchsorted(_FIRST, point, "right") - 1]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """From rows with a text and a language.  ``sample``: about how many documents of a language are read, chosen by a hash of the key."""
    rows = long_rows(labelled).where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    share = {r["lang"]: min(1.0, sample / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(share)
    if not names:
        return Model([], np.zeros((0, _SLOTS)), np.zeros((len(NAMES), 0), bool))
    some = F.lit(False)
    for name in names:
        some = some | ((F.col("lang") == name) & (F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < round(share[name] * (1 << 20))))
    schema = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP_BYTES):
            for name in part.column("lang").unique().to_pylist():
                spaced, starts, ends, _ = words_of(part.filter(pc.equal(part.column("lang"), name)).column("text"))
                totals = np.bincount(scripts(spaced, starts) + _SLOTS, minlength=_SLOTS + len(NAMES))
                for order in ORDERS:
                    at, sizes = starts - 1, np.maximum(ends - starts + 3 - order, 0)
                    stops = np.cumsum(sizes)
                    picks = np.arange(stops[-1] if stops.size else 0) + np.repeat(at - (stops - sizes), sizes)
                    totals += np.bincount(slots(spaced, order)[picks], minlength=totals.size)
                used = np.flatnonzero(totals)
                yield output(schema, lang=[name] * used.size, slot=used.astype(np.int32), n=totals[used])

    counts = np.zeros((len(names), _SLOTS + len(NAMES)))
    place = {name: i for i, name in enumerate(names)}
    for row in rows.where(some).select("lang", "text").mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[place[row["lang"]], row["slot"]] = row["n"]
    grams = counts[:, :_SLOTS].reshape(len(names), len(ORDERS), -1) + ALPHA
    logs = np.log(grams / grams.sum(2, keepdims=True)).reshape(len(names), -1) / len(ORDERS)
    used = counts[:, _SLOTS:] / np.maximum(counts[:, _SLOTS:].sum(1, keepdims=True), 1)
    return Model(names, logs, (used >= SHARE).T.copy())


def word_scores(model: Model, spaced: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """By word and language; minus infinity's stand-in (-1e6) for a language that the script rules out."""
    scores = np.zeros((starts.size, len(model.languages)))
    sums = np.zeros(spaced.size + 1)
    for order in ORDERS:
        slot = slots(spaced, order)
        low, high = starts - 1, np.maximum(ends + 2 - order, starts - 1)
        for k in range(len(model.languages)):
            np.cumsum(model.logs[k][slot], out=sums[1 : slot.size + 1])
            scores[:, k] += sums[high] - sums[low]
    fits = model.candidates[scripts(spaced, starts)]
    scores[~fits & fits.any(1, keepdims=True)] = -1e6
    return scores


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; ``bounds``: the number of words before each text (n + 1)."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    labels = np.zeros(scores.shape[0], np.int16)
    longest = int(sizes[0]) if sizes.size else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t words
    stay, source = np.ones(scores.shape, bool), np.zeros(scores.shape[0], np.int16)
    value = scores[starts[: alive[0]]] if longest else scores[:0]
    final = [np.zeros(0)] * longest
    for t in range(1, longest):
        if alive[t] < alive[t - 1]:
            final[t - 1] = value[alive[t] :].argmax(1)
        value, at = value[: alive[t]], starts[: alive[t]] + t
        best = value.argmax(1)
        moved = np.take_along_axis(value, best[:, None], 1) - switch
        stay[at], source[at] = value >= moved, best
        value = np.maximum(value, moved) + scores[at]
    if longest:
        final[-1] = value.argmax(1)
    now = np.zeros(0, np.int64)
    for t in range(longest - 1, -1, -1):
        if final[t].size:
            now = np.concatenate([now, final[t]])
        at = starts[: alive[t]] + t
        labels[at] = now
        if t:
            now = np.where(stay[at, now], now, source[at])
    return labels


def identify(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", switch: float = SWITCH) -> DataFrame:
    """``key``, lang_pred, score and spans (lang, first word, words, bytes) for every row."""
    table = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("n_bytes", pa.int32())])
    schema = pa.schema([(key, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = table.value
        names = pa.array(held.languages or ["und"])
        for part in steps(batches, "text", STEP_BYTES):
            n = part.num_rows
            usable = np.array(part.column("letters").to_pylist(), bool) & bool(held.languages)
            spaced, starts, ends, bounds = words_of(pc.if_else(pa.array(usable), part.column("text"), ""))
            if not starts.size:
                yield output(schema, **{key: part.column(key)}, lang_pred=["und"] * n, score=np.zeros(n), spans=[[]] * n)
                continue
            labels = viterbi(word_scores(held, spaced, starts, ends), bounds, switch)
            sizes = ends - starts
            owner = np.repeat(np.arange(n), np.diff(bounds))
            votes = np.bincount(owner * len(held.languages) + labels, sizes, n * len(held.languages)).reshape(n, -1)
            best, whole = votes.argmax(1), votes.sum(1)
            usable &= whole > 0
            first = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])])
            spans = pa.StructArray.from_arrays([names.take(pa.array(labels[first])), pa.array((first - bounds[owner[first]]).astype(np.int32)), pa.array(np.diff(np.r_[first, labels.size]).astype(np.int32)), pa.array(np.add.reduceat(sizes, first).astype(np.int32))], fields=list(span))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[first], np.arange(n + 1)).astype(np.int32)), spans)
            yield output(schema, **{key: part.column(key)}, lang_pred=pc.if_else(pa.array(usable), names.take(pa.array(best)), "und"), score=np.where(usable, votes.max(1) / np.maximum(whole, 1), 0.0), spans=lists)

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    picked = long_rows(docs).select(F.col(key).cast("long").alias(key), F.col(text).alias("text"), letters.alias("letters"))
    return picked.mapInArrow(run, f"{key} long, lang_pred string, score double, spans array<struct<lang:string,first_word:int,n_words:int,n_bytes:int>>")
