"""Each operator against brute force or an exact round trip, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import rows as plain_rows
from pyspark.sql import functions as F

from cadenza.llm import ans, chat, ctw, decontam, langid, piece, quality, queries, simhash_vp, suffix_dedup, token_counts
from cadenza.llm.common import held_out

WORD_BPE, BYTE_BPE, PIECES = (queries.vocabulary(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def low(b):
    return re.sub(rb"[A-Z]+", lambda m: m[0].lower(), b)


def by_id(df, key="doc_id"):
    out = {r[key]: r for r in df.collect()}
    return out


# 1 language identification


def languages(spark):
    rnd = random.Random(2)
    words = {"en": ["the", "house", "water", "light", "thing"], "fr": ["été", "maison", "lumière", "chose", "eau"], "ru": ["дом", "вода", "свет", "вещь", "книга"]}
    rows = [(i, " ".join(rnd.choice(words[lang]) for _ in range(40)), lang) for i, lang in enumerate(["en", "fr", "ru"] * 20)]
    return words, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_identification(spark):
    words, labelled = languages(spark)
    model = langid.train(labelled.where(~held_out("doc_id", 4, 2)))
    assert model.languages == ["en", "fr", "ru"]
    mixed = " ".join(words["en"] * 6) + " " + " ".join(words["fr"] * 3) + " " + " ".join(words["ru"])
    odd = [(1, mixed), (2, None), (3, ""), (4, "12 !?"), (5, "дом"), (6, "日本"), (7, "the " * 30_000), (7, "the")]
    out = langid.identify(spark.createDataFrame(odd, "doc_id long, text string").withColumn("letters", F.lit(1)), model).collect()
    got = {r.doc_id: r for r in out if r.doc_id != 7}
    assert [(s.lang, s.n_words) for s in got[1].spans] == [("en", 30), ("fr", 15), ("ru", 5)] and got[1].lang_pred == "en" and 0 < got[1].score < 1
    assert [(got[i].lang_pred, got[i].score, got[i].spans) for i in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert got[5].lang_pred == "ru" and len([r for r in out if r.doc_id == 7]) == 2
    held = labelled.where(held_out("doc_id", 4, 2))
    right = langid.identify(held, model).join(held, "doc_id").where("lang = lang_pred").count()
    assert right == held.count() > 0


def test_viterbi_equals_search():
    rnd = np.random.default_rng(1)
    sizes = [4, 0, 1, 6]
    bounds = np.r_[0, np.cumsum(sizes)]
    scores = rnd.normal(size=(bounds[-1], 3)) * 3
    got = langid.viterbi(scores, bounds, 2.0)
    for a, b in zip(bounds, bounds[1:]):
        cost = lambda path, a=a: sum(scores[a + i, s] for i, s in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
        import itertools

        best = max(itertools.product(range(3), repeat=int(b - a)), key=cost)
        assert math.isclose(cost(tuple(got[a:b])), cost(best))


def test_language_identification_of_nothing(spark, empty, docs):
    model = langid.train(empty)
    assert {r.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


# 2 quality rules


def repeat_words(words):
    at = collections.defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    return len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)})


def normal_line(line):
    return re.sub(rb"\d", b"0", b" ".join(low(line).split()))


def test_quality(docs, corpus):
    got = by_id(quality.verdicts(docs))
    hosts = collections.defaultdict(set)
    lines = {}
    for i, t, _, s in corpus:
        lines[i] = [(normal_line(x), len(x.split())) for x in (t or "").encode().split(b"\n") if x.split()]
        for x, _ in lines[i]:
            hosts[s, x].add(t)
    for i, t, _, s in corpus:
        b = (t or "").encode()
        w, ls = b.split(), [x for x in b.split(b"\n") if x.split()]
        gone = sum(n for x, n in lines[i] if len(hosts[s, x]) > quality.LINE_DOCS and i != min(j for j, u, _, v in corpus if v == s and any(x == y for y, _ in lines[j])))
        failed = len(w) < 10 or 100 * repeat_words(w) > 20 * len(w)
        want = (len(w), sum(len(x.decode()) for x in w), sum(b.count(c.encode()) for c in "#*$%&|<>"), len(ls) - len(set(ls)), repeat_words(w), gone, failed, not failed and len(w) - gone >= quality.KEPT_SHARE * len(w))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_boilerplate, r.base_failed, r.kept) == want, i
    assert got[201].n_boilerplate == 6 and got[200].n_boilerplate == 0 and not got[301].kept


def test_quality_apply(docs, empty):
    out = by_id(quality.apply(docs))
    assert "NOW 2024" in out[200].text and "NOW 2024" not in out[201].text and 301 not in out and 500 not in out
    assert quality.apply(docs).columns == docs.columns
    assert quality.verdicts(empty).count() == quality.apply(empty).count() == 0
    twice = docs.where("doc_id < 20").union(docs.where("doc_id < 20"))
    assert quality.apply(twice).count() == 2 * quality.apply(docs.where("doc_id < 20")).count()


def test_quality_of_rows_without_sound_ids(spark):
    """Repeated rows count once; rows with a null id, or of one id with other texts, are judged apart."""
    tail = lambda k: f"subscribe to our letter right now\n" + " ".join(f"w{k}x{i}" for i in range(10))
    many = [(i, tail(i), "h") for i in range(12)]
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit("clash"))
    got = collections.Counter((r.doc_id, r.n_boilerplate, r.kept) for r in quality.verdicts(df([*many, many[5]])).collect())
    assert got == collections.Counter([(0, 0, True), (5, 6, True), *((i, 6, True) for i in range(1, 12))])
    short, fine = "too short", "a quite ordinary text of more than ten words stands in this row"
    assert [r.text for r in quality.apply(df([(None, short, "h"), (None, fine, "h")])).collect()] == [fine]
    assert [r.text for r in quality.apply(df([(1, short, "h"), (1, fine, "h")])).collect()] == [fine]
    unnamed = [(None, t, h) for _, t, h in many]
    kept = quality.apply(df(unnamed)).collect()
    assert len(kept) == 12 and sum("subscribe" in r.text for r in kept) == 1
    copies = quality.verdicts(df([(i, many[0][1], "h") for i in range(11)])).collect()  # documents are counted, not texts
    assert {(r.doc_id, r.kept) for r in copies} == {(i, i == 0) for i in range(11)}


# 3 token files


def test_token_files(spark, docs, corpus, empty, tmp_path):
    made = token_counts.tokenizer(WORD_BPE)
    got = by_id(ans.round_trip(docs, WORD_BPE, str(tmp_path / "a")))
    start = 0
    for i, t, _, _ in sorted(corpus, key=lambda r: r[0]):
        ids = np.array([*made.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, ids.size, zlib.crc32(ids.tobytes())), i
        start += ids.size
    assert ans.round_trip(empty, WORD_BPE, str(tmp_path / "b")).count() == 0
    twice = docs.where("doc_id in (1, 2)").union(docs.where("doc_id = 2"))
    assert sorted(r.start for r in ans.round_trip(twice, WORD_BPE, str(tmp_path / "c")).collect())[2] == got[1].n_tokens + got[2].n_tokens


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 300_000])
def test_blocks(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 40_000
    freq = ans.scale(np.bincount(ids, minlength=1 << 16))
    assert freq.sum() == 1 << ans.SCALE
    sections = ans.encode_block(ids, freq)
    every = ans.LANES * ans.EVERY
    assert len(sections) == -(-n // every)
    for k, section in reversed(list(enumerate(sections))):  # any checkpoint is a start
        assert np.array_equal(ans.decode_section(section, freq), ids[k * every : (k + 1) * every])
        broken = bytearray(section)
        broken[len(broken) // 2] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            ans.decode_section(bytes(broken), freq)


def test_a_folder_is_read_alone(spark, tmp_path):
    """Long documents over several blocks and parts, null and repeated ids; another session reads the folder; a spoiled table is refused."""
    rnd = random.Random(3)
    long = " ".join(rnd.choice("abc xyz quiet river stone".split()) for _ in range(300_000))
    rows = [(5, "a b c"), (None, "first"), (None, "again"), (None, None), (7, long), (7, "x"), (8, "tail"), (7, "x")]
    folder = str(tmp_path / "f")
    ans.write(spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")), WORD_BPE, folder)
    got = ans.read_blocks(folder, spark.newSession()).collect()
    made = token_counts.tokenizer(WORD_BPE)
    ids = lambda t: np.array([*made.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), ids(t).size, zlib.crc32(ids(t))) for i, t in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, None, 5, 7, 7, 7, 8]
    assert spark.read.parquet(f"{folder}/blocks").count() > 1
    table = spark.read.parquet(f"{folder}/table")
    table.withColumn("frequencies", F.concat(F.col("frequencies"), F.lit(b"abcd"))).write.parquet(f"{folder}2/table")
    with pytest.raises(ValueError, match="table"):
        ans.read_table(spark, f"{folder}2")


@pytest.mark.parametrize("n", [0, 1, 7, 1000, 100_001])
def test_checksums_combine(n):
    a, b = random.Random(n).randbytes(50), random.Random(n + 1).randbytes(n)
    assert ans.crc32_shift(zlib.crc32(a), n) ^ zlib.crc32(b) == zlib.crc32(a + b)


# 4 context-tree weighting


def sequential_ctw(train, text):
    """Log10-probability by dictionaries over the same tree, straight from the definition."""
    D = ctw.DEPTH
    n = collections.defaultdict(lambda: [0, 0])
    bits = lambda b: [(b >> (7 - j)) & 1 for j in range(8)]

    def walk(t):
        full = bytes([255]) * D + t + b"\xff"
        for p in range(D, len(full)):
            node = 1
            for bit in bits(full[p]):
                yield full[p - D : p], node, bit
                node = 2 * node + bit

    for t in train:
        for c, node, bit in walk(t):
            for d in range(D + 1):
                n[c[D - d :], node][bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weighted, below = {}, collections.defaultdict(float)
    for c, node in sorted(n, key=lambda k: -len(k[0])):
        own = kt(*n[c, node])
        weighted[c, node] = own if len(c) == D else math.log(0.5) + np.logaddexp(own, below[c, node])
        if c:
            below[c[1:], node] += weighted[c, node]
    total = 0.0
    for c, node, bit in walk(text):
        p = None
        for d in range(D, -1, -1):
            key = c[D - d :], node
            if key not in n and d:
                continue
            a = n[key] if key in n else [0, 0]
            own = (a[bit] + 0.5) / (sum(a) + 1)
            if p is None:
                p = own
            else:
                share = math.exp(math.log(0.5) + kt(*a) - weighted[key])
                p = share * own + (1 - share) * p
        total += math.log10(p)
    return total


def test_context_tree(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["ab", "Abc", "bca", "été", "ab\n"]) for _ in range(rnd.randint(0, 30))) for _ in range(30)] + [None, "", "zzz new words", "ab\0b", "q" * 3000]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x"))
    got = by_id(ctw.score(df, ~held_out("doc_id", 7, 2), block_bytes=2000))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    train = [(t or "").encode() for i, t in rows if not held[i]]
    c = collections.Counter(w for t in train for w in [*low(t).split(), None])
    total = sum(c.values())
    for i, t in rows:
        w = [*low((t or "").encode()).split(), None]
        base = sum(math.log10((c[x] + 1) / (total + len(c) + 1)) for x in w)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(c[x] > 0 for x in w), total)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
        if i % 3 == 0 or i > 29:
            assert math.isclose(got[i].score, sequential_ctw(train, (t or "").encode()), rel_tol=1e-6, abs_tol=1e-6), i


def test_context_tree_of_rows_without_sound_ids(spark):
    df = spark.createDataFrame([(None, "ab ab"), (None, "bca"), (1, "ab ab"), (1, "ab ab"), (1, None)], "doc_id long, text string").withColumn("kind", F.lit("clash"))
    got = ctw.score(df, F.lit(True), block_bytes=4).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("1", 1), ("1", 3), ("1", 3), ("None", 2), ("None", 3)]
    assert len({round(r.score, 9) for r in got if r.n_tokens == 3}) == 1 and {r.train_tokens for r in got} == {12}


def test_context_trees_stream_alike(spark, monkeypatch, small_batches):
    """Groups cut into chunks of any size give the same values."""
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, "".join(rnd.choice("abc \n") for _ in range(400))) for i in range(20)], "doc_id long, text string")
    rows = lambda: {r.key: r.value for r in ctw.log_probabilities(ctw.gather(df.select("text", F.lit(True).alias("trains"))).where("kind = 1").select("key", "n")).collect()}
    whole = rows()
    groups = ctw._groups
    small_batches(50)
    monkeypatch.setattr(ctw, "_groups", lambda batches: groups(batches, 7))
    small = rows()
    assert whole.keys() == small.keys() and all(math.isclose(whole[k], small[k], rel_tol=1e-9) for k in whole)


def test_context_tree_of_nothing(empty, docs):
    assert ctw.score(empty, F.lit(True)).count() == 0
    some = docs.where("doc_id in (1, 500)")
    got = by_id(ctw.score(some, F.lit(False)))
    assert got[500].train_tokens == 0 and math.isclose(got[500].score, 8 * math.log10(0.5))


# 5 suffix arrays


def brute_repeats(corpus, length=100):
    seen, out = set(), {}
    for i, t in sorted((r[0], r[1]) for r in corpus):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            gone[p : p + length] |= w in seen
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) > 0).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard_runs", [4096, 3])
def test_repeats(docs, corpus, shard_runs):
    got = {k: tuple(r[1:]) for k, r in by_id(suffix_dedup.measure_cuts(docs, shard_runs=shard_runs)).items()}
    assert got == brute_repeats(corpus)


def test_repeats_of_rows_that_share_an_id(spark):
    """A row is cut by what its own text repeats, whatever its id."""
    rnd = random.Random(51)
    prose = lambda n: " ".join(rnd.choice("abcdefghijklmn") * rnd.randrange(1, 9) + str(rnd.randrange(999)) for _ in range(n))
    c, a, shared = prose(150), prose(150), prose(40)
    b = prose(20) + " " + c[100:450] + " " + prose(20)
    cases = [[(0, c), (1, a), (1, b)], [(0, c), (1, b), (1, "short text here")], [(1, c), (1, b), (1, b), (1, a), (2, shared), (2, f"x{shared}"), (2, None), (None, c)]]
    for rows in cases:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        numbered = [r.text for r in df.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"), "text").distinct().orderBy("doc_id", "h").collect()]
        found = dict(zip(numbered, brute_repeats(list(enumerate(numbered))).values(), strict=True))
        got = suffix_dedup.measure_cuts(df).where("doc_id is not null").collect()
        assert sorted(tuple(r) for r in got) == sorted((i, *found[t]) for i, t in rows if i is not None)
        kept = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in suffix_dedup.apply(df).where("doc_id is not null").collect())
        assert kept == sorted((i, found[t][3]) for i, t in rows if i is not None and (found[t][0] > found[t][1] or not found[t][1]))


def test_span_hashes_depend_on_content_alone():
    """No two spans of other content agree, not even those on which polynomials modulo 2 ** 64 do; equal ones do wherever they stand."""
    from cadenza.llm.common import span_hashes

    thue = bytes(97 + bin(i).count("1") % 2 for i in range(4096))
    other = bytes(195 - x for x in thue)
    rnd = random.Random(6)
    parts = [thue[:1024], other[:1024], thue, other, *(bytes(rnd.choice(b"ab") for _ in range(n)) for n in range(1, 40)), b"", b"a", b"a\0", b"\0a"]
    data = np.frombuffer(b"|".join(parts * 2), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts * 2]) - 1
    got = span_hashes(data, ends - [len(p) for p in parts * 2], ends)
    assert np.array_equal(got[: len(parts)], got[len(parts) :]) and len(set(got.tolist())) == len(set(parts))


def test_runs_are_joined(spark, small_batches):
    rnd = random.Random(17)
    rows = [(rnd.randrange(5), rnd.randrange(300), rnd.randrange(1, 9)) for _ in range(400)]
    small_batches(16)
    got = [(r.doc, r.at, r.n) for r in suffix_dedup.joined_runs(spark.createDataFrame(rows, "doc long, at int, n int")).collect()]
    windows = {(d, p) for d, at, n in rows for p in range(at, at + n)}
    assert {(d, p) for d, at, n in got for p in range(at, at + n)} == windows and len(got) == sum((d, p - 1) not in windows for d, p in windows)


def test_repeats_edges(spark, docs, empty):
    assert suffix_dedup.measure_cuts(empty).count() == 0
    assert all(r.n_removed == 0 for r in suffix_dedup.measure_cuts(docs.where("doc_id = 7").union(docs.where("doc_id = 7"))).collect())
    one = docs.where("doc_id = 7").select("text").first()[0]
    odd = spark.createDataFrame([(None, one), (1, one), (2, "é" * 300), (3, "é" * 300)], "doc_id long, text string")
    got = by_id(suffix_dedup.measure_cuts(odd))
    assert got[None].n_removed == got[1].n_removed == 0 and got[3].n_removed == 600
    kept = by_id(suffix_dedup.apply(odd))
    assert kept[None].text == kept[1].text == one and 3 not in kept
    assert suffix_dedup.apply(docs).columns == docs.columns


def test_suffix_array_and_prefixes():
    data = np.frombuffer(b"abracadabra" * 5 + b"abrac\0\0", np.uint8)
    order = suffix_dedup.suffix_array(data, 20)
    raw = data.tobytes() + bytes(20)
    keys = [raw[p : p + 20] for p in order]
    assert keys == sorted(keys) and sorted(order) == list(range(data.size))
    got = suffix_dedup.common_prefixes(data, order, 20)
    for k in range(1, data.size):
        a, b = data[order[k - 1] :].tobytes()[:20], data[order[k] :].tobytes()[:20]
        assert got[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# 6 chat windows


def test_chat(spark, duck, sf):
    assert plain_rows(queries.op6_chat_windows(spark, sf).toPandas()) == plain_rows(duck(sf, queries.ORACLES["op6_chat_windows"]))


def test_chat_windows(spark):
    say = lambda k: "word " * 150 + str(k)
    rows = [(1, 0, "system", "be [INST] kind &lt;"), *((1, k, "user" if k % 2 else "assistant", say(k)) for k in range(1, 21)), (2, None, None, None), (2, 1, "assistant", None), (2, 1, "assistant", "x</s>"), (2, 1, "assistant", "x</s>"), (None, 0, "assistant\n", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("clash"))
    windows = chat.format_windows(df)
    got = sorted(windows.where("conv_id = 1").collect(), key=lambda r: r.window_no)
    assert len(got) > 3 and all(r.formatted.startswith("<s>system\nbe &lb;INST] kind &amp;lt;</s>") for r in got) and all(r.n_context >= 1 for r in got[1:])
    assert all(r.n_context == 2 for r in got[1:])  # the system turn and one repeated turn fit
    digest = by_id(chat.digests(windows), "conv_id")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert digest[1].turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:21])) and digest[1].loss_sha256 == sha("".join(say(k) for k in range(2, 21, 2)))
    assert (digest[2].n_turns, digest[2].loss_chars, digest[2].turns_sha256) == (4, 10, sha("\n\nassistant\n\n" + "assistant\nx</s>\n" * 2))
    assert digest[None].turns_sha256 == sha("assistant\n\ny\n") and digest[None].loss_chars == 0
    assert chat.digests(chat.format_windows(df.where("false"))).count() == 0


def test_no_window_is_over_budget(spark):
    rnd = random.Random(12)
    rows = []
    for c in range(60):
        n = rnd.choice((1, 3, 12, 40, 600 if c == 7 else 5))
        size = lambda: rnd.choice((0, 5, 90, 400, 1500, 3000, 9000 if c % 10 == 0 else 10))  # noqa: E731, B023
        for k in range(n):
            role = "system" if (k == 0 and c % 2) or (c % 7 == 3 and k in (2, 5)) else "user" if k % 2 else "assistant"
            rows.append((c, k, role, "".join(rnd.choice("ab <[&é日") for _ in range(size()))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("clash"))
    windows = chat.format_windows(df).withColumn("own", F.size(chat.read_turns(F.col("formatted"), F.col("n_context")))).cache()
    for r in windows.collect():
        assert math.ceil(len(r.formatted.encode()) / 4) <= r.n_tokens and (r.n_tokens <= chat.BUDGET or (r.over_budget and r.own == 1 and r.n_context <= 1))
        assert len(r.formatted) / 4 <= chat.BUDGET or r.over_budget
    assert windows.where("over_budget").count() > 0 and windows.where("n_context > 1").count() > 10
    full = windows.where(f"n_tokens > 0.6 * {chat.BUDGET}").count()
    assert full > windows.count() / 3
    digest = by_id(chat.digests(windows), "conv_id")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c in range(60):
        own = [r for r in rows if r[0] == c]
        assert digest[c].turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in own)) and digest[c].loss_sha256 == sha("".join(t for _, _, r, t in own if r == "assistant"))


@pytest.mark.parametrize("run", [3, 512])
def test_short_turns_fill_windows(spark, monkeypatch, run):
    """Windows are what a loop over the turns gives, whatever the length of a run of the fold."""
    monkeypatch.setattr(chat, "RUN", run)
    rows = [(c, k, "assistant" if k % 2 else "user", f"two{k} words" * (1 + k % 3 * c)) for c in (0, 1) for k in range(256)] + [(None, k, "system" if k == 0 else "user", "x y") for k in range(40)]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.window_no): r.n_tokens for r in windows.select("conv_id", "window_no", "n_tokens").collect()}
    most = max(math.ceil(len(f"<s>{r}\n{t}</s>") / 4) for _, _, r, t in rows)
    for conv in (0, 1, None):
        last = max(w for c, w in got if c == conv)
        assert all(chat.BUDGET - most < n <= chat.BUDGET for (c, w), n in got.items() if c == conv and w < last)
    assert len(got) >= 6


def test_tokens_beside_marks(spark, small_batches):
    """Texts over spaces, marks, emoji and ideographs have sentencepiece's ids, and the flag holds only where they are the rebuilt tokenizer's."""
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcqx 1  ▁▁😀日本é\n.") for _ in range(rnd.randrange(14))) for _ in range(6000)] + ["x▁ 😀", "q▁  z", "▁ 1", "a ▁ ▁ c", "", " ", "▁", " ▁ "]
    made = piece.codec(PIECES)
    own = made.own.encode(texts)
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for r in piece.encode_decode(df, PIECES, with_ids=True).collect():
        assert r.ids == own[r.doc_id] and (not r.same_ids or made.fast.encode(texts[r.doc_id], add_special_tokens=False).ids == r.ids)
    flagged = piece.add_pieces(df.limit(50), PIECES, same="flag")
    assert flagged.columns == ["doc_id", "text", "piece_ids", "decoded", "flag"] and flagged.where("flag").count() > 0


def test_every_word_is_compared(spark):
    """Where the rebuilt tokenizer errs in any word, sentencepiece's ids come out and the flag says so."""

    class Wrong:
        def encode_batch_fast(self, units, add_special_tokens):
            return [type("Encoding", (), {"ids": [7]}) for _ in units]

        def token_to_id(self, piece):
            return 7

    with open(PIECES, "rb") as file:
        made = piece.Codec(file.read())
    made.fast = Wrong()
    texts = [f"word{i} other{i * i}" for i in range(300)] + ["end "]
    ids, before, same = made.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(before, before[1:])] == made.own.encode(texts) and not same.any()


def test_calls_and_memory_of_words_are_bounded():
    """However many distinct words a batch has, a library's call gets a few thousand, and long units aren't remembered."""
    with open(PIECES, "rb") as file:
        made = piece.Codec(file.read())
    fast, own, calls = made.fast, made.own, []

    class Fast:
        def encode_batch_fast(self, units, add_special_tokens):
            calls.append(len(units))
            return fast.encode_batch_fast(units, add_special_tokens=add_special_tokens)

        def token_to_id(self, unit):
            return fast.token_to_id(unit)

    class Own:
        def encode(self, units, num_threads):
            calls.append(len(units))
            return own.encode(units, num_threads=num_threads)

    made.fast, made.own = Fast(), Own()
    texts = [" ".join(f"w{i}x{k}" for k in range(100)) for i in range(200)] + ["日本語" * 5_000, "", "end "]
    ids, before, same = made.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(before, before[1:])] == own.encode(texts) and same.all()
    assert sum(calls) > 40_000 and max(calls) <= 4_096
    assert len(made.seen) > 20_000 and max(map(len, made.seen)) <= 64


# 7 decontamination


def test_decontamination(spark, empty):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(40))) for i in range(6)] + [(6, "too short"), (7, None), (None, "x"), (8, "")]
    words = [i[1].split() for i in items[:6]]
    spoiled = [w if k % 8 else "zzz" for k, w in enumerate(words[1])]
    rows = [(0, text(200)), (1, text(50) + words[0] + text(50)), (2, text(50) + spoiled + text(50)), (3, words[2][10:25] + text(30)), (4, text(90) + words[3][:5]), (5, words[4] * 2 + words[5]), (6, [w.upper() + "," for w in words[0]]), (7, text(20_000) + words[0])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows] + [(8, None), (9, ""), (None, " ".join(words[0]))], "doc_id long, text string").withColumn("tokens", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matches, r.n_overlap) for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (5, 4), (5, 5), (6, 0), (7, 0)}
    assert got[1, 0] == (40, 40) and got[3, 2] == (15, 15) and got[2, 1][0] >= 33
    assert {r.doc_id for r in decontam.clean(docs, bench).collect()} == {0, 4, 8, 9}  # a row without an id is judged too
    assert decontam.contaminated(docs, bench.where("false")).count() == decontam.contaminated(docs.where("false"), bench).count() == 0
    assert decontam.contaminated(docs.union(docs), bench).count() == len(got)


def test_decontamination_without_spaces_and_of_short_items(spark):
    rnd = random.Random(9)
    text = lambda low, n: "".join(chr(low + rnd.randrange(40)) for _ in range(n))
    items = [(0, text(0x4E00, 30)), (1, text(0x3042, 30)), (2, text(0x0E01, 30)), (3, "one two Three"), (4, "日本語学"), (5, "a «quoted» word, then ten more words are following it"), (6, "five tokens are in this")]
    around = lambda low, s: text(low, 50) + "。" + s + text(low, 50) + "、" + text(low, 20)
    rows = [(0, around(0x5000, items[0][1])), (1, around(0x5000, items[1][1])), (2, around(0x0E01, items[2][1])), (3, "Zero one, two THREE four one two three"), (4, "これは日本語学です"), (5, "x…a “quoted” word—then ten more words are following it。y"), (6, "one two four three"), (7, "日本語の学"), (8, "five tokens are in that"), (9, around(0x5000, text(0x4E00, 30)))]
    spoiled = list(items[0][1])
    spoiled[10] = spoiled[20] = "\u9000"
    rows += [(10, around(0x5000, "".join(spoiled))), (11, "five tokens are in this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matches, r.n_overlap) for r in decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {k: v for k, v in got.items() if k != (10, 0)} == {(0, 0): (30, 30), (1, 1): (30, 30), (2, 2): (30, 30), (3, 3): (3, 3), (4, 4): (4, 4), (5, 5): (10, 10), (11, 6): (5, 5)}
    assert got[10, 0] == (28, 30)
    cut = lambda t: decontam.token_hashes(pa.array(t))[1].tolist()
    assert cut(["été’s x", "", None, "日本", "日a本é語", "é", "ก"]) == [0, 3, 3, 3, 5, 10, 11, 12]


def brute_overlaps(docs, items, least=10, identity=0.7):
    """All (document, item) with a segment of a diagonal that is an overlap."""
    out = set()
    for d, t in docs:
        for i, u in items:
            a, b = t.split(), u.split()
            for diagonal in range(-len(b) + 1, len(a)):
                same = [a[k + diagonal] == b[k] for k in range(max(0, -diagonal), min(len(b), len(a) - diagonal))]
                sums = np.r_[0, np.cumsum(same)]
                low, high = np.triu_indices(len(same) + 1, 1)
                n = sums[high] - sums[low]
                if ((n >= min(least, len(b))) & (n >= identity * (high - low) - 1e-9)).any():
                    out.add((d, i))
                    break
    return out


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(31)
    vocab = [f"w{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, text(rnd.choice((12, 30, 60)))) for i in range(25)] + [(30, text(330))]
    docs = []
    for k in range(60):
        item = rnd.choice(items[:25])[1]
        low = rnd.randrange(max(1, len(item) - 12))
        piece = list(item[low : low + rnd.choice((8, 12, 40))])
        for _ in range(int(len(piece) * rnd.choice((0, 0.1, 0.2)))):
            piece[rnd.randrange(len(piece))] = "zzz"
        docs.append((k, text(30) + piece + text(30)))
    chained = [w if k % 16 < 11 else f"other{k}" for k, w in enumerate(items[-1][1])]  # blocks of 11 equal tokens, 5 others between
    docs += [(100, chained), (101, chained[:11] + text(20)), (102, text(80))]
    docs, items = ([(i, " ".join(w)) for i, w in x] for x in (docs, items))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_overlaps(docs, items)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert got == want and {(100, 30), (101, 30)} <= want and len(want) > 30


def test_decontamination_of_rows_without_sound_ids(spark):
    rnd = random.Random(32)
    words = lambda n: " ".join(f"v{rnd.randrange(5000)}" for _ in range(n))
    item, other, fine = words(30), words(30), words(50)
    rows = [(1, fine), (1, f"{words(9)} {item}"), (None, f"{item} {words(9)}"), (None, fine), (2, other), (2, other), (3, fine)]
    bench = spark.createDataFrame([(0, item), (0, other), (None, fine)], "item_id long, text string")
    kept = decontam.clean(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", fine), ("None", fine), ("3", fine)])


def test_widest_segment():
    rng = np.random.default_rng(3)
    for _ in range(300):
        same = rng.random(rng.integers(1, 30)) < rng.random()
        sums = np.r_[0, np.cumsum(same)]
        ok = [(sums[b] - sums[a], a - b, -a, b) for a in range(same.size) for b in range(a + 1, same.size + 1) if same[a] and same[b - 1] and sums[b] - sums[a] >= 0.7 * (b - a) - 1e-9]
        best = max(ok, default=None)
        assert decontam.widest_segment(same, 0.7) == ((-best[2], best[3]) if best else (0, 0))


# 8 pieces


def test_pieces(docs, corpus, empty):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = by_id(piece.encode_decode(docs, PIECES, with_ids=True))
    for i, t, _, _ in corpus:
        want = own.encode(t or "")
        assert (got[i].ids, got[i].n_tokens, got[i].ids_crc32) == (want, len(want), zlib.crc32(np.array(want, "<u4").tobytes())), i
        assert got[i].same_text == ("▁" not in (t or "")), i
    assert sum(r.same_ids for r in got.values()) >= len(corpus) - 3
    back = by_id(piece.add_pieces(docs, PIECES))
    assert all(back[i].decoded == own.decode(own.encode(t or "")) for i, t, _, _ in corpus if i != 507)
    assert piece.encode_decode(empty, PIECES).count() == piece.add_pieces(empty, PIECES).count() == 0


def test_the_rebuilt_tokenizer_agrees_on_every_word(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    units = [r.u for r in docs.select(F.explode(F.split("text", " ")).alias("u")).distinct().collect() if r.u]
    units += ["a" * 9, "ab" * 5, "ana" * 4, "\n\n\n", "日本語", "\u0301", "=====", "x" * 300]
    made = piece.codec(PIECES)
    fast = [e.ids for e in made.fast.encode_batch_fast(units, add_special_tokens=False)]
    assert [u for u, a, b in zip(units, fast, made.own.encode(units)) if a != b and not piece.may_tie(u)] == []
    ids = np.array([i for x in fast for i in x])
    data, offsets = made.decode(ids, np.cumsum([0, *map(len, fast)]))
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == made.fast.decode_batch(fast, skip_special_tokens=False)


def test_pieces_of_rows_without_sound_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "c"), (1, "a b"), (1, "a b"), (1, None)], "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    assert sorted((str(r.doc_id), r.n_tokens) for r in piece.encode_decode(df, PIECES).collect()) == [("1", 0), ("1", 2), ("1", 2), ("None", 1), ("None", 2)]


def test_a_unigram_model():
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    for p, s, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("▁a", -1, 1), ("b", -2, 1), ("ab", -2.5, 1), ("▁", -3, 1), ("a", -3, 1), *((f"<0x{k:02X}>", -10, 6) for k in range(256))]:
        m.pieces.add(piece=p, score=s, type=kind)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.unk_id = 1, True, 0
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = "identity", True, False, True
    data = m.SerializeToString()
    codec, own = piece.Codec(data), SentencePieceProcessor(model_proto=data)
    texts = ["ab a bb", "", "aé b", "b"]
    ids, before, same = codec.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(before, before[1:])] == own.encode(texts) and same.all()


# 9 token counts


def test_token_counts(docs, corpus, empty):
    made = token_counts.tokenizer(BYTE_BPE)
    got = by_id(token_counts.count_tokens(docs, BYTE_BPE))
    for i, t, _, _ in corpus:
        n = len(made.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 1024), i
    assert token_counts.count_tokens(empty, BYTE_BPE).count() == 0


def test_safe_boundaries(corpus):
    made = token_counts.tokenizer(BYTE_BPE)
    rnd = random.Random(9)
    odd = ["".join(rnd.choice("ab ,.'\n\té\u00a0\u2003!st日\u0301|<>12") for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    texts = [*odd, *(r[1] for r in corpus if r[1] and len(r[1]) < 4000)]
    parts, before = token_counts.split_pieces(pa.array(texts))
    cut = [parts.to_pylist()[a:b] for a, b in zip(before, before[1:])]
    assert ["".join(c) for c in cut] == texts and max(map(len, cut)) > 100
    sizes = [len(e) for e in made.encode_batch(parts.to_pylist(), add_special_tokens=False)]
    whole = [len(e) for e in made.encode_batch(texts, add_special_tokens=False)]
    assert [sum(sizes[a:b]) for a, b in zip(before, before[1:])] == whole


def test_long_texts_of_any_script_are_split(spark):
    rnd = random.Random(3)
    words = lambda low, span, n, size, gap: gap.join("".join(chr(low + rnd.randrange(span)) for _ in range(size)) for _ in range(n))
    texts = [words(0xAC00, 11172, 9000, 3, " "), words(0x905, 50, 9000, 5, " "), words(0x4E00, 20000, 4000, 12, "，"), words(0x4E00, 20000, 4000, 12, "。"), words(0x3041, 80, 900, 9, "、"), "ー。！？、 　日本　 語 ，x，日" * 50]
    made = token_counts.tokenizer(BYTE_BPE)
    parts, before = token_counts.split_pieces(pa.array(texts))
    assert (np.diff(before)[:4] > [8000, 8000, 3000, 3000]).all() and max(len(p.encode()) for p in parts.to_pylist()[: before[4]]) < 200
    df = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (None, None), (1, texts[1])], "doc_id long, text string").withColumn("n_bytes", F.lit("clash"))
    got = collections.Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(df, BYTE_BPE).collect())
    count = [len(made.encode(t, add_special_tokens=False).ids) for t in texts]
    assert got == collections.Counter([*enumerate(count), (None, count[0]), (None, 0), (1, count[1])])
    assert token_counts.byte_level(made) and not token_counts.byte_level(token_counts.tokenizer(WORD_BPE))


# 10 SimHash


def brute_fingerprint(text):
    words = low((text or "").encode()).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints):
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if root[a] > root[b] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    root[a], changed = root[b], True
    return root


def test_simhash(docs, corpus, empty):
    got = by_id(simhash_vp.near_duplicates(docs))
    prints = {i: brute_fingerprint(t) for i, t, _, _ in corpus}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)
    assert simhash_vp.near_duplicates(empty).count() == 0
    kept = {r.doc_id for r in simhash_vp.drop_near_duplicates(docs).collect()}
    assert kept == {i for i, r in got.items() if r.component_id == i}


def test_links_over_many_shards(spark):
    rnd = random.Random(6)
    centres = [rnd.getrandbits(64) for _ in range(150)]
    values = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for c in centres for _ in range(8)}
    prints = {v - (1 << 64) if v >> 63 else v: v for v in values}
    df = spark.createDataFrame([(k,) for k in prints], "fp long")
    roots = {r.node: r.root for r in simhash_vp.components(simhash_vp.links(df, per_shard=64)).collect()}
    want = brute_components(dict(sorted((k, v) for k, v in prints.items())))
    assert {k: roots.get(k, k) for k in prints} == want


def test_near_duplicates_of_rows_without_sound_ids(spark):
    """Rows of one id with different texts are judged apart; repeated rows go together; rows without an id stay."""
    rnd = random.Random(14)
    a, b = (" ".join(f"u{rnd.randrange(900)}" for _ in range(60)) for _ in range(2))
    df = spark.createDataFrame([(1, a), (2, a), (2, a), (2, b), (None, a), (None, b)], "doc_id long, text string").withColumn("fp", F.lit("clash"))
    want = sorted([("1", a), ("2", b), ("None", a), ("None", b)])
    for kept in (simhash_vp.drop_near_duplicates(df), simhash_vp.drop_similar(df)):
        assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == want and kept.columns == df.columns


def test_what_the_driver_sees_does_not_grow_with_partitions(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("fp"))
    seen = [simhash_vp.links(df.repartition(n), sample=500).count() for n in (1, 64)]
    assert seen[0] == seen[1]


def test_a_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 99)], "a long, b long")
    roots = {r.node: r.root for r in simhash_vp.components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 61)} | {100: 99}
    assert simhash_vp.components(edges.where("false")).count() == 0


def test_similar_documents(spark, docs, empty):
    rnd = random.Random(21)
    vocab = [f"v{i}" for i in range(300)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    texts = []
    for i in range(12):
        words = [rnd.choice(vocab) for _ in range(rnd.choice((12, 100, 160)))]
        texts.append(words)
        for k in range(5):  # chains of copies, each with one more word changed
            words = list(words)
            words[rnd.randrange(len(words))] = f"x{i}_{k}"
            texts.append(words)
    texts += [passage + [rnd.choice(vocab) for _ in range(rnd.choice((10, 13, 40)))] for _ in range(60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(900, None), (901, " "), (902, "V1 v2"), (903, "v1  v2"), (None, " ".join(texts[0]))]
    sets = {}
    for i, t in rows:
        words = low((t or "").encode()).split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    close = {(a, b) for a in sets for b in sets if a is not None and b is not None and b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    root = {i: i for i, _ in rows if i is not None}
    for _ in root:
        for a, b in close:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).repartition(3)
    got = by_id(simhash_vp.similar_documents(df))
    assert {i: got[i].component_id for i in root} == root and got[None].component_id == root[0]
    kept = {r.doc_id for r in simhash_vp.drop_similar(df).collect()}
    assert kept == {None, *root.values()} and len(kept) < len({r.doc_id for r in simhash_vp.drop_near_duplicates(df, size=5).collect()})
    assert simhash_vp.similar_documents(empty).count() == 0 and simhash_vp.similar_documents(docs.union(docs)).count() == 2 * docs.count()


def test_the_pipeline_drops_similar_documents(spark, sf):
    import corpus_pipeline

    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:50], "changed", *words[51:]])), (3, " ".join([*words[:30], "a", *words[31:60], "b", *words[61:]])), (4, " ".join(words[:50]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, df, sf).collect()} == {1, 4}


# 1, the whole query


def test_language_identification_equals_a_plain_version(spark):
    """Counts in dicts, and for each text the best of all labels by a loop over words and languages."""
    rnd = random.Random(71)
    stems = {"aa": "abcde ", "bb": "cdefg ", "cc": "жзийк ", "dd": "eéàgh "}
    make = lambda lang, n: "".join(rnd.choice(stems[lang]) for _ in range(n))
    rows = [(i, make(lang, rnd.randrange(5, 120)), lang) for i, lang in enumerate(sorted(stems) * 12)]
    rows += [(100 + i, f"{make('aa', 60)} {make('cc', 60)}. {make('dd', 50)}", None) for i in range(20)] + [(200, None, "aa"), (201, "12 !!", "bb"), (202, "", None), (203, "日本 abc", None), (204, "A" * 3000, None)]
    words = lambda t: re.findall(rb"[A-Za-z\x80-\xff]+", t.lower().encode())
    script = lambda w: langid.NAMES[langid._SCRIPT[np.searchsorted(langid._FIRST, ord(w.decode()[0]), "right") - 1]]  # noqa: E731, SLF001

    def grams(w, order):
        text = b" " + w + b" "
        return [((int.from_bytes(text[k : k + order], "big") * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - langid.SLOT_BITS) for k in range(len(text) - order + 1)]

    held = [(t, lang) for i, t, lang in rows if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    names = sorted({lang for _, lang in held})
    seen = {(lang, o): collections.Counter(g for t, x in held if x == lang for w in words(t) for g in grams(w, o)) for lang in names for o in langid.ORDERS}
    used = {lang: collections.Counter(script(w) for t, x in held if x == lang for w in words(t)) for lang in names}
    size = 1 << langid.SLOT_BITS

    def log(lang, w):
        return sum(math.log((seen[lang, o][g] + langid.ALPHA) / (sum(seen[lang, o].values()) + langid.ALPHA * size)) for o in langid.ORDERS for g in grams(w, o)) / len(langid.ORDERS)

    want = {}
    for i, t, _ in rows:
        ws = words(t or "")
        if not ws or not any(c.isalpha() for c in t):
            want[i] = ("und", 0.0)
            continue
        value, back = None, []
        for w in ws:
            fits = [used[n][script(w)] >= langid.SHARE * max(1, sum(used[n].values())) for n in names]
            scores = [-1e6 if any(fits) and not f else log(n, w) for n, f in zip(names, fits, strict=True)]
            if value is None:
                value = scores
                continue
            top = max(range(len(names)), key=lambda k: (value[k], -k))
            back.append([k if value[k] >= value[top] - langid.SWITCH else top for k in range(len(names))])
            value = [max(value[k], value[top] - langid.SWITCH) + scores[k] for k in range(len(names))]
        at = [max(range(len(names)), key=lambda k: (value[k], -k))]
        for row in reversed(back):
            at.append(row[at[-1]])
        votes = collections.Counter()
        for w, k in zip(ws, reversed(at), strict=True):
            votes[k] += len(w)
        best = max(range(len(names)), key=lambda k: (votes[k], -k))
        want[i] = (names[best], votes[best] / sum(votes.values()))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    got = langid.identify(df, langid.train(df.where(~held_out("doc_id", 4, 2))))
    assert {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in got.collect()} == {i: (n, round(s, 9)) for i, (n, s) in want.items()}
