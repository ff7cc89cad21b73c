"""Phrases, centroids and the multi-index against plain versions on small tables with every odd case."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import centroids, multi_index, phrases


def plain_phrases(rows, least, subsumed, top, longest=3):
    """Per language the first phrases, by counting all n-grams."""
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if 2 <= len(p) and a >= least}
        held = []
        for p, a in some.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= subsumed * a and inside(q) for q, b in some.items()):
                continue
            score, k = min((Fraction(1000000 * a * a, f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p)))
            held.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, total[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(held)[:top], 1)]
    return sorted(out)


def some_texts():
    rnd = random.Random(3)
    words = ["the", "The", "of", "river", "été", "a", "b", "日本", "x-y", "ÀB"]
    rows = [(" ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ",", " \t", "\n"]) for _ in range(rnd.randrange(0, 60))), rnd.choice(["en", "de", None])) for _ in range(120)]
    return rows + [(None, "en"), ("", None), (" \t.;", "fr"), ("a b a b a b a b " * 900, "en"), ("a a a a a a a a a a a a a", "xx"), ("one", "xx"), ("nul\0x nul\0x " * 12, "xx")] + rows[:20]


@pytest.mark.parametrize(("least", "subsumed", "top", "longest", "size"), [(10, 50, 2000, 3, 1 << 20), (4, 80, 7, 4, 300), (10, 50, 2000, 2, 1000)])
def test_phrases_equal_counting_all(spark, least, subsumed, top, longest, size):
    rows = some_texts()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3).selectExpr("*", "1 as block", "'x' as words", "2 as id", "'y' as phrase")
    got = phrases.phrases(df, least=least, subsumed=subsumed, top=top, longest=longest, block_bytes=size)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == plain_phrases(rows, least, subsumed, top, longest)


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.phrases(none).collect() == []
    assert phrases.phrases(spark.createDataFrame([(None, None), ("rare words", "en")], "text string, lang string")).collect() == []


def test_no_row_of_a_table_holds_a_block(spark):
    """A row that holds all of a block takes an executor's memory several times over."""
    text = " ".join(f"w{i % 9000} w{i % 9000 + 1}" for i in range(20_000))
    held = phrases.blocks(spark.createDataFrame([(text, "en")], "text string, lang string"))
    sizes = lambda df: [df.select(F.max(F.size(c))).first()[0] for c, kind in df.dtypes if kind.startswith("array")]
    assert sizes(held) and max(sizes(held)) <= 4096
    words = held.where("codes IS NULL")
    assert words.select(F.count("word"), F.sum("count")).first()[:] == (9001, 40_000) and held.select(F.sum(F.size("codes"))).first()[0] == 40_000
    pairs = phrases.next_level(held, words.select("block", "number", F.col("number").cast("long").alias("id")))
    assert sizes(pairs) and max(sizes(pairs)) <= 4096
    counts = Counter(zip(text.split(), text.split()[1:], strict=False))
    assert sorted(r[0] for r in pairs.where("codes IS NULL").select("count").collect()) == sorted(counts.values())


def test_scores_past_64_bits_are_exact(spark):
    cases = [(10**15, 10**15, 10**15), (999_999_999_999_989, 10**15 - 11, 10**15 - 7), (10, 3_000_000_000, 7_000_000_000), (123_456_789_012, 987_654_321_098, 123_456_789_013)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    got = [r.s for r in df.select(phrases.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()]
    assert got == [1000000 * a * a // (x * y) for a, x, y in cases]


def plain_clusters(rows, dim, k, rounds, seed="1"):
    kept = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) and abs(64 * x) <= centroids.LARGEST for x in v)]
    by = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[0] or 0, r[1])
    c = [v for _, v in sorted(kept, key=by)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, q), j) for j, q in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        c = [[sum(xs) // len(xs) for xs in zip(*m)] if (m := [v for (_, v), o in zip(kept, own) if o == j]) else q for j, q in enumerate(c)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], c


def some_vectors(dim=6, n=300, seed=4):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 2) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [c + rnd.gauss(0, 0.2 if i % 3 else 1.5) for c in centres[i % 4]]) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(40)] + [rows[3], rows[3]]  # copies under other ids, repeated rows
    rows += [(900, None), (901, []), (902, [1.0] * (dim - 1)), (903, [1.0] * (dim - 1) + [None]), (904, [float("nan")] * dim), (905, [float("inf")] + [0.0] * (dim - 1)), (906, [0.0] * dim), (None, [0.5] * dim)]
    return rows


@pytest.mark.parametrize(("k", "rounds"), [(5, 3), (16, 6), (1, 2), (400, 2)])
def test_bounds_change_no_cluster(spark, k, rounds):
    rows = some_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).selectExpr("*", "0 as cluster", "1 as id", "2 as upper")
    found, made = centroids.cluster(df, dim=6, k=k, rounds=rounds)
    expected, c = plain_clusters(rows, 6, k, rounds)
    got = found.select("vec_id", "cluster", "distance").collect()
    assert Counter(map(tuple, got)) == Counter(expected) and made.tolist() == c
    if k == 5:
        assert found.where("settled > 0").count() > 0
    about = centroids.summed(found, made)
    assert about.count() == len(got) and {r.inertia for r in about.collect()} == {sum(d for _, _, d in expected)}


def test_clusters_of_nothing_and_of_large_components(spark):
    found, made = centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>"), dim=2)
    assert centroids.summed(found, made).collect() == []
    big = [(1, [2.0e6, -2.0e6]), (2, [-2.0e6, 2.0e6]), (3, [3.0e6, 0.0])]
    found, _ = centroids.cluster(spark.createDataFrame(big, "vec_id long, embedding array<double>"), dim=2, k=1, rounds=1)
    expected, _ = plain_clusters(big, 2, 1, 1)
    assert sorted(map(tuple, found.select("vec_id", "cluster", "distance").collect())) == expected and len(expected) == 2


def plain_nearest(rows, top, asks):
    kept = {}
    for i, v in rows:
        if i is not None and v and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[i] = min(kept.get(i, v), v)

    def score(a, b):  # one component after the other; sum() compensates
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    return {q: sorted(((-score(v, w), i) for i, w in kept.items() if i != q))[:top] for q, v in kept.items() if asks(q)}


@pytest.mark.parametrize(("block", "asked"), [(8192, 1024), (16, 3)])
def test_multi_index_finds_the_nearest(spark, block, asked):
    rows = some_vectors(n=1200)
    rows += [(5, [9.0] * 6), (6, [-9.0] * 6)]  # ids with two vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).selectExpr("*", "0 as id", "1 as x", "2 as score")
    got = multi_index.search(df, F.col("id") % 20 == 0, block=block, asked=asked).collect()
    expected = plain_nearest(rows, 20, lambda q: q % 20 == 0)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r["rank"]] = (-r.score, r.vec_id)
    assert set(found) == set(expected)
    hits = 0
    for q, near in found.items():
        listed = [near[k] for k in range(1, len(near) + 1)]
        assert len(listed) == 20 and listed == sorted(listed) and q not in {i for _, i in listed}
        hits += len({i for _, i in listed} & {i for _, i in expected[q]})
    assert hits >= 0.9 * sum(map(len, expected.values()))
    every = multi_index.search(df, F.col("id") % 20 == 0, recall=1.0, block=block, asked=asked)
    assert {tuple(r) for r in every.where("query_id = 1220").collect()} == {(1220, k, i, -s) for k, (s, i) in enumerate(expected[1220], 1)}  # one of many copies


def test_multi_index_of_few_and_none(spark):
    few = [(0, [1.0, 0.0]), (20, [1.0, 0.5]), (3, [0.0, 0.0]), (4, [2.0, 2.0]), (7, None)]
    df = spark.createDataFrame(few, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in multi_index.search(df, F.col("id") % 20 == 0).collect()}
    assert got == {(0, 1, 4, 2.0), (0, 2, 20, 1.0), (20, 1, 4, 3.0), (20, 2, 0, 1.0)}
    assert multi_index.search(df.where("false"), F.col("id") % 20 == 0).collect() == []
    assert multi_index.search(df.where("vec_id = 0"), F.col("id") % 20 == 0).collect() == []
