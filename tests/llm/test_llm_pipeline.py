"""The pipeline's stages, and the registered queries on the smallest tables."""

import pytest
from compare import rows

import corpus_pipeline
from cadenza.llm import queries


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert before is None or ids <= before
        assert out.columns == columns if number < 4 else out.columns == [*columns, "piece_ids", "decoded"]
        docs, before = out.checkpoint(), ids
    assert docs.where("text <> decoded").count() == 0 and len(before) > 100


def test_an_empty_table_runs_through(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(spark, duck, sf, name):
    got = queries.QUERIES[name](spark, sf).toPandas()
    if name in queries.ORACLES:
        assert rows(got) == rows(duck(sf, queries.ORACLES[name]))
    assert len(got) == len(spark.read.parquet(f"{sf}/documents.parquet").toPandas()) or name in ("op6_chat_windows", "op7_spaced_seeds", "pipeline")


def test_rows_without_sound_ids_run_through(spark, tmp_path):
    """Null, repeated and shared ids, null columns and an extra column: each stage's decisions on them."""
    import random

    rnd = random.Random(41)
    prose = lambda n: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    item, a, b, shared = prose(30), prose(60), prose(60), prose(40)
    rows = [
        (1, a), (2, a), (2, b), (None, prose(50)), (None, "too short"), (None, None), (3, f"{prose(20)} {item}"), (None, f"{item} {prose(20)}"), (4, prose(40)), (4, prose(45)), (5, f"{shared} {prose(30)}"), (6, f"{prose(30)} {shared}"),
        (7, ""), (8, prose(5000)), (9, prose(33)), (9, None),
    ]
    df = spark.createDataFrame([(i, t, None, None, None, "extra") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, tokens string")
    spark.createDataFrame([(0, item), (None, a), (1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, str(tmp_path)).checkpoint()
        kept[name] = [(r.doc_id, r.text) for r in df.collect()]
    texts = dict(enumerate(t for _, t in rows))
    gone = {4, 5, 12, 15}
    assert sorted(map(str, kept["quality_rules"])) == sorted(str(r) for k, r in enumerate(rows) if k not in gone)
    gone |= {1}  # a copy of document 1; the other row of id 2 has a text of its own
    assert sorted(map(str, kept["simhash_near_dedup"])) == sorted(str(r) for k, r in enumerate(rows) if k not in gone)
    cut = dict(x for x in kept["suffix_array_dedup"] if x[0] == 6)
    assert shared not in cut[6] and texts[11].startswith(cut[6][:40]) and len(kept["suffix_array_dedup"]) == len(rows) - len(gone)
    assert len(kept["benchmark_decontamination"]) == len(rows) - len(gone) - 2 and not any(item in t for _, t in kept["benchmark_decontamination"])
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "tokens", "piece_ids", "decoded"] and df.where("text <> decoded").count() == 0


def test_helper_names_as_extra_columns(spark, sf, tmp_path):
    """Columns named as those that the stages add on their way pass through."""
    names = ["_key", "_host", "_gone", "_hash", "_doc", "_spans", "of_key", "of_host", "OF_HASH", "gone", "of_id", "spans", "spans_", "host", "text_hash", "fp", "class"]
    plain = spark.read.parquet(f"{sf}/documents.parquet")
    df = plain.selectExpr("*", *(f"concat('{n}', doc_id) as {n}" for n in names))
    for _, stage in corpus_pipeline.STAGES:
        plain, df = stage(spark, plain, sf).checkpoint(), stage(spark, df, sf).checkpoint()
    assert df.drop(*names).exceptAll(plain).count() == 0 and df.count() == plain.count()
    assert df.where(" or ".join(f"{n} <> concat('{n}', doc_id)" for n in names)).count() == 0


def plain_pipeline(rows, items):
    """(id, text, ids) that every stage's plain version leaves: lines counted in dicts, all pairs of shingle sets, all strings of 100 bytes, all diagonals, the sentencepiece library."""
    import collections

    import numpy as np
    from test_llm_operators import PIECES, brute_overlaps, low, normal_line, repeat_words

    from cadenza.llm import piece, quality

    lines = lambda t: [x for x in t.split("\n") if x.strip()]
    norm = lambda x: normal_line(x.encode())
    hosts, kept = collections.defaultdict(set), []
    for i, t, h in rows:
        for x in lines(t):
            hosts[h, norm(x)].add(i)
    for i, t, h in rows:
        gone = {x for x in lines(t) if len(hosts[h, norm(x)]) > quality.LINE_DOCS and i != min(hosts[h, norm(x)])}
        words = t.split()
        left = len(words) - sum(len(x.split()) for x in lines(t) if x in gone)
        if len(words) >= 10 and 100 * repeat_words(t.encode().split()) <= 20 * len(words) and left >= quality.KEPT_SHARE * len(words):
            kept.append((i, "\n".join(x for x in t.split("\n") if x not in gone)))
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in kept for w in [low(t.encode()).split()]}
    root = {i: i for i in sets}
    close = [(a, b) for a in sets for b in sets if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in root:
        for a, b in close:
            root[a] = root[b] = min(root[a], root[b])
    seen, cut = set(), []
    for i, t in sorted(x for x in kept if root[x[0]] == x[0]):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            gone[p : p + 100] |= b[p : p + 100] in seen
            seen.add(b[p : p + 100])
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes().decode()
        if rest.split() or not gone.any():
            cut.append((i, rest))
    leaks = {i for i, _ in brute_overlaps(cut, items)}
    own = piece.codec(PIECES).own
    return sorted((i, t, own.encode(t)) for i, t in cut if i not in leaks)


def test_the_pipeline_equals_its_plain_version(spark, tmp_path):
    import random

    rnd = random.Random(61)
    words = lambda n: [f"w{rnd.randrange(900)}" for _ in range(n)]
    prose = lambda n: " ".join(words(n))
    item, passage, line = [words(30) for _ in range(4)], prose(40), "read more at our site now 2024"
    rows = [(i, prose(rnd.choice((12, 40, 90))), f"h{i % 2}") for i in range(25)]
    rows += [(100 + i, f"{prose(30)}\n{line}\n{prose(rnd.choice((3, 30)))}", "h0") for i in range(13)]
    rows += [(150 + i, "\n".join([line] * 4 + [prose(4 + i)]), "h0") for i in range(4)]
    for i in range(12):  # chains of copies with ever more words changed
        text = rows[i][1].split()
        for k in range(3):
            text[rnd.randrange(len(text))] = f"x{i}y{k}"
            rows.append((200 + 10 * i + k, " ".join(text), "h1"))
    rows += [(400 + i, f"{prose(25)} {passage if i % 2 else passage[30:]} {prose(25)}", "h1") for i in range(5)]
    for i in range(8):
        leak = list(item[i % 4][rnd.randrange(4) :][: rnd.choice((9, 14, 26))])
        leak[rnd.randrange(len(leak))] = "zz"
        rows.append((500 + i, " ".join(words(20) + leak + words(20)), "h0"))
    rows += [(600, "too short", "h0"), (601, "again and again and " * 30, "h0"), (602, "", "h0")]
    items = [(i, " ".join(w)) for i, w in enumerate(item)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.createDataFrame([(i, t, "en", h, len(t)) for i, t, h in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.text, list(r.piece_ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = plain_pipeline(rows, items)
    assert got == want and 25 < len(want) < len(rows) - 20
