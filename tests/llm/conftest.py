import random

import pytest

WORDS = ["the", "of", "river", "stone", "Light", "over", "quiet", "hill", "and", "früh", "été", "mañana", "walks", "green", "door", "paper", "seven", "music", "late", "answer"]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + (rnd.choice(".,") if rnd.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): prose, copies, a near copy, shared passages and lines, and every odd case."""
    rnd = random.Random(5)
    rows = [(i, prose(rnd, 20 + 7 * i) + "\n" + prose(rnd, 30), "en", f"src{i % 3}") for i in range(40)]
    shared, line = prose(rnd, 60), "Subscribe to our letter NOW 2024"
    rows += [(100 + i, prose(rnd, 30) + " " + shared + " " + prose(rnd, 30), "en", "src0") for i in range(12)]
    rows += [(200 + i, prose(rnd, 40) + f"\n{line}\n" + prose(rnd, 40), "en", "src1") for i in range(14)]
    rows += [(300 + i, f"{line}\n{line.lower()}\n{line.upper()}\n" + prose(rnd, 11), "en", "src1") for i in range(2)]
    rows += [(400, rows[30][1], "en", "src2"), (401, rows[30][1], "en", "src2"), (402, rows[31][1] + " x", "en", "src0")]
    rows += [(500, None, "en", "src0"), (501, "", None, None), (502, " \t\n\x0b ", "de", "src0"), (503, "!!! 123 ...", "en", "src0"), (504, "ab" * 400, "en", "src0"), (505, prose(rnd, 6000), "en", "src0")]
    rows += [(506, "a  b   c ", "en", "src0"), (507, " lead ▁ mark", "en", "src0"), (508, "x<|endoftext|>y <|startoftext|> Z", "en", "src0"), (509, "日本語 текст \U0001f600 é \0 end", "en", "src0")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string").repartition(3)
    return df.selectExpr("*", "length(text) as n_chars", "'clash' as tokens", "1 as fp", "'x' as n_words").cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


@pytest.fixture
def small_batches(spark):
    """Sets the rows of an Arrow batch for one test."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.set(name, before)
