"""The registered queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import ans, centroids, chat, ctw, decontam, langid, multi_index, phrases, piece, quality, simhash_vp, suffix_dedup, token_counts
from cadenza.llm.common import documents, held_out, shared_dir


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_viterbi_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(~held_out("doc_id", 4, 2)))
    return langid.identify(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.verdicts(documents(spark, sf_dir))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boilerplate")


def op3_range_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/blocks-{uuid.uuid4().hex}"
    return ans.round_trip(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), folder)


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out("doc_id", 7, 2)
    got = ctw.score(documents(spark, sf_dir), ~held)
    return got.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op5_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure_cuts(documents(spark, sf_dir))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.format_windows(turns.unionByName(extra)))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.encode_decode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op10_simhash_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_vp.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_pair_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(documents(spark, sf_dir))


def op12_hamerly(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.summed(*centroids.cluster(embeddings(spark, sf_dir)))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(embeddings(spark, sf_dir), F.col("id") % multi_index.EVERY == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_viterbi_langid": op1_viterbi_langid,
    "op2_line_frequency": op2_line_frequency,
    "op3_range_ans": op3_range_ans,
    "op4_context_tree": op4_context_tree,
    "op5_suffix_arrays": op5_suffix_arrays,
    "op6_chat_windows": op6_chat_windows,
    "op7_spaced_seeds": op7_spaced_seeds,
    "op8_piece_codec": op8_piece_codec,
    "op9_token_counts": op9_token_counts,
    "op10_simhash_vp": op10_simhash_vp,
    "op11_pair_naming": op11_pair_naming,
    "op12_hamerly": op12_hamerly,
    "op13_multi_index": op13_multi_index,
    "pipeline": pipeline,
}

#: One row per turn of op6 as the template writes it, with the window that holds it and those that repeat it.
_OP6_TURNS = f"""
WITH base AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
a AS (
  SELECT *, '<s>' || replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), chr(10), '&nl;') || chr(10)
      || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;') || '</s>' AS piece,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS ord FROM base),
b AS (
  SELECT *, CAST(ceil(strlen(piece) / 4.0) AS BIGINT) AS n, role = 'system' AND sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY ord) = 1 AS sys FROM a),
c AS (
  SELECT *, CAST(coalesce(sum(CASE WHEN sys THEN 0 ELSE n END) OVER w, 0) AS BIGINT) AS starts, CAST(coalesce(sum(CASE WHEN sys THEN n END) OVER w, 0) AS BIGINT) AS fixed
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d AS (
  SELECT *, coalesce(starts - min(CASE WHEN NOT sys THEN starts END) OVER (PARTITION BY conv_id ORDER BY starts RANGE BETWEEN {chat.HISTORY} PRECEDING AND CURRENT ROW), 0) AS past FROM c),
e AS (
  SELECT *, fixed + past + n <= {chat.BUDGET} AS repeats, {chat.BUDGET} - fixed - CASE WHEN fixed + past + n <= {chat.BUDGET} THEN past ELSE 0 END AS room FROM d),
f AS (
  SELECT *, list({{'n': n, 'room': room, 'used': n, 'opens': 1}}) OVER (PARTITION BY conv_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM e),
g AS (
  SELECT *, list_reduce(so_far, lambda h, x: CASE WHEN h.used + x.n <= h.room THEN {{'n': x.n, 'room': h.room, 'used': h.used + x.n, 'opens': 0}} ELSE x END).opens AS opens FROM f),
h AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY ord) AS no FROM g),
i AS (
  SELECT *, max(no) OVER (PARTITION BY conv_id) AS last_no, max(starts + CASE WHEN sys THEN 0 ELSE n END) OVER (PARTITION BY conv_id, no) AS closes,
    max(CASE WHEN opens = 1 THEN repeats END) OVER (PARTITION BY conv_id ORDER BY no RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS next_repeats FROM h),
t AS (
  SELECT *, 1 + CASE WHEN sys THEN last_no - no WHEN next_repeats AND closes - starts <= {chat.HISTORY} THEN 1 ELSE 0 END AS times, length(piece) AS chars FROM i)
"""


def _op12_sql(k: int = centroids.K, rounds: int = centroids.ROUNDS) -> str:
    """The rounds one after the other, all centroids scanned for every vector."""
    said = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS i, unnest(v) AS x FROM e),
c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS i, unnest(v) AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id), vec_id, v) - 1 AS k FROM e) WHERE k < {k})"""
    for r in range(rounds + 1):
        said += f""",
d{r} AS (SELECT vec_id, k, sum((x - c) * (x - c)) AS d FROM p JOIN c{r} USING (i) GROUP BY vec_id, k),
a{r} AS MATERIALIZED (SELECT vec_id, k, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)"""
        if r < rounds:
            said += f""",
m{r} AS (SELECT k, i, CAST((s - ((s % n) + n) % n) / n AS BIGINT) AS c FROM (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM p JOIN a{r} USING (vec_id) GROUP BY k, i)),
c{r + 1} AS MATERIALIZED (SELECT c{r}.k, c{r}.i, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k, i))"""
    return said + f""",
h AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256 FROM a{rounds} JOIN h USING (k)"""


ORACLES: dict[str, str] = {
    "op12_hamerly": _op12_sql(),
    "op11_pair_naming": rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT doc, lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\f\r]')) AS piece FROM d),
q AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM s),
w AS MATERIALIZED (SELECT piece, lang, unnest(ws) AS w1, unnest(range(len(ws))) AS i FROM q),
g AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM w WINDOW p AS (PARTITION BY piece ORDER BY i)),
g1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM w GROUP BY ALL),
g2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
g3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
n AS (SELECT lang, sum(f) AS n FROM g1 GROUP BY lang),
over2 AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, w1 AS x, w2 AS y, f FROM g3 UNION ALL SELECT lang, w2, w3, f FROM g3) GROUP BY ALL),
c2 AS (SELECT g2.lang, g2.w1 || ' ' || g2.w2 AS phrase, g2.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM g2 JOIN g1 x ON x.lang = g2.lang AND x.w1 = g2.w1 JOIN g1 y ON y.lang = g2.lang AND y.w1 = g2.w2
  LEFT JOIN over2 o ON o.lang = g2.lang AND o.x = g2.w1 AND o.y = g2.w2 WHERE g2.f >= {phrases.LEAST} AND (o.f IS NULL OR 100 * o.f < {phrases.SUBSUMED} * g2.f)),
c3 AS (
  SELECT g3.lang, g3.w1 || ' ' || g3.w2 || ' ' || g3.w3 AS phrase, g3.f AS a, x.f AS l, y.f AS r, 1 AS k FROM g3 JOIN g1 x ON x.lang = g3.lang AND x.w1 = g3.w1 JOIN g2 y ON y.lang = g3.lang AND y.w1 = g3.w2 AND y.w2 = g3.w3
  UNION ALL
  SELECT g3.lang, g3.w1 || ' ' || g3.w2 || ' ' || g3.w3, g3.f, x.f, y.f, 2 FROM g3 JOIN g2 x ON x.lang = g3.lang AND x.w1 = g3.w1 AND x.w2 = g3.w2 JOIN g1 y ON y.lang = g3.lang AND y.w1 = g3.w3),
c AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM (SELECT * FROM c2 UNION ALL SELECT * FROM c3)),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b) JOIN n USING (lang) WHERE rank <= {phrases.TOP}""",
    "op6_chat_windows": _OP6_TURNS + """
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY ord), '')) AS loss_sha256,
  CAST(sum(times * chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op5_suffix_arrays": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, b[p:p + 99] AS s FROM (SELECT doc_id, b, unnest(range(1, n - 98)) AS p FROM d WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 OR lag(p) OVER (PARTITION BY doc_id ORDER BY p) IS NULL THEN 1 ELSE 0 END AS opens FROM r),
i AS (SELECT doc_id, min(p) AS a, max(p) + 99 AS z FROM (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g) GROUP BY doc_id, k),
c AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS nxt FROM i),
k AS (SELECT c.doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed,
    string_agg(hex(CASE WHEN a - 1 > before THEN d.b[before + 1:a - 1] ELSE ''::BLOB END) || CASE WHEN nxt IS NULL AND z < d.n THEN hex(d.b[z + 1:d.n]) ELSE '' END, '' ORDER BY a) AS kept
  FROM c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  CASE WHEN kept IS NULL THEN sha256(d.b) ELSE sha256(unhex(kept)) END AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op2_line_frequency": rf"""
WITH d AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM (SELECT DISTINCT doc_id, source, coalesce(text, '') AS t FROM documents)),
w AS (SELECT r, doc_id, source, t, string_split(t, chr(10)) AS ls, regexp_extract_all(t, '[^ \t-\r]+') AS words FROM d),
m AS (
  SELECT r, words, len(words) AS n_words, length(regexp_replace(t, '[ \t-\r]', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(ls, lambda x: regexp_matches(x, '[^ \t-\r]'))) - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^ \t-\r]')))) AS n_dup_lines FROM w),
pos AS (SELECT r, words, unnest(range(1, n_words - 3)) AS p FROM m WHERE n_words >= 5),
win AS (SELECT r, p, array_to_string(words[p:p + 4], ' ') AS g FROM pos),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS k FROM win) WHERE k > 1),
cov AS (SELECT r, sum(least(5, coalesce(nxt - p, 5))) AS n_repeat_words FROM (SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS nxt FROM rep) GROUP BY r),
l AS (
  SELECT r, doc_id, source, t, trim(regexp_replace(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[ \t-\r]+', ' ', 'g'), ' ') AS line
  FROM (SELECT r, doc_id, source, t, unnest(ls) AS x FROM w)),
lw AS (SELECT r, doc_id, source, t, line, sum(len(string_split(line, ' '))) AS words FROM l WHERE line <> '' GROUP BY ALL),
n AS (SELECT r, words, count(*) OVER (PARTITION BY source, line) AS docs, row_number() OVER (PARTITION BY source, line ORDER BY doc_id NULLS LAST, t) AS place FROM lw),
gone AS (SELECT r, sum(words) AS n_boilerplate FROM n WHERE docs > {quality.LINE_DOCS} AND place > 1 GROUP BY r),
v AS (
  SELECT d.doc_id, d.source, d.t, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_boilerplate, 0) AS n_boilerplate
  FROM d JOIN m USING (r) LEFT JOIN cov USING (r) LEFT JOIN gone USING (r))
SELECT o.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words) AND n_words - n_boilerplate >= {quality.KEPT_SHARE} * n_words AS kept,
  CAST(n_boilerplate AS BIGINT) AS n_boilerplate
FROM documents o JOIN v ON o.doc_id IS NOT DISTINCT FROM v.doc_id AND o.source IS NOT DISTINCT FROM v.source AND coalesce(o.text, '') = v.t""",
}
