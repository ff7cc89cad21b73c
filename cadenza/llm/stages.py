"""The stages of the corpus pipeline: from raw documents to token ids.

Each takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of documents; the last
adds ``piece_ids`` and ``decoded``.  Nulls in any column, repeated rows, rows that share an id, empty tables and extra columns are taken as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontam, piece, quality, simhash_vp, suffix_dedup
from cadenza.llm.common import documents, scratch


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars again, of texts that may have lost some."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines above their host's limit go; so do documents that fail the base rules or are depleted."""
    return _counted(quality.apply(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingle sets of Jaccard similarity 0.8 and more, the one with the smallest id stays."""
    return simhash_vp.drop_similar(docs, size=5, similarity=0.8)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes and more that start earlier elsewhere are cut from texts."""
    return _counted(suffix_dedup.apply(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and the text that they decode to."""
    import public_tokenizers

    return piece.add_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_codec", piece_codec),
]

#: Suffix arrays, fingerprints and tokens are beyond SQL; a test holds the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  Between stages the rows are written to the shared folder and read again, so a lost executor costs a stage's tasks at most."""
    docs, before = documents(spark, sf_dir), lambda: None
    for name, stage in STAGES[:-1]:
        docs, drop = scratch(stage(spark, docs, sf_dir), name)
        before()
        before = drop
    return STAGES[-1][1](spark, docs, sf_dir)
