"""The corpus pipeline; its stages are in ``cadenza.llm.stages``."""

from cadenza.llm.stages import ORACLE_SQL, STAGES, benchmark_decontamination, piece_codec, quality_rules, run, simhash_near_dedup, suffix_array_dedup

__all__ = ["ORACLE_SQL", "STAGES", "benchmark_decontamination", "piece_codec", "quality_rules", "run", "simhash_near_dedup", "suffix_array_dedup"]
