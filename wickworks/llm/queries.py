"""The registered queries of this subpackage, and the SQL that gives the same rows.

Queries without SQL are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.llm import blocks, chosenpath, decontam, gains, improbable, langid, lines, mixing, resample, rules, suffix, trie, warc
from wickworks.llm.base import table


def op2_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, shards = warc.archive_pages(pages)
    return warc.read_pages(pages, folder, shards, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.dedup_suffixes(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.jaccard_join(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = blocks.dedup_substrings(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = improbable.with_edits(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")})


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(trie.ordered(table(spark, sf_dir, "conversations"))))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = gains.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return drawn.select(F.col("doc_id").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_warc_roundtrip": op2_warc_roundtrip,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_target_resampling": op13_target_resampling,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op2_warc_roundtrip": warc.op2_sql(),
    "op4_suffix_dedup": suffix.op4_sql(),
    "op5_quality_rules": rules.op5_sql(),
    "op8_jaccard_join": chosenpath.op8_sql(),
    "op9_substring_dedup": blocks.op9_sql(),
    "op10_line_dedup": lines.op10_sql(),
    "op12_prefix_trie": trie.op12_sql(),
    "op13_target_resampling": gains.op13_sql(),
}
