"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
its rows as Parquet in the shared folder and rereads them as the next stage's
docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.llm import chosenpath, decontam, langid, lines, mixing
from wickworks.llm.base import table, written
from wickworks.session import apply_job_conf


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: no letter, or no language with a posterior of one half."""
    return langid.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; so do documents of which no line with a word is left."""
    cut = lines.dedup_lines(docs).where("n_lines > n_removed").drop("n_lines", "n_removed")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document stays, that with the smallest id."""
    return chosenpath.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, numbered by copy_no."""
    return mixing.mixed(docs)


def _configured(stage):
    """``stage`` under the session settings that the operators assume."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_job_conf(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _configured(identify_language)),
    ("line_dedup", _configured(dedup_lines)),
    ("near_duplicates", _configured(join_near_duplicates)),
    ("decontamination", _configured(decontaminate)),
    ("source_mixing", _configured(mix_sources)),
]

# Languages, benchmark tiles and the random mix have no SQL: tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
