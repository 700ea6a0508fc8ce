"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.llm import decontaminate, jaccard, langid, line_templates, packing
from roadrisk.llm.shipping import shipped
from roadrisk.session import materialise

#: Some stages have no SQL form (a trained classifier, a tokenizer, a packing fit).
ORACLE_SQL = None


@shipped
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose language is ambiguous, go."""
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.annotate(docs, model)
    return found.where((F.col("_lang_pred") != langid.UND) & ~F.col("_lang_ambiguous")).select(docs.columns)


@shipped
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, and with them documents that had nothing else."""
    found = line_templates.drop_recurring_lines(docs)
    left = (F.col("n_dropped") == 0) | F.col("text").rlike(r"\S")
    return found.where(left).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@shipped
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram similarity, directly or through others, one stays."""
    return jaccard.keep_one(docs).select(docs.columns)


@shipped
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.where("contaminated").select(F.col("text_key").alias("_text_key")).distinct()
    return (docs.withColumn("_text_key", F.xxhash64(F.coalesce("text", F.lit("")))).join(gone, "_text_key", "left_anti")
            .select(docs.columns))


@shipped
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with the sequence and offset that they are packed to."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language), ("line_dedup", line_dedup), ("ngram_jaccard_join", one_of_each_group),
          ("benchmark_decontamination", decontaminated), ("best_fit_packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared
    scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
