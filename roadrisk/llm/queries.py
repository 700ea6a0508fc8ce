"""The thin registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadrisk.llm.shipping import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = shipped(fn)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.decontaminate import contamination
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.token_files import digests, token_files
    path = token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return digests(spark, path)


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.quality import cascade
    out = cascade(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.langid import held_out, identify
    out = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from roadrisk.llm.langid import held_out
    from roadrisk.llm.toxicity import toxicity
    out = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"),
                   table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.line_templates import drop_recurring_lines
    return drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.jaccard import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_key")


#: The key of the registered query; a deployment passes its own.
PSEUDONYM_KEY = b"registered query"


@register
def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.pii import pseudonymise
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


@register
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.langid import held_out
    from roadrisk.llm.secrets import certain_findings, scan
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return scan(docs, lambda found: certain_findings(found.where(~held_out())), key=PSEUDONYM_KEY, path_col="source")


@register
def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from roadrisk.llm.quality_vote import held_out, quality_votes
    out = quality_votes(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                      "neighbours", "best_cosine", "nearest_id", "nearest_label")


#: Of how many (document, run) pairs one loses a letter, by the query's contract.
SLIP = 97


@register
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.spelling import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), slip=SLIP)


@register
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadrisk.llm.alignment import alignment
    return alignment(table(spark, sf_dir, "documents").select("doc_id", "text"),
                     public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
