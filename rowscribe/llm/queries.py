"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowscribe.llm import (
    bpe,
    language,
    near_dedup,
    packing,
    periodic_runs,
    pii,
    quality_model,
    quality_rules,
    source_audit,
    suffix_dedup,
    token_counts,
    top_k,
    url_filter,
)
from rowscribe.llm.common import table

#: The rules that the URL query applies.
URL_RULES = [
    url_filter.Rule("net/", allow=False),
    url_filter.Rule("example.net/en/", allow=True),
    url_filter.Rule("example.com/de/", allow=False),
    url_filter.Rule("org/fr/", allow=True),
]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.predict_languages(documents, language.fit(documents))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_model.score_quality(documents, quality_model.fit(documents, table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    texts = documents.select("doc_id", periodic_runs.with_planted_runs(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.periodic_runs(texts).withColumn("best", periodic_runs.strongest(F.col("runs")))
    line = lambda run: F.concat(F.concat_ws(",", *(run[name].cast("string") for name in ("start", "length", "period"))), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.listed(spans, base_only=True), 256).alias("base_sha256"),
        pii.listed(spans).alias("spans"),
    )


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_suffix_dedup,
        op2_bpe,
        op3_packing,
        op4_token_counts,
        op5_language,
        op6_url_filter,
        op7_top_k,
        op8_quality_rules,
        op9_near_dedup,
        op10_quality_model,
        op11_periodic_runs,
        op12_pii,
        op13_source_audit,
    )
}
