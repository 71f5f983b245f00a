"""The corpus pipeline: filters and dedup over `documents`, then tokens. Each stage's output is written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of `documents`. Null texts pass the filters as empty ones. An empty table stays one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselattice.llm import bpe, common, decontaminate, line_dedup, ngram_join, toxicity

TOXIC_FROM = 0.3
#: A document with fewer own words than the near-duplicate threshold leaves is a copy, which that stage settles.
COPY_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs, model, output="__score").where(F.col("__score") < TOXIC_FROM).select(*docs.columns)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more sites share; n_chars follows the text.

    Only documents with over ``COPY_PERCENT`` % of their words in such lines keep them.
    """
    cleaned = line_dedup.remove_boilerplate(docs, copy_percent=COPY_PERCENT)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by links of similarity 0.8 or more the document with the least identifier, null last.

    Rows equal in identifier and text are one document; other rows are documents of their own, whatever their identifiers.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    classes = ngram_join.similarity_classes(keyed.select("__key", "text"), doc_id="__key").select(F.col("doc_id").alias("__key"), "class_id")
    ranked = keyed.select("__key", "doc_id").join(classes, "__key").groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key"))["__key"].alias("__id"))
    met = keyed.join(ranked.select("__id"), F.col("__key") == F.col("__id"))
    first = met.withColumn("__n", F.row_number().over(Window.partitionBy("__id").orderBy("text")))
    return first.where("__n = 1").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item; rows are told apart by identifier and text."""
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    leaks = decontaminate.find_leaks(keyed.select("__key", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="__key")
    return keyed.join(leaks.select(F.col("doc_id").alias("__leak")).distinct(), F.col("__key") == F.col("__leak"), "left_anti").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, with digests of the ids and of the bytes that they decode to."""
    kept = tuple(c for c in ("doc_id", "lang", "source") if c in docs.columns)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=kept, outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("tokens", encode_tokens),
]

#: SQL cannot state the toxicity classifier; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = common.release(spark, last=1 << 30)
    for name, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
        common.release(spark, keep=before, last=1)  # what this stage and those before it wrote, but for its output
    return STAGES[-1][1](spark, docs, sf_dir)
