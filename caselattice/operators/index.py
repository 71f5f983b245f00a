"""Persistent search indexes: tables of postings, statistics and vectors with a manifest, and a gate on their corpus."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselattice.functions import text as tx
from caselattice.operators import retrieval
from caselattice.sources import files, sinks

#: Fields of the text that is indexed where a record brings none of its own.
INDEXED_FIELDS = ("设备类型", "设备单元号", "设备指令号", "设备参数")


def indexed_text(columns: list[str], fields: tuple[str, ...] = INDEXED_FIELDS, own: str = "_text") -> Column:
    """A record's own search text, or its fields that hold something, with spaces between."""
    parts = [F.when(~F.coalesce(F.col(f), F.lit("")).isin("", "[]"), F.col(f)) for f in fields if f in columns]
    made = F.concat_ws(" ", *parts) if parts else F.lit("")
    return F.coalesce(F.nullif(F.col(own), F.lit("")), made) if own in columns else made


def vector_encoder(encode: Callable[[list[str]], list[list[float]]], instruction: str = ""):
    """An Arrow function column -> unit vectors, from a function of texts; the instruction goes before queries only."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for vector in encode([instruction + (t or "") for t in texts]):
            norm = sum(x * x for x in vector) ** 0.5 or 1.0
            out.append([x / norm for x in vector])
        return pd.Series(out)

    return run


def checked_records(records: DataFrame, key: str) -> DataFrame:
    """The records; fails on a blank or repeated key, or where there is none at all."""
    counts = records.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.nullif(tx.clean(key), F.lit(""))).alias("d")).first()
    if not counts.n or counts.n != counts.d:
        raise ValueError(f"{counts.n} records with {counts.d} distinct keys")
    return records


def build_index(records: DataFrame, folder: str, *, key: str, tokens: Callable[[Column], Column] = tx.index_tokens, encode=None, **facts) -> None:
    """Writes postings, statistics, vectors (with ``encode``) and a manifest below ``folder``, which must not be there."""
    spark = records.sparkSession
    docs = checked_records(records, key).select(F.col(key).alias("doc"), indexed_text(records.columns).alias("text"))
    words = tokens(F.col("text"))
    post = retrieval.postings(docs, "doc", words)
    post.repartition("term").write.parquet(f"{folder}/postings")
    retrieval.corpus_stats(docs, words).write.parquet(f"{folder}/stats")
    if encode is not None:
        docs.select("doc", encode("text").alias("dv")).write.parquet(f"{folder}/vectors")
    mark = files.fingerprint(docs).first()
    sinks.write_manifest(spark, f"{folder}/manifest.json", {"status": "completed", "documents": mark.n_rows, "corpus_hash": mark.hash, "dense": encode is not None, **facts})


def open_index(spark: SparkSession, folder: str, records: DataFrame | None = None, key: str = "id") -> dict:
    """The index's tables and manifest; fails if ``records`` aren't those it was made of."""
    manifest = json.loads("\n".join(r[0] for r in spark.read.text(f"{folder}/manifest.json").collect()))
    if records is not None:
        mark = files.fingerprint(records.select(F.col(key).alias("doc"), indexed_text(records.columns).alias("text"))).first()
        if (mark.n_rows, mark.hash) != (manifest["documents"], manifest["corpus_hash"]):
            raise ValueError("the index was made of another corpus")
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in ("postings", "stats", *(["vectors"] if manifest["dense"] else []))}
    return tables | {"manifest": manifest}


def search_index(index: dict, queries: DataFrame, *, query_tokens: Column, encode=None, pool: int = 50, k: int = 5, strict: bool = False) -> DataFrame:
    """Hybrid search of (query, text): a lexical pool, dense scores within it, fusion, the first ``k``.

    Without vectors or encoder ranks are lexical alone; so they are where the encoder fails on the first query, unless
    ``strict``. Scores are compared to nine decimals, so that ties don't hang on the order of a sum.
    """
    post, stats = index["postings"], index["stats"]
    asked = queries.select("query", F.explode(query_tokens).alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("qtf"))
    idf = retrieval.term_stats(post, stats)
    weight = F.col("qtf") * F.col("idf") * F.col("tf") * 2.5 / (F.col("tf") + 1.5 * (0.25 + 0.75 * F.col("doc_len") / F.col("avgdl")))
    met = retrieval.small(asked).join(post, "term").join(idf, "term").crossJoin(F.broadcast(stats.select("avgdl")))  # one row
    ranked = retrieval.top_k(met.groupBy("query", "doc").agg(F.round(F.sum(weight), 9).alias("score")), max(pool, k), name="bm25_rank")
    if encode is not None and not strict:
        try:
            queries.limit(1).select(encode("text")).collect()
        except Exception as error:  # whatever the caller's encoder raises
            logging.getLogger(__name__).warning("the encoder fails, ranks are lexical alone: %s", error)
            encode = None
    if encode is None or "vectors" not in index:
        scored = ranked.withColumn("dense", F.lit(None).cast("double"))
    else:
        scored = retrieval.rerank(ranked, index["vectors"], queries.select("query", encode("text").alias("qv"))).withColumn("dense", F.round("dense", 9))
    return retrieval.fuse(scored).where(F.col("final_rank") <= k)


def case_documents(cases: DataFrame, tables: DataFrame) -> DataFrame:
    """(id, source, ao_text, table, defined_ids, search_text) of cases met with their predicted tables; the last table
    of an id counts."""
    # of tables under one id the last counts: by ``line_number`` where there is one, else the greatest as text
    last = tables.groupBy("id").agg(F.max_by("rows", "line_number" if "line_number" in tables.columns else F.to_json("rows")).alias("table"))
    met = cases.join(last, "id", "left").withColumn("table", F.coalesce("table", F.array().cast("array<map<string,string>>")))
    markers = F.transform("table", lambda row: F.element_at(row, F.lit("判据关联标志")))
    return met.select(
        "id", F.coalesce("source", F.lit("")).alias("source"), F.col("content").alias("ao_text"), "table",
        tx.defined_ids("content", markers).alias("defined_ids"), F.concat_ws("\n", "content", F.to_json("table")).alias("search_text"),
    )


def judgement(c) -> Column:
    """(needs_retrieval, referenced_ids, referenced_tasks, reason, parse_ok) of a judge's JSON answer."""
    reply = F.col(c) if isinstance(c, str) else c
    at = lambda name: F.get_json_object(reply, f"$.{name}")

    def words(name: str) -> Column:
        given = at(name)
        listed = F.from_json(given, "array<string>")
        return F.when(given.isNull(), F.array().cast("array<string>")).when(given.startswith("["), F.filter(listed, lambda x: x.isNotNull())).otherwise(F.array(given))

    fine = F.coalesce(F.size(F.json_object_keys(reply)) > 0, F.lit(False))
    return F.struct(
        F.coalesce(tx.judged_true(at("needs_retrieval")), F.lit(False)).alias("needs_retrieval"), words("referenced_ids").alias("referenced_ids"), words("referenced_tasks").alias("referenced_tasks"),
        F.coalesce(at("reason"), F.lit("")).alias("reason"), fine.alias("parse_ok"),
    )


def search_request(cases: DataFrame, judged: Column) -> DataFrame:
    """(id, needed, overridden, query, targets) from judgements and what the texts themselves refer to."""
    from caselattice.operators.prep import merge_judgement

    held = cases.withColumn("j", judged)
    needed, overridden = merge_judgement(tx.needs_other_cases("search_text"), F.col("j.needs_retrieval"))
    own_ids, own_tasks = tx.referenced_ids("search_text"), tx.referenced_tasks("search_text")
    said = lambda label, items: F.concat(F.lit(f"{label}: "), F.array_join(items, ", "))
    query = F.concat_ws("\n", "ao_text", said("referenced_ids", F.col("j.referenced_ids")), said("referenced_tasks", F.col("j.referenced_tasks")), said("observed_ids", own_ids), said("observed_tasks", own_tasks))
    targets = F.transform(F.when(F.size("j.referenced_ids") > 0, F.col("j.referenced_ids")).otherwise(own_ids), lambda x: F.upper(F.ltrim(x, F.lit("@"))))
    return held.select("id", needed.alias("needed"), overridden.alias("overridden"), query.alias("query"), targets.alias("targets"))
