"""Lexical, dense and fused retrieval, and the audited decision on what was found.

All searches are joins of a query table with postings or vectors; top-k windows rank by score with a named tie-break,
so Catalyst limits each group before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselattice import schema
from caselattice.functions import similarity as sim
from caselattice.functions import text as tx
from caselattice.operators import blocks
from caselattice.session import stash

#: Queries and pools up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is seen to have at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def postings(docs: DataFrame, doc: str, tokens: Column) -> DataFrame:
    """(doc, term, tf, doc_len) of documents with tokens."""
    listed = docs.select(F.col(doc).alias("doc"), tokens.alias("tokens"))
    spread = listed.select("doc", F.size("tokens").alias("doc_len"), F.explode("tokens").alias("term"))
    return spread.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("doc_len").alias("doc_len"))


def corpus_stats(docs: DataFrame, tokens: Column) -> DataFrame:
    """One row: documents and mean length, documents without tokens included."""
    return docs.select(F.size(tokens).alias("n")).agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("avgdl"))


def term_stats(post: DataFrame, stats: DataFrame) -> DataFrame:
    """(term, df, idf)"""
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.crossJoin(F.broadcast(stats)).select("term", "df", F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf"))


#: Stands for a document itself among its terms; no tokenizer gives it.
_SELF = ""


def bm25(queries: DataFrame, query: str, query_tokens: Column, docs: DataFrame, doc: str, doc_tokens: Column, *, distinct_terms: bool, k1: float = 1.5, b: float = 0.75, least_avgdl: float = 0.0) -> DataFrame:
    """(query, doc, score) of documents that share a term with a query.

    ``distinct_terms`` counts a query's term once, else as often as it stands there. Documents are tokenised once: only the
    queries' terms are kept of the postings, with one entry for each document, and written; statistics and scores are
    taken from there. So frequent words of the corpus that no query has cost nothing.
    """
    asked = queries.select(F.col(query).alias("query"), F.explode(F.array_distinct(query_tokens) if distinct_terms else query_tokens).alias("term"))
    asked = stash(asked.groupBy("query", "term").agg(F.count(F.lit(1)).alias("qtf")), "bm25-queries")
    terms = small(asked.select("term").distinct().union(queries.sparkSession.createDataFrame([(_SELF,)], "term string")))
    listed = docs.select(F.col(doc).alias("doc"), doc_tokens.alias("tokens"))
    spread = listed.select("doc", F.size("tokens").alias("doc_len"), F.explode(F.concat("tokens", F.array(F.lit(_SELF)))).alias("term"))
    post = stash(spread.join(terms, "term", "left_semi").groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("doc_len").alias("doc_len")), "bm25-postings")
    own, post = post.where(F.col("term") == _SELF), post.where(F.col("term") != _SELF)
    # documents without a key, or with a repeated one, are one entry with that many copies
    stats = own.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum(F.col("tf") * F.col("doc_len")) / F.sum("tf"), F.lit(0.0)).alias("avgdl"))
    idf = term_stats(post, stats)
    part = F.col("qtf") * F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("doc_len") / F.greatest(F.col("avgdl"), F.lit(least_avgdl))))
    met = small(asked).join(post, "term").join(idf, "term").crossJoin(F.broadcast(stats.select("avgdl")))  # one row
    return met.groupBy("query", "doc").agg(F.sum(part).alias("score"))


def top_k(scored: DataFrame, k: int, *, by: str = "query", score: str = "score", tie: str = "doc", name: str = "rank") -> DataFrame:
    return scored.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(F.desc(score), tie))).where(F.col(name) <= k)


def dense_scores(queries: DataFrame, items: DataFrame, *, query: str, item: str, vector: str) -> DataFrame:
    """(query, doc, dense): every stated query against all items; the queries are the broadcast side, in checked size."""
    asked = queries.select(F.col(query).alias("query"), F.col(vector).alias("qv"))
    return items.select(F.col(item).alias("doc"), F.col(vector).alias("dv")).crossJoin(small(asked)).select("query", "doc", sim.dot(F.col("qv"), F.col("dv")).alias("dense"))


def nearest(items: DataFrame, asked: DataFrame, k: int, *, parts: int = 1, width: int | None = None) -> DataFrame:
    """(query, doc, score_e6, rank): the ``k`` best of (key, vector) for each asked one, by product or, with several ``parts`` of
    ``width``, by late interaction. Even, finite vectors meet in blocks; others by a row for each pair."""
    seen = items.unionByName(asked).agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most"), F.max(_odd_vector("vector")).alias("odd"), F.count(F.when(F.col("key").isNull() | F.col("vector").isNull(), 1)).alias("gone")).first()
    if seen.least is None or (seen.least == seen.most == (parts * width if width else seen.least) and seen.least > 0 and not seen.odd and not seen.gone):
        return blocks.nearest(items, asked, k, parts)
    if width is None:
        score = sim.dot(F.col("qv"), F.col("dv"))
    else:
        score = sim.max_sim(*[F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), cut) for cut in (lambda i: F.slice("qv", i * width + 1, width), lambda i: F.slice("dv", i * width + 1, width))])
    pairs = items.select(F.col("key").alias("doc"), F.col("vector").alias("dv")).crossJoin(small(asked.select(F.col("key").alias("query"), F.col("vector").alias("qv"))))
    return top_k(pairs.select("query", "doc", tx.round_micro(score).alias("score_e6")), k, score="score_e6")


def _odd_vector(vector: str) -> Column:
    """Whether something in it is null, not finite or so large that products are not."""
    return F.coalesce(F.exists(F.col(vector).cast("array<double>"), lambda x: ~F.coalesce(F.abs(x) < 1e150, F.lit(False))), F.lit(False))


def rerank(pool: DataFrame, vectors: DataFrame, query_vectors: DataFrame) -> DataFrame:
    """Adds dense scores to a pool: (query, doc) met with (doc, dv) and (query, qv)."""
    met = pool.join(vectors, "doc", "left").join(query_vectors, "query", "left")
    return met.withColumn("dense", F.when(F.col("dv").isNotNull() & F.col("qv").isNotNull(), sim.dot(F.col("qv"), F.col("dv")))).drop("dv", "qv")


def fuse(pool: DataFrame, *, base: int = 60) -> DataFrame:
    """Dense rank, margin to the second, reciprocal rank fusion and the final rank of pools with bm25_rank and dense."""
    dense = Window.partitionBy("query").orderBy(F.desc_nulls_last("dense"), "bm25_rank")
    ranked = pool.withColumn("dense_rank", F.when(F.col("dense").isNotNull(), F.row_number().over(dense)))
    ranked = ranked.withColumn("margin", F.when(F.col("dense_rank") == 1, F.col("dense") - F.lead("dense").over(dense)))
    ranked = ranked.withColumn("rrf", 1 / (base + F.col("bm25_rank")) + F.coalesce(1 / (base + F.col("dense_rank")), F.lit(0.0)))
    return ranked.withColumn("final_rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("rrf"), "bm25_rank")))


def cross_case(scores: DataFrame, *, base: int = 1, k: int = 5, dense: bool = True) -> DataFrame:
    """Fusion over all other cases of (query, doc, lexical, dense, defines): cases that define a wanted id come first."""
    w = Window.partitionBy("query")
    ranked = scores.where("query <> doc").withColumn("lexical_rank", F.row_number().over(w.orderBy(F.desc("lexical"), "doc")))
    score = 1 / (base + F.col("lexical_rank"))
    if dense:
        ranked = ranked.withColumn("dense_rank", F.row_number().over(w.orderBy(F.desc("dense"), "doc")))
        score = score + 1 / (base + F.col("dense_rank"))
    ranked = ranked.withColumn("rrf", score)
    return ranked.withColumn("rank", F.row_number().over(w.orderBy(F.desc("defines"), F.desc("rrf"), "doc"))).where(F.col("rank") <= k)


def cross_case_search(cases: DataFrame, asked: DataFrame, *, tokens: Callable[[Column], Column] = tx.search_tokens, vectors: DataFrame | None = None, k: int = 5, shown: int = 6000) -> DataFrame:
    """(query, doc, lexical, dense, defines, rank, ao) of the other cases for each stated query.

    ``cases`` has id, search_text, defined_ids and ao_text; ``asked`` has id, query and targets; ``vectors`` id and vector of
    both, without which only words count. Every other case is ranked, those without a common word by their identifier;
    cases that define a target come first. ``ao`` is cut to ``shown`` characters for display, after the search.
    """
    if _keyed_once(cases, asked, vectors):
        given = vectors.select("id", F.col("vector").cast("array<double>").alias("vector")) if vectors is not None else None
        ranked = blocks.ranked(_hashed(cases, tokens(F.col("search_text")), "defined_ids", given), _hashed(asked, F.array_distinct(tokens(F.col("query"))), "targets", given), k=k, base=1, dense=vectors is not None)
    else:
        ranked = _every_pair_ranked(cases, asked, tokens, vectors, k)
    return ranked.join(cases.select(F.col("id").alias("doc"), F.left("ao_text", F.lit(shown)).alias("ao")), "doc")


def _keyed_once(cases: DataFrame, asked: DataFrame, vectors: DataFrame | None) -> bool:
    """Whether keys are numbers or words, of one type, there and not repeated, and vectors finite and of one length."""
    tables = [t for t in (cases, asked, vectors) if t is not None]
    kinds = {t.schema["id"].dataType.simpleString() for t in tables}
    if len(kinds) > 1 or not kinds <= {"int", "bigint", "string"}:
        return False
    n = [t.agg((F.count(F.lit(1)) == F.countDistinct("id")).alias("once")) for t in tables]
    if not all(t.first().once for t in n):
        return False
    if vectors is None:
        return True
    seen = vectors.agg(F.countDistinct(F.size("vector")).alias("n"), F.min(F.size("vector")).alias("least"), F.max(_odd_vector("vector")).alias("odd")).first()
    return seen.n == 0 or (seen.n == 1 and seen.least > 0 and not seen.odd)


def _hashed(rows: DataFrame, terms: Column, ids: str, vectors: DataFrame | None) -> DataFrame:
    """Rows as `blocks.ranked` takes them; words and identifiers are told apart by 64-bit hashes."""
    listed, hashes = F.col(ids), lambda c: F.transform(c, lambda x: F.xxhash64(x))
    kind = F.when(listed.isNull(), 0).when(F.size(listed) == 0, 1).when(F.exists(listed, lambda x: x.isNull()), 3).otherwise(2)
    known = F.array_distinct(F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda x: x.isNotNull()))
    met = rows.withColumn("vector", F.lit(None).cast("array<double>")) if vectors is None else rows.join(vectors, "id", "left")
    return met.select(F.col("id").alias("key"), hashes(terms).alias("terms"), hashes(known).alias("ids"), kind.alias("kind"), "vector")


def _every_pair_ranked(cases: DataFrame, asked: DataFrame, tokens: Callable[[Column], Column], vectors: DataFrame | None, k: int) -> DataFrame:
    """The same by a row for every pair, for repeated keys and uneven vectors."""
    queries = asked.select(F.col("id").alias("query"), "query", "targets").toDF("query", "said", "targets")
    hits = bm25(queries, "query", tokens(F.col("said")), cases, "id", tokens(F.col("search_text")), distinct_terms=True, least_avgdl=1.0)
    docs = cases.select(F.col("id").alias("doc"), "defined_ids")
    each = docs.crossJoin(small(queries.select("query", "targets"))).where("doc <> query")
    met = each.join(hits, ["query", "doc"], "left").select("query", "doc", F.round(F.coalesce("score", F.lit(0.0)), 9).alias("lexical"), F.arrays_overlap("defined_ids", "targets").alias("defines"))
    if vectors is None:
        met = met.withColumn("dense", F.lit(None).cast("double"))
    else:
        met = rerank(met, vectors.select(F.col("id").alias("doc"), F.col("vector").alias("dv")), vectors.select(F.col("id").alias("query"), F.col("vector").alias("qv")))
    return cross_case(met, k=k, dense=vectors is not None)


def replacement_decision(known: Column, identifier: Column, candidates: Column, *, mode: str = "replace", threshold: float = 0.68, margin: float = 0.05) -> Column:
    """One of twelve outcomes from an array of candidates (primary_key, command_code, dense, dense_rank, margin)."""
    wanted = tx.clean(identifier)
    fits = lambda c: (tx.clean(c["primary_key"]) == wanted) | (tx.clean(c["command_code"]) == wanted)
    top, none = F.get(candidates, F.lit(0)), F.coalesce(F.size(candidates), F.lit(0)) < 1
    out = F.when(known & none, "review_known_identifier_no_candidate").when(known & fits(top), "kept_known_identifier_top1")
    out = out.when(known & F.exists(candidates, fits), "review_known_identifier_not_top1").when(known, "review_known_identifier_not_retrieved").when(none, "no_candidate")
    if mode == "annotate":
        return out.otherwise("review_unknown_identifier")
    out = out.when(top["dense"].isNull(), "review_bm25_only_not_auto_replaced").when(~top["dense_rank"].eqNullSafe(F.lit(1)), "review_rrf_top_not_bge_top1")
    out = out.when(top["dense"] < threshold, "review_bge_below_threshold").when(top["margin"].isNull(), "review_bge_margin_unavailable")
    return out.when(top["margin"] < margin, "review_bge_margin_too_small").otherwise("replaced_unknown_identifier")


def membership(rows: DataFrame, value: Column, codes: DataFrame, code: Column) -> DataFrame:
    """Adds ``found``: whether the value is among the codes; null without codes. Codes are made distinct first, so the
    join keeps the rows, and an OR over two code columns is an explode instead of a nested loop."""
    listed = codes.select(F.explode(F.array_distinct(code)).alias("__code")).where("__code IS NOT NULL").distinct()
    any_code = listed.limit(1).agg((F.count(F.lit(1)) > 0).alias("__any"))
    met = rows.withColumn("__value", value).join(listed, F.col("__value") == F.col("__code"), "left").crossJoin(F.broadcast(any_code))
    return met.withColumn("found", F.when(F.col("__any"), F.col("__code").isNotNull())).drop("__value", "__code", "__any")


# --- rows of case tables ------------------------------------------------------------------------------

#: The row fields that a device query is made of.
QUERY_FIELDS = ("说明", "操作内容", "操作对象", "操作目的", "判据描述", "操作类型", "设备类型", "设备单元号", "设备参数")


def long_rows(cases: DataFrame, key: str = "id", rows: str = "rows") -> DataFrame:
    """(key, row_index, row) of every row of every table."""
    return cases.select(F.col(key).alias("id"), F.posexplode(rows).alias("row_index", "row"))


def is_searched(row: Column, every_step: bool = False) -> Column:
    """Execution steps with something in a device field, or all execution steps."""
    filled = F.array(*[F.element_at(row, F.lit(f)) for f in schema.DEVICE_FIELDS])
    return (tx.strip(F.element_at(row, F.lit(schema.LEVEL))) == schema.EXECUTION) & (F.exists(filled, tx.is_meaningful) | F.lit(every_step))


def context_queries(rows: DataFrame, context: int = 3, every_step: bool = False) -> DataFrame:
    """(id, row_index, query) of searched rows: distinct meaningful fields of up to ``context`` rows before that are no
    execution steps, then of the row itself, with full stops between."""
    own = F.filter(F.array(*[tx.strip(F.element_at("row", F.lit(f))) for f in QUERY_FIELDS]), tx.is_meaningful)
    step = tx.strip(F.element_at("row", F.lit(schema.LEVEL))) == schema.EXECUTION
    before = Window.partitionBy("id").orderBy("row_index").rowsBetween(-context, -1)
    listed = rows.withColumns({"own": own, "searched": is_searched(F.col("row"), every_step), "given": F.when(step, F.array().cast("array<string>")).otherwise(own)})
    joined = listed.withColumn("before", F.flatten(F.collect_list("given").over(before)))
    return joined.where("searched").select("id", "row_index", F.array_join(F.array_distinct(F.concat("before", "own")), "。").alias("query"))


def run_applied(cases: DataFrame, devices: DataFrame, search: Callable[[DataFrame], DataFrame], *, mode: str = "replace", threshold: float = 0.68, margin: float = 0.05, every_step: bool = False, key: str = "id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases, audits, report): the whole retrieval run over case tables.

    Searched rows become context queries; ``search`` takes (query, text), the row's name and its query, and gives (query,
    final_rank, primary_key, command_code, device_type, dense, dense_rank, margin); each row gets a decision, replaced rows
    the top candidate's command and type, and every searched row a note with its query, candidates and decision. ``devices`` has the known
    primary keys and command codes. Mode ``annotate`` never replaces. ``cases`` has rows as an array of maps.
    """
    rows = long_rows(cases, key)
    asked = context_queries(rows, every_step=every_step).withColumn("name", F.concat("id", F.lit("#"), F.col("row_index").cast("string")))
    codes = devices.select(tx.clean("primary_key").alias("primary_key"), tx.clean("command_code").alias("command_code"))
    wanted = membership(rows.join(asked.select("id", "row_index", "name", "query"), ["id", "row_index"]).withColumn("identifier", tx.clean(F.element_at("row", F.lit(COMMAND)))), F.col("identifier"), codes, F.array(F.nullif("primary_key", F.lit("")), F.nullif("command_code", F.lit(""))))
    fields = ("primary_key", "command_code", "device_type", "dense", "dense_rank", "margin")
    listed = search(asked.select(F.col("name").alias("query"), F.col("query").alias("text")))
    found = listed.groupBy(F.col("query").alias("name")).agg(F.array_sort(F.collect_list(F.struct("final_rank", *fields))).alias("candidates"))
    met = stash(wanted.join(found, "name", "left").withColumn("known", F.coalesce("found", F.lit(False))), "applied-rows")
    audits = met.select(
        "id", "row_index", "query", "identifier", "known",
        replacement_decision(F.col("known"), F.col("identifier"), F.col("candidates"), mode=mode, threshold=threshold, margin=margin).alias("decision"),
        F.element_at("row", F.lit(COMMAND)).alias("old_code"), F.element_at("row", F.lit(DEVICE_TYPE)).alias("old_type"), F.coalesce("candidates", F.array().cast(met.schema["candidates"].dataType)).alias("candidates"),
    )
    replaced = F.col("decision") == "replaced_unknown_identifier"
    top = F.get("candidates", F.lit(0))
    audits = audits.withColumns({"new_code": F.when(replaced, top["command_code"]).otherwise(F.col("old_code")), "new_type": F.when(replaced, top["device_type"]).otherwise(F.col("old_type"))})
    report = audits.groupBy("decision").agg(F.count(F.lit(1)).alias("n"))
    return apply_decisions(cases, audits, key), audits, report


#: The fields that a replacement writes, and the one that notes a row's decision.
COMMAND, DEVICE_TYPE, NOTE = "设备指令号", "设备类型", "_device_retrieval"


def apply_decisions(cases: DataFrame, audits: DataFrame, key: str = "id") -> DataFrame:
    """Writes the top candidate's command and type into replaced rows and a note, the audit as JSON, into each audited
    row; units and parameters stay as they were.

    ``audits`` has id, row_index, decision and candidates; a case's audits are few and are gathered by its id.
    """
    top, replaced = F.get("candidates", F.lit(0)), F.col("decision") == "replaced_unknown_identifier"
    note = F.to_json(F.struct(*[c for c in ("query", "old_type", "old_code", "decision", "candidates") if c in audits.columns], replaced.alias("replaced")))
    edit = F.struct(F.col("row_index").alias("i"), F.when(replaced, top["command_code"]).alias("code"), F.when(replaced, top["device_type"]).alias("kind"), note.alias("note"))
    gathered = audits.groupBy(F.col("id").alias("__id")).agg(F.collect_list(edit).alias("__edits"))
    met = cases.join(gathered, F.col(key) == F.col("__id"), "left")

    def edited(row: Column, i: Column) -> Column:
        own = F.get(F.filter(F.coalesce("__edits", F.array().cast("array<struct<i:int,code:string,kind:string,note:string>>")), lambda e: e["i"] == i), F.lit(0))
        noted = lambda drop: F.map_filter(row, lambda k, _: ~k.isin(*drop))
        changed = F.map_concat(noted((COMMAND, DEVICE_TYPE, NOTE)), F.create_map(F.lit(COMMAND), own["code"], F.lit(DEVICE_TYPE), own["kind"], F.lit(NOTE), own["note"]))
        return F.when(own.isNull(), row).when(own["code"].isNotNull(), changed).otherwise(F.map_concat(noted((NOTE,)), F.create_map(F.lit(NOTE), own["note"])))

    return met.withColumn("rows", F.transform("rows", edited)).drop("__id", "__edits")


#: What stands for a search without result.
NO_RESULT = "[RETRIEVAL_RESULTS]\n未检索到可用的其他测试用例。"


def retrieval_context(found: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(query, context): the text that presents each query's results, in rank order; with ``asked`` (query) also of the
    queries that found nothing."""
    block = F.concat(F.lit("--- 参考用例 "), F.col("rank").cast("string"), F.lit(": "), F.col("doc").cast("string"), F.lit(" (score="), F.col("score").cast("string"), F.lit(") ---\nAO:\n"), F.col("ao"), F.lit("\n结构化表格:\n"), F.to_json("table"))
    made = found.groupBy("query").agg(F.concat(F.lit("[RETRIEVAL_RESULTS]\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", block.alias("b")))), lambda x: x["b"]), "\n")).alias("context"))
    return made if asked is None else asked.select("query").distinct().join(made, "query", "left").withColumn("context", F.coalesce("context", F.lit(NO_RESULT)))
