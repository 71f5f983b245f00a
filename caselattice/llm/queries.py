"""The registered queries of the operators: thin, over whole tables, with their fixed parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, decontaminate, html_extract, line_dedup, lm_score, ngram_join, quality, secret_scan, toxicity, warc

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=("doc_id",), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


_RATIO_SQL = {m: f"{c}::DOUBLE / greatest({n}, 1)" for m, (c, n, _) in quality.RATIOS.items()} | {quality.MEAN: "word_chars::DOUBLE / greatest(n_words, 1)"}
_RULES_SQL = [f"CASE WHEN f.{m} - 3 * sqrt({c}::DOUBLE * {u}) / greatest({n}, 1) > hi_{m} THEN 'high_{m}' END" for m, (c, n, u) in quality.RATIOS.items()]
_RULES_SQL += [f"CASE WHEN f.{quality.MEAN} - e > hi_{quality.MEAN} THEN 'high_{quality.MEAN}' END", f"CASE WHEN f.{quality.MEAN} + e < lo_{quality.MEAN} THEN 'low_{quality.MEAN}' END"]


def _sketch_sql(name: str, keys: str) -> str:
    by = f"PARTITION BY {keys + ', ' if keys else ''}measure"
    return f"""{name}0 AS (SELECT {keys + ', ' if keys else ''}measure, bucket, sum(n) AS n FROM cells GROUP BY ALL), {name}1 AS (SELECT *, sum(n) OVER ({by} ORDER BY bucket) AS below, sum(n) OVER ({by}) AS whole,
  CASE WHEN bucket = -1048576 THEN 0.0::DOUBLE ELSE pow(1.01::DOUBLE, bucket) END AS v FROM {name}0),
{name} AS (SELECT {keys + ', ' if keys else ''}measure, max(whole) AS n, min(CASE WHEN 100 * below >= 10 * whole THEN v END) AS q0, min(CASE WHEN 100 * below >= 50 * whole THEN v END) AS q1, min(CASE WHEN 100 * below >= 75 * whole THEN v END) AS q2 FROM {name}1 GROUP BY ALL)"""


_DRAWN_SQL = ", ".join(f"(g.n * g.q{k} + 100.0::DOUBLE * (l.n * l.q{k} + 100.0::DOUBLE * a.q{k}) / (l.n + 100.0::DOUBLE)) / (g.n + 100.0::DOUBLE) AS q{k}" for k in range(3))
_OP9_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, hash(array_to_string(w[i : i + 7], ' ')) AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM t WHERE len(w) >= 8)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, generate_series(0, 7) s(k) GROUP BY 1),
c AS (SELECT t.doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(text, E' \t\n\x0b\f\r', ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines, len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_own_lines,
  coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(text, '[!?]')) AS n_marks,
  len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) AS n_echoes FROM t LEFT JOIN covered USING (doc_id)),
d AS (SELECT *, (n_lines - n_own_lines)::BIGINT AS n_dup_lines, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
f AS (SELECT *, {', '.join(f'{x} AS {m}' for m, x in _RATIO_SQL.items())}, 3 * (word_chars::DOUBLE / greatest(n_words, 1)) / (2 * sqrt(greatest(n_words, 1))) AS e FROM d),
cells AS (SELECT lang, source, measure, CASE WHEN v > 0 THEN ceil(ln(v) / ln(1.01::DOUBLE))::INT ELSE -1048576 END AS bucket, count(*) AS n
  FROM (SELECT lang, source, unnest([{', '.join(f"'{m}'" for m in quality.MEASURES)}]) AS measure, unnest([{', '.join(quality.MEASURES)}]) AS v FROM f WHERE NOT base_failed) GROUP BY ALL),
{_sketch_sql("g", "lang, source")}, {_sketch_sql("l", "lang")}, {_sketch_sql("a", "")},
q AS (SELECT g.lang, g.source, g.measure, {_DRAWN_SQL} FROM g JOIN l ON l.lang = g.lang AND l.measure = g.measure JOIN a ON a.measure = g.measure),
b AS (SELECT lang, source, {', '.join(f"max(CASE WHEN measure = '{m}' THEN q1 + 6 * greatest(q1 - q0, 1.9::DOUBLE * (q2 - q1)) END) AS hi_{m}" for m in quality.MEASURES)},
  max(CASE WHEN measure = '{quality.MEAN}' THEN q1 - 6 * greatest(q1 - q0, 1.9::DOUBLE * (q2 - q1)) END) AS lo_{quality.MEAN} FROM q GROUP BY ALL),
j AS (SELECT f.*, list_filter([{', '.join(_RULES_SQL)}], lambda x: x IS NOT NULL) AS failed FROM f LEFT JOIN b ON b.lang = f.lang AND b.source = f.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules FROM j
"""


@_query("op9_quality_rules", _OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules")
    )


_OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
     g AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first <> p.page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""


@_query("op1_warc_bundles", _OP1_SQL)
def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    planned = warc.plan_revisits(pages, "page_id", "payload")
    folder = common.new_path(spark, "warc")
    records = planned.select(F.col("page_id").alias("record_id"), "record_type", "refers_to", F.col("url").alias("uri"), "payload", "payload_bytes", "payload_digest")
    index = warc.write_bundles(records, folder)
    read = warc.read_bundles(spark, folder, index, fields=("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "intact"))
    # a response that fails its digest stops the query
    checked = F.when(F.coalesce("intact", F.lit(True)), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest")))
    return read.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", checked.alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"))


_OP7_SQL = r"""
WITH raw AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
     bare AS (SELECT doc_id, source, pos, line, trim(line, E' \t\n\x0b\f\r') AS b, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM raw),
     spread AS (SELECT b FROM bare WHERE words >= 3 GROUP BY b HAVING count(DISTINCT coalesce(source, '')) >= 10),
     hit AS (SELECT bare.*, words >= 3 AND spread.b IS NOT NULL AS h FROM bare LEFT JOIN spread ON bare.b = spread.b),
     doc AS (SELECT doc_id, count(*) FILTER (h) AS n, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT h), '') AS t FROM hit GROUP BY doc_id)
SELECT doc_id, n AS n_spread, n AS n_removed, false AS is_copy, md5(t) AS text_md5 FROM doc
"""


@_query("op7_line_spread", _OP7_SQL)
def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_boilerplate(docs).select("doc_id", "n_spread", "n_removed", "is_copy", F.md5("text").alias("text_md5"))


_OP8_SQL = r"""
WITH t AS (SELECT 0 AS k, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
     w AS (SELECT k, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM t),
     s AS (SELECT DISTINCT k, id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS sh
           FROM (SELECT k, id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
     n AS (SELECT id, count(*) AS n FROM s WHERE k = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n.n) AS n_item, count(*) AS n_shared
FROM s b JOIN s d ON b.sh = d.sh AND b.k = 1 AND d.k = 0 JOIN n ON n.id = b.id
GROUP BY 1, 2 HAVING count(*) >= 0.8 * any_value(n.n)
"""


@_query("op8_benchmark_leaks", _OP8_SQL)
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model, keep=("doc_id",))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@_query("op6_context_tree")
def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm_score.score(docs, held)


_OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     s AS (SELECT DISTINCT id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS sh FROM (SELECT id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
     n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
     p AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.id <> b.id GROUP BY 1, 2),
     l AS (SELECT p.a, p.b, p.k = x.n AND p.k = y.n AS same FROM p JOIN n x ON x.id = p.a JOIN n y ON y.id = p.b WHERE p.k >= 0.8 * (x.n + y.n - p.k)),
     r AS (SELECT doc_id AS id, doc_id AS m FROM documents UNION SELECT l.a, r.m FROM r JOIN l ON l.b = r.id AND r.m < l.a),
     c AS (SELECT id, min(m) AS class_id FROM r GROUP BY id)
SELECT d.doc_id, any_value(c.class_id) AS class_id, least(d.doc_id, coalesce(min(l.b) FILTER (l.same), d.doc_id)) AS rep_id, count(l.b) AS n_links
FROM documents d JOIN c ON c.id = d.doc_id LEFT JOIN l ON l.a = d.doc_id GROUP BY d.doc_id
"""


@_query("op2_ngram_jaccard", _OP2_SQL)
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(_table(spark, sf_dir, "documents"))


@_query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "position", F.sha2("candidate", 256).alias("candidate_sha256"), F.col("length").cast("int").alias("length"), "entropy", "coverage", "score", "is_secret")
