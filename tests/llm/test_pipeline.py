"""The pipeline on planted documents, and its stages against brute force."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from .test_text_operators import brute_classes, brute_lines, edited, sentence, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rnd = random.Random(31)
    folder = str(tmp_path_factory.mktemp("planted"))
    license_line = "released under some wellknown license"
    texts = {}
    for i in range(200):
        texts[i] = "\n".join([sentence(rnd, 25, 3000), license_line if i % 5 == 0 else sentence(rnd, 7, 3000), sentence(rnd, 30, 3000)])
    toxic = set(range(0, 200, 7))
    for i in toxic:
        texts[i] = texts[i] + " idiot moron stupid" + sentence(rnd, 5, 3000)
    item = sentence(rnd, 40, 3000)
    texts[300] = sentence(rnd, 500, 3000) + " " + item + "\n" + sentence(rnd, 300, 3000)
    texts[301], texts[302], texts[303] = texts[11], edited(rnd, texts[12], 1), texts[13].upper()
    texts[304], texts[305] = None, ""
    rows = [(i, t, "en", f"src{i % 13}", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item), (1, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, toxic


def test_run(spark, planted):
    folder, texts, toxic = planted
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    gone = toxic | {300, 301, 302, 303}
    assert set(got) == set(texts) - gone
    assert got[304].n_tokens == got[305].n_tokens == 0


def test_stages_follow_one_another(spark, planted):
    folder, texts, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)
    cleaned = functions["line_dedup"](spark, docs, folder)
    assert cleaned.columns == columns
    rows = {r.doc_id: r for r in cleaned.collect()}
    order = sorted(texts)
    for i, (_, _, text) in zip(order, brute_lines([texts[i] for i in order], [f"src{i % 13}" for i in order], 10, copy_percent=80)):
        assert rows[i].text == text and rows[i].n_chars == len(text or "")
    single = functions["near_duplicates"](spark, docs, folder)
    classes = brute_classes([texts[i] for i in order])
    assert {r.doc_id for r in single.collect()} == {order[k] for k, (c, _, _) in classes.items() if c == k} and single.columns == columns
    item = spark.read.parquet(f"{folder}/benchmark.parquet").where("item_id = 0").first().text
    free = functions["decontamination"](spark, docs, folder)
    assert {r.doc_id for r in free.collect()} == {i for i in order if len(shingles(texts[i]) & shingles(item)) < 0.8 * len(shingles(item))}


def test_shared_passages_go_from_short_documents(spark):
    """A document of 40 % own words is cleaned; one that is nearly all shared lines is left to the near-duplicate stage."""
    rnd = random.Random(41)
    passage = sentence(rnd, 60, 3000)
    own = [sentence(rnd, 40, 3000) for _ in range(12)]
    rows = [(i, f"{passage}\n{t}", "en", f"src{i}", 1) for i, t in enumerate(own)] + [(20, f"{passage}\nfew own words", "en", "src0", 1)]
    got = {r.doc_id: r for r in corpus_pipeline.drop_boilerplate_lines(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert all(got[i].text == t and got[i].n_chars == len(t) for i, t in enumerate(own)) and got[20].text == rows[12][1]


def test_rows_that_share_or_lack_an_identifier(spark):
    """Distinct texts under one identifier, or under none, are documents; copies go, those without identifier first."""
    rnd = random.Random(43)
    a, b, c, d = (sentence(rnd, 80, 3000) for _ in range(4))
    pairs = [(1, a), (1, b), (1, a), (2, b), (None, c), (None, d), (None, a), (7, edited(rnd, d, 1)), (None, c), (8, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], SCHEMA)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c), pairs[7], (8, None), (9, None)], key=str)


def test_leaks_without_identifier_go_and_their_namesakes_stay(spark, planted):
    folder, texts, _ = planted
    clean = [texts[i] for i in (1, 2, 3)]
    pairs = [(None, texts[300]), (None, clean[0]), (5, texts[300]), (5, clean[1]), (5, clean[2]), (6, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], SCHEMA)
    got = sorted(str((r.doc_id, r.text)) for r in corpus_pipeline.drop_benchmark_leaks(spark, docs, folder).collect())
    assert got == sorted(str(x) for k, x in enumerate(pairs) if k not in (0, 2))


def test_repeated_rows_and_empty_tables(spark, planted, tmp_path):
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    twice = corpus_pipeline.drop_near_duplicates(spark, docs.unionByName(docs), folder)
    assert twice.count() == corpus_pipeline.drop_near_duplicates(spark, docs, folder).count()
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
