"""What the second round of findings named, on small inputs that failed before."""

import duckdb
import pytest
from pyspark.sql import functions as F

from caselattice.operators import prep, retrieval
from caselattice.plans import queries


@pytest.fixture
def against_sql(spark, tmp_path):
    """Whether a query gives its SQL's rows on tables of the given DuckDB expressions."""

    def run(name, **tables):
        con = duckdb.connect()
        for t, made in tables.items():
            con.execute(f"COPY ({made}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
        found = queries.QUERIES[name](spark, str(tmp_path))
        wanted = con.execute(queries.ORACLES[name])
        columns = [c[0] for c in wanted.description]
        rows = wanted.fetchall()
        assert rows and sorted(map(repr, rows)) == sorted(repr(tuple(r[c] for c in columns)) for r in found.collect())

    return run


def test_references_without_semicolon(against_sql):
    against_sql("html_clean", pages="""SELECT * FROM (VALUES (1, 'a &amp; b &am<p>c</p>&amp<p class="x">d &copy'), (2, '&amp;quot; &quot; &middot;&nbsp;&copy; &lt;b&gt; &#65;'), (3, '')) t(page_id, html)""")


def test_numbers_of_five_digits(spark, against_sql):
    against_sql("case_texts", conversations="SELECT * FROM (VALUES (10001, 0, 'user', 'a'), (10003, 0, 'user', 'b'), (9998, 1, 'user', 'c'), (10004, 0, 'system', 'd'), (20, 0, 'user', 'e'), (123457, 0, 'user', 'f')) t(conv_id, turn, role, text)")
    # the operator itself cuts no number
    assert spark.range(123457, 123458).select(prep.case_id(F.lit(""), F.lit(""), F.col("id"))).first()[0] == "case_123457"


def test_cross_case_search_makes_no_pairs(spark):
    """Blocks give what a row for every pair gives: ties, few and many that define a target, unknown ones, no vectors."""
    words = ["alpha", "beta", "gamma", "delta", "common"]
    made = []
    for i in range(160):
        text = " ".join(words[j % 5] for j in range(i % 7)) + " common" * (i % 3 > 0)
        ids = None if i % 53 == 7 else [] if i % 3 else ["A"] if i % 4 else ["A", "B"] if i % 12 else ["B", None]
        made.append((i, text, ids, f"ao {i}"))
    cases = spark.createDataFrame(made, "id long, search_text string, defined_ids array<string>, ao_text string").repartition(5)
    asked = spark.createDataFrame([(i, made[i][1] + " beta", (["A"], ["B"], ["Z"], [], None, ["C", None])[i // 10 % 6]) for i in range(0, 160, 10)] + [(999, "delta alpha", ["B"])], "id long, query string, targets array<string>")
    vectors = spark.createDataFrame([(i, [float(i % 9), 1.0, float(i % 4)]) for i in range(0, 160) if i % 5 != 1], "id long, vector array<double>")
    for held in (vectors, None):
        columns = ["query", "rank", "doc", "lexical", "dense", "defines", "lexical_rank"] + ["dense_rank"] * (held is not None)
        found = retrieval.cross_case_search(cases, asked, vectors=held)
        plain = retrieval._every_pair_ranked(cases, asked, retrieval.tx.search_tokens, held, 5)
        assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
        got, wanted = (sorted(map(tuple, x.select(*columns).collect()), key=repr) for x in (found, plain))
        assert len(got) == 17 * 5 and got == wanted


def test_nearest_in_blocks(spark, against_sql):
    """Copies tie by key, near ties go by millionths, and no pair becomes a row."""
    made = "SELECT i::BIGINT AS vec_id, list_transform(generate_series(1, 64), lambda k: (((i % 37) * k * 7919 % 101) / 101 - 0.5 + (i % 3) * 3e-8)::FLOAT) AS embedding, 0 AS label FROM range(900) r(i)"
    for name in ("dense_topk", "maxsim_topk"):
        against_sql(name, embeddings=made)
    vectors = spark.createDataFrame([(i, [float(i), 1.0] if i else None) for i in range(5)], "key long, vector array<double>")
    for few, n in ((vectors.where("key > 0"), 4), (vectors, 5), (vectors.where("key > 9"), 0)):
        found = retrieval.nearest(few, few.where("key = 2"), 2)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("MapInArrow" in plan) == (n != 5) and [(r.query, r.doc, r.score_e6) for r in found.orderBy("rank").collect()] == [(2, 4, 9_000_000), (2, 3, 7_000_000)][: n and 2]
