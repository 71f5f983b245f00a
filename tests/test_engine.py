"""Scalar functions, scores, alignment, decisions, readers and writers against values worked out by hand or by brute force."""

import io
import itertools
import json
import random
import zipfile
from xml.etree import ElementTree

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from caselattice import schema
from caselattice.functions import jsonparse
from caselattice.functions import similarity as sim
from caselattice.functions import text as tx
from caselattice.operators import browse, prep, retrieval, scoring
from caselattice.sources import files, sinks


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_text_columns(spark):
    assert values(spark, tx.strip("x"), [None, "　a \t", " b ", "c"]) == ["", "a", "b", "c"]
    assert values(spark, tx.clean("x"), [" a\0b ", None]) == ["ab", ""]
    assert values(spark, tx.is_meaningful("x"), ["", " [] ", "NULL", "None", "无", "否", "x"]) == [False] * 6 + [True]
    assert values(spark, tx.is_true("x"), ["1", " TRUE", "y", "是", "deleted", "已删除", "0", None]) == [True] * 6 + [False] * 2
    assert values(spark, tx.reference_form("x"), ["a*@Temp_1+ 2", " 12 ", "@温度-3", None]) == ["a * @ID + 2", "12", "@ID - 3", ""]
    assert values(spark, tx.numeric_form("x"), ["39.0", "39.50;41", " x ; 1e3", "1234567.5", "0.00001234567", "-2.5"]) == ["39", "39.5;41", "x;1000", "1.23457e+06", "1.23457e-05", "-2.5"]
    assert values(spark, tx.referenced_ids("x"), ["@b1 @a x@c (@d)", None]) == [["a", "b1", "d"], []]
    assert values(spark, tx.referenced_tasks("x"), ["TASK 12-345-67-89 task01-22-33-44"]) == [["TASK 12-345-67-89", "task01-22-33-44"]]
    assert values(spark, tx.needs_other_cases("x"), ["见前序用例", "b * @x", "TASK 12-345-67-89", "plain"]) == [True, True, False, False]
    assert values(spark, tx.defined_ids("x", F.array(F.lit("q@m1"), F.lit(None).cast("string"))), ["记录电压为@v1，@z"]) == [["M1", "V1"]]
    assert values(spark, tx.search_tokens("x"), ["TASK-1 和温度 @Id3 3.5的"]) == [["task-1", "温", "度", "@id3", "3.5"]]
    assert values(spark, tx.index_tokens("x"), ["a Bc 的温1"]) == [["b", "c", "温", "1"]]
    assert values(spark, tx.without_reasoning("x"), ["<think>a</think>```json\n[1]\n```", "a</think>b<think>c</think>"]) == ["[1]", "b"]
    assert values(spark, tx.plain_html("x"), ["&lt;b&gt;x&lt;/b&gt;<br>y<p>z</p>\n\n<img alt='' src='/a.png'>", "a&#xa0;b​c"]) == ["x\ny\nz\n[IMAGE: /a.png]", "abc"]
    assert values(spark, tx.column_name(F.col("x").cast("int")), ["1", "26", "27", "52", "702", "703", "18278"]) == ["A", "Z", "AA", "AZ", "ZZ", "AAA", "ZZZ"]
    assert values(spark, tx.column_number("x"), ["A", "AA", "ZZ", "AAA"]) == [1, 27, 702, 703]
    names = list(itertools.islice(sinks.column_names(), 703))
    assert [names[n - 1] for n in (1, 26, 27, 702, 703)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_field_forms_agree_with_plain_ones(spark):
    inputs = [None, "", " null", "[]", "３９．０", "39.50;41", "a*@x", "是", "全部成功", "1e400", "Straße"]
    rows = spark.createDataFrame([(i, f, x) for f in ("左值", "判据范围", "是否使用设备", "多判据组合条件", "说明") for i, x in enumerate(inputs) if x != "1e400"], "i int, f string, x string")
    for r in rows.withColumn("got", tx.field_form("x", "f")).collect():
        assert r.got == sim.field_form(r.x, r.f), r


def slow_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc中", max_size=30), st.text("abc中", max_size=30))
def test_similarity_properties(a, b):
    assert sim.common_length(a, b) == slow_common(a, b) == sim.common_length(b, a)
    assert 0 <= sim.gram_f(a, b) <= 1 + 1e-12 and sim.gram_f(a, a) == pytest.approx(1)
    assert sim.field_score(a, a, "说明") == 1 and 0 <= sim.field_score(a, b, "说明") <= 1 + 1e-12
    assert sim.first_field_score(a, b, "说明") == pytest.approx(sim.first_field_score(b, a, "说明"))


def test_field_scores():
    assert sim.field_score("", None, "说明") == 1 and sim.field_score("x", "", "说明") == 0
    assert sim.field_score("39.0", "39", "左值") == 1 and sim.field_score("1;2", "1", "判据范围") == 0
    assert sim.field_score("100", "90", "判据范围") == pytest.approx(2.718281828 ** -0.5, rel=1e-6)
    assert sim.gram_f("ab", "ac") == pytest.approx(0.25)
    assert sim.first_field_score("abc", "abd", "说明") == pytest.approx(0.3 / 3 + 0.3 / 2 + 0.4 * 2 / 3)


def best_by_trying(scores):
    m, n = len(scores), len(scores[0])
    best = (0.0, 0)
    for k in range(1, min(m, n) + 1):
        for left in itertools.combinations(range(m), k):
            for right in itertools.combinations(range(n), k):
                total = sum(scores[i][j] for i, j in zip(left, right))
                if total > best[0] + 1e-9 or abs(total - best[0]) <= 1e-9 and k > best[1]:
                    best = (total, k)
    return best


def test_alignment_is_best_and_in_order():
    import numpy as np

    rnd = random.Random(8)
    for _ in range(60):
        m, n = rnd.randint(1, 5), rnd.randint(1, 5)
        scores = [[rnd.choice([0, 0.25, 0.5, 1.0]) for _ in range(n)] for _ in range(m)]
        pairs = scoring.best_path(np.array(scores))
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        total, k = best_by_trying(scores)
        assert sum(scores[i][j] for i, j in pairs) == pytest.approx(total) and len(pairs) == k


STEP = {"步骤层级": "步骤", "说明": "打开电源", "操作内容": "按下按钮"}
RULE = {"步骤层级": "判据", "判据描述": "电压正常", "判据范围": "39;41"}


def test_table_scores(spark):
    same = scoring.score_table([STEP, RULE], [STEP, RULE])
    assert same["overall_score"] == 1 and same["row_count_match"]
    nothing = scoring.score_table([], [])
    assert nothing["overall_score"] == 1 and scoring.first_score_table([], [])["overall_score"] == pytest.approx(0.4)
    half = scoring.score_table([STEP, RULE], [STEP])
    assert half["row_coverage"] == 0.5 and half["row_precision"] == 1 and half["structure_score"] == pytest.approx(0.35 * 0.5 + 0.5 * 0.5 + 0.15 * 2 / 3)
    assert half["overall_score"] == pytest.approx(0.4 * half["structure_score"] + 0.6 * 2 / 3)
    semantic = scoring.score_table([STEP], [dict(STEP, 说明="别的")], scorer=lambda a, b, f: 7.0)
    assert semantic["content_score"] == 1
    first = scoring.first_score_table([STEP, RULE], [STEP])
    assert first["content_score"] == pytest.approx(1 - 0.3 * 0.5)
    rows = spark.createDataFrame([("a", [STEP, RULE], [STEP]), ("b", None, None)], "id string, gt_rows array<map<string,string>>, pred_rows array<map<string,string>>")
    got = {r.id: r for r in scoring.score_tables(rows).collect()}
    assert got["a"].overall_score == round(half["overall_score"], 4) and got["b"].overall_score == 1 and got["a"].field_scores["说明"] == 1
    means = scoring.mean_scores(scoring.score_tables(rows)).first()
    assert means.num_samples == 2 and means.overall_score == pytest.approx(round((got["a"].overall_score + 1) / 2, 4), abs=1e-4)
    assert scoring.mean_scores(scoring.score_tables(rows.limit(0))).first().overall_score == 0


def test_json_readers(spark):
    row = '{"步骤层级":"步骤"}'
    found = lambda r: (r.rows, r.success, r.strict, r.mode)
    assert found(jsonparse.read_evaluation(f"[{row}]")) == ([{"步骤层级": "步骤"}], True, True, "strict_json_array")
    assert found(jsonparse.read_evaluation('{"rows":[]}'))[1:] == (True, False, "object_wrapper:rows")
    stray = jsonparse.read_evaluation(f"see [1] then [{row}]")
    assert found(stray) == ([], False, False, "recovered_array") and stray.errors == ["[0]:not_an_object"]
    assert jsonparse.read_evaluation(f"<think>[1]</think>```json\n[{row}]\n```").mode == "recovered_array"
    assert found(jsonparse.read_evaluation("none")) == ([], False, False, "failed")
    assert jsonparse.read_judge(f'x {{"table":[{row},3]}}').rows == [{"步骤层级": "步骤"}]
    assert jsonparse.read_judge(f'{{"步骤列表":null,"rows":[{row}]}}').rows == [{"步骤层级": "步骤"}]
    assert jsonparse.read_server(f"[1] [{row}]").rows == [{"步骤层级": "步骤"}] and jsonparse.read_server("").rows == [] and not jsonparse.read_server("x").success
    assert jsonparse.first_object('[1] {"a":2}') == {"a": 2}
    reply = '{"choices":[{"message":{"content":"hi"}}]}'
    listed = '{"choices":[{"message":{"content":[{"type":"text","text":"a"},{"type":"text","text":"b"}]}}]}'
    assert values(spark, jsonparse.response_text("x"), [reply, listed, '{"text":"t"}', "raw", None]) == ["hi", "ab", "t", "raw", ""]
    raw = spark.createDataFrame([(1, f"[{row}]"), (2, None)], "id int, raw string")
    assert [(r.parse_success, len(r.rows), r.schema_valid) for r in jsonparse.recover_rows(raw, "raw").orderBy("id").collect()] == [(True, 1, False), (False, 0, False)]
    errors = {r.id: r.errors for r in jsonparse.recover_rows(raw, "raw").collect()}
    assert errors[2] == ["no_json_list"] and "[0].说明:missing" in errors[1]
    full = json.dumps([dict.fromkeys(schema.LEVEL_FIELDS["用例"], "x") | {"步骤层级": "用例"}], ensure_ascii=False)
    assert jsonparse.recover_rows(spark.createDataFrame([(1, full)], "id int, raw string"), "raw").first().schema_valid


def test_row_and_chat_checks(spark):
    good = json.dumps([dict.fromkeys(schema.LEVEL_FIELDS["用例"], "x") | {"步骤层级": "用例"}], ensure_ascii=False)
    bad = '[{"步骤层级":"执行步骤","设备类型":3},{"步骤层级":"q"},{"步骤层级":"判据","操作类型":"坏","是否使用设备":""}]'
    got = values(spark, prep.row_errors(jsonparse.typed_rows("x")), [good, "[]", "{}", "x", bad])
    assert got[:4] == [[], ["empty"], ["not_a_list"], ["not_a_list"]]
    assert "[0].设备类型:not_text" in got[4] and "[0].设备参数:missing" in got[4] and "[1].步骤层级:illegal" in got[4] and "[2].操作类型:not_allowed" in got[4]
    assert not any(e.startswith("[2].是否使用设备:not_allowed") for e in got[4])
    chat = lambda *roles: [Row(role=r, content="c") for r in roles]
    rows = spark.createDataFrame([(0, chat("system", "user", "assistant")), (1, chat("user", "assistant", "assistant")), (2, chat("assistant")), (3, chat("user", "system", "assistant"))], "i int, m array<struct<role:string,content:string>>")
    errors = [r[0] for r in rows.orderBy("i").select(prep.chat_errors_strict(F.col("m"))).collect()]
    assert errors == [[], ["early_assistant"], ["too_few_messages", "no_user"], ["system_not_first"]]
    assert [r[0] for r in rows.orderBy("i").select(prep.is_tuning_chat(F.col("m"))).collect()] == [True, False, False, False]


def test_split_sizes(spark):
    rows = spark.createDataFrame([(f"s{n}", n * 1000 + i) for n in range(1, 51) for i in range(n)], "source string, id long")
    got = {}
    for r in prep.stratified_split(rows, "source", "id").groupBy("source", "part").count().collect():
        got[r.source, r.part] = r["count"]
    for n in range(1, 51):
        train, evaluation = max(1, int(n * 0.8)), max(1, int(n * 0.1))
        if n - train - evaluation < 1:
            train = max(1, n - 2)
            evaluation = max(1, n - train - 1)
        evaluation = min(evaluation, n - train)
        assert tuple(got.get((f"s{n}", p), 0) for p in ("train", "eval", "test")) == (train, evaluation, n - train - evaluation)


def test_decisions(spark):
    c = lambda key, dense=None, rank=None, margin=None: Row(primary_key=key, command_code=key + "c", dense=dense, dense_rank=rank, margin=margin)
    cases = [
        (True, [], "review_known_identifier_no_candidate"), (True, [c("k"), c("o")], "kept_known_identifier_top1"), (True, [c("o"), c("k")], "review_known_identifier_not_top1"), (True, [c("o")], "review_known_identifier_not_retrieved"),
        (False, [], "no_candidate"), (False, [c("o")], "review_bm25_only_not_auto_replaced"), (False, [c("o", 0.82, 2)], "review_rrf_top_not_bge_top1"), (False, [c("o", 0.67, 1, 0.2)], "review_bge_below_threshold"),
        (False, [c("o", 0.82, 1)], "review_bge_margin_unavailable"), (False, [c("o", 0.82, 1, 0.049)], "review_bge_margin_too_small"), (False, [c("o", 0.82, 1, 0.12)], "replaced_unknown_identifier"),
    ]
    rows = spark.createDataFrame([(i, k, v) for i, (k, v, _) in enumerate(cases)], "i int, known boolean, cs array<struct<primary_key:string,command_code:string,dense:double,dense_rank:int,margin:double>>").orderBy("i")
    assert [r[0] for r in rows.select(retrieval.replacement_decision(F.col("known"), F.lit(" k "), F.col("cs"))).collect()] == [e for *_, e in cases]
    annotated = [r[0] for r in rows.select(retrieval.replacement_decision(F.col("known"), F.lit("k"), F.col("cs"), mode="annotate")).collect()]
    assert annotated[5:] == ["review_unknown_identifier"] * 6


def test_context_and_apply(spark):
    step = lambda level, **f: {"步骤层级": level} | f
    rows = [step("用例", 说明="自检"), step("步骤", 操作内容="上电"), step("判据", 判据描述="正常"), step("执行步骤", 设备类型="电源", 设备指令号="x1"), step("步骤", 操作内容="断电"), step("判据", 判据描述="正常"), step("执行步骤", 设备指令号="x2")]
    cases = spark.createDataFrame([("c", rows)], "id string, rows array<map<string,string>>")
    got = {r.row_index: r.query for r in retrieval.context_queries(retrieval.long_rows(cases)).collect()}
    assert got == {3: "自检。上电。正常。电源", 6: "断电。正常"}
    audits = spark.createDataFrame([("c", 6, "replaced_unknown_identifier", [Row(command_code="N", device_type="T")]), ("c", 3, "no_candidate", [])], "id string, row_index int, decision string, candidates array<struct<command_code:string,device_type:string>>")
    new = retrieval.apply_decisions(cases, audits).first().rows
    assert new[6]["设备指令号"] == "N" and new[6]["设备类型"] == "T" and [r for i, r in enumerate(new) if i not in (3, 6)] == [r for i, r in enumerate(rows) if i not in (3, 6)]
    assert {k: v for k, v in new[3].items() if k != retrieval.NOTE} == rows[3] and json.loads(new[3][retrieval.NOTE])["decision"] == "no_candidate"
    assert json.loads(new[6][retrieval.NOTE])["replaced"] and not json.loads(new[3][retrieval.NOTE])["replaced"]


def test_the_whole_applied_run(spark):
    step = lambda level, **f: {"步骤层级": level} | f
    rows = [step("步骤", 操作内容="上电"), step("执行步骤", 设备类型="旧", 设备指令号="bad", 设备单元号="u"), step("执行步骤", 设备指令号="C2"), step("执行步骤")]
    cases = spark.createDataFrame([("c", rows)], "id string, rows array<map<string,string>>")
    devices = spark.createDataFrame([("P1", "C1"), ("P2", "C2")], "primary_key string, command_code string")

    def search(asked):
        hit = asked.where("text like '%上电%'")
        first = hit.selectExpr("query", "1 AS final_rank", "'P1' AS primary_key", "'C1' AS command_code", "'电源' AS device_type", "0.9D AS dense", "1 AS dense_rank", "0.2D AS margin")
        return first.unionByName(hit.selectExpr("query", "2 AS final_rank", "'P2' AS primary_key", "'C2' AS command_code", "'阀' AS device_type", "0.7D AS dense", "2 AS dense_rank", "CAST(NULL AS DOUBLE) AS margin"))

    done, audits, report = retrieval.run_applied(cases, devices, search)
    got = {r.row_index: r for r in audits.collect()}
    assert {i: r.decision for i, r in got.items()} == {1: "replaced_unknown_identifier", 2: "review_known_identifier_not_top1"}
    assert (got[1].old_code, got[1].new_code, got[1].new_type, got[1].known) == ("bad", "C1", "电源", False) and got[2].new_code == "C2" and len(got[2].candidates) == 2
    new = done.first().rows
    assert (new[1]["设备指令号"], new[1]["设备类型"], new[1]["设备单元号"]) == ("C1", "电源", "u") and new[2]["设备指令号"] == "C2" and new[0] == rows[0] and new[3] == rows[3]
    note = json.loads(new[1][retrieval.NOTE])
    assert note["replaced"] and note["query"] == "上电。旧。u" and note["candidates"][0]["command_code"] == "C1"
    assert {r.decision: r.n for r in report.collect()} == {"replaced_unknown_identifier": 1, "review_known_identifier_not_top1": 1}
    kept, looked, _ = retrieval.run_applied(cases, devices, search, mode="annotate")
    assert {r.row_index: r.decision for r in looked.collect()}[1] == "review_unknown_identifier" and kept.first().rows[1]["设备指令号"] == "bad"
    nothing, none, _ = retrieval.run_applied(cases, devices, lambda asked: search(asked).limit(0))
    assert {r.decision for r in none.collect()} == {"no_candidate", "review_known_identifier_no_candidate"} and nothing.first().rows[1]["设备指令号"] == "bad"


def test_search_over_cases(spark):
    cases = spark.createDataFrame([("1", "记录 alpha beta", ["V1"], "x" * 7000), ("2", "alpha alpha", [], "two"), ("3", "gamma", [], "three"), ("4", "delta", ["V1"], "four")], "id string, search_text string, defined_ids array<string>, ao_text string")
    asked = spark.createDataFrame([("2", "alpha", ["V1"]), ("3", "nothing like it", [])], "id string, query string, targets array<string>")
    got = sorted((r.query, r.rank, r.doc, r.lexical > 0, len(r.ao)) for r in retrieval.cross_case_search(cases, asked).collect())
    assert got == [("2", 1, "1", True, 6000), ("2", 2, "4", False, 4), ("2", 3, "3", False, 5), ("3", 1, "1", False, 6000), ("3", 2, "2", False, 3), ("3", 3, "4", False, 4)]
    vectors = spark.createDataFrame([("1", [1.0, 0.0]), ("2", [0.0, 1.0]), ("3", [0.6, 0.8]), ("4", [0.0, 1.0])], "id string, vector array<double>")
    both = {(r.query, r.rank): r.doc for r in retrieval.cross_case_search(cases, asked, vectors=vectors).collect()}
    assert [both["2", k] for k in (1, 2, 3)] == ["1", "4", "3"] and both["3", 1] == "2"  # 1 and 4 tie
    texts = {r.query: r.context for r in retrieval.retrieval_context(spark.createDataFrame([("q", 1, "d", 0.5, "ao", [{"a": "b"}])], "query string, rank int, doc string, score double, ao string, table array<map<string,string>>"), spark.createDataFrame([("q",), ("z",)], "query string")).collect()}
    assert texts["z"] == retrieval.NO_RESULT and "参考用例 1: d (score=0.5)" in texts["q"]


def test_conversion(spark):
    cmd = "device_command_id string, dev_cat_id string, command_desc string, command_code string, param_type string, param_desc string, deleted string, row_number int"
    commands = spark.createDataFrame([("C1", "K1", "d", "", "p", "q", None, 2), ("C2", "K2", "d", "x", "", "", "0", 3), ("C3", "K1", "", "", "", "", "1", 4), ("C4", "K9", "", "", "", "", "", 5), ("C4", "K1", "", "", "", "", "", 6), (" ", "K1", "", "", "", "", "", 7)], cmd)
    cats = spark.createDataFrame([("K1", "N", "D", "c", "a", "", 2), ("K2", "", "", "", "al", "", 3), ("K2", "later", "", "", "", "", 4), ("K3", "", "", "", "", "是", 5)], "dev_cat_id string, dev_cat_name string, dev_cat_desc string, device_cat_code string, device_cat_alias string, deleted string, row_number int")
    records, rejects, report = prep.convert_commands(commands, cats)
    assert [(r["设备指令主键"], r["设备指令号"], r["设备类型"], r["_text"]) for r in records.collect()] == [("C1", "C1", "N", "N | a | D | c | K1 | d | C1 | p | q"), ("C2", "x", "al", "al | K2 | d | x | C2")]
    assert sorted((r.row, r.reason, r.device_command_id, r.dev_cat_id) for r in rejects.collect()) == [(5, "dev_cat_id_not_found_or_deleted", "C4", "K9"), (6, "duplicate_device_command_id", "C4", None), (7, "missing_device_command_id", None, None)]
    r = report.first()
    assert (r.command_rows, r.deleted_commands, r.deleted_categories, r.records, r.rejected, r.orphans, r.code_fallbacks, r.n_duplicate_ids) == (6, 1, 1, 2, 3, 1, 1, 1)


def test_readers(spark, tmp_path):
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"id":"1","v":1}\n\nbad\n[1]\n{"id":"2","v":2}\n{"id":"1","v":3}\n', encoding="utf-8")
    from pyspark.sql import types as T

    kind = T._parse_datatype_string("id string, v int")
    assert sorted((r.id, r.v) for r in files.lenient_json_lines(spark, str(lines), kind, "id").collect()) == [("1", 3), ("2", 2)]
    with pytest.raises(Exception, match="a.jsonl:3: not JSON"):
        files.strict_json_lines(spark, str(lines), kind).collect()
    lines.write_text('{"id":"1","v":1}\n{"id":"2","v":2}\n', encoding="utf-8")
    assert files.strict_json_lines(spark, str(lines), kind).count() == 2
    table = tmp_path / "a.csv"
    table.write_bytes('名称;id\n"电源\n一";1\n;\n阀;2\n'.encode("gb18030"))
    rows, encoding, delimiter = files.sniffed_csv(spark, str(table), ("id",))
    assert (encoding, delimiter) == ("gb18030", ";") and [(r.row_number, r["名称"], r.id) for r in rows.orderBy("row_number").collect()] == [(2, "电源\n一", "1"), (4, "阀", "2")]
    with pytest.raises(ValueError):
        files.sniffed_csv(spark, str(table), ("none",))
    asked = tmp_path / "q.csv"
    asked.write_text("﻿id,query\na,one\n,two\nc, \n", encoding="utf-8")
    assert [(r.ao_id, r.instruction) for r in files.query_csv(spark, str(asked)).collect()] == [("a", "one"), ("2", "two")]
    xml = tmp_path / "a.xml"
    xml.write_text('<Root xmlns="u"><F><Op n="1"><T>a&lt;br&gt;b</T></Op><Op><T>c</T></Op><W/></F></Root>', encoding="utf-8")
    got = files.xml_records(spark, str(xml), triggers=("*/Op", "*/W"), attributes={"*/Op": {"n": "name"}}, texts={"*/T": "text"}).orderBy("record_number").collect()
    assert [r.record for r in got] == [{"name": "1", "text": "a\nb"}, {"text": "c"}]
    shadowed = files.xml_records(spark, str(xml), triggers="*/Op", attributes={"*/Op": {"n": "name"}, "Root/F/Op": {}}, texts={})
    assert shadowed.count() == 0
    for name in ("p_id131.PNG", "p.txt", "q.jpg"):
        (tmp_path / name).write_bytes(b"x")
    found = files.images(spark, str(tmp_path)).collect()
    assert [(r.image_id, r.source_ao_id) for r in found] == [("p_id131", "131"), ("q", None)] and all(r.embedding_name.endswith(".pt") for r in found)
    assert files.stale_embeddings(files.images(spark, str(tmp_path)), files.images(spark, str(tmp_path))).count() == 0
    mark = lambda df: files.fingerprint(df).first()
    assert mark(rows).n_rows == 2 and mark(rows) == mark(rows.orderBy("id")) and mark(rows.union(rows)).hash != mark(rows.limit(0)).hash
    facts = prep.conversion_report(spark.createDataFrame([(6,)], "command_rows long"), {"commands": files.source_facts(spark, str(table))})
    assert facts["sources"]["commands"]["encoding"] == "gb18030" and facts["statistics"] == {"command_rows": 6} and facts["created_at"][4] == "-"


def test_line_numbers_over_splits(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 37)):
        (tmp_path / f"{name}.jsonl").write_text("\ufeff" + "".join(f"{name}{i}" + "x" * (i % 50) + ("\r\n" if i % 3 else "\n") for i in range(n)) + "\n", encoding="utf-8")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = files.json_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 1
        rows = {(r.file[-7], r.line_number): r.value for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    expected = {(name, i + 1): f"{name}{i}" + "x" * (i % 50) for name, n in (("a", 5000), ("b", 37)) for i in range(n)}
    assert rows == expected | {("a", 5001): "", ("b", 38): ""}


def workbook(rows):
    strings = [v for r in rows for v in r if v is not None]
    cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{"ABCDEFG"[j - 1]}{i}" t="s"><v>{strings.index(v)}</v></c>' for j, v in enumerate(r, 1) if v is not None) + "</row>" for i, r in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="x"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    rows = [["h1", "h2", "h3"], [None, "lost", "m0"], ["A", None, "m1"], [None, None, "m2"], [None, None, None], ["B", None, "m3"]]
    (tmp_path / "a.xlsx").write_bytes(workbook(rows))
    read = files.workbook_rows(spark, str(tmp_path / "a.xlsx"))
    nested = files.nested_records(read, is_major=lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit("")) != "", major={0: "name"}, minor={2: "step"})
    assert [(r.name, [s.step for s in r.steps]) for r in nested.orderBy("island").collect()] == [("A", ["m1", "m2"]), ("B", ["m3"])]
    old, new = {"步骤层级": "执行步骤", "设备指令号": "=1+1", "_x": "h", "extra": "e"}, {"步骤层级": "执行步骤", "设备指令号": "N"}
    book = sinks.build_workbook(ao_text="t\x01" + "y" * 40_000, original_rows=[old], final_rows=[new], modifications=[{"row_index": 0, "original": old, "final": new, "candidate": {"bm25_rank": 2}, "source_decision": "d"}], facts={"model": "m"})
    with zipfile.ZipFile(io.BytesIO(book)) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    for text in parts.values():
        ElementTree.fromstring(text)
    one, two, three = (parts[f"xl/worksheets/sheet{i}.xml"] for i in (1, 2, 3))
    assert ">N<" in one and "=1+1" not in one and "=1+1" in two and ">N<" not in two and "=1+1" in three and ">N<" in three
    assert "<f>" not in one + two + three and "extra" in two and "_x" not in two and sinks.CUT_MARK in three and "�" in three
    assert "未应用" in zipfile.ZipFile(io.BytesIO(sinks.build_workbook(ao_text="", original_rows=[], final_rows=[], modifications=[], facts={}))).read("xl/worksheets/sheet3.xml").decode()


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "中")], "i int, s string")
    sinks.write_json_lines(df, str(tmp_path / "out"), "i")
    part = next((tmp_path / "out").glob("part*"))
    assert part.read_text(encoding="utf-8") == '{"i":1,"s":"中"}\n{"i":2,"s":null}\n'
    sinks.write_result_csv(df.orderBy("i"), str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").read_bytes().startswith(b"\xef\xbb\xbfi,s\r\n1,")
    sinks.write_manifest(spark, str(tmp_path / "m.json"), {"status": "completed"})
    with pytest.raises(FileExistsError):
        sinks.write_manifest(spark, str(tmp_path / "m.json"), {})
    read = lambda name: json.loads((tmp_path / name).read_text(encoding="utf-8"))
    with sinks.run_manifest(spark, str(tmp_path / "run.json"), model="m") as entries:
        assert read("run.json")["status"] == "initializing"
        entries["samples"] = 3
    assert read("run.json") | {"started_at": 0, "ended_at": 0} == {"status": "completed", "model": "m", "samples": 3, "started_at": 0, "ended_at": 0}
    with pytest.raises(KeyError), sinks.run_manifest(spark, str(tmp_path / "bad.json")):
        raise KeyError("x")
    assert read("bad.json")["status"] == "failed" and "KeyError" in read("bad.json")["error"]
    with pytest.raises(ValueError):
        sinks.distinct_paths("/a", "/b", "/a/")


def test_browsing(spark):
    rows = lambda *r: spark.createDataFrame([(i, "s", n, float(v)) for n, (i, v) in enumerate(r)], "id string, source string, ordinal int, score double")
    pairs = browse.paired_samples(rows(("b", 1), ("a", 2), ("b", 5)), rows(("a", 3), ("b", 1), ("x", 9)))
    assert [(r.id, r.base_score, r.other_score, r.delta) for r in browse.page(pairs, "nonsense", 0, 10).collect()] == [("a", 2.0, 3.0, 1.0), ("b", 5.0, 1.0, -4.0)]
    assert [r.id for r in browse.page(pairs, "id", 1, 1).collect()] == ["b"] and browse.search(pairs, "A").count() == 1
    zipped = scoring.positional_zip(rows(("a", 1)), rows(("b", 1)), "ordinal", "id")
    with pytest.raises(Exception, match="differ in their key"):
        zipped.collect()
    codes = spark.createDataFrame([("k",)], "c string")
    found = retrieval.membership(rows(("k", 1), ("z", 1)), F.col("id"), codes, F.array("c"))
    assert {r.id: r.found for r in found.collect()} == {"k": True, "z": False}
    assert {r.found for r in retrieval.membership(rows(("k", 1)), F.col("id"), codes.limit(0), F.array("c")).collect()} == {None}
    assert values(spark, browse.prompt_mode("x"), ["lora+FULL", "compressed", "x"]) == ["full", "compressed", "compressed"]
    tables = spark.createDataFrame([("a", [{"步骤层级": "x", "zz": "1"}, {"_h": "1", "yy": "2"}])], "id string, rows array<map<string,string>>")
    assert [r["name"] for r in browse.columns_in_order(tables, ["步骤层级"]).orderBy("place").collect()] == ["步骤层级", "zz", "yy"]


def test_stream_of_cases(spark, tmp_path):
    from caselattice.streaming.annotate import annotate_cases

    cases = tmp_path / "cases"
    cases.mkdir()
    row = {"步骤层级": "执行步骤", "设备类型": "电源"}
    for n in range(3):
        (cases / f"{n}.json").write_text(json.dumps({"id": str(n), "rows": [STEP, row]}, ensure_ascii=False) + "\n", encoding="utf-8")
        annotate_cases(spark, str(cases), str(tmp_path / "out"), str(tmp_path / "state"), lambda q: q).awaitTermination()
    got = sorted((r.id, r.row_index, r.query) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(str(n), 1, "打开电源。按下按钮。电源") for n in range(3)]


def test_indexes(spark, tmp_path):
    from caselattice.operators import index

    records = spark.createDataFrame([("a", "电源 开"), ("b", "阀门 关"), ("c", "")], "id string, _text string")
    encode = lambda texts: [[float(len(t)), 1.0] for t in texts]
    index.build_index(records, str(tmp_path / "i"), key="id", encode=index.vector_encoder(encode), model="m")
    opened = index.open_index(spark, str(tmp_path / "i"), records)
    assert opened["manifest"]["documents"] == 3 and opened["manifest"]["model"] == "m"
    queries = spark.createDataFrame([("q", "开电")], "query string, text string")
    found = index.search_index(opened, queries, query_tokens=tx.index_tokens("text"), encode=index.vector_encoder(encode, "Q:")).collect()
    assert [(r.doc, r.bm25_rank, r.dense_rank, r.final_rank) for r in found] == [("a", 1, 1, 1)] and found[0].margin is None
    plain = index.search_index(opened, queries, query_tokens=tx.index_tokens("text")).first()
    assert plain.dense is None and plain.rrf == pytest.approx(1 / 61)
    with pytest.raises(ValueError, match="another corpus"):
        index.open_index(spark, str(tmp_path / "i"), records.limit(2))
    with pytest.raises(ValueError):
        index.checked_records(records.unionByName(records), "id")


def test_judgements(spark):
    from caselattice.operators import index

    answers = ['{"needs_retrieval":"是","referenced_ids":"x","referenced_tasks":["t",null],"reason":"r"}', '{"needs_retrieval":false}', "{}", "bad", None]
    got = values(spark, index.judgement("x"), answers)
    assert (got[0].needs_retrieval, got[0].referenced_ids, got[0].referenced_tasks, got[0].reason, got[0].parse_ok) == (True, ["x"], ["t"], "r", True)
    assert [(g.needs_retrieval, g.parse_ok) for g in got[1:]] == [(False, True), (False, False), (False, False), (False, False)]
    cases = spark.createDataFrame([("1", "s", "记录电压@v1"), ("2", None, "b*@v1 见前序用例")], "id string, source string, content string")
    tables = spark.createDataFrame([("2", [{"判据关联标志": "@k"}])], "id string, rows array<map<string,string>>")
    docs = index.case_documents(cases, tables)
    assert {r.id: r.defined_ids for r in docs.collect()} == {"1": ["V1"], "2": ["K"]}
    asked = {r.id: r for r in index.search_request(docs, index.judgement(F.lit("{}"))).collect()}
    assert asked["2"].needed and asked["2"].overridden and "V1" in asked["2"].targets and not asked["1"].needed


def test_summaries(spark):
    assert scoring.pair_details([STEP], [STEP])[0]["fields"]["说明"]["similarity"] == 1
    rows = spark.createDataFrame([([1, 2, 3, 4], [-100, -100, 3, 4])], "t array<int>, l array<int>")
    assert scoring.tokenised_summary(rows, "t", "l").first().supervised_ratio == 0.5
    assert tuple(scoring.invalid_lines(spark.createDataFrame([(1,), (1,), (2,)], "line_number int")).first()) == (2, 3)


def test_small_checks(spark, tmp_path):
    from pyspark.sql import types as T

    got = values(spark, F.size(prep.locate_rows(F.col("x"))), ['[{"a":"1"}]', '{"pred_rows":[{},{}]}', '{"步骤列表":[{}]}', '{"rows":1}', "x", None])
    assert got == [1, 2, 1, 0, 0, 0]
    chats = spark.createDataFrame([([Row(role="user", content="ab"), Row(role="assistant", content="c")],)], "messages array<struct<role:string,content:string>>")
    m = prep.measured_lengths(chats, lambda c: F.split(c, "")).first()
    assert (m.prompt_tokens, m.total_tokens, m.assistant_tokens, m.prefix_match) == (8, 20, 12, True)
    rows = spark.createDataFrame([(2, 2, [0, 1]), (2, 3, [0, 0]), (0, 0, [5])], "n int, f int, i array<int>")
    assert [r[0] for r in rows.select(browse.export_request_errors(F.col("n"), F.col("f"), F.col("i"))).collect()] == [[], ["tables_differ_in_rows", "index_repeated"], ["row_count", "index_out_of_range"]]
    assert browse.layout(browse.PAIRED_FILES | {"x"}) == "paired" and browse.layout({browse.OLDER_FILE}) == "legacy" and browse.layout(set()) == "missing"
    root = tmp_path / "results"
    for name, n in (("one", 3), ("two", 9), ("old", None)):
        (root / name).mkdir(parents=True)
        for f in browse.PAIRED_FILES if n else {browse.OLDER_FILE}:
            (root / name / f).write_text(json.dumps({"num_samples": n}))
    assert browse.discover(spark, str(root))[0].endswith("/two") and browse.discover(spark, str(root), str(root / "old")) == (str(root / "old"), "legacy")
    assert browse.discover(spark, str(root / "one"))[1] == "paired" and browse.discover(spark, str(tmp_path / "none"))[1] == "missing"
    samples = spark.createDataFrame([(str(i), float(i)) for i in range(7)], "id string, delta double").withColumn("source", F.lit(""))
    shown, total = browse.page_with_total(samples, "delta_asc", 1, 3)
    assert [(r.id, r.place) for r in shown.collect()] == [("3", 4), ("4", 5), ("5", 6)] and tuple(total.first()) == (7, 3)
    parts = prep.split_tables(spark.createDataFrame([(1, "train"), (2, "test"), (3, "eval"), (4, "train")], "i int, part string"))
    assert {k: v.count() for k, v in parts.items()} == {"train": 2, "eval": 1, "test": 1, "all": 4} and parts["all"].columns == ["i"]
    path = tmp_path / "c.jsonl"
    path.write_text('{"id":"1"}\n', encoding="utf-8")
    kind = T._parse_datatype_string("id string")
    first = files.cached_json_lines(spark, str(path), kind)
    assert files.cached_json_lines(spark, str(path), kind) is first
    path.write_text('{"id":"1"}\n{"id":"2"}\n', encoding="utf-8")
    assert files.cached_json_lines(spark, str(path), kind).count() == 2
