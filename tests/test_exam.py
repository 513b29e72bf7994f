"""The exam operators on a synthetic paper; mutations must each raise their own code."""

import copy

import pytest
from pyspark.sql import functions as F

from sheaf.functions import exam_text as X
from sheaf.functions import similarity as S
from sheaf.functions.text import split_lines
from sheaf.operators import audit, qc
from sheaf.operators import exam as E

LINES = [
    "# 2024 某校期中",
    "注意",
    "<img src=\"a.png\">",
    "",
    "1. 第一题的题干是什么？",
    "题干第二行",
    "A. 甲",
    "B. 乙",
    "2. 第二题的题干是什么？",
    "A. 丙",
    "## 二、综合部分",
    "阅读材料一",
    "3. 第三题问什么？",
    "4. 第四题问什么？",
    "【答案】",
    "1. A 2. B",
    "3. 因为如此",
    "4. 所以这样",
    "【解析】第一题略",
]


def span(a, b):
    return {"start": a, "end": b}


def unit(uid, nums, kind="standalone_question", **spans):
    return {"unit_id": uid, "unit_type": kind, "question_numbers": nums, "printed_number": [str(n) for n in nums], "section": None, "section_ref": None, "basis": None, "basis_evidence": None} | {r: spans.get(r) for r in E.ROLES}


def paper():
    return {
        "doc_id": "p",
        "text": "\n".join(LINES),
        "rendered": "“题干区开始”x“题干区结束”“答案区开始”AB“答案区结束”" * 3,
        "annotated": None,
        "source_file": "p.md",
        "identity_version": 1,
        "units": [
            unit("Q1", [1], stem=span(3, 6), options=span(7, 8), answer=span(16, 16), explanation=span(19, 19)),
            unit("Q2", [2], stem=span(9, 9), options=span(10, 10), answer=span(16, 16)),
            unit("U3-4", [3, 4], "composite_question", material=span(12, 12), questions=span(12, 14), answer=span(17, 18)),
        ],
    }


def frame(spark, *papers):
    return spark.createDataFrame([tuple(p[c] for c in ("doc_id", "text", "rendered", "annotated", "source_file", "identity_version", "units")) for p in papers], E.PAPER)


def ready(spark, p):
    """The paper with identity and its annotated text."""
    return E.annotated(E.assign_identity(frame(spark, p)))


def codes(df):
    r = E.quality(df).collect()[0]
    return {i["code"] for i in r["issues"]}, r["verdict"]


def test_sections_partition_the_paper(spark):
    r = E.assign_identity(frame(spark, paper())).collect()[0]
    assert [(s["id"], s["start_line"], s["end_line"], s["derived"]) for s in r["sections"]] == [("S0", 1, 10, True), ("S1", 11, 19, False)]
    assert [u["section_ref"] for u in r["units"]] == ["S0", "S0", "S1"]


def test_good_paper_passes_and_is_admitted(spark):
    df = ready(spark, paper())
    assert codes(df) == (set(), "PASS")
    assert E.dispositions(df).collect()[0]["disposition"] == "ADMITTED"


def test_annotation_keeps_the_source_and_pairs_its_marks(spark):
    df = ready(spark, paper())
    marks = {(r["kind"], r["tag"]): (r["start_line"], r["end_line"]) for r in E.anchors(df).collect()}
    assert marks["stem", "Q1"] == (3, 6) and marks["unit", "U3-4"] == (12, 18) and marks["unit", "Q1"] == (3, 19)
    text = df.collect()[0]["annotated"].split("\n")
    assert [x for x in text if not x.startswith("<!-- META:")] == LINES


def _mutate(name):
    p = paper()
    u = p["units"]
    if name == "C3_ANSWERS":
        p["rendered"] = p["rendered"].replace("AB", "A", 1)
    elif name == "C1_UNPAIRED_STEM":
        p["rendered"] += "“题干区结束”"
    elif name == "C2_NUMBERS":
        u[1]["question_numbers"] = []
    elif name == "C4_COMPOSITE":
        u[2]["material"] = u[2]["questions"] = None
        u[2]["stem"] = span(12, 14)
    elif name == "C5_IMAGES":
        u[0]["stem"] = span(5, 6)
    elif name == "C6_TABLES":
        p["text"] = p["text"].replace("\n注意\n", "\n| a | b |\n")
    elif name == "C7_INSTRUCTIONS":
        p["rendered"] += "\n本大题共 3 小题"
    elif name == "C9_PAPER_LINES":
        u[0]["extra"] = span(11, 11)
        p["text"] = p["text"].replace("## 二、综合部分", "## 二、选择题")
    elif name == "C11_REPEATED_STEM":
        u[0]["stem"], u[0]["explanation"], u[0]["extra"] = span(5, 6), span(5, 5), span(3, 3)
    elif name == "C12_NOT_NESTED":
        u[2]["material"] = span(11, 12)
    elif name == "C13_SAME_SECTION":
        u[1]["question_numbers"] = [2, 1]
    elif name == "C13_CONFLICT":
        u[2]["question_numbers"] = [3, 4, 1]
    elif name == "C13_KEEP_UNPROVED":
        u[2]["question_numbers"] = [3, 4, 1]
        u[2]["basis"], u[2]["basis_evidence"] = "keep", "L99"
    return p


@pytest.mark.parametrize("code", ["C1_UNPAIRED_STEM", "C2_NUMBERS", "C3_ANSWERS", "C4_COMPOSITE", "C5_IMAGES", "C6_TABLES", "C7_INSTRUCTIONS", "C9_PAPER_LINES", "C11_REPEATED_STEM", "C12_NOT_NESTED", "C13_SAME_SECTION", "C13_CONFLICT", "C13_KEEP_UNPROVED"])
def test_each_mutation_raises_its_rule(spark, code):
    got, verdict = codes(ready(spark, _mutate(code)))
    assert code in got
    assert verdict == ("PENDING_REVIEW" if code == "C13_KEEP_UNPROVED" else "FAIL")


def test_kept_number_with_evidence_passes(spark):
    p = paper()
    p["units"][2]["question_numbers"] = [3, 4, 1]
    p["units"][2] |= {"basis": "keep", "basis_evidence": "见 L13"}
    assert codes(ready(spark, p)) == (set(), "PASS")


def test_annotated_must_equal_source_and_provenance_must_exist(spark):
    df = ready(spark, paper())
    assert codes(df.withColumn("annotated", F.concat("annotated", F.lit("\nx"))))[0] == {"C8_DIFFERS"}
    assert codes(df.withColumn("annotated", F.lit(None).cast("string")))[0] == {"C8_NO_ANNOTATED"}
    assert codes(df.withColumn("annotated", F.regexp_replace("annotated", "META:unit:end", "META:other:end")))[0] == {"C10_UNPAIRED"}
    assert codes(df.withColumn("text", F.lit(None).cast("string"))) == ({"C15_PROVENANCE"}, "FAIL")
    lost = df.withColumn("units", F.transform("units", lambda u: u.withField("section_ref", F.lit(None).cast("string"))))
    assert codes(lost) == ({"C14_SCOPE_MISSING"}, "PENDING_REVIEW")


def test_dispositions_are_ordered(spark):
    def of(df):
        return E.dispositions(df).collect()[0]["disposition"]

    df = ready(spark, paper())
    assert of(df.withColumn("identity_version", F.lit(1))) == "REJECTED_V1"
    assert of(df.withColumn("source_file", F.lit(None).cast("string"))) == "MISSING"
    assert of(df.withColumn("units", F.lit(None).cast(df.schema["units"].dataType))) == "MISSING"
    assert of(df.withColumn("text", F.substring("text", 1, 60))) == "REJECTED_STALE"
    assert of(df.withColumn("rendered", F.lit(""))) == "REJECTED_QC_FAIL"


def test_records_materials_and_probes(spark):
    df = ready(spark, paper())
    r = {x["unit_id"]: x for x in E.unit_records(df).collect()}
    assert r["Q2"]["stem"] == [LINES[8]] and r["U3-4"]["answer"] == LINES[16:18] and r["Q2"]["explanation"] is None
    m = E.shared_materials(df).collect()
    assert [(x["material"]["start"], x["units"]) for x in m] == [(12, [2])]
    bad = paper()
    bad["units"][0]["stem"], bad["units"][2]["answer"], bad["units"][1]["answer"] = span(5, 9), span(17, 19), span(12, 12)
    got = {(x["unit_ord"], x["check"]) for x in E.probes(frame(spark, bad)).collect()}
    assert got == {(0, "P14"), (1, "P13"), (2, "P13")} or got == {(0, "P14"), (1, "P13")}


def test_answer_parsers(spark):
    t = spark.createDataFrame([("1-3 ABC 7–8ＡD x1.2-3 AB 4-5 ABC", "21\\. B 22. C 23. A\n9. A only\n21. D 24. A", "<table><tr><td>1</td><td>2</td><td></td></tr><tr><td>A</td><td>BC</td><td></td></tr></table>")], "a string, b string, c string")
    r = t.select(X.range_answers(F.col("a")).alias("a"), X.inline_answers(split_lines(F.col("b"))).alias("b"), X.table_answers(F.col("c")).alias("c")).collect()[0]
    assert r["a"] == {1: "A", 2: "B", 3: "C", 7: "A", 8: "D"}
    assert r["b"] == {21: "B", 22: "C", 23: "A", 24: "A"}
    assert r["c"] == {1: "A", 2: "BC"}
    k = spark.createDataFrame([("<td>1. A</td><td>2. B</td>", [1, 3]), ("<td>A</td><td>B</td>", [5, 6]), ("<td>A</td>", [5, 6])], "x string, n array<int>")
    got = [r[0].asDict() for r in k.select(X.keyed_cells(F.col("x"), F.col("n"))).collect()]
    assert got[0] == {"method": "td_by_question_number", "answers": {1: "1. A"}, "unresolved": [3]}
    assert got[1] == {"method": "td_positional", "answers": {5: "A", 6: "B"}, "unresolved": []}
    assert got[2]["unresolved"] == [5, 6]


@pytest.mark.parametrize("line,want", [("### **１2．**题", 12), ("1\\. x", 1), ("（1）x", None), ("3、y", 3), ("2024 年", None), ("　5. z", 5), (None, None)])
def test_question_number(spark, line, want):
    r = spark.createDataFrame([(line,)], "x string").select(X.question_number(F.col("x")).alias("q")).collect()[0]["q"]
    assert (r and r["n"]) == want


def test_kind_subject_and_lint(spark):
    rows = spark.createDataFrame([("高考英语真题.md", "x", "合格考"), ("卷.md", "数学", "会考"), ("理综卷.md", "x", ""), ("a.md", "x", "函数 方程 数列 细胞")], "name string, parent string, text string")
    got = [(r[0]["kind"], r[0]["reason"], r[1]["subject"], r[1]["reason"]) for r in rows.select(X.exam_kind(F.col("name"), F.col("text")), X.subject(F.col("name"), F.col("parent"), F.col("text"))).collect()]
    assert got == [("高考真题", "文件名", "英语", "文件名"), ("会考", "内容", "数学", "父目录"), ("其他汇编", "未判定", "理综", "文件名(综合卷)"), ("其他汇编", "未判定", "数学", "内容推断")]
    t = spark.createDataFrame([("a $x\n\\ce{H}\n\\5 <table><tr><td></tr></table>\n<div>",)], "t string")
    r = t.select(X.lint(F.col("t"), split_lines(F.col("t"))).alias("l")).collect()[0]["l"]
    assert (r["dollar_odd"], r["ce"], r["bad_command"], r["unbalanced"], r["div"]) == ([1], 1, [3], ["td"], [4])


def test_binding_tiers(spark):
    rows = [
        (1, "B", None, "答案 B", "答案 B", ["B"]),
        (2, "因 为", None, "3. 因为如此", "3. 因为如此", []),
        (3, "别处", None, "这里", "这里\n别处", []),
        (4, "没有的话", None, "这里", "这里", None),
        (5, "x", None, None, "x", []),
        (6, "", None, "x", "x", []),
        (7, "abcdefghij", "compressed", "abcdefghi…j", "d", []),
    ]
    df = spark.createDataFrame(rows, "k int, value_text string, form string, block string, document string, candidates array<string>")
    got = {r["k"]: (r["tier"], r["match"], r["mismatch_class"], r["source_value"]) for r in E.bound_answers(df).collect()}
    assert got == {
        1: ("rule_candidate", "exact", None, "B"),
        2: ("source_substring", "normalized", None, "因为"),
        3: ("mismatch_withheld", "none", "outside_region", None),
        4: ("mismatch_withheld", "none", "absent_from_doc", None),
        5: ("mismatch_withheld", "none", "no_locator", None),
        6: ("not_applicable", "none", None, None),
        7: ("compressed_weak", "none", None, None),
    }


def test_similarities(spark):
    df = spark.createDataFrame([("abcd", "bcde"), (None, "x"), ("", "")], "a string, b string")
    r = df.select(S.ratio("a", "b"), S.coverage("a", "b")).collect()
    assert tuple(r[0]) == (0.75, 0.75) and r[1][0] is None and r[2][0] == 1.0


def test_probe_patterns_and_paper_lines(spark):
    rows = spark.createDataFrame([("考试时间 90 分钟",), ("满分150 分",), ("注意事项",), ("本卷考试时间 90",), ("姓名：甲",)], "x string")
    assert [r[0] for r in rows.select(E.is_paper_line(F.col("x"))).collect()] == [True, True, True, False, True]
    from sheaf.operators.binding import display, range_value

    forms = spark.createDataFrame([("$10^{12}$",), ("H_{2}O",), ("x^{n-1}",), ("\\Rightarrow \\sqrt \\in",), ("\\frac{\\text{a}}{b}",)], "t string")
    assert [r[0] for r in forms.select(display(F.col("t"))).collect()] == ["10¹²", "H_{2}O", "xⁿ⁻¹", "⇒ √ \\in", "\\frac{a}{b}"]
    got = spark.createDataFrame([("1-3：EFG",), ("16—18 ＡＢＣ",), ("1-9 AB",)], "t string").select(range_value(F.col("t"), F.lit(2)), range_value(F.col("t"), F.lit(17))).collect()
    assert [tuple(r) for r in got] == [("F", None), (None, "B"), ("B", None)]


def test_decimals_are_no_numbers_for_the_probes(spark):
    p = paper()
    lines = list(LINES)
    lines[4], lines[15] = "9.5% 的题干", "1. Ａ 2. while"
    p["text"] = "\n".join(lines)
    got = {(r["unit_ord"], r["check"], r["detail"]) for r in E.probes(frame(spark, p)).collect()}
    assert not [g for g in got if g[1] == "P14" and g[2] == "9"] and not [g for g in got if g[0] < 2 and g[1] != "P14"]


def test_excerpts_keep_no_handlers(spark):
    from sheaf.functions.markup import excerpt

    rows = spark.createDataFrame([(['<img src="a.png" onerror="x()">', '<b>t</b><u>s</u><hr>', "<script>y</script>", '<img src="javascript:z">', "<tbody>"],)], "l array<string>")
    got = rows.select(excerpt(F.col("l"))).first()[0]
    assert "<b>t</b><u>s</u><hr>" in got and "<img" not in got and "<script" not in got and "<tbody" not in got


@pytest.mark.parametrize("ids", [("p", "p"), (None, None), ("p", None)])
def test_papers_that_share_an_id_are_judged_one_by_one(spark, ids):
    good, bad = paper() | {"doc_id": ids[0]}, paper() | {"doc_id": ids[1], "rendered": "x"}
    df = E.annotated(E.assign_identity(frame(spark, good, bad, good)))
    assert df.count() == 3
    assert sorted(r["verdict"] for r in E.quality(df).collect()) == ["FAIL", "PASS", "PASS"]
    assert sorted(r["disposition"] for r in E.dispositions(df).collect()) == ["ADMITTED", "ADMITTED", "REJECTED_QC_FAIL"]
    assert audit.preflight(df).count() == 3
    for out in (E.dispositions(df), audit.preflight(df)):
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_number_coverage_is_not_as_long_as_its_numbers(spark):
    data = [("a", 1), ("a", 3), ("a", 3), ("a", 2_000_000_000), ("b", 1), ("b", 2), ("c", None), ("d", 0), ("d", -5), ("d", 2)]
    df = spark.createDataFrame(data, "k string, n long")
    assert sorted(map(tuple, qc.number_gaps(df, "k", F.col("n")).collect())) == [("a", 2, 2), ("a", 4, 1_999_999_999), ("d", 1, 1)]
    got = {r["k"]: (r["top"], r["n_missing"], r["n_repeated"]) for r in qc.number_coverage(df, "k", F.col("n")).collect()}
    assert got == {"a": (2_000_000_000, 1_999_999_997, 1), "b": (2, 0, 0), "c": (None, 0, 0), "d": (2, 1, 0)}


HAYS = ["", " ", "a", " a b ", "ａ　ｂ\tc\n", "x𝟘y 😀 z", "\x1cab\x85c", "因 为，所以（Ａ）", "aXbXc" * 30, None]
NEEDLES = ["", " ", "a", "ab", "b c", "abc", "y😀", "为,所", "(A)", "caX bXca", "zz", None]


def test_index_map_and_likenesses_against_loops(spark):
    from sheaf.functions import places as P

    fold = {i: i - 0xFEE0 for i in range(0xFF01, 0xFF5F)}
    kept = lambda s: [(i, c) for i, c in enumerate(s.translate(fold)) if not c.isspace()]
    pairs = [(h, n) for h in HAYS for n in NEEDLES]
    df = spark.createDataFrame([(i, h, n) for i, (h, n) in enumerate(pairs)], "i int, h string, n string")
    got = df.select("i", P.find_compact(F.col("h"), F.col("n")).alias("s"), P.is_subsequence(F.col("n"), F.col("h")).alias("sub"), P.longest_share(F.col("n"), F.col("h")).alias("run"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: P.raw_place(P.runs(F.col("h")), k)).alias("map"))
    for r in got.collect():
        h, n = pairs[r["i"]]
        if h is not None:
            places = [i for i, _ in kept(h)]
            assert r["map"] == [places[k] if k < len(places) else None for k in range(10)]
        if h is None or n is None:
            assert r["s"] is None and r["sub"] is None
            continue
        text, want = "".join(c for _, c in kept(h)), "".join(c for _, c in kept(n))
        at = text.find(want) if want else -1
        assert (tuple(r["s"]) if r["s"] else None) == ((kept(h)[at][0], kept(h)[at + len(want) - 1][0] + 1) if at >= 0 else None), (h, n)
        rest = iter(h)
        assert r["sub"] == all(c in rest for c in n)
        best = max([q - p for p in range(len(n)) for q in range(p + 1, len(n) + 1) if n[p:q] in h], default=0)
        assert r["run"] == (best / len(n) if n else 0.0)


def test_binding_tiers(spark):
    rows = [
        (1, "ＡB", "verbatim", "x", "x", ["zz", "A B", "ＡB"], None, None),
        (2, "错", "verbatim", "块", "文", ["对"], "entry_bound", True),
        (3, "错", "verbatim", "块", "文", ["对"], "region_bound", True),
        (4, "错", "combined", "块", "文", ["对"], "entry_bound", True),
        (5, "甲丙", "verbatim", "甲乙丙", "甲乙丙丁", [], None, True),
        (6, "甲丁", "verbatim", "甲乙丙", "甲乙丙丁", [], None, True),
        (7, "x", None, None, "x", [], None, True),
        (8, "x", None, None, "x", None, None, None),
        (9, "a b", "compressed", "xab", "xab", [], None, True),
        (10, "abcdefghij", "descriptive", "abcdefghi…j", "d", [], None, True),
        (11, "Ｂ", "compressed", "x", "x", ["B"], None, True),
    ]
    df = spark.createDataFrame(rows, "k int, value_text string, form string, block string, document string, candidates array<string>, bind_source string, cited boolean")
    got = {r["k"]: (r["tier"], r["match"], r["mismatch_class"], r["source_value"], r["bound_value"]) for r in E.bound_answers(df).collect()}
    assert got == {
        1: ("rule_candidate", "normalized", None, "A B", "A B"),
        2: ("mismatch_recovered", "none", "absent_from_doc", "对", "对"),
        3: ("mismatch_withheld", "none", "absent_from_doc", None, None),
        4: ("mismatch_withheld", "none", "absent_from_doc", None, None),
        5: ("mismatch_withheld", "none", "in_region_edit", None, None),
        6: ("mismatch_withheld", "none", "outside_region", None, None),
        7: ("mismatch_withheld", "none", "locator_invalid", None, None),
        8: ("mismatch_withheld", "none", "no_locator", None, None),
        9: ("compressed_strong", "normalized", None, None, "a b"),
        10: ("mismatch_withheld", "none", "in_region_edit", None, None),
        11: ("rule_candidate", "normalized", None, "B", "Ｂ"),
    }
    plan = E.bound_answers(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
