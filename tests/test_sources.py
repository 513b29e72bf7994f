"""Corpus scans, readers, sinks, and the fixers."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sheaf.operators import exam as E
from sheaf.operators import fixers as X
from sheaf.sources import corpus as C
from tests.test_exam import frame, paper, span


def test_scan_hashes_and_leaves_derived_trees_out(spark, tmp_path):
    files = {"a/x.md": "é\r\nb  \n", "a/sub/x (2).md": "e\u0301\nb", "reslice-1/y.md": "no", "_imgs/z.md": "no", "top.md": "t"}
    for n, t in files.items():
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(t.encode())
    (tmp_path / "a/bad.md").write_bytes(b"\xff\xfe")
    got = {r["rel_path"]: r for r in C.scan(spark, str(tmp_path)).collect()}
    assert set(got) == {"a/x.md", "a/sub/x (2).md", "top.md", "a/bad.md"}
    x, y = got["a/x.md"], got["a/sub/x (2).md"]
    assert x["sha256"] == hashlib.sha256(files["a/x.md"].encode()).hexdigest()
    assert x["norm_sha256"] == y["norm_sha256"] == hashlib.sha256("é\nb".encode()).hexdigest()
    assert (y["top_dir"], y["parent_dir"], y["stem"]) == ("a", "sub", "x (2)") and got["a/bad.md"]["text"] is None
    keys = {(r["key_kind"], r["key"]): r["paths"] for r in C.paths_by_key(C.scan(spark, str(tmp_path))).collect()}
    assert keys["stripped", "x"] == ["a/sub/x (2).md", "a/x.md"]


def test_json_lines_good_bad_and_strict(spark, tmp_path):
    p = tmp_path / "l.jsonl"
    p.write_text('{"a": 1}\nnot json\n\n{"a": 2}\n')
    good, bad = C.read_jsonl(spark, str(p), "a int")
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and [r["line"] for r in bad.collect()] == ["not json"]
    with pytest.raises(ValueError):
        C.read_jsonl(spark, str(p), "a int", strict=True)


def test_manifests_keep_unknown_keys(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x.manifest.json").write_text(json.dumps({"source_file": "x.md", "later": {"k": 1}}))
    r = C.read_manifests(spark, str(tmp_path), "source_file string").collect()[0]
    assert r["source_file"] == "x.md" and json.loads(r["extra"]["later"]) == {"k": 1}


def test_recognised_pages_and_boxes(spark):
    page = lambda *ts: json.dumps({"result": {"layoutParsingResults": [{"markdown": {"text": t, "images": {"i": "u"}}} for t in ts]}})
    rows = spark.createDataFrame([("d", 1, page("a", "b")), ("d", 2, "broken"), ("d", 3, page("c"))], "doc_id string, line_no int, line string")
    r = C.recognised_text(rows).collect()[0]
    assert (r["pages"], r["text"], r["bad_lines"], len(r["images"])) == (3, "a\n\n---\n\nb\n\n---\n\nc", 1, 3)
    lines = spark.createDataFrame([("d", 1, "x"), ("d", 2, " --- "), ("d", 3, '<img src="box_1_2_3_4.png">')], "doc_id string, line_no int, line string")
    got = [(x["page"], x["prompt_text"]) for x in C.with_boxes(lines).orderBy("line_no").collect()]
    assert got == [(1, "x"), (2, " --- "), (2, '<img src="box_1_2_3_4.png"> [p2 box 1,2,3,4]')]


@pytest.mark.parametrize("reply,want", [('x {"a": 1} y', 1), ('```json\n{"a": 2,}\n```', 2), ('{"a": 3\n"b": 4}', 3), ("none", None), ('{"a": \x014}', 4)])
def test_reply_object(spark, reply, want):
    r = spark.createDataFrame([(reply,)], "r string").select(C.reply_object(F.col("r"), "a int").alias("o")).collect()[0]["o"]
    assert (r and r["a"]) == want


def test_image_delivery_status(spark):
    refs = spark.createDataFrame([("d", 1, "http://x/a.png"), ("d", 2, "../a.png"), ("d", 3, "i/b.png"), ("d", 4, "i/c.png"), ("d", 5, "j/d.png"), ("e", 1, "k/d.png")], "doc_id string, line_no int, ref string")
    assets = spark.createDataFrame([("i/c.png", "1", "00"), ("j/d.png", "2", "89504E47"), ("k/d.png", "3", "FFD8FF00")], "ref string, sha256 string, magic string")
    assert [r["status"] for r in C.delivered(refs, assets).orderBy("doc_id", "line_no").collect()] == ["REMOTE", "UNSAFE", "NOT_FOUND", "BAD_IMAGE", "OK", "COLLISION"]


def test_ledger_is_all_or_nothing(spark, tmp_path):
    row = ("a.pdf", "0" * 64, 3, None)
    schema = "source_rel string, source_sha256 string, pages int, provenance string"
    C.append_ledger(spark.createDataFrame([row], schema), str(tmp_path / "l"))
    with pytest.raises(ValueError):
        C.append_ledger(spark.createDataFrame([row, ("b.pdf", "0" * 64, None, None)], schema), str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 1


def units(df):
    return df.collect()[0]["units"]


def test_fixers(spark):
    p = paper()
    p["units"][0]["stem"], p["units"][1]["answer"] = span(0, 6), span(99, 16)
    u = units(X.clamp_spans(frame(spark, p)))
    assert (u[0]["stem"]["start"], u[1]["answer"]["start"], u[1]["answer"]["end"]) == (1, 16, 19)
    p = paper()
    p["units"][0]["question_numbers"], p["units"][1]["question_numbers"] = None, []
    assert [x["question_numbers"] for x in units(X.number_missing(frame(spark, p)))] == [[5], [6], [3, 4]]
    p = paper()
    p["units"][2]["question_numbers"] = [1, 2]
    assert [x["question_numbers"] for x in units(X.shift_numbers(frame(spark, p)))] == [[1], [2], [3, 4]]
    p = paper()
    p["units"][0]["explanation"] = span(17, 19)
    p["text"] = p["text"].replace("【解析】", "【分析】")
    assert units(X.trim_explanations(frame(spark, p)))[0]["explanation"]["start"] == 19
    p["text"] = p["text"].replace("\n2. 第二", "\n### 2. 第二")
    assert "\n2. 第二" in X.plain_numbered_lines(frame(spark, p)).collect()[0]["text"]
    p = paper()
    p["units"][0]["stem"] = span(5, 6)
    assert units(X.attach_orphan_images(frame(spark, p)))[0]["stem"]["start"] == 3


def test_completeness_and_items(spark):
    rows = spark.createDataFrame([("略", "略", True), ("甲；见解析", "x", True), ("3", "得 3", True), ("3", "(1) 3\n(2) 4", True), ("3", "得 $3", True), ("3", None, False)], "v string, b string, c boolean")
    assert [r[0] for r in rows.select(X.completeness(F.col("v"), F.col("b"), F.col("c"))).collect()] == ["unknown", "partial", "full", "partial", "partial", "unknown"]
    # a number beside a placeholder is a part's, and a word that only holds 略 is an answer
    told = spark.createDataFrame([("3；见解析",), ("战略",), ("略。",), ("同上",), ("理由见解析，乙",), ("",)], "v string")
    assert [r[0] for r in told.select(X.placeholder(F.col("v"))).collect()] == ["pure", "none", "pure", "pure", "partial", "none"]
    item = "struct<sub_label:string,slot_id:string,value_text:string,asset_ref:string,form:string,source_region:string,evidence_lines:struct<start:int,end:int>,status:string,missing_reason:string>"
    items = spark.createDataFrame([((None, "1#1", "x", None, "verbatim", "answer_area", (1, 2), "resolved", None),), ((None, "1", "x", "a.png", "odd", "nowhere", (3, 2), "disputed", "why"),)], f"i {item}")
    got = [r[0] for r in items.select(X.item_issues(F.col("i"), F.lit(9))).collect()]
    assert got == [[], ["FORM", "REGION", "REASON", "SLOT", "LINES", "BOTH", "DISPUTED"]]


def test_manifest_validation(spark):
    def codes(p):
        return {i["code"] for i in X.validated(frame(spark, p)).collect()[0]["issues"]}

    base = codes(paper())
    assert base == {"C_A3", "C_A4"}
    p = paper()
    p["units"][2]["questions"] = span(13, 15)
    assert "C_A1" in codes(p) and "C_A4" not in codes(p)
    p = paper()
    p["units"][0]["answer"], p["units"][1]["question_numbers"] = None, [1]
    assert {"NO_ANSWER", "NUMBER_TWICE"} <= codes(p)
    p = paper()
    p["units"][0]["stem"] = span(5, 99)
    assert "SPAN" in codes(p)
    assert E.ROLES[0] == "stem"


def test_markup(spark):
    from sheaf.functions import markup as M

    def one(c, *values):
        return [r[0] for r in spark.createDataFrame([(v,) for v in values], "t string").select(c(F.col("t"))).collect()]

    assert one(M.to_html, "# A & b\n\ntext <x\n---\n<table></table>\n##### e") == ["<h1>A &amp; b</h1>\n<p>text &lt;x</p>\n<hr>\n<table></table>\n<h4>e</h4>"]
    assert one(M.repaired_line, "<td>a\\n1</td>", "x \\quad y $\\quad$") == ["<td>a<br>1</td>", "x   y $\\quad$"]
    assert one(lambda t: M.excerpt(F.array(t)), '<td>1</td><script>x</script><img src="a">') == ['<td>1</td>&lt;script&gt;x&lt;/script&gt;<img src="a">']
    m = F.create_map(F.lit("a.png"), F.lit("imgs/b.png"))
    assert one(lambda t: M.rewritten_refs(t, m), '![x](a.png) <img src="a.png"> ![y](c.png)') == ['![x](imgs/b.png) <img src="imgs/b.png"> ![y](c.png)']


def test_more_fixers(spark):
    t = spark.createDataFrame([(["<img a>", "<div>A</div>", "<img b>", "<div>B</div>", "<img c>", "<div>D</div>"],)], "l array<string>")
    assert [tuple(x) for x in t.select(X.image_options(F.col("l"), F.lit(1), F.lit(6))).collect()[0][0]] == [("A", 1, 2), ("B", 3, 4)]
    p = paper()
    p["text"] = p["text"].replace("2. 第二题的题干是什么？\nA. 丙", "2. 见下表？\n| a | b |\n| c | d |")
    p["units"][1] |= {"stem": span(9, 9), "options": None}
    assert units(X.pull_tables(frame(spark, p)))[1]["stem"]["end"] == 11


def test_review_pages(spark):
    from sheaf.operators import review as R

    lines = [f"line {i} <b>x</b> <script>" for i in range(30)]
    rows = [("p", "2", "t", lines, (1, 25)), ("p", "1", None, lines, (29, 30)), ("q", "1", "t", lines, (5, 99))]
    items = spark.createDataFrame(rows, "paper string, item string, title string, lines array<string>, span struct<start:int,end:int>")
    sheets = {r["paper"]: r["page"] for r in R.worksheet(items).collect()}
    assert sheets["p"].index("## 1 ") < sheets["p"].index("## 2 t") and sheets["p"].count("> line") == 20 and "(no lines)" in sheets["q"]
    pages = {r["paper"]: r["page"] for r in R.review_html(items).collect()}
    assert pages["p"].count("<section>") == 2 and "<script>" not in pages["p"] and "<b>x</b>" in pages["p"]


def test_pdf_pages_and_text_layer(spark):
    good = b"%PDF-1.4 1 0 obj <</Type /Pages>> 2 0 obj <</Type/Page>> 3 0 obj <</Type /Page >>"
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"no pdf")), (3, bytearray(b"%PDF-1.7 compressed"))], "i int, c binary")
    assert [r["n"] for r in df.select("i", C.pdf_pages(F.col("c")).alias("n")).orderBy("i").collect()] == [2, None, None]
    assert df.select(C.pdf_pages_by_library("c").alias("n")).count() == 3
    pages = spark.createDataFrame([("a", 1, 90), ("a", 2, 80), ("a", 3, 0), ("b", 1, 0), ("b", 2, 90)], "doc_id string, page int, chars int")
    assert {r["doc_id"]: r["kind"] for r in C.text_layer(pages).collect()} == {"a": "native_text", "b": "scanned"}
