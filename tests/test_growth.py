"""Steps whose cost once grew faster than their input, or by a large factor of it."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from sheaf.functions import exam_text as X
from sheaf.functions import similarity
from sheaf.functions import text as T
from sheaf.operators import audit, chain, isolation
from sheaf.operators import copies as C
from sheaf.operators import exam as E
from sheaf.plans import catalog, repair_queries
from tests.test_copies import cover
from tests.test_exam import frame, paper, span, unit


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [1, 2])
def test_a_text_that_begins_with_the_other_has_the_ratio_of_lengths(seed):
    r = random.Random(seed)
    for _ in range(2000):  # beyond 200 characters the matcher leaves out frequent ones
        a = "".join(r.choice("abcde" if r.random() < 0.9 else "甲乙丙丁") for _ in range(r.choice([0, 1, 9, 120, 199, 200, 260, 400])))
        b = a + "".join(r.choice("abcx") for _ in range(r.randint(0, 40)))
        if b:
            for x, y in ((a, b), (b, a)):
                assert difflib.SequenceMatcher(None, x, y).ratio() == 2.0 * len(a) / (len(a) + len(b))


def test_line_scan_asks_python_only_of_other_pairs(spark):
    docs = spark.createDataFrame([("a", "1. abcdefghijkl\n1. abcdefghijkl mn\n2. abcdefghijkl\n2. abcdXfghijkl")], "doc_id string, text string")
    out = C.line_scan(docs)
    assert [tuple(p) for p in out.first()["doubled"]] == [(1, 2, "1"), (3, 4, "2")]
    assert "aggregate(" not in plan(out)  # no bound character by character for each pair


def test_copied_lines_stay_in_their_row(spark):
    p = paper() | {"text": "# t\n1. abcdefghijklmnop\n## a\n1. abcdefghijklmXYZ\nA", "units": [unit("Q1", [1], stem=span(2, 2), answer=span(5, 5))]}
    out = C.copied_lines(frame(spark, p))
    assert [(x["line_no"], round(x["cover"], 6)) for x in out.collect()] == [(4, round(cover("1.abcdefghijklmnop", "1.abcdefghijklmXYZ"), 6))]
    below = plan(out).partition("ArrowEvalPython")[2]
    assert below and "inline(_open" not in below  # not a row a line that carries all questions


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_best_covers(spark, block, monkeypatch):
    r = random.Random(block)
    monkeypatch.setattr(similarity, "MOST_COUNTS", block)
    word = lambda: "".join(r.choice("abcd甲") for _ in range(r.randint(1, 12)))
    for _ in range(60):
        xs, ys = [word() for _ in range(4)], [word() for _ in range(r.randint(1, 9))]
        got = [b.tolist() for b in similarity._bounds(xs, ys)]
        assert got == [[sum(min(x.count(c), y.count(c)) for c in set(x)) for y in ys] for x in xs]
    rows = [([word() for _ in range(4)], [word() for _ in range(r.randint(1, 9))]) for _ in range(200)]
    df = spark.createDataFrame(rows, "xs array<string>, ys array<string>")
    for xs, ys, best in df.select("xs", "ys", similarity.best_covers("xs", "ys", F.lit(0.62))).collect():
        for x, at, c in zip(xs, best["at"], best["cover"]):
            covers = [cover(x, y) for y in ys]
            most = max(covers)
            assert (at, c) == ((covers.index(most), most) if most >= 0.62 else (None, None))


def test_fidelity_of_mixed_texts(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice(["a", "Z", "9", "_", "-", " ", "é", "中", "鿿", "<b>", "<", ">", "٣"]) for _ in range(r.randint(5, 40)))
    rows = [(word(), "，".join(word() for _ in range(r.randint(0, 6)))) for _ in range(300)] + [(None, None), ("x", None), (None, "a" * 60)]
    rows += [(s, "。".join([t or "", re.sub("<[^>]+>", "", s or "")])) for s, t in rows]
    bare = lambda t: re.sub("[^0-9A-Za-z一-鿿]+", "", t)

    def told(s, t):
        if t is None or len(bare(t)) < 20:
            return "no_text_layer", None, None
        ps = [p for p in map(bare, re.split("[，。、；：！？\n\r]", t)) if len(p) >= 12]
        near = bare(re.sub("<[^>]+>", "", s or ""))
        return ("ok", len(ps), sum(p in near or p[:10] in near or p[-10:] in near for p in ps)) if ps else ("no_prose", None, None)

    df = spark.createDataFrame(rows, "s string, t string").select("s", "t", audit.fidelity(F.col("s"), F.col("t"), least_text=20).alias("f"))
    for s, t, f in df.collect():
        assert (f["status"], f["n_prose"], f["n_found"]) == told(s, t)
    assert r"[\W_]+" in plan(df)  # ASCII, which most text is, does not go through the large class


def test_a_text_is_measured_once_for_all_spans(spark):
    guard = str(isolation.paper_guards()["a span is too wide"])
    assert guard.index("char_length") < guard.index("forall")


def test_a_text_is_made_once_to_be_split(spark):
    ends = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    texts = ["", "a", "a\n", "\n\n", None, *[f"x{e}y\nz{e}" for e in (*ends, "\r\n")], "a\u2027b\u202ac\x1fd"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.split_lines(F.concat("t", F.lit(""))).alias("ls"))
    assert all(ls == (None if t is None else t.splitlines()) for t, ls in df.collect())
    assert str(T.split_lines(F.upper("t"))).count("upper") == 1


def test_marks_need_one_shuffle_and_one_paper(spark):
    p = paper() | {"annotated": "<!-- META:stem:start:Q1 -->\n# 一\n<!-- META:stem:end:Q1 -->\nb <!-- META:stem:start:Q1 -->\n<!-- META:stem:end:Q1 -->\n<!-- META:x -->\nc\n<!-- META:unit:end:Q9 -->"}
    rows = frame(spark, p, p | {"doc_id": "q", "annotated": None})
    got = sorted(map(tuple, E.anchors(rows).select("kind", "tag", "nth", "start_line", "end_line").collect()), key=str)
    assert got == [("stem", "Q1", 1, 1, 1), ("stem", "Q1", 2, 3, 2), ("unit", "Q9", 1, None, 3)]
    assert plan(E.anchors(rows)).count("Exchange") == plan(audit.anchor_drift(rows)).count("Exchange") == 1
    assert {r["status"] for r in audit.anchor_drift(rows).where("doc_id = 'q'").collect()} == {"DRIFT"}


def test_zones_are_cut_once(spark):
    mark = F.lit("x")
    assert str(audit._zone_of(F.upper(mark), ("a", "b"))).count("upper") <= 3
    assert str(X.range_answers(F.col("t"))).count("regexp_extract_all") == 1
    texts = ["1-3ABC", "11–12 AB，.2-3AB 4~5CDE 6—7ＡＢ", "1-2A", "12-3AB", "", None, "1234-5AB 1 - 2 AB3-4 CD"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.range_answers(F.col("t")).alias("m"))
    for t, m in df.collect():
        want = {}
        for lo, hi, letters in re.findall(X.RANGE_ANSWER, t or ""):
            if int(hi) > int(lo) and len(letters) == int(hi) - int(lo) + 1:
                for i, c in enumerate(letters):
                    want.setdefault(int(lo) + i, c.translate({0xFF21 + k: 65 + k for k in range(4)}))
        assert (m or {}) == want and (m is None) == (t is None)


def test_moves_read_texts_once(spark, tmp_path, monkeypatch):
    rows = [(i, f"t{i % 3}", "en", "src1") for i in range(9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    out = catalog.queries()["applied_moves"](spark, str(tmp_path))
    assert {tuple(r) for r in out.select("gate", "detail").collect()} == {("BATCH", "target_twice")}
    seen = []
    real = repair_queries.stored
    monkeypatch.setattr(repair_queries, "stored", lambda df, name: seen.append((name, "sha2(" in plan(df))) or real(df, name))
    catalog.queries()["applied_moves"](spark, str(tmp_path)).collect()
    assert [n for n, texts in seen if texts] == ["digests"]


def test_rules_take_lines_and_leave_the_rest_alone(spark):
    p = paper()
    rows = E.assign_identity(frame(spark, p), keep_lines=True)
    split = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("META:[^>]*")
    assert split(E.with_facts(E.annotated(rows))) < split(E.with_facts(E.annotated(E.assign_identity(frame(spark, p)))))
    assert E.LINES not in E.with_quality(E.annotated(rows)).columns
    assert "regexp" not in str(T.has_other_ends(F.col("t"))).lower() and "rlike" not in str(T.has_other_ends(F.col("t"))).lower()
    line = str(X.leading_number(F.col("t")))
    assert line.count("regexp_extract") == 1  # not once for each use of the number


@pytest.mark.parametrize("end", ["\r", " ", "\r\n"])
def test_other_line_ends_in_annotated_texts(spark, end):
    lines, mark = ["a", "b"], "<!-- META:stem:start:Q1 -->"
    texts = [f"a\n{mark}\nb", f"a{end}{mark}{end}b", f"a\n<!-- META:x{end} -->\nb", f"a\nb{end}", f"a\nb{end}c", "a\nb\n", "a\nb\n\n", ""]
    df = spark.createDataFrame([(t, lines) for t in texts], "t string, ls array<string>")
    got = df.select("t", E.differs(F.col("t"), E.annotated_facts(F.col("t")), F.col("ls")).alias("d")).collect()
    for t, d in got:
        assert d == ([x for x in t.splitlines() if not re.match(r"\s*<!--\s*META:", x)] != lines), repr(t)


def test_preflight_does_not_join_papers_with_their_table(spark):
    text = plan(catalog.queries()["contract_preflight"](spark, "/root/testdata/sf0.001"))
    assert "Join" not in text and "Exchange" not in text


def test_rounds_of_a_chain_compare_fields(spark):
    rows = spark.createDataFrame([("a", 1, {"k": 1}), ("b", None, None)], "x string, n int, m map<string,int>")
    fixers = {"none": lambda d: d, "up": lambda d: d.withColumn("n", F.when(F.col("n") < 3, F.col("n") + 1).otherwise(F.col("n"))), "map": lambda d: d.withColumn("m", F.create_map(F.lit("k"), F.lit(2)))}
    assert "sha2(" not in plan(chain._round(rows.withColumns({"rounds": F.lit(0), "steps": F.array().cast("array<string>"), "settled": F.lit(False)}), rows.columns, fixers))
    got = {r["x"]: (r["n"], r["m"], r["rounds"], r["steps"], r["settled"]) for r in chain.fixpoint(rows, fixers).collect()}
    assert got == {"a": (3, {"k": 2}, 3, ["up", "map"], True), "b": (None, {"k": 2}, 2, ["map"], True)}
    undone = {"up": lambda d: d.withColumn("n", F.col("n") + 1), "down": lambda d: d.withColumn("n", F.col("n") - 1)}
    assert {r["x"]: (r["n"], r["rounds"], r["steps"], r["settled"]) for r in chain.fixpoint(rows, undone).collect()} == {"a": (1, 1, ["up", "down"], True), "b": (None, 1, [], True)}
