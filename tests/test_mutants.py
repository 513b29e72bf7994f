"""Every quality rule is killed by its mutator, and mutants that change nothing are told."""

from pyspark.sql import functions as F

from sheaf.operators import exam as E
from sheaf.operators import mutants as M
from tests.test_exam import frame, paper, ready


def test_every_rule_is_killed_on_a_good_paper(spark):
    df = ready(spark, paper())
    got = {r["mutant"]: r for r in M.judged_mutants(df).collect()}
    assert set(got) == set(M.MUTATORS)
    for name, r in got.items():
        assert r["changed"] and r["hit"] and not r["silent"], (name, r)
        assert r["target"] in r["new_codes"]
    rules = {m.code.split("_")[0] for m in M.MUTATORS.values()}
    assert rules == {f"C{i}" for i in range(1, 16)}


def test_matrix_and_survivors(spark):
    good, bare = paper(), paper() | {"doc_id": "q", "text": None, "units": None}
    df = E.annotated(E.assign_identity(frame(spark, good, good, bare)))
    lax = {"nothing": M.Mutator("C7_INSTRUCTIONS", lambda: {"rendered": F.col("rendered")}), "unseen": M.Mutator("C7_INSTRUCTIONS", lambda: {"rendered": F.concat("rendered", F.lit("\nharmless"))})} | M.MUTATORS
    judged = M.judged_mutants(df, lax)
    assert judged.count() == 3 * len(lax)
    matrix = {(r["mutant"], r["code"]): r["n"] for r in M.kill_matrix(judged).collect()}
    assert all(matrix[name, m.code] == 2 for name, m in M.MUTATORS.items())
    left = {r["mutant"]: (r["n"], r["n_hit"], r["n_silent"]) for r in M.survivors(judged).collect()}
    assert "nothing" not in left and left["unseen"] == (3, 0, 2)
    assert left["source_lost"] == (2, 2, 0)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert M.judged_mutants(df.limit(0)).count() == 0


def test_rows_wait_for_python_without_their_texts(spark):
    node = E.quality(ready(spark, paper()))._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "ArrowEvalPython":
        node = node.children().apply(0)
    held = {a.name() for a in (node.children().apply(0).output().apply(i) for i in range(node.children().apply(0).output().size()))}
    assert "_pairs" in held and not held & {"text", "rendered", "annotated", "units", "lines", "sections"} and not any(c.startswith("_of_") for c in held)


def test_facts_are_told_anew_where_a_text_is_edited(spark):
    df = ready(spark, paper())
    fresh = M.judged_mutants(df, check=lambda p: E.with_quality(p.drop(*E.FACTS)))
    assert sorted(map(str, M.judged_mutants(df).collect())) == sorted(map(str, fresh.collect()))


def test_mutants_are_judged_within_their_row(spark):
    node = M.judged_mutants(ready(spark, paper()))._jdf.queryExecution().optimizedPlan()
    nodes = [node]
    while node.children().size():
        node = node.children().apply(0)
        nodes.append(node)
    rows = [n for n in nodes if n.nodeName() == "Generate" and "explode(" in n.generator().toString()]
    assert len(rows) == 1  # a row a mutant comes last, without texts
    held = {a.name() for a in (rows[0].child().output().apply(i) for i in range(rows[0].child().output().size()))}
    assert "_judged" in held and not held & {"text", "rendered", "annotated", "units", "lines", "sections"} and not any(c.startswith("_of_") for c in held)


def test_mutants_in_place_are_as_mutants_in_rows(spark):
    p = paper()
    texts = [p["text"] + x for x in ("\n", "\r", " <!-- META:x -->", "\n<!-- META:x -->\n", "\u2028", '\n<img src="a.png">\n| c |')]
    shown = [p["rendered"] + x for x in ("\n", " x", "\n“题干区开始”\na\n“答案区开始”", "\n考试时间 3")] + ["", None]
    marked = [x for x in ("\n", "", "a\rb", "<!-- META:unit:end:Q1 \x0b-->", None)]
    first = p["units"][0]
    odd = [p | {"text": t} for t in (*texts, "", None)] + [p | {"rendered": t} for t in shown] + [p | {"units": None}, p | {"source_file": None}, p | {"units": [first | {"explanation": first["stem"]}]}, p | {"identity_version": 1}]
    rows = [x | {"doc_id": str(i)} for i, x in enumerate(odd)]
    df = E.annotated(E.assign_identity(frame(spark, *rows)))
    df = df.withColumn("identity_version", F.when(F.col("doc_id") == str(len(rows) - 1), 1).otherwise(F.col("identity_version")))
    df = df.unionByName(E.annotated(E.assign_identity(frame(spark, *[p | {"doc_id": f"m{i}"} for i in range(len(marked))]))).withColumn("annotated", F.coalesce(*[F.when(F.col("doc_id") == f"m{i}", F.concat("annotated", F.lit(m)) if m is not None else F.lit(None)) for i, m in enumerate(marked)])))
    more = {
        "name_lost": M.Mutator("C15_PROVENANCE", lambda: {"source_file": F.lit(None)}),
        "name_found": M.Mutator("C15_PROVENANCE", lambda: {"source_file": F.lit("a.md"), "text": F.coalesce("text", F.lit("1. a"))}),
        "mark_added": M.Mutator("C1_UNPAIRED_STEM", lambda: {"rendered": F.concat("rendered", F.lit("\n“题干区开始”"))}, {"rendered": "“题干区开始”"}),
        "older": M.Mutator("C13_SAME_SECTION", lambda: {"identity_version": F.lit(1)}),
        "none": M.Mutator("C7_INSTRUCTIONS", dict),
    }
    got = M.judged_mutants(df, M.MUTATORS | more).collect()
    want = M.judged_mutants(df, M.MUTATORS | more, check=lambda x: E.with_quality(x.drop(*E.FACTS))).collect()
    assert len(got) == (len(rows) + len(marked)) * (len(M.MUTATORS) + len(more))
    assert sorted(map(str, got)) == sorted(map(str, want))
