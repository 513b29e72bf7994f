"""The shape of plans: what shuffles, what is read, what is pushed down; and the SQL views."""

import re

import pytest
from pyspark.sql import functions as F

from sheaf.operators import exam
from sheaf.plans import audit_queries, catalog, exam_queries, library, recovery_queries, views  # noqa: F401

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["numbered_lines", "document_counts", "span_slices", "clamped_spans", "rule_classification", "subject_score", "quality_flags", "tag_balance", "verdict_ladder", "json_props", "exam_verdicts", "exam_dispositions", "option_recovery", "answer_binding", "line_scan", "copied_lines", "migrated_papers", "contained_verdicts", "fix_chain"])
def test_projections_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(catalog.queries()[name](spark, SF))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_nested_loops_no_python_and_pruned_reads(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in ("exam_verdicts", "exam_dispositions", "contract_preflight", "rule_kills", "line_scan", "copied_lines", "fix_chain", "migrated_papers", "contained_verdicts"):  # difflib, on pairs of lines that a bound lets through
        assert not re.search("ArrowEvalPython|MapInArrow|BatchEvalPython", text)


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_quantity > 10").select("l_orderkey", "l_linenumber")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10" in text
    assert re.search(r"ReadSchema: struct<l_orderkey:\w+,l_linenumber:\w+,l_quantity:[\w(),]+>", text)
    text = plan(catalog.queries()["missing_numbers"](spark, SF))
    assert "l_extendedprice" not in text


def test_paper_rules_need_no_shuffle_but_for_the_similarity(spark):
    df = exam_queries.papers(spark, SF)
    assert "Exchange" not in plan(exam.assign_identity(spark.createDataFrame([], exam.PAPER)))
    assert exam.probes(df).count() >= 0


def test_views(spark):
    docs = spark.createDataFrame([("d", "a\n![x](y.png)\n")], "doc_id string, text string")
    views.register_documents(docs)
    assert spark.sql("SELECT n_lines FROM doc").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM line WHERE line_no = 2").first()[0] == 1
    assert spark.sql("SELECT ref, kind FROM image_ref").first() == ("y.png", "local")
    papers = exam_queries.annotated_papers(spark, SF)
    views.register_papers(papers)
    got = spark.sql("SELECT verdict, count(*) AS n FROM paper_quality GROUP BY verdict").collect()
    n = papers.agg(F.count("*"), F.sum(F.size("units"))).first()
    assert {r["verdict"] for r in got} == {"PASS", "FAIL"} and sum(r["n"] for r in got) == n[0]
    assert "unit" in views.names(spark) and spark.sql("SELECT count(*) FROM unit").first()[0] == n[1]


def test_windowed_counts_on_a_stream(spark, tmp_path):
    from sheaf.streaming.ingest import windowed_counts

    rows = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts, 'a' AS event_type UNION ALL SELECT timestamp'2024-01-01 09:00:00', 'a' UNION ALL SELECT timestamp'2024-01-01 00:50:00', 'a'")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = windowed_counts(stream).writeStream.outputMode("append").format("memory").queryName("counted").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT n FROM counted").collect()
    assert [r["n"] for r in got] == [2]
    assert windowed_counts(rows).agg(F.sum("n")).first()[0] == 3


@pytest.mark.parametrize("name, most", [("range_answers", 3), ("inline_answers", 2), ("table_answers", 3), ("display_forms", 2)])
def test_texts_are_parsed_once(spark, name, most):
    text = catalog.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= text.count("regexp_extract_all(") <= most
