"""Temporary views, so that the engine's relations can be used from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import text
from sheaf.operators import exam, spans


def register_documents(docs: DataFrame) -> None:
    """``doc`` (doc_id, text, sha256, n_lines), ``line`` (doc_id, line_no, line) and ``image_ref``
    (doc_id, line_no, ref, kind) over documents (doc_id, text). Nothing is computed until used."""
    lines = spans.lines_of(docs)
    docs.select("doc_id", "text", F.sha2("text", 256).alias("sha256"), F.size(text.split_lines(F.col("text"))).alias("n_lines")).createOrReplaceTempView("doc")
    lines.createOrReplaceTempView("line")
    refs = lines.where(F.contains("line", F.lit("![")) | F.contains("line", F.lit("<img"))).select("doc_id", "line_no", F.explode(text.image_refs(F.col("line"))).alias("ref"))
    refs.withColumn("kind", text.ref_kind(F.col("ref"))).createOrReplaceTempView("image_ref")


def register_papers(papers: DataFrame) -> None:
    """``paper_quality``, ``paper_disposition``, ``unit``, ``material`` and ``probe`` over papers
    as operators.exam has them."""
    exam.quality(papers).createOrReplaceTempView("paper_quality")
    exam.dispositions(papers).createOrReplaceTempView("paper_disposition")
    exam.unit_records(papers).createOrReplaceTempView("unit")
    exam.shared_materials(papers).createOrReplaceTempView("material")
    exam.probes(papers).createOrReplaceTempView("probe")


def names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.isTemporary)
