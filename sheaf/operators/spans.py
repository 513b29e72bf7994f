"""Lines and spans of documents. A span is closed and 1-based; every join on a range also has
the document's equality, so it plans as a hash join with the range as its residual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.text import split_lines


def lines_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, line: the base relation."""
    return docs.select(key, F.posexplode(split_lines(F.col(text))).alias("pos", "line")).select(key, (F.col("pos") + 1).alias("line_no"), "line")


def is_span(start: Column, end: Column, n_lines: Column) -> Column:
    return F.coalesce((start >= 1) & (start <= end) & (end <= n_lines), F.lit(False))


def clamped(start: Column, end: Column, n_lines: Column) -> Column:
    """Span within 1..n_lines, its ends in order; null stays null."""
    a, b = (F.least(F.greatest(c, F.lit(1)), n_lines) for c in (start, end))
    return F.when(start.isNotNull() & end.isNotNull(), F.struct(F.least(a, b).alias("start"), F.greatest(a, b).alias("end")))


def span_text(lines: Column, start: Column, end: Column) -> Column:
    """Text of a span of an array of lines, null if it is none. Needs no shuffle."""
    return F.when(is_span(start, end, F.size(lines)), F.array_join(F.slice(lines, start, end - start + 1), "\n"))


def span_lines(lines: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines with the spans (key, start, end, ...) that cover them."""
    s = spans.withColumnRenamed(key, "_key")
    return lines.join(s, (lines[key] == s["_key"]) & lines["line_no"].between(s["start"], s["end"])).drop("_key")


def uncovered(lines: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines that no span covers."""
    s = spans.select(F.col(key).alias("_key"), "start", "end")
    return lines.join(s, (lines[key] == s["_key"]) & lines["line_no"].between(s["start"], s["end"]), "left_anti")


def sections(headings: DataFrame, ends: DataFrame, key: str = "doc_id") -> DataFrame:
    """Headings (key, line_no, title) as a partition of each document (ends: key, n_lines):
    a section reaches to the line before the next heading; lines before the first one, or all
    where there is none, are section 0. Titles that repeat are numbered by ``occurrence``."""
    rows = headings.select(key, F.col("line_no").cast("long").alias("line_no"), "title").unionByName(ends.select(key, F.lit(1).cast("long").alias("line_no"), F.lit(None).cast("string").alias("title")))
    rows = rows.groupBy(key, "line_no").agg(F.max("title").alias("title"))
    by = Window.partitionBy(key).orderBy("line_no")
    n = ends.select(key, F.col("n_lines").cast("long").alias("n_lines"))
    rows = rows.join(n, key)
    return rows.select(
        key,
        F.row_number().over(by).cast("long").alias("ordinal"),
        "title",
        F.col("line_no").alias("start_line"),
        F.coalesce(F.lead("line_no").over(by) - 1, F.col("n_lines")).alias("end_line"),
        F.row_number().over(Window.partitionBy(key, "title").orderBy("line_no")).cast("long").alias("occurrence"),
        F.col("title").isNull().alias("derived"),
    )


def located(points: DataFrame, marks: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Points (key, at, ...) with the ``value`` of the last mark (key, at, value) at or before
    them: one union and one window, whatever the number of marks."""
    both = points.withColumns({value: F.lit(None).cast(marks.schema[value].dataType), "_mark": F.lit(0)}).unionByName(marks.select(key, at, value).withColumn("_mark", F.lit(1)), allowMissingColumns=True)
    by = Window.partitionBy(key).orderBy(at, F.desc("_mark")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(value, F.last(value, True).over(by)).where("_mark = 0").drop("_mark")


def nearest(points: DataFrame, spans: DataFrame, key: str, name: str, most: int | None = None) -> DataFrame:
    """Points (key, line_no, ...) with the span (key, start, end, name) of the smallest gap,
    then the smallest start, then name; null beyond ``most`` lines or without spans."""
    s = spans.select(F.col(key).alias("_key"), "start", "end", F.col(name).alias("_name"))
    gap = F.greatest(F.col("start") - F.col("line_no"), F.col("line_no") - F.col("end"), F.lit(0))
    met = points.join(s, F.col(key) == F.col("_key"), "left").withColumn("gap", gap)
    best = F.min(F.when(F.col("gap").isNotNull() & (F.lit(most is None) | (F.col("gap") <= (most or 0))), F.struct("gap", "start", "_name"))).alias("b")
    return met.groupBy(*points.columns).agg(best).select(*points.columns, F.col("b._name").alias(name), F.col("b.gap").alias("gap"))


def owners(lines: DataFrame, spans: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each covered line with one span, the first by ``order``."""
    by = Window.partitionBy(key, "line_no").orderBy(*order)
    return span_lines(lines, spans, key).withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")
