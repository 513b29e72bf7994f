"""Pages for people to review samples: worksheets and HTML. Inputs are samples of stated size
(see operators.sampling); a page is one row for each group of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import markup
from sheaf.operators.spans import is_span


def _cut(lines: Column, span: Column, most: int) -> Column:
    """At most so many lines of a span."""
    n = F.least(span["end"] - span["start"] + 1, F.lit(most))
    return F.when(is_span(span["start"], span["end"], F.size(lines)), F.slice(lines, span["start"], n))


def worksheet(items: DataFrame, most: int = 18) -> DataFrame:
    """paper, page: Markdown with each item (paper, item, title, lines, span) and its first lines."""
    body = F.coalesce(F.array_join(F.transform(_cut(F.col("lines"), F.col("span"), most), lambda x: F.concat(F.lit("> "), x)), "\n"), F.lit("> (no lines)"))
    entry = F.concat(F.lit("## "), F.col("item"), F.lit(" "), F.coalesce("title", F.lit("")), F.lit("\n\n"), body, F.lit("\n\nlabel: \nnote: \n"))
    rows = items.select("paper", F.struct(F.col("item"), entry.alias("x")).alias("e"))
    return rows.groupBy("paper").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["x"]), "\n").alias("page"))


def review_html(items: DataFrame) -> DataFrame:
    """paper, page: the same items as HTML, with tags that are safe and a field for the label."""
    body = F.coalesce(markup.excerpt(F.when(is_span(F.col("span.start"), F.col("span.end"), F.size("lines")), F.slice("lines", F.col("span.start"), F.col("span.end") - F.col("span.start") + 1))), F.lit("(no lines)"))
    head = markup.escaped(F.concat_ws(" ", "item", "title"))
    entry = F.concat(F.lit("<section><h3>"), head, F.lit("</h3>\n"), body, F.lit('\n<p><input name="'), markup.escaped(F.col("item")), F.lit('"></p></section>'))
    rows = items.select("paper", F.struct(F.col("item"), entry.alias("x")).alias("e"))
    pages = rows.groupBy("paper").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["x"]), "\n").alias("body"))
    return pages.select("paper", markup.page(F.col("paper"), F.col("body")).alias("page"))
