"""Markdown lines to HTML, safe excerpts, and repairs of markup in a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.text import split_lines, strip

# Tags that an excerpt keeps, and attributes that are safe in them.
KEPT_TAGS = "img|table|tr|td|th|div|br|hr|sup|sub|b|i|u|center"
SAFE_ATTRIBUTE = r"(?:src|alt|width|height|style|align|colspan|rowspan|border|class)=(?:\"(?!\s*(?i:javascript|data):)[^\"<>]*\"|'(?!\s*(?i:javascript|data):)[^'<>]*'|[\w.%#-]+)"


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def to_html(text: Column) -> Column:
    """Headings (level four at most), rules, HTML lines as they are, other lines as paragraphs."""

    def line(x: Column) -> Column:
        s = strip(x)
        level = F.least(F.char_length(F.regexp_extract(s, r"^(#{1,6})\s", 1)), F.lit(4)).cast("string")
        head = F.concat(F.lit("<h"), level, F.lit(">"), escaped(F.regexp_replace(s, r"^#{1,6}\s+", "")), F.lit("</h"), level, F.lit(">"))
        return F.when(s == "", "").when(s.rlike("^(---|\\*\\*\\*)$"), "<hr>").when(s.rlike("^<"), s).when(s.rlike(r"^#{1,6}\s"), head).otherwise(F.concat(F.lit("<p>"), escaped(s), F.lit("</p>")))

    return F.array_join(F.filter(F.transform(split_lines(text), line), lambda x: x != ""), "\n")


def page(title: Column, body: Column) -> Column:
    return F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), escaped(title), F.lit("</title></head><body>\n"), body, F.lit("\n</body></html>"))


def excerpt(lines: Column) -> Column:
    """Lines (array) as HTML in which only KEPT_TAGS are tags, and these only where all their
    attributes are SAFE_ATTRIBUTE: others are shown as text, so nothing in them runs."""
    text = escaped(F.array_join(lines, "<br>\n"))
    return F.regexp_replace(text, rf"(?i)&lt;(/?(?:{KEPT_TAGS})(?:\s+{SAFE_ATTRIBUTE})*\s*/?)&gt;", "<$1>")


def outside_math(line: Column, old: str, new: str) -> Column:
    """Replace a string where it is not between dollars."""
    parts = F.split(line, r"\$", -1)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(old), F.lit(new))).otherwise(p)), "$")


def repaired_line(line: Column) -> Column:
    r"""In table lines a literal \n is a line break; outside math \quad is a blank."""
    fixed = F.when(line.rlike(r"<td|^\s*\|"), F.regexp_replace(line, r"\\n(?![a-z])", "<br>")).otherwise(line)
    return outside_math(fixed, "\\quad", " ")


def rewritten_refs(text: Column, mapping: Column) -> Column:
    """Image targets by a map<string,string>; others stay."""
    pattern = r"(?<=src=\")[^\"]+(?=\")|(?<=\]\()[^)\s]+(?=\))"
    refs = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    new = F.transform(refs, lambda r: F.coalesce(F.try_element_at(mapping, r), r))
    return F.array_join(F.concat(F.flatten(F.zip_with(F.slice(gaps, 1, F.size(refs)), new, lambda g, r: F.array(g, r))), F.slice(gaps, F.size(refs) + 1, 1)), "")
