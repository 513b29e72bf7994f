"""Near copies inside a document: lines that repeat another with a difference, and doubled numbered lines.

difflib's matching blocks decide, and Python's own matcher computes them; but what two lines can have
in common at most is their characters, each as often as the rarer side has it. Only pairs whose
bound reaches what is asked for, or the best so far, are matched (see functions.similarity). Lines go to
Python as arrays of their document's row: nothing shuffles, and no line is carried once a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import places, similarity
from sheaf.functions.text import ASCII_SPACE, SPACE, computed, is_ascii, let, split_lines
from sheaf.operators.exam import _text

# Forms that differ in print only, commands, patterns of lines, and limits.
SAME = {"（": "(", "）": ")", "，": ",", "。": ".", "．": ".", "：": ":", "；": ";", "、": ",", "“": '"', "”": '"', "％": "%", "＋": "+", "－": "-", "＝": "="}
SMALL = dict(zip("₀₁₂₃₄₅₆₇₈₉⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", "01234567890123456789+-", strict=True))
GONE = "·"
WRAPPED = [r"\\(?:underline|underdot|overline|dot|overset\{[^{}]*\}|underset\{[^{}]*\})\{([^{}]*)\}", r"\\(?:mathrm|text|mathbf|mathit|rm|displaystyle|left|right|ce)\{([^{}]*)\}"]
SPACING = r"\\(?:quad|qquad|cdot|times|,|;|!| |%|\$)"
MARKUP = r"[$^_{}\\]"
LINE_NUMBER = r"(?U)^\s*(\d{1,3})\s*[.．、]"
NUMBERED = r"(?U)^\s*(\d{1,3})\s*[.、．]\s*(\S.*)$"
#: What stands before the body of a line that is NUMBERED.
NUMBERED_HEAD = r"(?U)^\s*\d{1,3}\s*[.、．]\s*(?=\S)"
PUNCTUATION = rf"(?U)[{SPACE},。，、：:；;（）()]+"
#: The same of ASCII, sign by sign.
ASCII_PUNCTUATION = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f ,:;()]+"
LATEX = r"\\[a-zA-Z]+\{|\^\{|_\{|\\xrightarrow|\\frac|\\sqrt|\\times|\\ce\b"
COMPLEX = r"\\mathrm|\\xrightarrow|\\xleftarrow|\\text\{|\\underset|\\overset|\\ce\{|\\frac|\\begin"
LOW, HIGH, LEAST = 0.62, 0.995, 12
NEAR_LINES, LEAST_RATIO, LEAST_BODY = 4, 0.7, 8
QUESTION, ANSWER = ("stem", "options", "material", "questions"), ("answer", "explanation")


def without_punctuation(text: Column) -> Column:
    return F.when(is_ascii(text), F.regexp_replace(text, ASCII_PUNCTUATION, "")).otherwise(F.regexp_replace(text, PUNCTUATION, ""))


def print_form(line: Column) -> Column:
    """The line without what differs in print only: blanks, widths, raised digits, LaTeX wrappers."""
    table = SAME | SMALL
    wide = lambda x: F.translate(F.regexp_replace(x, f"(?U)[{SPACE}]+", ""), "".join(table) + GONE, "".join(table.values()))
    t = F.when(is_ascii(line), F.regexp_replace(line, ASCII_SPACE, "")).otherwise(wide(line))  # all that is translated is not ASCII

    def unwrapped(x: Column) -> Column:
        for pattern in WRAPPED:
            x = F.regexp_replace(x, pattern, "$1")
        return F.regexp_replace(x, SPACING, "")

    return F.regexp_replace(let(t, lambda x: F.when(F.contains(x, F.lit("\\")), unwrapped(x)).otherwise(x)), MARKUP, "")


def counts(text: Column) -> Column:
    """array<struct<c, n>>: the text's characters and how often it has each."""
    often = lambda c: F.struct(c.alias("c"), (F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))).alias("n"))
    return F.transform(F.array_distinct(places.characters(text)), often)


def most_in_common(own: Column, other: Column) -> Column:
    """A bound of what matching blocks of two texts hold: ``own`` are the counts() of one."""
    has = lambda c: F.char_length(other) - F.char_length(F.replace(other, c, F.lit("")))
    return F.aggregate(own, F.lit(0), lambda n, x: n + F.least(x["n"], has(x["c"])).cast("int"))


def copied_lines(papers: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, unit_ord, line_no, text, cover: lines beside a unit's answer, in no question's span, that
    repeat a line of that unit's question with a difference.

    Looked at are the lines before a unit's answer spans, from the one with a number of the unit on, and
    those between them, if no question has them; not HTML, and LEAST characters or more in print
    form. A line belongs to the unit whose question's line it covers best (of ties the first); it is
    told where that is the unit itself and the cover, of the shorter line, is from ``low`` to
    ``high``: less is no copy, more is one without a difference. Both directions of a pair are one:
    cover is of the shorter. Papers that share a doc_id are looked at one by one; without units or text
    nothing is told."""
    rows = computed(_text(papers), {"_units": F.coalesce("units", F.array().cast(papers.schema["units"].dataType))})
    n = F.size("lines")
    spans = lambda u, roles: F.array_compact(F.array(*[F.when(u[r].isNotNull() & (u[r]["start"] <= u[r]["end"]), F.struct(u[r]["start"].alias("start"), u[r]["end"].alias("end"))) for r in roles]))
    inside = F.flatten(F.transform("_units", lambda u: F.flatten(F.transform(spans(u, QUESTION), lambda s: F.sequence(s["start"], s["end"])))))
    rows = computed(rows, {"_taken": F.array_distinct(inside)})
    line = lambda k: F.get("lines", k - 1)
    plain = lambda x: ~F.coalesce(x, F.lit("<")).rlike(rf"(?U)^[{SPACE}]*<")
    between = lambda a, z: F.when(a <= z, F.sequence(a, z)).otherwise(F.array().cast("array<int>"))
    untouched = lambda ks: F.when(F.forall(ks, lambda k: ~F.array_contains("_taken", k)), ks).otherwise(F.array().cast("array<int>"))

    def before(u: Column, own: Column) -> Column:
        first = F.get(own, F.lit(0))["start"]
        start = F.coalesce(F.array_max(F.filter("_taken", lambda k: k < first)), F.lit(0)) + 1
        numbers = F.transform(F.coalesce(u["question_numbers"], F.array().cast("array<int>")), lambda x: x.cast("string"))
        named = let(numbers, lambda ns: F.filter(between(start, F.least(first - 1, n)), lambda k: F.array_contains(ns, F.regexp_extract(line(k), LINE_NUMBER, 1))))
        return let(F.array_min(named), lambda a: F.when(a.isNotNull(), between(a, F.least(first - 1, n))).otherwise(F.array().cast("array<int>")))

    def gaps(own: Column) -> Column:
        return F.flatten(F.transform(own, lambda s, i: untouched(between(s["end"] + 1, F.coalesce(F.get(own, i + 1)["start"] - 1, s["end"])))))

    def windows(u: Column, i: Column) -> Column:
        found = let(F.array_sort(F.array_distinct(spans(u, ANSWER))), lambda own: F.when(F.size(own) > 0, F.array_distinct(F.concat(before(u, own), gaps(own)))).otherwise(F.array().cast("array<int>")))
        return F.transform(F.filter(found, lambda k: (k <= n) & plain(line(k))), lambda k: F.struct(i.alias("unit_ord"), k.alias("line_no"), print_form(line(k)).alias("x")))

    of_unit = lambda u, i: F.flatten(F.transform(spans(u, QUESTION), lambda s: F.transform(F.filter(between(s["start"], F.least(s["end"], n)), lambda k: (k >= 1) & plain(line(k))), lambda k: F.struct(i.alias("unit_ord"), print_form(line(k)).alias("y")))))
    rows = computed(rows, {"_open": F.filter(F.flatten(F.transform("_units", windows)), lambda w: F.char_length(w["x"]) >= LEAST)})
    rows = computed(rows.where(F.size("_open") > 0), {"_asked": F.filter(F.flatten(F.transform("_units", of_unit)), lambda q: q["y"] != "")})
    rows = rows.where(F.size("_asked") > 0).withColumn("_best", similarity.best_covers(F.col("_open.x"), F.col("_asked.y"), F.lit(low)))
    told = F.transform("_open", lambda w, i: F.struct(w["unit_ord"].alias("unit_ord"), w["line_no"].alias("line_no"), line(w["line_no"]).alias("text"), F.get("_best.at", i).alias("at"), F.get("_best.cover", i).alias("cover")))
    mine = lambda w: w["cover"].between(low, high) & (F.get("_asked", w["at"])["unit_ord"] == w["unit_ord"])
    return rows.select("doc_id", F.inline(F.filter(told, mine))).select("doc_id", "unit_ord", "line_no", "text", "cover")


def line_scan(docs: DataFrame) -> DataFrame:
    """doc_id, doubled array<struct<line, again, number>>, bare_simple and bare_complex array<int>.

    doubled: numbered lines at most NEAR_LINES apart with one number and bodies of LEAST_BODY characters
    or more (punctuation aside) that are alike by LEAST_RATIO; a line is held against the few numbered
    ones that follow, so the pairs are linear. Where one body begins with the other, the ratio is that of
    their lengths; only other pairs whose lengths allow it go to Python. bare: lines with LaTeX commands
    and no dollar sign. A null text has no lines; rows that share a doc_id are looked at one by one."""
    rows = computed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), {"lines": split_lines(F.col("text"))})
    heads = F.transform("lines", lambda x, i: F.struct((i + 1).alias("line"), F.regexp_extract(x, NUMBERED_HEAD, 0).alias("head"), x.alias("x")))
    item = lambda h: F.struct(h["line"].alias("line"), F.regexp_extract(h["head"], r"(?U)\d{1,3}", 0).alias("number"), without_punctuation(F.substr(h["x"], F.char_length(h["head"]) + 1)).alias("body"))
    sized = lambda a: F.struct(a["line"].alias("line"), a["number"].alias("number"), a["body"].alias("body"), F.char_length(a["body"]).alias("n"))
    has = lambda x: F.contains(x, F.lit("\\")) | F.contains(x, F.lit("^{")) | F.contains(x, F.lit("_{"))  # noqa: E731  (in all that LATEX matches)
    bare = F.filter(F.transform("lines", lambda x, i: F.when(has(x) & ~F.contains(x, F.lit("$")) & x.rlike(LATEX), F.struct((i + 1).alias("line"), x.rlike(COMPLEX).alias("complex")))), lambda b: b.isNotNull())
    rows = computed(rows.select("doc_id", "lines"), {"_items": F.transform(F.transform(F.filter(heads, lambda h: h["head"] != ""), item), sized), "_bare": bare}).drop("lines")
    most = lambda a, b: F.lit(2.0) * F.least(a["n"], b["n"]) / (a["n"] + b["n"])  # noqa: E731  (what the ratio is at most)
    close = lambda a: lambda b: (a["number"] == b["number"]) & (b["line"] - a["line"] <= NEAR_LINES) & (F.least(a["n"], b["n"]) >= LEAST_BODY) & (most(a, b) >= LEAST_RATIO)
    begins = lambda a, b: F.startswith(a["body"], b["body"]) | F.startswith(b["body"], a["body"])

    def pair(a: Column):
        return lambda b: let(begins(a, b), lambda sure: F.struct(a["line"].alias("line"), b["line"].alias("again"), a["number"].alias("number"), F.when(~sure, a["body"]).alias("x"), F.when(~sure, b["body"]).alias("y")))

    rows = computed(rows, {"_pairs": F.flatten(F.transform("_items", lambda a, i: F.transform(F.filter(F.slice("_items", i + 2, NEAR_LINES), close(a)), pair(a))))}).drop("_items")
    rows = rows.withColumn("_alike", similarity.alike(F.col("_pairs.x"), F.col("_pairs.y"), F.lit(LEAST_RATIO)))
    sure = F.filter("_pairs", lambda p, i: p["x"].isNull() | F.get("_alike", i))
    some = lambda c: F.transform(F.filter("_bare", lambda b: b["complex"] == c), lambda b: b["line"])
    told = F.transform(sure, lambda p: F.struct(p["line"].alias("line"), p["again"].alias("again"), p["number"].alias("number")))
    return rows.select("doc_id", told.alias("doubled"), some(F.lit(False)).alias("bare_simple"), some(F.lit(True)).alias("bare_complex"))
