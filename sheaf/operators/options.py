"""Options of choice questions, told from the marks in a span of lines.

Four kinds of mark are looked for in turn: clean ones (`A.`), ones glued to a digit (`2D.`), ones with
a blank only (`D 文`), and lines without any mark. All are events of one array, by kind and place,
and one fold over it keeps what has been found so far. Only the first kind may come in any order; the
others must be the next letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import computed, find_all, let, strip

# Marks of options, and words that a lone letter with a blank begins a sentence with.
CLEAN = r"(?U)(?<![A-Za-z0-9_])([A-Ha-h])\s*[.．、:，。)）]"
GLUED = r"(?U)(?<![A-Za-z0-9_])\d([A-H])\s*[.．、](?![0-9\\^_{}])"
ANY_GLUED = r"(?U)(?<![A-Za-z0-9_])\d[A-H]\s*[.．、]"
SPACED = r"^[ \u00a0]*([A-Ha-h])[ \u00a0]{1,3}(?=[\u4e00-\u9fff])"
PROSE = r"^[ \u00a0]*[A-Ha-h][ \u00a0]+(?:是|有|在|了|和|与|或|被|把|对|从|到|为|要|会|能|可|这|那|其|其中|年|月|日)"
NUMBERED = r"(?U)^\d+\s*[.．、\\]"
CHOICES = ("single_choice", "multiple_choice", "true_false")

MARK = "struct<label:string,start_line:int,end_line:int>"
LETTERS = "ABCDEFGH"


def _clean(line: Column) -> Column:
    """Labels of clean marks; one that follows another with only blanks between is the other's text."""
    apart = lambda gaps: lambda label, k: (k == 0) | (strip(F.get(gaps, k)) != "")
    return let(F.split(line, CLEAN, -1), lambda gaps: F.filter(F.transform(find_all(line, CLEAN, 1), F.upper), apart(gaps)))


def _spaced(line: Column) -> Column:
    return F.when(line.rlike(PROSE), F.array().cast("array<string>")).otherwise(F.transform(find_all(line, SPACED, 1), F.upper))


def _unmarked(line: Column) -> Column:
    """Whether the line may be an option's text, without any kind of mark."""
    t = strip(line)
    other = t.startswith("<") | t.startswith("#") | t.startswith("---") | t.rlike(NUMBERED)
    return (F.char_length(t) >= 4) & ~other & ~line.rlike(CLEAN) & ~line.rlike(ANY_GLUED) & ~line.rlike(PROSE) & ~line.rlike(SPACED)


def _events(body: Column, start: Column) -> Column:
    """array<struct<kind, label, line>> in the order in which the fold takes them."""

    def of(kind: int, labels) -> Column:
        event = lambda i: lambda label: F.struct(F.lit(kind).alias("kind"), label.alias("label"), (start + i).cast("int").alias("line"))
        return F.flatten(F.transform(body, lambda x, i: F.transform(labels(x), event(i))))

    nothing = lambda x: F.when(_unmarked(x), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(of(1, _clean), of(2, lambda x: find_all(x, GLUED, 1)), of(3, _spaced), of(4, nothing))


def _step(acc: Column, e: Column) -> Column:
    has = lambda label: F.exists(acc["marks"], lambda m: m["label"] == label)
    top = F.array_max(F.transform(acc["marks"], lambda m: m["label"]))
    following = F.when(top.isNull(), F.lit("A")).otherwise(F.nullif(F.substr(F.lit(LETTERS), F.instr(F.lit(LETTERS), top) + 1, F.lit(1)), F.lit("")))
    later = (e["kind"] < 4) | (e["line"] > acc["last"])
    full = (e["kind"] == 4) & F.forall(F.array(*map(F.lit, "ABCD")), has)
    label = F.when(e["kind"] == 4, following).otherwise(e["label"])
    new = later & ~full & F.when(e["kind"] == 1, ~has(e["label"])).otherwise(label.isNotNull() & (label == following))
    mark = lambda label, a: F.array(F.struct(label.alias("label"), a.cast("int").alias("start_line"), e["line"].alias("end_line")))
    last = F.get(acc["marks"], F.size(acc["marks"]) - 1)
    marks = F.when(F.coalesce(new, F.lit(False)), F.concat(acc["marks"], mark(label, e["line"])))
    marks = marks.when(full & later, F.concat(F.slice(acc["marks"], 1, F.size(acc["marks"]) - 1), mark(last["label"], last["start_line"]))).otherwise(acc["marks"])
    moved = F.coalesce(new, F.lit(False)) | (full & later)
    return F.struct(F.when(moved, F.greatest(acc["last"], e["line"])).otherwise(acc["last"]).alias("last"), marks.cast(f"array<{MARK}>").alias("marks"))


def _in_order(marks: Column) -> Column:
    by = F.array_sort(F.transform(marks, lambda m: F.struct(m["start_line"].alias("start_line"), m["end_line"].alias("end_line"), m["label"].alias("label"))))
    return F.transform(by, lambda m: F.struct(m["label"].alias("label"), m["start_line"].alias("start_line"), m["end_line"].alias("end_line")))


def option_marks(lines: Column, start: Column, end: Column) -> Column:
    """array<struct<label, start_line, end_line>> of the options A to H in lines ``start`` to ``end``
    (from 1), in order of place. Only marks that stand in the lines are told; a line without one is
    the next option after the last mark, or once A to D are there more of the last option. A span
    without lines gives none. At most eight options are held, so a fold's state is small."""
    body = F.slice(lines, start, F.greatest(F.least(end, F.size(lines)) - start + 1, F.lit(0)))
    first = F.struct((start - 1).cast("int").alias("last"), F.array().cast(f"array<{MARK}>").alias("marks"))
    return let(F.aggregate(_events(body, start), first, _step, lambda acc: acc["marks"]), _in_order)


def _inside(span: Column, lines: Column) -> Column:
    return F.coalesce((span["start"] >= 1) & (span["start"] <= span["end"]) & (span["end"] <= F.size(lines)), F.lit(False))


def with_options(units: DataFrame) -> DataFrame:
    """``units`` with ``options`` completed from their lines, and ``option_note``.

    ``units`` are rows with lines (array<string>), unit_type, question_type, options_lines and
    questions_lines (struct<start, end>, 1-based), and options (array of label and lines, or null).

    Without declared options all that are found are taken (NO_LABELS where there are none). Found
    runs from A to D or beyond that lack a declared label prove it to be text: they replace what was
    declared (PRUNED). Else labels that are lacking are added (RECOVERED). A composite choice unit that
    declares neither options nor their lines gets those of its questions' lines (COMPOSITE). Spans
    that are not in the lines, and null lines, leave a unit as it is. Other columns stay.
    """
    declared = F.coalesce("options", F.array().cast(f"array<{MARK}>"))
    composite = (F.col("unit_type") == "composite_question") & (F.size(declared) == 0) & F.col("options_lines").isNull() & F.col("question_type").isin(*CHOICES)
    span = F.when(F.coalesce(composite, F.lit(False)), F.col("questions_lines")).otherwise(F.col("options_lines"))
    rows = computed(units, {"_declared": declared, "_span": F.when(_inside(span, F.col("lines")), span), "_composite": F.coalesce(composite, F.lit(False))})
    rows = computed(rows, {"_found": F.when(F.col("_span").isNotNull(), option_marks(F.col("lines"), F.col("_span.start"), F.col("_span.end"))).otherwise(F.array().cast(f"array<{MARK}>"))})
    labels = lambda c: F.transform(c, lambda m: m["label"])
    run = F.size("_found").between(4, len(LETTERS)) & (F.array_join(labels("_found"), "") == F.substr(F.lit(LETTERS), F.lit(1), F.size("_found")))
    odd, lacking = F.array_except(labels("_declared"), labels("_found")), F.array_except(labels("_found"), labels("_declared"))
    known = F.size("_declared") > 0
    note = F.when(F.col("_span").isNull() | (F.col("_composite") & (F.size("_found") == 0)), F.lit(None)).when(F.col("_composite"), "COMPOSITE")
    note = note.when(~known & (F.size("_found") == 0), "NO_LABELS").when(~known, "FOUND").when(run & (F.size(odd) > 0), "PRUNED").when(F.size(lacking) > 0, "RECOVERED")
    rows = computed(rows, {"option_note": note})
    added = _in_order(F.concat("_declared", F.filter("_found", lambda m: ~F.array_contains(labels("_declared"), m["label"]))))
    out = F.when(F.col("option_note").isin("COMPOSITE", "FOUND", "PRUNED"), F.col("_found")).when(F.col("option_note") == "RECOVERED", added).otherwise(F.col("options"))
    return rows.select(*[out.alias(c) if c == "options" else F.col(c) for c in units.columns], "option_note")
