"""Exam papers: sections, identity, quality rules, dispositions, probes, answer binding.

A paper is one row with its lines and units as arrays, so each rule is a projection: nothing
shuffles, and a scan is all that a corpus costs. Spans are struct<start, end>, closed, 1-based;
units are known by position, as unit_ids may repeat.
"""

from __future__ import annotations

import functools
import os.path
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import places, similarity
from sheaf.functions.exam_text import leading_number
from sheaf.functions.text import OTHER_ENDS, SPACE, compact, computed, first_match, has_other_ends, let, split_lines, strip, without_last_empty
from sheaf.operators.qc import worst

# Patterns of the paper format.
META = r"<!--\s*META:[^>]*-->\n?"
SECTION_LINE = r"^#{1,4}\s*(?:第[一二三四五]部分|[一二三四五六七八九十]{1,3}\s*[、．.]|考点|考向|专题|模块)"
SUB_QUESTION = r"^\s*[（(]\s*\d{1,3}\s*[）)]|^\s*[①②③④⑤⑥⑦⑧⑨⑩]"
HEAD_PREFIX = r"(?U)^(?:#{1,6}\s*)?(?:第[一二三四五]部分\s*)?(?:[一二三四五六七八九十]{1,3}\s*[、．.]\s*|\d{1,3}\s*\\?\s*[.、．]\s*|[\s【】()（）☑√✓*·\-—:：。.、_]+)*"
ANSWER_WORD = "答案|解析|评分"
NUMBERING = r"\d{1,3}\s*[.、．]|[一二三四五六七八九十]{1,3}\s*[、．]|模块|任选|考点|考向|专题|针对训练|汇编|部分|[A-ZＡ-Ｚ]\s*[组組]"
IMAGE_LINE = r"<img\s|!\[[^\]]*\]\("
TABLE_LINE = r"^\s*\|.*\|\s*$|<table|</tr>"
NOTICE = "考生须知|注意事项|答题卡|考场纪律|考[生试]须知"
INSTRUCTION = r"本大题共|请将答案.{0,10}答题卡|在答题卡上|答题卡指定区域|考试时间\s*\d|注意事项"
#: One of these is in all that INSTRUCTION matches.
INSTRUCTS = ("本大题共", "答题卡", "考试时间", "注意事项")
ESSENTIAL = "任选|不少于|不超过|按要求作答|保留.{0,4}小数|写一篇|自拟"
GUIDANCE = "选出.{0,10}(选项|答案)|(涂黑|填涂|填写)该项|将该项.{0,6}(涂黑|填涂|填写)|填入.{0,12}(单词|空白|空格|表格)|完成下列各题|完成题目|根据要求写作"
PAPER_LINE = (
    r"^#{1,4}\s*\d{4}\s*北京|^#{1,4}\s*[一二三四五六七八九十]+\s*[、．.]\s*(单选|选择|多选|填空|非选择|简答|实验|计算|作文|书面表达|阅读|完形|听力|解答|判断)"
    r"|^#{1,4}\s*参考答案|^#{1,4}\s*答案与解析|^#{1,4}\s*评分标准|共\s*\d+\s*(小题|题).{0,12}(共\s*\d+\s*分|每题|每小题)|^班级[：:]|^\s*姓名[：:]|^\s*学号[：:]"
    r"|考试时间\s*\d|满分\s*\d+|^\s*注意事项"
)
#: What a line that PAPER_LINE matches begins with.
PAPER_BEGINS = "#共班姓学考满注"
ZONES = {"stem": ("“题干区开始”", "“题干区结束”"), "answer": ("“答案区开始”", "“答案区结束”")}
#: A stem and an explanation that are more alike are one text (C11).
ALIKE = 0.85
ROLES = ("stem", "options", "answer", "explanation", "extra", "material", "questions")

SPAN = "struct<start:int,end:int>"
UNIT = "struct<unit_id:string,unit_type:string,question_numbers:array<int>,printed_number:array<string>,section:string,section_ref:string,basis:string,basis_evidence:string," + ",".join(f"{r}:{SPAN}" for r in ROLES) + ">"
PAPER = f"doc_id string, text string, rendered string, annotated string, source_file string, identity_version int, units array<{UNIT}>"


def text_lines(text: Column) -> Column:
    """Lines of a source without META comments."""
    bare = F.when(F.contains(text, F.lit("META:")), F.regexp_replace(text, META, "")).otherwise(text)
    return split_lines(bare)


#: A column that spares a second split of the text: see with_lines().
LINES = "_lines"


def with_lines(papers: DataFrame) -> DataFrame:
    """``papers`` with LINES, which the steps here and the fixers take instead of the text's lines. Whoever
    changes the text must drop them; with_facts() ends them."""
    return papers if LINES in papers.columns else computed(papers, {LINES: text_lines(F.col("text"))})


def _text(papers: DataFrame) -> DataFrame:
    """``papers`` with ``lines``, those of the source without META comments."""
    if LINES in papers.columns:
        return papers.withColumn("lines", F.col(LINES))
    return computed(papers, {"lines": text_lines(F.col("text"))})


def _at(lines: Column, no: Column) -> Column:
    return F.get(lines, no - 1)


def is_paper_line(line: Column) -> Column:
    """A line of the paper, not of a question. The patterns hold where the line begins."""
    begins = F.regexp_extract(line, f"(?U)^[{SPACE}]*+([{PAPER_BEGINS}])?", 1) != ""  # few lines do; the patterns ask for nothing else
    return F.coalesce(begins & strip(line).rlike(f"(?U)^(?:{PAPER_LINE})"), F.lit(False))


def is_heading(line: Column) -> Column:
    """A section's heading: not one of answers, nor a sub-question's."""
    s = strip(line)
    head = F.substring(F.regexp_replace(s, HEAD_PREFIX, ""), 1, 10)
    title = F.regexp_replace(s, r"^#{1,4}\s*", "")
    return F.contains(line, F.lit("#")) & F.startswith(s, F.lit("#")) & s.rlike(SECTION_LINE) & ~head.rlike(ANSWER_WORD) & ~title.rlike(SUB_QUESTION)


def sections(lines: Column) -> Column:
    """array<struct<id, title, ordinal, start_line, end_line, derived>> that partition the
    lines. What stands before the first heading, or all without any, is the derived S0."""
    title = lambda x: F.substring(F.regexp_replace(strip(x), r"^#{1,4}\s*", ""), 1, 40)
    heads = F.filter(F.transform(lines, lambda x, i: F.when(is_heading(x), F.struct((i + 1).alias("at"), title(x).alias("title")))), lambda h: h.isNotNull())
    last = F.greatest(F.size(lines), F.lit(1))
    lead = F.array(F.struct(F.lit(1).alias("at"), F.lit(None).cast("string").alias("title"), F.lit(True).alias("derived")))
    none = F.array().cast("array<struct<at:int,title:string,derived:boolean>>")

    def whole(h: Column) -> Column:
        first = F.coalesce(F.get(h, F.lit(0))["at"], last + 1)
        return F.concat(F.when(first > 1, lead).otherwise(none), F.transform(h, lambda x: F.struct(x["at"].alias("at"), x["title"].alias("title"), F.lit(False).alias("derived"))))

    def told(a: Column) -> Column:
        n_lead = F.size(F.filter(a, lambda s: s["derived"]))
        return F.transform(
            a,
            lambda s, i: F.struct(
                F.concat(F.lit("S"), i.cast("string")).alias("id"),
                s["title"].alias("title"),
                F.when(s["derived"], 0).otherwise(i - n_lead + 1).alias("ordinal"),
                s["at"].alias("start_line"),
                F.coalesce(F.get(a, i + 1)["at"] - 1, last).alias("end_line"),
                s["derived"].alias("derived"),
            ),
        )

    return let(heads, lambda h: let(whole(h), told))


def unit_start(u: Column) -> Column:
    return F.coalesce(u["stem"]["start"], u["material"]["start"], u["questions"]["start"], u["options"]["start"])


def assign_identity(papers: DataFrame, keep_lines: bool = False) -> DataFrame:
    """Papers of identity version 2: ``sections``, and each unit's section by its first line,
    the first section where it has none. Units are known by position. ``keep_lines``: see with_lines()."""
    papers = with_lines(papers) if keep_lines else papers
    rows = computed(_text(papers), {"sections": sections(F.col("lines"))})

    def placed(u: Column) -> Column:
        inside = F.filter("sections", lambda s: unit_start(u).between(s["start_line"], s["end_line"]))
        own = F.coalesce(F.get(inside, F.lit(0)), F.get(F.col("sections"), F.lit(0)))
        return let(own, lambda s: u.withField("section_ref", s["id"]).withField("section", s["title"]))

    return computed(rows, {"units": F.transform("units", placed), "identity_version": F.lit(2)}).drop("lines")


def _issue(code: str, severity: str, detail: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), detail.cast("string").alias("detail"))


def _when(code: str, holds: Column, detail: Column | None = None, severity: str = "FAIL") -> Column:
    return F.when(F.coalesce(holds, F.lit(False)), _issue(code, severity, F.lit("") if detail is None else detail))


def _told(a: Column, most: int = 5) -> Column:
    return F.array_join(F.slice(a, 1, most).cast("array<string>"), ",")


def covered(units: Column) -> Column:
    """Line numbers in any span of any unit."""
    each = F.transform(units, lambda u: F.flatten(F.array_compact(F.array(*[F.when(u[r]["start"] <= u[r]["end"], F.sequence(u[r]["start"], u[r]["end"])) for r in ROLES]))))
    return F.array_distinct(F.flatten(each))


def claimed_numbers(units: Column) -> Column:
    """All question numbers of all units, as often as they are claimed."""
    return F.flatten(F.transform(units, lambda u: F.coalesce(u["question_numbers"], F.array().cast("array<int>"))))


def evidence_lines(evidence: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(evidence, F.lit("")), F.lit(r"L(\d+)"), 1), lambda r: r.cast("int"))


def evidence_holds(u: Column, lines: Column) -> Column:
    """Whether a declared number is backed: all cited lines exist; up to the first heading among
    them each carries numbering, and a number at a line's start is one of the unit's."""
    refs = evidence_lines(u["basis_evidence"])
    inside = (F.size(refs) > 0) & F.forall(refs, lambda r: r.between(1, F.size(lines)))
    own = F.array_union(F.coalesce(u["question_numbers"], F.array().cast("array<int>")), F.coalesce(F.transform(u["printed_number"], lambda p: p.try_cast("int")), F.array().cast("array<int>")))

    def state(r: Column) -> Column:  # 2: heading, ends the check; 1: good; 0: bad
        s = strip(_at(lines, r))
        n = F.regexp_extract(s, r"^(\d{1,3})\s*[.、．]", 1)
        return F.when(s.rlike(SECTION_LINE), 2).when(~s.rlike(NUMBERING), 0).when((n != "") & ~F.array_contains(own, n.cast("int")), 0).otherwise(1)

    seen = F.transform(refs, state)
    fold = F.aggregate(seen, F.lit(1), lambda a, x: F.when(a == 1, x).otherwise(a))
    return inside & (fold >= 1)


def identity_issues(units: Column, secs: Column, lines: Column) -> Column:
    """C13 and C14 of identity version 2, array of issues.

    A number has several owners legally only if no two are in one section and at most one does
    not keep its number by declaration; kept numbers without evidence are for review."""
    n_lines = F.greatest(F.size(lines), F.lit(1))
    bad_span = F.filter(secs, lambda s: ~F.coalesce((s["start_line"] >= 1) & (s["start_line"] <= s["end_line"]) & (s["end_line"] <= n_lines), F.lit(False)))
    twice = F.size(secs) != F.size(F.array_distinct(F.transform(secs, lambda s: s["ordinal"])))
    lost = F.filter(units, lambda u: F.coalesce(u["section_ref"], F.lit("")) == "")
    claims = F.flatten(F.transform(units, lambda u: F.transform(F.coalesce(u["question_numbers"], F.array().cast("array<int>")), lambda n: F.struct(n.alias("n"), F.coalesce(u["section_ref"], F.lit("")).alias("s"), F.coalesce(u["basis"] == "keep", F.lit(False)).alias("keeps"), (F.coalesce(u["basis"] == "keep", F.lit(False)) & evidence_holds(u, lines)).alias("proved")))))

    def judged(own: Column, n: Column) -> Column:
        same = F.size(F.array_distinct(F.transform(own, lambda c: c["s"]))) < F.size(own)
        free = F.size(F.filter(own, lambda c: ~c["keeps"])) > 1
        weak = F.exists(own, lambda c: c["keeps"] & ~c["proved"])
        told = n.cast("string")
        return F.when(F.size(own) > 1, F.coalesce(_when("C13_SAME_SECTION", same, told), _when("C13_CONFLICT", free, told), _when("C13_KEEP_UNPROVED", weak, told, "PENDING_REVIEW")))

    fixed = F.array(
        _when("C13_ORDINAL", twice),
        _when("C13_SECTION_SPAN", F.size(bad_span) > 0),
        _when("C14_SCOPE_MISSING", F.size(lost) > 0, F.size(lost), "PENDING_REVIEW"),
    )
    # only numbers that are claimed twice are looked at further, and only papers that have some
    once = let(claimed_numbers(units), lambda ns: F.size(ns) == F.size(F.array_distinct(ns)))
    none = F.array().cast("array<struct<code:string,severity:string,detail:string>>")
    owned = let(claims, lambda cs: let(F.sort_array(cs), lambda so: F.transform(_repeats(so), lambda n: let(F.filter(so, lambda c: c["n"] == n), lambda own: judged(own, n)))))
    return F.array_compact(F.concat(fixed, F.when(once, none).otherwise(owned)))


def _repeats(claims: Column) -> Column:
    """Numbers that stand twice in a sorted array of claims."""
    again = F.filter(claims, lambda c, i: F.coalesce(F.get(claims, i + 1)["n"] == c["n"], F.lit(False)))
    return F.array_distinct(F.transform(again, lambda c: c["n"]))


def quality(papers: DataFrame) -> DataFrame:
    """doc_id, issues array<struct<code, severity, detail>>, verdict of each paper: see with_quality()."""
    return with_quality(papers).select("doc_id", "issues", "verdict")


def text_facts(text: Column, lines: Column | None = None) -> Column:
    """What the rules ask of a source: struct of its lines (``lines``, if they are at hand), the question
    numbers that begin them, and the places (from 1) of images, tables and lines of the paper."""
    has = lambda x, *words: functools.reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in words))
    # without a META comment, which begins with "<", what the text lacks all of its lines lack
    some = lambda places, *words: F.when(text.isNull() | has(text, "<", *words), places).otherwise(F.array().cast("array<int>"))

    def told(lines: Column) -> Column:
        where = lambda f: F.filter(F.transform(lines, lambda x, i: F.when(f(x), i + 1)), lambda n: n.isNotNull())
        return F.struct(
            lines.alias("lines"),
            F.array_distinct(F.filter(F.transform(lines, leading_number), lambda n: n.between(1, 200))).alias("numbers"),
            some(where(lambda x: has(x, "<img", "![") & x.rlike(IMAGE_LINE)), "![").alias("images"),
            some(where(lambda x: has(x, "|", "<table", "</tr>") & x.rlike(TABLE_LINE) & ~x.rlike(NOTICE)), "|").alias("tables"),
            where(is_paper_line).alias("paper"),
        )

    return let(text_lines(text), told) if lines is None else told(lines)


def rendered_facts(rendered: Column) -> Column:
    """What the rules ask of a rendered text, null as empty: struct of how often each mark of a zone
    stands in it, how many units have no answer, and lines of instructions."""
    whole = F.coalesce(rendered, F.lit(""))
    start, end = ZONES["answer"]
    marks = {f"{z}_{k}": m for z, ms in ZONES.items() for k, m in zip(("start", "end"), ms)}
    first = os.path.commonprefix(list(marks.values()))  # one search for all marks, of which none overlaps another
    found = lambda x: F.regexp_extract_all(x, F.lit(f"{first}(?:" + "|".join(m[len(first) :] for m in marks.values()) + ")"), 0)
    times = lambda hits, m: F.size(hits) - F.size(F.array_remove(hits, F.lit(m)))
    empty = lambda b: ~F.contains(b, F.lit(start)) | (F.char_length(strip(F.substring_index(F.substring_index(F.substring_index(b, start, 2), start, -1), end, 1))) < 2)
    instructs = lambda x: x.rlike(INSTRUCTION) & ~x.rlike(ESSENTIAL) & ~(F.forall(F.regexp_extract_all(x, F.lit(INSTRUCTION), 0), lambda h: h == "在答题卡上") & x.rlike(GUIDANCE))
    may_instruct = lambda x: functools.reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in INSTRUCTS))
    blocks = lambda x: let(F.split(x, ZONES["stem"][0], -1), lambda b: F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))))
    none = F.array().cast("array<string>")

    def told(x: Column) -> Column:
        counts = let(found(x), lambda hits: F.struct(*[times(hits, m).alias(name) for name, m in marks.items()]))
        return F.struct(
            counts.alias("marks"),
            F.size(F.filter(blocks(x), empty)).alias("empty"),
            F.when(may_instruct(x) & x.rlike(INSTRUCTION), F.filter(split_lines(x), lambda l: may_instruct(l) & instructs(l))).otherwise(none).alias("told"),
        )

    return let(whole, told)


def annotated_facts(annotated: Column) -> Column:
    """What the rules ask of an annotated text: struct of what stands between its line feeds without marks
    (``plain``), whether a mark holds another line end, so that these are no lines (``broken``), and the kinds
    that have another number of starts than of ends. See differs()."""
    has = lambda x: F.contains(x, F.lit("META:"))
    marks = lambda x, end: F.regexp_extract_all(x, F.lit(rf"META:(\w+):{end}"), 1)
    times = lambda a, k: F.size(a) - F.size(F.array_remove(a, k))
    odd = lambda m: F.filter(F.array_union(m["a"], m["z"]), lambda k: times(m["a"], k) != times(m["z"], k))
    uneven = lambda x: let(F.struct(marks(x, "start").alias("a"), marks(x, "end").alias("z")), odd)

    def told(lines: Column) -> Column:
        marked = F.array_join(F.filter(lines, has), "\n")  # no mark reaches beyond its line
        return let(marked, lambda m: F.struct(F.filter(lines, lambda x: ~_is_mark(x)).alias("plain"), has_other_ends(m).alias("broken"), uneven(m).alias("uneven")))

    return let(F.split(annotated, "\n", -1), lambda p: let(without_last_empty(p), told))


def _is_mark(line: Column) -> Column:
    """A line of an annotated text that is not the source's."""
    return F.startswith(line, F.lit("<!-- META:")) | F.contains(line, F.lit("META:")) & line.rlike(r"^\s*<!--\s*META:")


def is_even(facts: Column, lines: Column) -> Column:
    """Whether what stands between the line feeds of an annotated text are its lines, so that no other line ends
    are there. No line of the source has one: they are looked for in marks and in what is no line of the source."""
    return ~facts["broken"] & ((facts["plain"] == lines) | ~F.exists(F.array_except(facts["plain"], lines), has_other_ends))


def differs(annotated: Column, facts: Column, lines: Column, even: Column | None = None) -> Column:
    """Whether an annotated text without its marks has other lines than the source. Only one that is not
    ``even`` (see is_even(); of any source) is split once more."""
    slow = F.filter(split_lines(annotated), lambda x: ~_is_mark(x)) != lines
    quick = (F.size(facts["plain"]) != F.size(lines)) | (facts["plain"] != lines)
    return F.when(is_even(facts, lines) if even is None else even, quick).otherwise(slow)


#: Columns that spare the rules a look at a text, and the text that each is about.
FACTS = {"_of_text": ("text", text_facts), "_of_rendered": ("rendered", rendered_facts), "_of_annotated": ("annotated", annotated_facts)}


def _text_facts_with(facts: Column, text: Column, line: Column) -> tuple[Column, Column]:
    ended = functools.reduce(lambda a, b: a | b, (F.endswith(text, F.lit(e)) for e in "\n" + OTHER_ENDS))
    n = F.size(facts["lines"])
    places = lambda own, k: F.concat(facts[k], F.transform(own[k], lambda i: i + n))
    both = lambda own: F.struct(F.concat(facts["lines"], own["lines"]).alias("lines"), F.array_distinct(F.concat(facts["numbers"], own["numbers"])).alias("numbers"), *[places(own, k).alias(k) for k in ("images", "tables", "paper")])
    return (text != "") & ~ended & ~F.contains(text, F.lit("META:")), let(text_facts(line), both)


def _rendered_facts_with(facts: Column, rendered: Column, line: Column) -> tuple[Column, Column]:
    # behind the end of an answer nothing is an answer
    return F.endswith(rendered, F.lit(ZONES["answer"][1])), F.struct(facts["marks"].alias("marks"), facts["empty"].alias("empty"), F.concat(facts["told"], rendered_facts(line)["told"]).alias("told"))


def _annotated_facts_with(facts: Column, annotated: Column, line: Column) -> tuple[Column, Column]:
    more = F.concat(facts["plain"], F.array(line))
    return (annotated != "") & ~F.endswith(annotated, F.lit("\n")), F.struct(more.alias("plain"), facts["broken"].alias("broken"), facts["uneven"].alias("uneven"))


_WITH = {"_of_text": _text_facts_with, "_of_rendered": _rendered_facts_with, "_of_annotated": _annotated_facts_with}


def is_plain(line: str) -> bool:
    """Whether it is one line without marks."""
    return line.splitlines() == [line] and not any(m in line for m in ("META:", *(m for ms in ZONES.values() for m in ms)))


def facts_with(name: str, facts: Column, text: Column, new: Column, line: Column) -> Column:
    """The column ``name`` of FACTS of ``new``, which is ``text`` with a line feed and a plain ``line`` after it,
    from the ``facts`` of ``text``. ``new`` is looked at only where the text's end and the line could become
    one, and where ``line`` is null, which says nothing of it."""
    apart, both = _WITH[name](facts, text, line)
    return F.when(line.isNotNull() & apart, both).otherwise(FACTS[name][1](new))


def with_facts(papers: DataFrame) -> DataFrame:
    """``papers`` with the columns FACTS, where they are not there yet. Those of the text take LINES, which go."""
    own = lambda k: [F.col(LINES)] if k == "_of_text" and LINES in papers.columns else []
    lost = {k: f(F.col(c), *own(k)) for k, (c, f) in FACTS.items() if k not in papers.columns}
    return (computed(papers, lost) if lost else papers).drop(LINES)


def _some(code: str, values: Column, detail: Callable[[Column], Column]) -> Column:
    return let(values, lambda a: _when(code, F.size(a) > 0, detail(a)))


def _composite(units: Column) -> Column:
    return F.filter(units, lambda u: u["unit_type"] == "composite_question")


def _zone_issues(r: Mapping[str, Column]) -> list[Column]:
    marks = r["_of_rendered"]["marks"]
    out = [_when("C1_NO_" + z.upper() + "_" + k.upper(), marks[f"{z}_{k}"] == 0) for z in ZONES for k in ("start", "end")]
    return out + [_when("C1_UNPAIRED_" + z.upper(), marks[f"{z}_start"] != marks[f"{z}_end"]) for z in ZONES]


def _number_issues(r: Mapping[str, Column]) -> list[Column]:
    missed = let(F.coalesce(F.array_max(r["_numbers"]), F.lit(0)), lambda top: F.sort_array(F.filter(F.array_except(r["_of_text"]["numbers"], r["_numbers"]), lambda n: n <= top)))
    return [_some("C2_NUMBERS", missed, lambda a: _told(a, 20))]


def _bare_issues(r: Mapping[str, Column]) -> list[Column]:
    bare = F.filter(_composite(r["units"]), lambda u: u["material"].isNull() & u["questions"].isNull())
    return [_some("C4_COMPOSITE", bare, lambda a: _told(F.transform(a, lambda u: u["unit_id"])))]


def _free(r: Mapping[str, Column], kind: str) -> Column:
    return F.filter(r["_of_text"][kind], lambda n: ~F.array_contains(r["_covered"], n))


def _nesting_issues(r: Mapping[str, Column]) -> list[Column]:
    def crossed(u: Column) -> Column:
        m, q = u["material"], u["questions"]
        meets = ~((m["end"] < q["start"]) | (q["end"] < m["start"]))
        return F.coalesce(meets & ~((q["start"] <= m["start"]) & (m["end"] <= q["end"])), F.lit(False))

    return [_when("C12_NOT_NESTED", F.exists(_composite(r["units"]), crossed))]


#: Rules, in the order of their issues: the paper's columns that each is told from, and its issues, from those,
#: their FACTS, and what told_from() has. Codes begin with the rule's name. C11 stands between C10 and C12: see with_quality().
RULES: dict[str, tuple[frozenset[str], Callable[[Mapping[str, Column]], list[Column]]]] = {
    "C1": (frozenset({"rendered"}), _zone_issues),
    "C2": (frozenset({"text", "units"}), _number_issues),
    "C3": (frozenset({"rendered"}), lambda r: [_when("C3_ANSWERS", r["_of_rendered"]["empty"] > 0, r["_of_rendered"]["empty"])]),
    "C4": (frozenset({"units"}), _bare_issues),
    "C5": (frozenset({"text", "units"}), lambda r: [_some("C5_IMAGES", _free(r, "images"), _told)]),
    "C6": (frozenset({"text", "units"}), lambda r: [_some("C6_TABLES", _free(r, "tables"), lambda a: _told(a, 10))]),
    "C7": (frozenset({"rendered"}), lambda r: [_some("C7_INSTRUCTIONS", r["_of_rendered"]["told"], lambda a: _told(a, 1))]),
    "C9": (frozenset({"text", "units"}), lambda r: [_some("C9_PAPER_LINES", F.filter(r["_covered"], lambda n: F.array_contains(r["_of_text"]["paper"], n)), lambda a: _told(a, 3))]),
    "C8": (frozenset({"text", "annotated"}), lambda r: [_when("C8_NO_ANNOTATED", r["annotated"].isNull()), _when("C8_DIFFERS", differs(r["annotated"], r["_of_annotated"], r["_of_text"]["lines"], r["_even"]))]),
    "C10": (frozenset({"annotated"}), lambda r: [_some("C10_UNPAIRED", r["_of_annotated"]["uneven"], _told)]),
}
REPEATED = frozenset({"text", "units"})
LAST_RULES: dict[str, tuple[frozenset[str], Callable[[Mapping[str, Column]], list[Column]]]] = {
    "C12": (frozenset({"units"}), _nesting_issues),
    "C13": (frozenset({"text", "units", "sections", "identity_version"}), lambda r: [_old_owners(r)]),
}


def _second(r: Mapping[str, Column]) -> Column:
    return F.coalesce(r["identity_version"], F.lit(1)) >= 2


def _old_owners(r: Mapping[str, Column]) -> Column:
    claims = F.flatten(F.transform(r["units"], lambda u: F.transform(F.coalesce(u["question_numbers"], F.array().cast("array<int>")), lambda n: F.struct(F.coalesce(u["section"], F.lit("")).alias("s"), n.alias("n")))))
    return _when("C13_SAME_SECTION", ~_second(r) & (F.size(claims) != F.size(F.array_distinct(claims))))


def owner_issues(r: Mapping[str, Column]) -> Column:
    """C13 and C14 of identity version 2; the columns are those of the rule C13."""
    return F.when(_second(r), identity_issues(r["units"], r["sections"], r["_of_text"]["lines"])).otherwise(F.array())


def told_from(units: Column, source: Column, marked: Column) -> dict[str, Column]:
    """What several rules ask for: _numbers and _covered of the units, and _even."""
    asked = F.size(source["images"]) + F.size(source["tables"]) + F.size(source["paper"]) > 0  # few papers have a line that is looked for in spans
    return {"_numbers": F.array_distinct(claimed_numbers(units)), "_covered": F.when(asked, covered(units)), "_even": is_even(marked, source["lines"])}


def columns_of(papers: DataFrame) -> dict[str, Column]:
    """What RULES ask of papers that have FACTS."""
    names = ["text", "source_file", "annotated", "units", "identity_version", *FACTS, "_numbers", "_covered", "_even"]
    return {c: F.col(c) for c in names} | {"sections": F.col("sections") if "sections" in papers.columns else sections(F.col("_of_text.lines"))}


def is_lost(text: Column, source_file: Column) -> Column:
    return text.isNull() | source_file.isNull()


def lost_issues() -> Column:
    return F.array(_issue("C15_PROVENANCE", "FAIL", F.lit("")))


def repeated_issue(holds: Column, unit: Column | None = None) -> Column:
    return _when("C11_REPEATED_STEM", holds, unit)


def with_quality(papers: DataFrame) -> DataFrame:
    """``papers`` with issues array<struct<code, severity, detail>> and verdict: rules C1 to C15, each a
    projection of its row, so papers that share a doc_id are judged one by one.

    ``text`` null means that the source is missing or not readable, which fails alone (C15).
    ``annotated`` null means there is none (C8). Version 1 papers are held to one owner of a
    number in a section. Only C11 runs Python, on one pair of lines a unit and after all other rules, so
    that rows wait for it with their issues and not with what those are told from. Columns FACTS that
    ``papers`` has are taken as they are, and kept."""
    rows = with_facts(papers)
    rows = computed(rows, told_from(F.col("units"), F.col("_of_text"), F.col("_of_annotated")))
    r = columns_of(papers)
    first = [i for _, told in RULES.values() for i in told(r)]
    last = F.concat(F.array(*[i for _, told in LAST_RULES.values() for i in told(r)]), owner_issues(r))
    lost = is_lost(r["text"], r["source_file"])
    rows = computed(rows, {"_first": F.when(lost, lost_issues()).otherwise(F.array_compact(F.array(*first))), "_last": F.when(~lost, F.array_compact(last)), "_pairs": F.when(~lost, repeat_pairs(r["units"], r["_of_text"]["lines"]))})
    names = [c for c in papers.columns if c not in ("issues", "verdict", LINES)]
    rows = rows.select(*names, "_first", "_last", "_pairs")
    rows = rows.withColumn("_alike", similarity.first_alike(F.col("_pairs.e"), F.col("_pairs.s"), F.lit(ALIKE)))
    repeated = repeated_issue(F.col("_alike.ratio") > ALIKE, F.get("_pairs", F.col("_alike.at"))["unit"])
    rows = computed(rows, {"issues": F.concat("_first", F.array_compact(F.array(repeated)), F.coalesce("_last", F.slice("_first", 1, 0)))})
    return rows.select(*names, "issues", worst(F.transform("issues", lambda i: i["severity"])).alias("verdict"))


def repeat_pairs(units: Column, lines: Column) -> Column:
    """array<struct<unit, e, s>>: the first lines of explanation and stem of the units in which they may be
    alike by more than ALIKE."""
    pair = lambda u: F.struct(u["unit_id"].alias("unit"), _at(lines, u["explanation"]["start"]).alias("e"), _at(lines, u["stem"]["start"]).alias("s"))
    told = F.filter(units, lambda u: u["explanation"].isNotNull() & u["stem"].isNotNull())
    pairs = F.filter(F.transform(told, pair), lambda p: p["e"].isNotNull() & p["s"].isNotNull() & ~p["e"].rlike("【分析】|【解答】"))
    close = F.transform(pairs, lambda p: let(compact(p["e"]), lambda e: F.struct(p["unit"].alias("unit"), e.alias("e"), F.when(p["e"] == p["s"], e).otherwise(compact(p["s"])).alias("s"))))
    # An upper bound of the ratio, 2 * shorter / both, leaves few pairs to Python.
    short = lambda p: F.least(F.char_length(p["e"]), F.char_length(p["s"]))
    return F.filter(close, lambda p: 2.0 * short(p) > ALIKE * (F.char_length(p["e"]) + F.char_length(p["s"])))


def dispositions(papers: DataFrame) -> DataFrame:
    """doc_id, verdict, disposition: what a consumer may use. First match wins, and what cannot
    be checked is never admitted. A paper without units has no manifest."""
    rows = with_quality(with_facts(papers))
    n = F.size("_of_text.lines")
    stale = F.exists("units", lambda u: F.exists(F.array(*[u[r] for r in ROLES]), lambda s: s.isNotNull() & ~F.coalesce((s["start"] >= 1) & (s["start"] <= s["end"]) & (s["end"] <= F.greatest(n, F.lit(1))), F.lit(False))))
    out = first_match(
        [
            ("MISSING", F.col("units").isNull()),
            ("REJECTED_V1", F.coalesce("identity_version", F.lit(1)) < 2),
            ("MISSING", F.col("source_file").isNull() | F.col("text").isNull()),
            ("REJECTED_STALE", stale),
            ("REJECTED_QC_UNCOMPUTABLE", F.col("verdict").isNull()),
            ("REJECTED_QC_FAIL", F.col("verdict") == "FAIL"),
            ("ADMITTED", F.col("verdict") == "PASS"),
        ],
        "ADMITTED_PENDING_REVIEW",
    )
    return rows.select("doc_id", "verdict", out.alias("disposition"))


def unit_records(papers: DataFrame) -> DataFrame:
    """One row a unit, by position: its texts by role and its place, the consumer's relation.
    Only admitted papers should come in (see dispositions)."""
    rows = _text(papers).select("doc_id", "lines", F.posexplode("units").alias("unit_ord", "u"))
    cut = lambda s: F.when((s["start"] >= 1) & (s["start"] <= s["end"]) & (s["end"] <= F.size("lines")), F.slice("lines", s["start"], s["end"] - s["start"] + 1))
    return rows.select("doc_id", "unit_ord", "u.unit_id", "u.unit_type", "u.question_numbers", "u.section_ref", *[cut(F.col("u")[r]).alias(r) for r in ROLES])


def shared_materials(papers: DataFrame) -> DataFrame:
    """doc_id, span, units: materials with the positions of the units that use them."""
    rows = papers.select("doc_id", F.posexplode("units").alias("unit_ord", "u")).where("u.material IS NOT NULL")
    return rows.groupBy("doc_id", F.col("u.material").alias("material")).agg(F.array_sort(F.collect_list("unit_ord")).alias("units"))


# Numbers at a line's start, steps of a solution, and forms of answers.
NUMBER_LINE = r"^\s{0,3}(?:#{1,6}\s*)?(\d{1,3})\s*(?:\\?[.、．,，)）])\s*(?!\d)"
STEP_LINE = r"^\s*\d{1,3}\s*、\s*[\u4e00-\u9fff]"
ANSWER_MARKS = r"【答案】|【参考答案】|☑\s*答案|答案\s*[:：]|故选|故答案为"
ANSWER_TABLE = r"(?i)<table"
ANSWER_LETTERS = r"(?<![A-Za-z])[A-DＡ-Ｄ]{2,}(?![A-Za-z])"
ANSWER_RANGE = r"\d{1,3}\s*[-–—~]\s*\d{1,3}\s*[A-DＡ-Ｄ]{2,}"
ANSWER_SINGLE = r"(?m)^\s*(?:\\?[.、．]?\s*)?[A-DＡ-Ｄ]\s*[.。、，,;；]?\s*$"
ANSWER_PAIR = r"\d{1,3}\s*(?:\\?[.、．])?\s*(?:[A-DＡ-Ｄ]|[a-z]{3,}|[\u4e00-\u9fff]{1,8})"


def probes(papers: DataFrame) -> DataFrame:
    """doc_id, unit_ord, check, detail: P14 foreign numbers in the question, P15 in the answer
    (lines of two answers or more are shared, and free), P13 an answer without any form of one. A
    measure, not a gate."""
    recs = unit_records(papers)
    own = F.coalesce("question_numbers", F.array().cast("array<int>"))
    pairs = lambda x: F.regexp_count(x, F.lit(f"(?U){ANSWER_PAIR}"))

    def foreign(part: Column, shared: bool) -> Column:
        number = lambda x: F.regexp_extract(x, f"(?U){NUMBER_LINE}", 1)
        free = F.lit(False) if not shared else None
        odd = lambda x: ~x.rlike(f"(?U){STEP_LINE}") & (number(x) != "") & ~F.array_contains(own, number(x).try_cast("int")) & ~(free if free is not None else pairs(x) >= 2)
        return F.transform(F.filter(part, odd), number)

    body = F.when(F.col("unit_type") == "composite_question", F.col("questions")).otherwise(F.col("stem"))
    none = F.array().cast("array<string>")
    whole = F.array_join("answer", "\n")
    formed = pairs(whole) >= 2
    for form in (ANSWER_MARKS, ANSWER_TABLE, ANSWER_RANGE, ANSWER_LETTERS, ANSWER_SINGLE):
        formed = formed | whole.rlike(f"(?U){form}")
    formless = (F.size("answer") > 0) & ~formed
    flag = lambda code: lambda d: F.struct(F.lit(code).alias("check"), d.alias("detail"))
    flags = F.concat(
        F.transform(F.coalesce(foreign(body, False), none), flag("P14")),
        F.transform(F.coalesce(foreign(F.col("answer"), True), none), flag("P15")),
        F.transform(F.when(F.coalesce(formless, F.lit(False)), F.array(F.substring(strip(F.get("answer", F.lit(0))), 1, 60))).otherwise(none), flag("P13")),
    )
    return recs.select("doc_id", "unit_ord", F.explode(flags).alias("f")).select("doc_id", "unit_ord", "f.*")


def bound_answers(entries: DataFrame) -> DataFrame:
    """Answers against their source. ``entries``: value_text, form (null: verbatim), block (text
    of the cited lines, null without valid ones), document, candidates array<string>; and if there
    is such a column, cited (lines were cited, valid or not) and bind_source (entry_bound: the
    candidates are this entry's own).

    Adds tier, match, mismatch_class, lcs_share (of compressed and descriptive answers that have no
    place), source_value (what the source says) and bound_value. In this order: the first candidate
    that equals the value but for blanks and full-width forms; its place in the block; a compressed
    answer whose characters stand in the block in order, four fifths in one piece; an entry's own
    candidate in place of a wrong verbatim value; nothing: the value is withheld, and told why (no
    lines, lines that are not there, edited, found elsewhere, found nowhere). All of it is a
    projection, native, and linear in the texts but for lcs_share."""
    value = strip(F.coalesce("value_text", F.lit("")))
    own = lambda c, otherwise: F.coalesce(F.col(c), F.lit(otherwise)) if c in entries.columns else F.lit(otherwise)
    rows = computed(entries, {"_v": value, "_form": F.coalesce("form", F.lit("verbatim")), "_c": compact(value), "_b": compact(F.col("block")), "_cands": F.coalesce("candidates", F.array().cast("array<string>"))})
    hit = F.get(F.filter("_cands", lambda c: compact(c) == F.col("_c")), F.lit(0))
    rows = computed(rows, {"_hit": F.when((F.col("_v") != "") & F.col("block").isNotNull(), hit)})
    rows = computed(rows, {"_span": F.when(F.col("_hit").isNull() & F.contains("_b", "_c"), places.find_compact(F.col("block"), F.col("_v")))})
    raw = F.substr("block", F.col("_span.start") + 1, F.col("_span.end") - F.col("_span.start"))
    lost = (F.col("_v") != "") & F.col("block").isNotNull() & F.col("_hit").isNull() & F.col("_span").isNull()
    rows = computed(rows, {"_raw": F.when(F.col("_hit").isNull(), raw), "_sub": F.when(lost, places.is_subsequence(F.col("_c"), F.col("_b"))), "_d": F.when(lost, compact(F.col("document")))})
    loose = F.col("_form").isin("compressed", "descriptive")
    rows = computed(rows, {"lcs_share": F.when(F.col("_sub").isNotNull() & loose, places.longest_share(F.col("_c"), F.col("_b")))})
    quoted = F.col("_form").isin("verbatim", "combined")
    recoverable = (own("bind_source", "region_bound") == "entry_bound") & (F.col("_form") == "verbatim") & (F.size("_cands") > 0)
    tier = first_match(
        [
            ("not_applicable", F.col("_v") == ""),
            ("mismatch_withheld", F.col("block").isNull()),
            ("rule_candidate", F.col("_hit").isNotNull()),
            ("source_substring", F.col("_raw").isNotNull() & quoted),
            ("compressed_strong", F.col("_raw").isNotNull()),
            ("compressed_weak", (F.col("_form") == "compressed") & F.col("_sub") & (F.col("lcs_share") >= 0.8)),
            ("mismatch_recovered", recoverable),
        ],
        "mismatch_withheld",
    )
    rows = computed(rows, {"tier": tier})
    is_ = lambda *tiers: F.col("tier").isin(*tiers)
    missed = is_("mismatch_recovered", "mismatch_withheld")
    why = first_match(
        [
            ("locator_invalid", missed & F.col("block").isNull() & own("cited", False)),
            ("no_locator", missed & F.col("block").isNull()),
            ("outside_region", missed & F.contains("_d", "_c")),
            ("in_region_edit", missed & F.col("_sub")),
            ("outside_region", missed & places.is_subsequence(F.col("_c"), F.col("_d"))),
            ("absent_from_doc", missed),
        ]
    )
    kind = lambda c: F.when(c == F.col("_v"), "exact").otherwise("normalized")
    match = F.when(is_("rule_candidate"), kind(F.col("_hit"))).when(is_("source_substring", "compressed_strong"), kind(F.col("_raw"))).otherwise("none")
    source = F.when(is_("rule_candidate"), F.col("_hit")).when(is_("source_substring"), F.col("_raw")).when(is_("mismatch_recovered"), F.get("_cands", F.lit(0)))
    bound = F.when(is_("rule_candidate") & ~quoted | is_("compressed_strong", "compressed_weak"), F.col("_v")).otherwise(source)
    return rows.withColumns({"match": match, "mismatch_class": why, "source_value": source, "bound_value": bound}).drop("_v", "_form", "_c", "_b", "_d", "_cands", "_hit", "_span", "_raw", "_sub")


def anchors(annotated: DataFrame) -> DataFrame:
    """doc_id, kind, tag, nth, start_line, end_line of META start and end marks in the annotated
    text; lines are those of the source. Of one kind and tag, the n-th start goes with the n-th
    end; what has no partner has a null there."""
    rows = annotated.select("doc_id", F.inline(marks_of(F.col("annotated"))))
    return paired_marks(rows).select("doc_id", "kind", "tag", "nth", "start_line", "end_line")


def marks_of(annotated: Column) -> Column:
    """array<struct<kind, tag, side, at, line_no>> of an annotated text's marks, in order: side is 1 of a start
    and 2 of an end, line_no the last line of the source up to it. Lines without a mark go no further."""
    part = lambda x, g: F.regexp_extract(x, r"META:(\w+):(start|end):?(.*?)\s*-->", g)
    told = lambda x, i: F.when(F.contains(x, F.lit("META:")), F.struct(i.alias("at"), x.rlike(r"^\s*<!--\s*META:").alias("alone"), part(x, 1).alias("kind"), part(x, 2).alias("end"), part(x, 3).alias("tag")))

    def counted(ms: Column) -> Column:
        def lined(all_alone: Column) -> Column:
            # a mark's own lines are not the source's; one inside a line of the source is rare
            before = lambda m, k: F.when(all_alone, k + 1).otherwise(F.size(F.filter(ms, lambda o: o["alone"] & (o["at"] <= m["at"]))))
            each = F.transform(ms, lambda m, k: F.struct(m["kind"].alias("kind"), m["tag"].alias("tag"), F.when(m["end"] == "end", 2).otherwise(1).alias("side"), m["at"].alias("at"), (m["at"] + 1 - before(m, k)).cast("long").alias("line_no")))
            return F.filter(each, lambda m: m["kind"] != "")

        return let(F.forall(ms, lambda m: m["alone"]), lined)

    return let(F.array_compact(F.transform(split_lines(annotated), told)), counted)


def paired_marks(rows: DataFrame, *more: Column) -> DataFrame:
    """Marks (doc_id, kind, tag, side, at, line_no) by doc_id, kind, tag and nth of their side, as start_line and
    end_line; and ``more`` aggregates of what shares a place. One shuffle, of marks."""
    from pyspark.sql import Window

    keys = ["doc_id", "kind", "tag"]
    rows = rows.repartition(*keys).withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "side").orderBy("at")))
    of = lambda side, line: F.max(F.when(F.col("side") == side, line))
    return rows.groupBy(*keys, "nth").agg(of(1, F.col("line_no") + 1).alias("start_line"), of(2, F.col("line_no")).alias("end_line"), *more)


def annotated(papers: DataFrame) -> DataFrame:
    """``papers`` with ``annotated``: the source with a start and an end mark around each unit and
    span. At one line, units open before their spans and close after them."""
    rows = _text(papers)
    # an order within a line as one number: ends stand after the line, starts before it, units about their spans
    deep, line, after = 1 << 36, 1 << 45, 1 << 46
    mark = lambda a, z, order, kind, u: F.struct(a.alias("a"), z.alias("z"), order.alias("o"), F.lit(kind).alias("kind"), F.coalesce(u["unit_id"], F.lit("")).alias("id"))
    seq = lambda i, k: i.cast("long") * 10 + k
    spans = F.flatten(F.transform("units", lambda u, i: F.array_compact(F.array(*[F.when(u[r].isNotNull(), mark(u[r]["start"], u[r]["end"], seq(i, deep + k), r, u)) for k, r in enumerate(ROLES)]))))
    lo, hi = (lambda u: F.least(*[u[r]["start"] for r in ROLES])), (lambda u: F.greatest(*[u[r]["end"] for r in ROLES]))
    whole = F.transform("units", lambda u, i: mark(lo(u), hi(u), seq(i, 0), "unit", u))
    rows = rows.withColumn("s", F.filter(F.concat(whole, spans), lambda s: s["a"].isNotNull() & s["z"].isNotNull()))
    tag = lambda s, end: F.concat(F.lit("<!-- META:"), s["kind"], F.lit(f":{end}:"), s["id"], F.lit(" -->"))
    row = lambda at, order, x: F.struct(at.alias("at"), order.alias("o"), x.alias("x"))
    opens = F.transform("s", lambda s: row(s["a"], s["o"], tag(s, "start")))
    closes = F.transform("s", lambda s: row(s["z"], F.lit(after) - s["o"], tag(s, "end")))
    texts = F.transform("lines", lambda x, i: row(i + 1, F.lit(line), x))
    text = F.array_join(F.transform(F.sort_array(F.concat(opens, texts, closes)), lambda r: r["x"]), "\n")
    return rows.withColumn("_marked", text).select(*[F.col("_marked").alias(c) if c == "annotated" else F.col(c) for c in dict.fromkeys([*papers.columns, "annotated"])])
