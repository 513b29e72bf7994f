"""Deterministic rewrites of papers, and the checks of a manifest before it is used.

Each takes papers as in operators.exam (one row, lines and units as arrays) and is a projection.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.exam_text import inline_answers, question_number, range_answers, table_answers
from sheaf.functions.text import computed, find_all, first_match, one_of, split_lines, strip
from sheaf.operators.exam import LINES, ROLES, _at, _issue, _text, _when, covered, is_paper_line, text_lines, unit_start

ANSWER_MARK = "【答案】"


def clamp_spans(papers: DataFrame) -> DataFrame:
    """All spans inside their document, their ends in order."""
    rows = computed(papers, {"_n": F.size(split_lines(F.col("text")))})  # once a paper, not once a span

    def fixed(u: Column) -> Column:
        out = u
        for r in ROLES:
            a, b = (F.least(F.greatest(u[r][e], F.lit(1)), F.col("_n")) for e in ("start", "end"))
            out = out.withField(r, F.when(u[r]["start"].isNotNull() & u[r]["end"].isNotNull(), F.struct(F.least(a, b).alias("start"), F.greatest(a, b).alias("end"))))
        return out

    return rows.withColumn("units", F.transform("units", fixed)).drop("_n")


def number_missing(papers: DataFrame) -> DataFrame:
    """Units without numbers get those after the largest, in order."""
    top = F.coalesce(F.array_max(F.flatten(F.transform("units", lambda u: F.coalesce(u["question_numbers"], F.array().cast("array<int>"))))), F.lit(0))
    lacks = lambda u: F.coalesce(F.size(u["question_numbers"]), F.lit(0)) <= 0
    rows = papers.withColumns({"_top": top, "_lack": F.filter(F.transform("units", lambda u, i: F.when(lacks(u), i)), lambda i: i.isNotNull())})
    fixed = F.transform("units", lambda u, i: F.when(lacks(u), u.withField("question_numbers", F.array((F.col("_top") + F.array_position(F.col("_lack"), i)).cast("int")))).otherwise(u))
    return rows.withColumn("units", fixed).drop("_top", "_lack")


def shift_numbers(papers: DataFrame) -> DataFrame:
    """Units in the order of their first lines: where a unit's smallest number is not above all
    before it, its numbers move up to follow on. The running maximum is a fold over the array."""
    order = F.array_sort(F.transform("units", lambda u, i: F.struct(F.coalesce(unit_start(u), F.lit(0)).alias("at"), i.alias("i"), F.coalesce(u["question_numbers"], F.array().cast("array<int>")).alias("n"))))
    none = F.array().cast("array<struct<i:int,n:array<int>>>")

    def step(acc: Column, x: Column) -> Column:
        off = F.when((F.size(x["n"]) > 0) & (F.array_min(x["n"]) <= acc["top"]), acc["top"] - F.array_min(x["n"]) + 1).otherwise(0)
        new = F.transform(x["n"], lambda n: n + off)
        return F.struct(F.greatest(acc["top"], F.coalesce(F.array_max(new), F.lit(0))).alias("top"), F.concat(acc["out"], F.array(F.struct(x["i"].alias("i"), new.alias("n")))).alias("out"))

    got = F.aggregate(order, F.struct(F.lit(0).alias("top"), none.alias("out")), step, lambda a: a["out"])
    rows = computed(papers, {"_new": F.map_from_entries(got)})
    return rows.withColumn("units", F.transform("units", lambda u, i: u.withField("question_numbers", F.element_at("_new", i)))).drop("_new")


def _lines_where(papers: DataFrame, some: Column) -> DataFrame:
    """``papers`` with ``lines``, null where ``some`` does not hold: texts that need no look are not split."""
    return computed(papers, {"lines": F.when(some, F.col(LINES) if LINES in papers.columns else text_lines(F.col("text")))})


def trim_explanations(papers: DataFrame) -> DataFrame:
    """Explanations start at their first line that says so, if any does."""
    rows = _lines_where(papers, F.exists("units", lambda u: u["explanation"].isNotNull()))

    def fixed(u: Column) -> Column:
        e = u["explanation"]
        at = F.filter(F.sequence(e["start"], e["end"]), lambda n: _at(F.col("lines"), n).rlike("【分析】|【解答】"))
        new = F.when(e.isNotNull() & (e["start"] <= e["end"]), F.struct(F.coalesce(F.get(at, F.lit(0)), e["start"]).alias("start"), e["end"].alias("end"))).otherwise(e)
        return u.withField("explanation", new)

    return rows.withColumn("units", F.transform("units", fixed)).drop("lines")


def plain_numbered_lines(papers: DataFrame) -> DataFrame:
    """Numbered lines inside units lose their heading marks."""
    marked = lambda x: F.startswith(x, F.lit("#")) & x.rlike(r"^#{1,6}\s*\d{1,3}\s*[.．、]")
    rows = computed(_text(papers), {"_in": F.when(F.exists("lines", marked), covered(F.col("units")))})
    new = F.transform("lines", lambda x, i: F.when(marked(x) & F.array_contains(F.col("_in"), i + 1), F.regexp_replace(x, r"^#{1,6}\s*", "")).otherwise(x))
    return rows.withColumn("text", F.array_join(new, "\n")).drop("lines", "_in", LINES)


def wrap_bare_latex(line: Column) -> Column:
    """Bare LaTeX commands between dollars, in lines that have no dollars."""
    return F.when(F.contains(line, F.lit("$")), line).otherwise(F.regexp_replace(line, r"(\\[a-zA-Z]+(?:\{[^{}]*\})*(?:[_^](?:\{[^{}]*\}|\w))*)", r"\$$1\$"))


def attach_orphan_images(papers: DataFrame, most: int = 6) -> DataFrame:
    """Image lines that no span covers join the nearest span within ``most`` lines that only
    blank lines part from them; ties go to the earlier unit. All gaps are those of the spans as
    they came in, and a span that several images join reaches over all of them."""
    some = functools.reduce(lambda a, b: a | b, (F.contains("text", F.lit(w)) for w in ("META:", "<img", "![")))  # what goes with a META comment may part a mark
    rows = _lines_where(papers, some)
    rows = computed(rows, {"_in": F.when(F.col("lines").isNotNull(), covered(F.col("units")))})
    lines = F.col("lines")
    orphans = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(r"<img\s|!\[[^\]]*\]\(") & ~F.array_contains(F.col("_in"), i + 1), i + 1)), lambda n: n.isNotNull())
    spans = F.flatten(F.transform("units", lambda u, i: F.array_compact(F.array(*[F.when(u[r].isNotNull(), F.struct(i.alias("u"), F.lit(k).alias("r"), u[r]["start"].alias("a"), u[r]["end"].alias("z"))) for k, r in enumerate(ROLES)]))))

    def home(n: Column) -> Column:
        gap = lambda s: F.greatest(s["a"] - n, n - s["z"])
        lo, hi = (lambda s: F.least(s["z"], n) + 1), (lambda s: F.greatest(s["a"], n) - 1)
        clear = lambda s: F.forall(F.slice(lines, lo(s), F.greatest(hi(s) - lo(s) + 1, F.lit(0))), lambda x: strip(x) == "")
        near = F.filter(F.col("_spans"), lambda s: (gap(s) <= most) & clear(s))
        best = F.array_min(F.transform(near, lambda s: F.struct(gap(s).alias("gap"), s["u"].alias("u"), s["r"].alias("r"))))
        return F.struct(n.alias("n"), best["u"].alias("u"), best["r"].alias("r"))

    rows = computed(rows, {"_orphans": orphans, "_spans": F.when(lines.isNotNull(), spans)})
    rows = computed(rows, {"_homes": F.transform("_orphans", home)})

    def mine(i: Column, k: int) -> Column:
        return F.transform(F.filter("_homes", lambda h: (h["u"] == i) & (h["r"] == k)), lambda h: h["n"])

    def fixed(u: Column, i: Column) -> Column:
        out = u
        for k, r in enumerate(ROLES):
            own = mine(i, k)
            out = out.withField(r, F.when(F.size(own) > 0, F.struct(F.least(u[r]["start"], F.array_min(own)).alias("start"), F.greatest(u[r]["end"], F.array_max(own)).alias("end"))).otherwise(u[r]))
        return out

    return rows.withColumn("units", F.when(F.size("_homes") > 0, F.transform("units", fixed)).otherwise(F.col("units"))).drop("lines", "_in", "_orphans", "_spans", "_homes")


# Phrases that stand for an answer, whole answers that are none, marks of parts.
PLACEHOLDERS = (
    "答案见解析", "答案见详解", "答案见上文", "答案见下文", "答案见图", "答案见答案",
    "图像见解析", "图见解析", "见解析图", "证明见解析", "过程见解析", "理由见解析",
    "详见解析", "详见详解",
    "见解析", "见详解", "见答案", "见上文", "见下文", "无答案", "答案略",
)
NO_ANSWERS = ("略", "无", "同上", "答案略", "无答案")
PART_NUMBERS = r"[（(\[【]?[0-9０-９一二三四五六七八九十ⅠⅡⅢⅣⅤⅥ①②③④⑤⑥⑦⑧⑨⑩]+[）)\]】]?|[。．\.、，,；;：:！!？\?…—－\-]"
PART_MARK = r"(?m)[（(]\s*(?:[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]|[IVX]{1,4})\s*[）)]|^[（(]\s*\d{1,2}\s*[）)]"


def placeholder(value: Column) -> Column:
    """none, pure or partial: whether an answer only points elsewhere, or also does. Phrases are
    taken out longest first; what is left of numbers, marks and 的 is no answer."""
    close = F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", "")
    phrase = "|".join(sorted(PLACEHOLDERS, key=len, reverse=True))
    rest = F.regexp_replace(F.regexp_replace(close, phrase, ""), PART_NUMBERS, "")
    rest = F.regexp_replace(rest, "^[，,、；;：:的]+|[，,、；;：:的]+$", "")
    core = F.regexp_replace(close, r"[。．.、，,；;：:！!？?…]+$", "")
    return F.when(core.isin(*NO_ANSWERS), "pure").when(~close.rlike(phrase), "none").when(rest == "", "pure").otherwise("partial")


def many_parts(block: Column) -> Column:
    """Whether a text has two or more different part marks."""
    return F.size(F.array_distinct(F.transform(find_all(block, PART_MARK), lambda m: strip(m)))) >= 2


def completeness(value: Column, block: Column, cited: Column) -> Column:
    """full, partial or unknown: what an answer's value and its cited lines prove. What is not
    proved is unknown, never full."""
    v, b = strip(F.coalesce(value, F.lit(""))), F.coalesce(block, F.lit(""))
    inside = F.contains(F.replace(b, F.lit(" "), F.lit("")), F.replace(v, F.lit(" "), F.lit("")))
    return first_match(
        [
            ("unknown", placeholder(v) == "pure"),
            ("partial", placeholder(v) == "partial"),
            ("partial", F.regexp_count(b, F.lit(r"\$")) % 2 == 1),
            ("partial", b.rlike(r"\\frac\{[^}]*\s*$")),
            ("partial", (v != "") & cited & many_parts(b) & (F.char_length(v) <= 40) & ~F.contains(v, F.lit("\n"))),
            ("full", (v != "") & cited & inside & ~many_parts(b)),
        ],
        "unknown",
    )


def answer_numbers(line: Column) -> Column:
    """Numbers right before or after an answer mark."""
    near = F.concat(find_all(line, rf"(\d{{1,3}})\s*[.．、]?\s*{ANSWER_MARK}", 1), find_all(line, rf"{ANSWER_MARK}\s*(\d{{1,3}})\s*[.．、]", 1))
    return F.array_distinct(F.transform(near, lambda n: n.cast("int")))


def conclusion(text: Column) -> Column:
    """The one letter that a solution concludes with, else null."""
    return one_of(find_all(text, r"(?:故选|答案[为是：:]?|应选|选)[：:\s]*([A-H])(?![A-Za-z])", 1))


def validated(papers: DataFrame) -> DataFrame:
    """doc_id, issues: what a manifest must hold before it is used: spans in bounds, numbers once
    a section, composite units with a text, answers that are cited, and C-A1 to C-A4: questions
    without answers in them, answers without questions, shared tables, uncovered answers."""
    rows = _text(papers)
    lines = F.col("lines")
    n = F.size(lines)
    marked = lambda i: F.contains(_at(lines, i), F.lit(ANSWER_MARK))
    of = lambda s: F.when(s["start"] <= s["end"], F.sequence(F.greatest(s["start"], F.lit(1)), F.least(s["end"], n)))
    ok = lambda s: F.coalesce((s["start"] >= 1) & (s["start"] <= s["end"]) & (s["end"] <= n), F.lit(False))
    answered = F.array_distinct(F.flatten(F.transform(F.filter("units", lambda u: ok(u["answer"])), lambda u: of(u["answer"]))))
    rows = rows.withColumns({"_covered": covered(F.col("units")), "_answers": answered})

    def judged(u: Column) -> Column:
        own = F.coalesce(u["question_numbers"], F.array().cast("array<int>"))
        block = F.array_join(F.slice(lines, u["answer"]["start"], u["answer"]["end"] - u["answer"]["start"] + 1), "\n")
        told = F.array_union(F.array_union(F.map_keys(table_answers(block)), F.map_keys(range_answers(block))), F.map_keys(inline_answers(split_lines(block))))
        mixed = [F.exists(F.when(ok(u[r]), of(u[r])), lambda i: marked(i) & ~F.array_contains(F.col("_answers"), i)) for r in ("stem", "material", "questions")]
        head = lambda i: _at(lines, i).rlike(r"^\s*#{1,6}\s*\d") & F.array_contains(own, question_number(_at(lines, i))["n"]) & ~marked(i)
        paper = [F.exists(F.when(ok(u[r]), of(u[r])), lambda i: is_paper_line(_at(lines, i))) for r in ROLES]
        rules = [_when("SPAN", u[r].isNotNull() & ~ok(u[r]), F.concat(u["unit_id"], F.lit(f" {r}"))) for r in ROLES]
        rules += [
            _when("NO_NUMBERS", F.size(own) <= 0, u["unit_id"]),
            _when("NO_TEXT", (u["unit_type"] == "composite_question") & u["material"].isNull() & u["questions"].isNull(), u["unit_id"]),
            _when("NO_ANSWER", u["answer"].isNull(), u["unit_id"]),
            *[_when("C_A1", m, u["unit_id"]) for m in mixed],
            _when("C_A2", ok(u["answer"]) & F.exists(of(u["answer"]), head), u["unit_id"]),
            _when("C_A3", ok(u["answer"]) & (F.size(F.array_except(told, own)) > 0), u["unit_id"], "PENDING_REVIEW"),
            *[_when("PAPER_LINE", p, u["unit_id"]) for p in paper],
        ]
        return F.array_compact(F.array(*rules))

    claims = F.flatten(F.transform("units", lambda u: F.transform(F.coalesce(u["question_numbers"], F.array().cast("array<int>")), lambda x: F.struct(F.coalesce(u["section"], F.lit("")).alias("s"), x.alias("n")))))
    open_ = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.coalesce(marked(i), F.lit(False)) & ~F.array_contains(F.col("_covered"), i))
    whole = F.array_compact(F.array(_when("NO_UNITS", F.coalesce(F.size("units"), F.lit(0)) <= 0), _when("NUMBER_TWICE", F.size(claims) != F.size(F.array_distinct(claims)))))
    lost = F.transform(open_, lambda i: _issue("C_A4", "FAIL", i))
    return rows.select("doc_id", F.concat(whole, F.flatten(F.transform("units", judged)), lost).alias("issues"))


# Enums of answer items.
FORMS = ("verbatim", "compressed", "combined", "descriptive")
REGIONS = ("answer_area", "answer_table", "explanation_area", "stem_area", "material", "unknown")
STATES = ("resolved", "disputed", "missing", "unattributed")
REASONS = ("extraction_gap", "source_not_provided")


def item_issues(item: Column, n_lines: Column) -> Column:
    """Codes of what is wrong with an answer item (struct of sub_label, slot_id, value_text,
    asset_ref, form, source_region, evidence_lines, status, missing_reason)."""
    e = item["evidence_lines"]
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    flags = {
        "FORM": ~F.coalesce(item["form"].isin(*FORMS), F.lit(False)),
        "REGION": ~F.coalesce(item["source_region"].isin(*REGIONS), F.lit(False)),
        "STATUS": ~F.coalesce(item["status"].isin(*STATES), F.lit(False)),
        "REASON": item["missing_reason"].isNotNull() & ~item["missing_reason"].isin(*REASONS),
        "SLOT": item["slot_id"].isNotNull() & ~item["slot_id"].rlike(r"^.+#\d+$"),
        "LINES": e.isNotNull() & ~F.coalesce((e["start"] >= 1) & (e["start"] <= e["end"]) & (e["end"] <= n_lines), F.lit(False)),
        "BOTH": has(item["asset_ref"]) & has(item["value_text"]) & (item["form"] != "combined"),
        "DISPUTED": (item["status"] == "disputed") & has(item["value_text"]),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in flags.items()]))


def image_options(lines: Column, start: Column, end: Column) -> Column:
    """Options that are images with their letters below: array<struct<label, start_line,
    end_line>>, in order from A."""
    found = F.filter(
        F.transform(F.sequence(start, F.greatest(end - 1, start)), lambda n: F.struct(F.regexp_extract(F.coalesce(_at(lines, n + 1), F.lit("")), r"^\s*<div[^>]*>\s*([A-H])\s*</div>", 1).alias("label"), n.alias("start_line"), (n + 1).alias("end_line"))),
        lambda o: (o["label"] != "") & _at(lines, o["start_line"]).rlike(r"<img\s"),
    )
    return F.filter(found, lambda o, i: o["label"] == F.substr(F.lit("ABCDEFGH"), i + 1, F.lit(1)))


def pull_tables(papers: DataFrame) -> DataFrame:
    """Stems that name a table below them reach over the table lines that follow, up to the next
    unit and if no span has them yet."""
    rows = computed(_text(papers), {"_in": covered(F.col("units"))})
    lines = F.col("lines")

    def fixed(u: Column) -> Column:
        s = u["stem"]
        said = F.exists(F.slice(lines, s["start"], F.greatest(s["end"] - s["start"] + 1, F.lit(0))), lambda x: x.rlike("下表|如表|表中|表格"))
        after = F.sequence(s["end"] + 1, F.least(s["end"] + 40, F.size(lines)))
        free = lambda n: _at(lines, n).rlike(r"^\s*\||<table|</t[rd]>|</table>|^\s*$") & ~F.array_contains(F.col("_in"), n)
        stop = F.coalesce(F.get(F.filter(after, lambda n: ~free(n)), F.lit(0)), F.size(lines) + 1)
        last = F.array_max(F.filter(after, lambda n: (n < stop) & (strip(_at(lines, n)) != "")))
        ok = s.isNotNull() & said & (s["end"] < F.size(lines))
        return u.withField("stem", F.when(ok, F.struct(s["start"].alias("start"), F.coalesce(last, s["end"]).alias("end"))).otherwise(s))

    return rows.withColumn("units", F.transform("units", fixed)).drop("lines", "_in")
