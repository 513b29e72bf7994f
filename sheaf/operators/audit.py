"""Audits of papers: the artefacts of a paper against its spans, the consumer's contract, marks of
older annotations, fidelity to a text layer, and answers that can be proved from their source.

Papers are those of operators.exam: one row, lines and units as arrays, so an audit is a
projection; only the marks of annotated texts are a relation of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.exam_text import question_number, range_answers, table_answers
from sheaf.functions.text import computed, find_all, half_width, is_ascii, let, split_lines, strip
from sheaf.operators import binding
from sheaf.operators.exam import IMAGE_LINE, ROLES, TABLE_LINE, ZONES, _issue, _text, _when, identity_issues, marks_of, paired_marks, sections, with_facts, with_quality
from sheaf.operators.fixers import many_parts
from sheaf.operators.options import option_marks

# The third zone's marks, words of the contract, and forms that older annotations know.
EXPLANATION = ("“详解区开始”", "“详解区结束”")
BASES = ("answer_key", "shift", "keep", "printed_as_is", "explicit", "unverified")
PROVENANCES = ("source_line", "migration_report", "unknown")
CHOICES = ("single_choice", "multiple_choice", "true_false")
MARKS = r"<!--\s*META:(question|answer|explanation):(start|end):(\d+)(?:,\w+)?\s*-->"
SHARED_CUE = r"阅读下面|阅读下列|读下列|读图|材料一|材料二|完成\s*\d+|回答下列|根据材料|结合材料|完成下列|阅读材料|实验题|工艺流程|下列短文|读图文|读图表|下图为|下表为|下图是|下表是|如图.{0,6}所示.{0,20}回答"
PAPER_NOTICE = r"本大题共|本试题共|共\s*\d+\s*小题|请将答案.{0,10}答题卡|在答题卡|答题卡指定区域|考试时间|满分\s*\d+\s*分|注意事项"
FIGURE_WORD = r"如图|下图|右图|左图|图\s*\d|看图"
IMAGE_REF = r"!\[[^\]]*\]\([^)]+\)|<img|配图|imgs/"
ANSWERED = r"(?<![\d.\-–])(\d{1,3})\s*[\.．、]?\s*[（(]?\d{0,2}\s*分?[)）]?\s*[:：]?\s*[A-DＡ-ＤⅠⅡⅢⅣ]"
LETTER_SAID = r"故选\s*[：:]?\s*([A-Da-d])|(?:故)?答案(?:为|是)?\s*[：:]\s*([A-Da-d])(?![A-Za-z0-9])"
FORBIDDEN = r'[<>:"/\\|?*]'

_NONE = lambda: F.array().cast("array<string>")


def _span(lines: Column, s: Column) -> Column:
    """Lines of a span; none if it is not one of the document's."""
    ok = (s["start"] >= 1) & (s["start"] <= s["end"]) & (s["end"] <= F.size(lines))
    return F.when(F.coalesce(ok, F.lit(False)), F.slice(lines, s["start"], s["end"] - s["start"] + 1)).otherwise(_NONE())


def _close(lines: Column) -> Column:
    """Lines without blanks around, and without empty ones."""
    return F.filter(F.transform(lines, lambda x: strip(x)), lambda x: x != "")


def stem_zone(lines: Column, u: Column) -> Column:
    """Lines that a unit's question must show: material, then what of the questions is after it,
    or stem and options; then the extra lines."""
    after = F.greatest(u["questions"]["start"], F.coalesce(u["material"]["end"] + 1, u["questions"]["start"]))
    rest = _span(lines, F.struct(after.alias("start"), u["questions"]["end"].alias("end")))
    whole = F.concat(_span(lines, u["material"]), rest)
    return F.concat(F.when(u["unit_type"] == "composite_question", whole).otherwise(F.concat(_span(lines, u["stem"]), _span(lines, u["options"]))), _span(lines, u["extra"]))


def answer_zone(lines: Column, u: Column, everywhere: Column) -> Column:
    """struct<lines, shared>: what a unit's answer must show: its numbers' values, from the cited
    lines or else from ``everywhere`` (map<int,string> of the document), then the cited lines; of
    lines that other units share, only where they are."""
    cited = _span(lines, u["answer"])
    block = F.array_join(cited, "\n")
    here = _answers(block)
    own = F.coalesce(u["question_numbers"], F.array().cast("array<int>"))
    note = F.concat(F.lit("L"), u["answer"]["start"].cast("string"), F.lit("-L"), u["answer"]["end"].cast("string"))

    def shown(here: Column) -> Column:
        told = F.transform(F.array_sort(F.array_distinct(own)), lambda n: F.struct(n.alias("n"), F.coalesce(F.try_element_at(here, n), F.try_element_at(everywhere, n)).alias("v")))
        said = F.transform(F.filter(told, lambda t: F.coalesce(t["v"] != "", F.lit(False))), lambda t: F.concat(t["n"].cast("string"), F.lit("."), t["v"]))
        shared = (F.size(here) > 0) & (F.size(F.array_except(F.map_keys(here), own)) > 0)
        first = F.when(F.size(said) > 0, F.array(F.array_join(said, " "))).otherwise(_NONE())
        return F.struct(F.concat(first, F.when(shared, F.array(note)).otherwise(cited)).alias("lines"), shared.alias("shared"))

    return let(here, shown)


def _answers(text: Column) -> Column:
    """Answers of tables, then of ranges, as map<int,string>."""
    return let(let(text, lambda x: F.struct(table_answers(x).alias("t"), range_answers(x).alias("r"))), lambda m: F.map_concat(F.map_filter(m["r"], lambda k, v: ~F.map_contains_key(m["t"], k)), m["t"]))


def _zone_of(block: Column, marks: tuple[str, str], opened: bool = False) -> Column:
    """Lines of a zone of a unit's block; null without its marks. ``opened``: the block begins in it."""
    at = F.instr(block, marks[0])
    body = block if opened else F.when(at > 0, F.substr(block, at + len(marks[0])))
    return let(body, lambda b: F.when(F.contains(b, F.lit(marks[1])), split_lines(F.substring_index(b, marks[1], 1))))


def consistency(papers: DataFrame) -> DataFrame:
    """doc_id, unit_ord, zone, status, one row a unit and zone: what ``rendered`` shows of a unit
    against what its spans say (MATCH, DRIFT, or MISSING where the block or zone is not there). A
    paper without text or source_file is one DRIFT of zone ``provenance``; one with another
    number of blocks than units also has a DRIFT of zone ``blocks``."""
    rows = computed(_text(papers), {"_blocks": F.split(F.coalesce("rendered", F.lit("")), ZONES["stem"][0], -1)})
    lines, blocks = F.col("lines"), F.slice("_blocks", 2, F.greatest(F.size("_blocks") - 1, F.lit(0)))
    rows = computed(rows, {"_b": blocks, "_all": _answers(F.array_join(lines, "\n"))})

    def told(name: str, want: Column, got: Column) -> Column:
        status = let(got, lambda g: F.when(g.isNull(), "MISSING").when(_close(want) == _close(g), "MATCH").otherwise("DRIFT"))
        return F.struct(F.lit(name).alias("zone"), status.alias("status"))

    def judged(u: Column, i: Column) -> Column:
        b = F.get("_b", i)
        why = F.when(u["explanation"].isNotNull(), told("explanation", _span(lines, u["explanation"]), _zone_of(b, EXPLANATION)))
        zones = F.array_compact(F.array(told("stem", stem_zone(lines, u), _zone_of(b, ZONES["stem"], True)), told("answer", answer_zone(lines, u, F.col("_all"))["lines"], _zone_of(b, ZONES["answer"])), why))
        return F.transform(zones, lambda z: F.struct(i.alias("unit_ord"), z["zone"].alias("zone"), z["status"].alias("status")))

    whole_row = lambda zone: F.array(F.struct(F.lit(-1).alias("unit_ord"), F.lit(zone).alias("zone"), F.lit("DRIFT").alias("status")))
    each = F.flatten(F.transform("units", judged))
    each = F.when(F.size("_b") != F.size("units"), F.concat(whole_row("blocks"), each)).otherwise(each)
    bad = F.col("text").isNull() | F.col("source_file").isNull()
    return rows.select("doc_id", F.explode(F.when(bad, whole_row("provenance")).otherwise(each)).alias("z")).select("doc_id", "z.*")


def anchor_drift(papers: DataFrame) -> DataFrame:
    """doc_id, kind, tag, nth, status of the spans of units and the marks of ``annotated``: MATCH, or
    DRIFT where the lines differ or one side lacks the other."""
    # spans are side 0, in their units' order, of one relation with the marks: a paper is made once
    span = lambda u, r, i: F.when(u[r].isNotNull(), F.struct(F.lit(r).alias("kind"), F.coalesce(u["unit_id"], F.lit("")).alias("tag"), F.lit(0).alias("side"), i.alias("at"), F.lit(None).cast("long").alias("line_no"), u[r]["start"].alias("a"), u[r]["end"].alias("z")))
    spans = F.flatten(F.transform("units", lambda u, i: F.array_compact(F.array(*[span(u, r, i) for r in ROLES]))))
    no = F.lit(None).cast("int")
    marks = F.transform(F.filter(marks_of(F.col("annotated")), lambda m: m["kind"].isin(*ROLES)), lambda m: F.struct(*[m[c].alias(c) for c in ("kind", "tag", "side", "at", "line_no")], no.alias("a"), no.alias("z")))
    none = F.array().cast("array<struct<kind:string,tag:string,side:int,at:int,line_no:bigint,a:int,z:int>>")
    rows = papers.select("doc_id", F.inline(F.concat(F.coalesce(spans, none), F.coalesce(marks, none))))
    met = paired_marks(rows, F.max("a").alias("a"), F.max("z").alias("z"))
    same = F.col("a").eqNullSafe(F.col("start_line")) & F.col("z").eqNullSafe(F.col("end_line"))
    return met.select("doc_id", "kind", "tag", "nth", F.when(same, "MATCH").otherwise("DRIFT").alias("status"))


def answer_invariants(numbers: Column, answers: Column, unresolved: Column) -> Column:
    """array<struct<code, number>> of a parsed answer table (map<int,string>, array<int>) of a unit:
    OVERLAP, a number both answered and not; UNTOLD, one of the unit's that is neither; EMPTY, an
    answer without text. Null where no table was tried."""
    code = lambda c: lambda n: F.struct(F.lit(c).alias("code"), n.alias("number"))
    keys = F.map_keys(answers)
    both = F.transform(F.array_sort(F.array_intersect(keys, unresolved)), code("OVERLAP"))
    lost = F.transform(F.array_sort(F.array_except(F.array_except(numbers, keys), unresolved)), code("UNTOLD"))
    empty = F.transform(F.array_sort(F.map_keys(F.map_filter(answers, lambda k, v: strip(F.coalesce(v, F.lit(""))) == ""))), code("EMPTY"))
    return F.when(answers.isNotNull(), F.concat(both, lost, empty))


def preflight(papers: DataFrame) -> DataFrame:
    """doc_id, findings array<struct<code, severity, detail>>: what a consumer's contract asks.

    PC0 no units; PC10 no source; PC1 identity of version 1, after which nothing else is asked;
    PC2 identity fails; PC3 identity is for review; PC4 the verdict cannot be told; PC5 basis and
    PC6 provenance outside their words (``printed_provenance`` of a unit, null if units lack it);
    PC7 provenance and printed number contradict; PC8 a section that is not there; PC9 spans out
    of bounds."""
    rows = with_quality(with_facts(papers))
    lines, n = F.col("_of_text.lines"), F.greatest(F.size("_of_text.lines"), F.lit(1))
    secs = F.col("sections") if "sections" in papers.columns else sections(lines)
    fields = papers.schema["units"].dataType.elementType.fieldNames()
    own = lambda u: u["printed_provenance"] if "printed_provenance" in fields else F.lit(None).cast("string")
    printed = lambda u: F.coalesce(F.size(u["printed_number"]) > 0, F.lit(False))
    bad = lambda s: s.isNotNull() & ~F.coalesce((s["start"] >= 1) & (s["start"] <= s["end"]) & (s["end"] <= n), F.lit(False))

    def judged(u: Column) -> Column:
        told = F.coalesce(u["unit_id"], F.lit(""))
        ref = F.coalesce(u["section_ref"], F.lit(""))
        rules = [
            _when("PC5", ~F.coalesce(u["basis"].isin(*BASES), F.lit(False)), told),
            _when("PC6", ~F.coalesce(own(u).isin(*PROVENANCES), F.lit(False)), told),
            _when("PC7", (own(u) == "unknown") & printed(u) | (own(u) == "source_line") & ~printed(u), told),
            _when("PC8", (ref != "") & ~F.exists(secs, lambda s: s["id"] == ref), told),
            *[_when("PC9", bad(u[r]), F.concat(told, F.lit(f" {r}"))) for r in ROLES if r != "extra"],
        ]
        return F.array_compact(F.array(*rules))

    named = F.transform(identity_issues(F.col("units"), secs, lines), lambda i: F.struct(F.when(i["severity"] == "FAIL", "PC2").otherwise("PC3").alias("code"), i["severity"].alias("severity"), i["code"].alias("detail")))
    late = F.concat(named, F.array_compact(F.array(_when("PC4", F.col("verdict").isNull()))), F.flatten(F.transform("units", judged)))
    one = lambda code: F.array(_issue(code, "FAIL", F.lit("")))
    out = F.when(F.col("units").isNull(), one("PC0")).when(F.col("text").isNull() | F.col("source_file").isNull(), one("PC10")).when(F.coalesce("identity_version", F.lit(1)) < 2, one("PC1")).otherwise(late)
    return rows.select("doc_id", out.alias("findings"))


def marked_blocks(text: Column) -> Column:
    """array<struct<kind, number, text, open>> of a text with start and end marks of questions,
    answers and explanations (kind is their first letter): a block reaches from a start to the next
    mark of its kind; ``open`` says that this is no end. Kinds may nest; what stands outside of all
    is of kind ``-``."""
    kinds, ends, numbers = (find_all(text, MARKS, g) for g in (1, 2, 3))
    raw = F.arrays_zip(kinds.alias("k"), ends.alias("e"), numbers.alias("n"))
    marks = F.transform(raw, lambda m, i: F.struct(F.substring(m["k"], 1, 1).alias("kind"), (m["e"] == "end").alias("end"), m["n"].cast("int").alias("number"), i.alias("i")))

    def blocks(x: Column) -> Column:
        marks, gaps = x["marks"], x["gaps"]
        between = lambda a, z: F.array_join(F.slice(gaps, a + 2, z - a), "")  # noqa: E731  (text between two marks)

        def block(m: Column) -> Column:
            after = F.get(F.filter(F.slice(marks, m["i"] + 2, F.size(marks)), lambda o: o["kind"] == m["kind"]), F.lit(0))
            return F.when(~m["end"] & after.isNotNull(), let(after, lambda o: F.struct(m["kind"].alias("kind"), m["number"].alias("number"), between(m["i"], o["i"]).alias("text"), (~o["end"]).alias("open"))))

        level = lambda i: F.aggregate(F.slice(marks, 1, i), F.lit(0), lambda a, m: a + F.when(m["end"], -1).otherwise(1))
        outside = F.filter(F.transform(gaps, lambda g, i: F.struct(F.lit("-").alias("kind"), F.lit(None).cast("int").alias("number"), g.alias("text"), ((strip(g) == "") | (level(i) > 0)).alias("open"))), lambda f: ~f["open"])
        return F.concat(F.array_compact(F.transform(marks, block)), outside)

    return let(F.struct(marks.alias("marks"), F.split(text, MARKS, -1).alias("gaps")), blocks)


def mark_issues(text: Column) -> Column:
    """array<struct<code, severity, detail>> of an older annotation: P0 fails, P1 is for repair, P2 a
    hint (see mark_verdict)."""
    numbers = lambda b: F.array_distinct(F.filter(F.transform(split_lines(b["text"]), lambda x: question_number(x)["n"]), lambda n: n.isNotNull()))
    blocks = F.transform(marked_blocks(text), lambda b: F.struct(b["kind"].alias("kind"), b["number"].alias("number"), b["text"].alias("text"), b["open"].alias("open"), F.when(b["kind"] == "q", numbers(b)).otherwise(F.array().cast("array<int>")).alias("inner")))
    whole = F.regexp_replace(text, MARKS, "")
    parts = F.struct(blocks.alias("blocks"), F.map_keys(table_answers(whole)).alias("tables"), F.map_keys(range_answers(whole)).alias("ranges"))
    held = lambda p: F.array_distinct(F.flatten(F.transform(F.filter(p["blocks"], lambda b: b["kind"] == "q"), lambda b: b["inner"])))
    return let(parts, lambda p: let(held(p), lambda h: _mark_issues(p["blocks"], p["tables"], p["ranges"], h)))


def _mark_issues(blocks: Column, tables: Column, ranges: Column, held: Column) -> Column:
    of = lambda k: F.filter(blocks, lambda b: b["kind"] == k)
    q, a, free = of("q"), of("a"), of("-")
    inner = lambda b: b["inner"]
    labels = lambda bs: F.transform(bs, lambda b: b["number"])
    twice = lambda bs: F.size(bs) != F.size(F.array_distinct(labels(bs)))
    merged = F.filter(q, lambda b: (F.size(inner(b)) > 1) & ~b["text"].rlike(SHARED_CUE))
    nums = labels(q)
    between = lambda x, i: F.get(nums, i + 1)
    skipped = lambda x, i: F.size(F.array_except(F.sequence(x + 1, F.greatest(between(x, i) - 1, x + 1)), held)) > 0
    gap = F.filter(nums, lambda x, i: F.coalesce((between(x, i) > x + 1) & skipped(x, i), F.lit(False)))
    in_blocks = F.array_distinct(F.concat(labels(a), F.flatten(F.transform(a, lambda b: F.transform(find_all(b["text"], ANSWERED, 1), lambda n: n.cast("int"))))))
    wanted = F.when(F.size(held) > 0, held).otherwise(F.array_distinct(nums))
    lost = F.array_sort(F.array_except(wanted, F.concat(in_blocks, tables, ranges)))
    orphan = F.array_except(F.array_except(labels(a), nums), held)
    any_of = lambda bs, pattern: F.size(F.filter(bs, lambda b: b["text"].rlike(pattern)))
    rules = [
        _when("MARKER_MALFORMED", F.exists(blocks, lambda b: b["open"]), None, "P0"),
        _when("ANSWER_LABEL_DUP", twice(a), None, "P1"),
        _when("QUESTION_LABEL_DUP", twice(q), None, "P1"),
        _when("Q_BLOCK_MERGED_INDEPENDENT", F.size(merged) > 0, F.size(merged), "P1"),
        _when("QNUM_GAP", F.size(gap) > 0, F.size(gap), "P2"),
        _when("ANSWER_IN_TABLE", F.size(F.array_except(tables, labels(a))) > 0, None, "P2"),
        _when("ANSWER_IN_RANGE", F.size(F.array_except(ranges, labels(a))) > 0, None, "P2"),
        F.when(F.size(lost) > 0, F.struct(F.lit("ANSWER_MISSING").alias("code"), F.when(F.size(lost) > F.size(wanted) * 0.3, "P0").otherwise("P1").alias("severity"), F.array_join(lost.cast("array<string>"), ",").alias("detail"))),
        _when("ANSWER_ORPHAN", F.size(orphan) > 0, F.size(orphan), "P1"),
        _when("MATERIAL_OUTSIDE", F.exists(free, lambda b: b["text"].rlike(SHARED_CUE) & (F.char_length(strip(b["text"])) > 80)), None, "P1"),
        _when("IMAGE_DANGLING", F.exists(free, lambda b: b["text"].rlike(IMAGE_REF)), None, "P1"),
        _when("FIG_REF_NO_IMAGE", F.exists(q, lambda b: b["text"].rlike(FIGURE_WORD) & ~b["text"].rlike(IMAGE_REF)), None, "P2"),
        _when("TABLE_OUTSIDE", any_of(free, f"(?m){TABLE_LINE}") > 0, None, "P2"),
        _when("BOILERPLATE_INCLUDED", any_of(q, PAPER_NOTICE) > 0, None, "P2"),
        _when("ANSWER_EMPTY", F.exists(a, lambda b: F.char_length(strip(b["text"])) < 3), None, "P0"),
    ]
    return F.array_compact(F.array(*rules))


def mark_verdict(issues: Column) -> Column:
    """FAIL with a P0, REPAIR with a P1, HINT with any other, else PASS."""
    has = lambda s: F.exists(issues, lambda i: i["severity"] == s)
    return F.when(has("P0"), "FAIL").when(has("P1"), "REPAIR").when(F.size(issues) > 0, "HINT").otherwise("PASS")


def fidelity(source: Column, layer: Column, least_text: int = 50, least: int = 12, edge: int = 10) -> Column:
    """struct<status, n_prose, n_found, coverage, missing> of a source text against the text layer of
    its original: passages of ``least`` letters, digits and Chinese characters or more must stand in
    the source, whole or by their first or last ``edge``."""
    bare = lambda c: F.when(is_ascii(c), F.regexp_replace(c, r"[\W_]+", "")).otherwise(F.regexp_replace(c, r"[^0-9A-Za-z一-鿿]+", ""))
    untagged = lambda c: F.when(F.contains(c, F.lit("<")) & F.contains(c, F.lit(">")), F.regexp_replace(c, "<[^>]++>", "")).otherwise(c)
    # no separator is a letter, so what the layer holds is what its parts hold
    pieces = F.transform(F.split(layer, r"[，。、；：！？\n\r]", -1), lambda s: let(bare(s), lambda b: F.struct(b.alias("x"), F.char_length(b).alias("n"))))
    near = let(F.coalesce(source, F.lit("")), lambda c: let(untagged(c), bare))
    parts = let(pieces, lambda ps: F.struct(F.transform(F.filter(ps, lambda s: s["n"] >= least), lambda s: s["x"]).alias("passages"), F.aggregate(ps, F.lit(0), lambda n, s: n + s["n"]).alias("n"), near.alias("near")))

    def told(p: Column) -> Column:
        near, n = p["near"], F.size(p["passages"])
        # a passage that stands there whole stands there by its ends
        stands = lambda s: F.contains(near, F.left(s, F.lit(edge))) | F.contains(near, F.right(s, F.lit(edge)))
        status = F.when(p["n"].isNull() | (p["n"] < least_text), "no_text_layer").when(n == 0, "no_prose").otherwise("ok")

        def judged(lost: Column) -> Column:
            some = status == "ok"
            return F.struct(status.alias("status"), F.when(some, n).alias("n_prose"), F.when(some, n - F.size(lost)).alias("n_found"), F.when(some, F.round((n - F.size(lost)) / n, 3)).alias("coverage"), F.when(some, lost).alias("missing"))

        return let(F.filter(p["passages"], lambda s: ~stands(s)), judged)

    return let(parts, told)


def inline_evidence(lines: Column, answer: Column) -> Column:
    """struct<line, value>: the one conclusion that a solution states, in one line of the cited
    span. Null if it states none, several (even alike in one line), or has several parts."""
    block = _span(lines, answer)
    letters = lambda x: F.transform(find_all(x, LETTER_SAID, 0), lambda m: F.upper(F.regexp_extract(m, "([A-Da-d])$", 1)))
    values = lambda x: F.filter(F.transform(find_all(x, binding.CONCLUSION, 1), lambda v: F.regexp_replace(strip(v), "[。．.，,、；;]+$", "")), lambda v: (v != "") & ~v.rlike("^[A-Da-d]$"))
    said = F.filter(F.transform(block, lambda x, i: F.struct((answer["start"] + i).alias("line"), F.concat(letters(x), values(x)).alias("hits"))), lambda s: F.size(s["hits"]) > 0)
    vals = F.array_distinct(F.flatten(F.transform(said, lambda s: s["hits"])))
    sure = (F.size(said) > 0) & F.forall(said, lambda s: F.size(s["hits"]) == 1) & (F.size(vals) == 1) & ~many_parts(F.array_join(block, "\n"))
    return F.when(F.coalesce(sure, F.lit(False)), F.struct(said[0]["line"].cast("int").alias("line"), vals[0].alias("value")))


def table_evidence(lines: Column, answer: Column, numbers: Column) -> Column:
    """The one letter that a shared table in the cited span gives a unit of one number, else null."""
    block = F.array_join(_span(lines, answer), "\n")
    value = binding.table_value(block, F.get(numbers, F.lit(0)))
    sure = (F.size(numbers) == 1) & F.contains(block, F.lit("<table")) & value.rlike("^[A-D]$")
    return F.when(F.coalesce(sure, F.lit(False)), half_width(value))


def composite_options(papers: DataFrame) -> DataFrame:
    """doc_id, unit_ord, label, start_line, end_line of the options of composite choice units that
    declare none, as they stand in their questions (see options.option_marks). ``papers`` units have
    ``original_question_type``."""
    rows = _text(papers).select("doc_id", "lines", F.posexplode("units").alias("unit_ord", "u"))
    u = F.col("u")
    q = u["questions"]
    some = (u["unit_type"] == "composite_question") & u["options"].isNull() & u["original_question_type"].isin(*CHOICES) & (q["start"] >= 1) & (q["start"] <= q["end"]) & (q["end"] <= F.size("lines"))
    return rows.where(some).select("doc_id", "unit_ord", F.explode(option_marks(F.col("lines"), q["start"], q["end"])).alias("o")).select("doc_id", "unit_ord", "o.*")


def expected_output(path: Column, grades: dict[str, str], subjects: list[str], otherwise: str) -> Column:
    """Where the text of a source file goes: grade/subject/stem.md. Grade and subject are its folders,
    of a file at the top what its name says (``grades``: pattern to grade), or ``otherwise``;
    characters that file systems forbid become underscores."""
    parts = F.split(path, "/", -1)
    name = F.element_at(parts, -1)
    top = F.size(parts) == 1
    grade = F.lit(otherwise)
    for pattern, g in reversed(grades.items()):
        grade = F.when(name.rlike(pattern), g).otherwise(grade)
    subject = F.coalesce(*[F.when(F.contains(name, F.lit(s)), F.lit(s)) for s in subjects], F.lit(otherwise))
    folder = F.when(top, F.concat(grade, F.lit("/"), subject)).otherwise(F.concat(parts[0], F.lit("/"), F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).otherwise(otherwise)))
    return F.concat(folder, F.lit("/"), F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), FORBIDDEN, "_"), F.lit(".md"))


def images_outside(papers: DataFrame) -> DataFrame:
    """doc_id, n of image lines that no span of any unit has."""
    from sheaf.operators.exam import covered

    rows = _text(papers).withColumn("_in", covered(F.col("units")))
    free = F.filter(F.transform("lines", lambda x, i: x.rlike(IMAGE_LINE) & ~F.array_contains("_in", i + 1)), lambda b: b)
    return rows.select("doc_id", F.size(free).alias("n"))
