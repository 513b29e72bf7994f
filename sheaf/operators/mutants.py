"""Mutants of papers, and which rules notice them.

A mutator is an edit that must raise one rule's code. The mutants of a paper are judged within its row: what
the rules find in the original is carried over, and only the rules that look at an edited column are asked
again. So no text is copied for each mutant, and nothing joins. mutants() makes them as rows, for other checks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Mapping, Set
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import similarity
from sheaf.functions.text import computed, let
from sheaf.operators import exam
from sheaf.operators.exam import FACTS, SPAN, ZONES, text_lines, unit_start, with_facts, with_quality
from sheaf.operators.qc import worst

#: Number of the source's lines, which edits may ask for.
SIZE = "_size"


class Mutator(NamedTuple):
    """The code that must come, the columns that are edited, and the line that an edit adds to each of some of
    them, after a line feed and without any other change: what is known of such a text is not told anew."""

    code: str
    edit: Callable[[], dict[str, Column]]
    adds: Mapping[str, str] = MappingProxyType({})


def _first(change: Callable[[Column], Column]) -> dict[str, Column]:
    return {"units": F.transform("units", lambda u, i: F.when(i == 0, change(u)).otherwise(u))}


def _span(a: Column, z: Column) -> Column:
    return F.struct(a.cast("int").alias("start"), z.cast("int").alias("end")).cast(SPAN)


def _fields(**values: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def change(u: Column) -> Column:
        out = u
        for name, value in values.items():
            out = out.withField(name, value(u))
        return out

    return change


def _adds(code: str, column: str, line: str, more: Callable[[], dict[str, Column]] = dict) -> Mutator:
    return Mutator(code, lambda: {column: F.concat(column, F.lit("\n" + line))} | more(), {column: line})


_none = lambda u: F.lit(None).cast(SPAN)
_at = lambda k: lambda u: _span(unit_start(u) + k, unit_start(u) + k + 1)
_composite = lambda u: F.lit("composite_question")
(_stem, _), (_answer, _answer_end) = ZONES["stem"], ZONES["answer"]

MUTATORS: dict[str, Mutator] = {
    "zone_mark_lost": Mutator("C1_NO_STEM_START", lambda: {"rendered": F.replace("rendered", F.lit(_stem), F.lit(""))}),
    "number_lost": Mutator("C2_NUMBERS", lambda: _first(_fields(question_numbers=lambda u: F.array().cast("array<int>")))),
    "answer_emptied": Mutator("C3_ANSWERS", lambda: {"rendered": F.regexp_replace("rendered", f"(?s){_answer}.*?{_answer_end}", _answer + _answer_end)}),
    "parts_lost": Mutator("C4_COMPOSITE", lambda: _first(_fields(unit_type=_composite, material=_none, questions=_none))),
    "image_added": _adds("C5_IMAGES", "text", '<img src="m.png">'),
    "table_added": _adds("C6_TABLES", "text", "| a | b |"),
    "instruction_added": _adds("C7_INSTRUCTIONS", "rendered", "本大题共 3 小题"),
    "annotation_lost": Mutator("C8_NO_ANNOTATED", lambda: {"annotated": F.lit(None).cast("string")}),
    "annotation_edited": _adds("C8_DIFFERS", "annotated", "x"),
    "paper_line_taken": _adds("C9_PAPER_LINES", "text", "## 二、选择题", lambda: _first(_fields(extra=lambda u: _span(F.col(SIZE) + 1, F.col(SIZE) + 1)))),
    "mark_renamed": Mutator("C10_UNPAIRED", lambda: {"annotated": F.replace("annotated", F.lit("META:unit:end"), F.lit("META:other:end"))}),
    "stem_as_explanation": Mutator("C11_REPEATED_STEM", lambda: _first(_fields(explanation=lambda u: u["stem"]))),
    "parts_crossed": Mutator("C12_NOT_NESTED", lambda: _first(_fields(unit_type=_composite, material=_at(0), questions=_at(1)))),
    "number_twice": Mutator("C13_SAME_SECTION", lambda: _first(_fields(question_numbers=lambda u: F.concat(u["question_numbers"], u["question_numbers"])))),
    "section_lost": Mutator("C14_SCOPE_MISSING", lambda: _first(_fields(section_ref=lambda u: F.lit(None).cast("string")))),
    "source_lost": Mutator("C15_PROVENANCE", lambda: {"text": F.lit(None).cast("string")}),
}


def _sized(papers: DataFrame) -> DataFrame:
    return papers.withColumn(SIZE, F.size("_of_text.lines" if "_of_text" in papers.columns else text_lines(F.col("text"))))


def mutants(papers: DataFrame, mutators: Mapping[str, Mutator] = MUTATORS) -> DataFrame:
    """``papers`` once for each mutator: ``mutant``, the ``target`` code, ``changed`` (whether the edit did
    anything) and the edited columns. What ``papers`` has of exam.FACTS is told anew where its text is edited. A paper without units or text has nothing to edit there."""
    edits = {name: m.edit() for name, m in mutators.items()}
    rows = _sized(papers).withColumn("mutant", F.explode(F.array(*map(F.lit, mutators))))
    target = F.coalesce(*[F.when(F.col("mutant") == n, F.lit(m.code)) for n, m in mutators.items()])
    new = {}
    for c in dict.fromkeys(c for e in edits.values() for c in e):
        value = F.col(c)
        for name, e in edits.items():
            if c in e:
                value = F.when(F.col("mutant") == name, e[c].cast(papers.schema[c].dataType)).otherwise(value)
        new[c] = value
    rows = computed(rows, {f"_new_{c}": v for c, v in new.items()} | {"target": target})
    facts = {k: (c, f) for k, (c, f) in FACTS.items() if k in papers.columns and c in new}
    told = {k: F.when(F.col("mutant").isin([n for n, e in edits.items() if c in e]), f(F.col(f"_new_{c}"))).otherwise(F.col(k)) for k, (c, f) in facts.items()}
    rows = computed(rows, told) if told else rows
    changed = F.lit(False)
    for c in new:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    keep = [c for c in papers.columns if c not in new and c not in ("mutant", "target", "changed")]
    return rows.select(*keep, *[F.col(f"_new_{c}").alias(c) for c in new], "mutant", "target", changed.alias("changed"))


def judged_mutants(papers: DataFrame, mutators: Mapping[str, Mutator] = MUTATORS, check: Callable[[DataFrame], DataFrame] = with_quality) -> DataFrame:
    """doc_id, mutant, target, changed, new_codes (those the original lacks), hit (the target is among the
    mutant's codes), verdict and silent: changed, and the verdict still PASS. Another ``check`` than exam's
    rules gets the mutants as rows."""
    codes = lambda c: F.transform(c, lambda i: i["code"])
    papers = with_facts(papers)
    if check is with_quality:
        out = _judged_in_place(papers, mutators)
    else:
        base = check(papers)
        base = base.select(*[c for c in papers.columns if c in base.columns], codes("issues").alias("base_codes"))
        out = computed(check(mutants(base, mutators)), {"_codes": codes("issues")})
    new = F.array_sort(F.array_distinct(F.array_except("_codes", "base_codes")))
    return out.select("doc_id", "mutant", "target", "changed", new.alias("new_codes"), F.array_contains("_codes", F.col("target")).alias("hit"), "verdict", (F.col("changed") & (F.col("verdict") == "PASS")).alias("silent"))


def _judged_in_place(papers: DataFrame, mutators: Mapping[str, Mutator]) -> DataFrame:
    """doc_id, mutant, target, changed, _codes, verdict and base_codes of exam's rules over ``papers`` with FACTS."""
    edits = {name: m.edit() for name, m in mutators.items()}
    rows, r = _sized(papers), exam.columns_of(papers)
    alone, lines = exam.is_lost(r["text"], r["source_file"]), r["_of_text"]["lines"]
    # an edit could bring back a text or its name: then rules that do not ask for it have been asked before
    if any("source_file" in e for e in edits.values()):
        alone = r["text"].isNull()
    told = exam.told_from(r["units"], r["_of_text"], r["_of_annotated"])
    if any("text" in e and "units" not in e for e in edits.values()):  # edited texts have lines that are looked for in spans
        told["_covered"] = F.when(~alone, exam.covered(r["units"]))
    rows = computed(rows, told)
    found = F.when(alone, _issues(r, lambda on: "text" not in on)).otherwise(_issues(r, lambda on: True))
    rows = computed(rows, {"_found": found, "_pairs": F.when(~alone, exam.repeat_pairs(r["units"], lines))})
    groups: dict[frozenset[str], list[str]] = {}
    for name, e in edits.items():
        groups.setdefault(frozenset(e), []).append(name)
    group = lambda on, names: F.transform(F.array(*[_variant(papers, n, mutators[n], edits[n]) for n in names]), lambda v: _judged(r, v, on, {c for n in names for c in mutators[n].adds}))
    judged = F.concat(*[group(on, names) for on, names in groups.items()])
    rows = rows.select("doc_id", exam.is_lost(r["text"], r["source_file"]).alias("_lost"), "_found", "_pairs", judged.alias("_judged"))
    # pairs of lines for Python, by the mutant's place: those of the original, at -1, are also of mutants whose units and text are its own
    pair = lambda i: lambda p: F.struct(i.alias("i"), p["e"].alias("e"), p["s"].alias("s"))
    none = F.array().cast("array<struct<i:int,e:string,s:string>>")
    own = F.flatten(F.transform("_judged", lambda v, i: F.coalesce(F.transform(v["pairs"], pair(i)), none)))
    pairs = F.concat(F.coalesce(F.transform("_pairs", pair(F.lit(-1))), none), own)
    few = F.transform("_judged", lambda v: v.dropFields("pairs"))
    rows = computed(rows, {"_pairs": pairs, "_judged": few})
    above = F.lit(math.nextafter(exam.ALIKE, 1.0))
    rows = rows.withColumn("_alike", similarity.alike(F.col("_pairs.e"), F.col("_pairs.s"), above))
    rows = computed(rows, {"_repeat": F.array_distinct(F.filter(F.zip_with("_pairs", "_alike", lambda p, a: F.when(a, p["i"])), lambda i: i.isNotNull()))})
    issues = lambda found, lost, i: F.when(lost, exam.lost_issues()).otherwise(F.concat(found, F.array_compact(F.array(exam.repeated_issue(F.array_contains("_repeat", i))))))
    codes = lambda c: F.transform(c, lambda i: i["code"])
    base = codes(issues(F.col("_found"), F.col("_lost"), F.lit(-1)))
    rows = computed(rows, {"base_codes": base}).select("doc_id", "_repeat", "base_codes", F.posexplode("_judged").alias("_i", "v"))
    out = issues(F.col("v.found"), F.col("v.lost"), F.when(F.col("v.own"), F.col("_i")).otherwise(-1))
    rows = computed(rows, {"_issues": out})
    return rows.select("doc_id", "v.mutant", "v.target", "v.changed", codes("_issues").alias("_codes"), worst(F.transform("_issues", lambda i: i["severity"])).alias("verdict"), "base_codes")


def _issues(r: Mapping[str, Column], asked: Callable[[frozenset[str]], bool]) -> Column:
    """Issues of the rules whose columns are ``asked``, but for C11."""
    found = [i for on, told in (exam.RULES | exam.LAST_RULES).values() if asked(on) for i in told(r)]
    out = F.array(*found) if found else F.array().cast("array<struct<code:string,severity:string,detail:string>>")
    # without units there are no owners
    return F.array_compact(F.concat(out, F.coalesce(exam.owner_issues(r), F.slice(out, 1, 0))) if asked(exam.LAST_RULES["C13"][0]) else out)


def _variant(papers: DataFrame, name: str, mutator: Mutator, edit: Mapping[str, Column]) -> Column:
    """struct<mutant, target> of a mutant, its edited columns, and as +column the line that each gets, if that is known."""
    adds = {c: mutator.adds.get(c) for c in sorted(edit)}
    return F.struct(
        F.lit(name).alias("mutant"),
        F.lit(mutator.code).alias("target"),
        *[e.cast(papers.schema[c].dataType).alias(c) for c, e in sorted(edit.items())],
        *[F.lit(line if line is not None and exam.is_plain(line) else None).cast("string").alias("+" + c) for c, line in adds.items()],
    )


def _judged(r: Mapping[str, Column], v: Column, edited: frozenset[str], added: Set[str]) -> Column:
    """struct<mutant, target, changed, lost, found, own, pairs> of a variant whose ``edited`` columns are others:
    the issues but for C11, and whether the pairs of lines that C11 asks for are its own. Some get a line in
    their columns ``added``."""
    changed = functools.reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(v[c]) for c in sorted(edited)), F.lit(False))
    facts = {k: exam.facts_with(k, r[k], F.col(c), v[c], v["+" + c]) if c in added else f(v[c]) for k, (c, f) in FACTS.items() if c in edited}
    asks = lambda on: bool(on & edited)
    left = [k for k, (on, _) in (exam.RULES | exam.LAST_RULES).items() if not asks(on)]
    left += ["C14"] if "C13" in left else []
    none = F.slice("_found", 1, 0)
    kept = F.filter("_found", lambda i: F.substring_index(i["code"], "_", 1).isin(left)) if left else none
    own = asks(exam.REPEATED)

    def told(here: Mapping[str, Column]) -> Column:
        pairs = exam.repeat_pairs(here["units"], here["_of_text"]["lines"]) if own else F.lit(None).cast("array<struct<unit:string,e:string,s:string>>")
        found = lambda w: F.concat(kept, _issues(here | w, asks))
        # an edited text asks for what the same units and annotations have
        of = {"_numbers": "units", "_covered": "units", "_even": "annotated"}
        anew = {k: c for k, c in exam.told_from(here["units"], here["_of_text"], here["_of_annotated"]).items() if of[k] in edited}
        every = let(F.struct(*[c.alias(k) for k, c in anew.items()]), lambda w: found({k: w[k] for k in anew})) if anew else found({})
        return F.struct(every.alias("found"), pairs.alias("pairs"))

    here = dict(r) | {c: v[c] for c in edited}
    every = let(F.struct(*[c.alias(k) for k, c in facts.items()]), lambda w: told(here | {k: w[k] for k in facts})) if facts else told(here)
    lost = exam.is_lost(here["text"], here["source_file"])
    out = lambda w: F.struct(v["mutant"].alias("mutant"), v["target"].alias("target"), changed.alias("changed"), lost.alias("lost"), F.coalesce(w["found"], none).alias("found"), F.lit(own).alias("own"), w["pairs"].alias("pairs"))
    return let(F.when(~lost, every), out)


def kill_matrix(judged: DataFrame) -> DataFrame:
    """mutant, code, n: how many papers' mutants raise a code that the original lacks."""
    return judged.select("mutant", F.explode("new_codes").alias("code")).groupBy("mutant", "code").agg(F.count("*").alias("n"))


def survivors(judged: DataFrame) -> DataFrame:
    """mutant, target, n (papers that it changed), n_hit and n_silent: what the rules let pass."""
    return judged.where("changed").groupBy("mutant", "target").agg(F.count("*").alias("n"), F.count_if("hit").alias("n_hit"), F.count_if("silent").alias("n_silent"))
