"""Option marks and their recovery."""

import pytest
from pyspark.sql import functions as F

from sheaf.operators import options as O

CASES = {
    # clean marks in any order, several to a line, full-width separators, lower case
    ("A. 甲  B、乙", "C．丙 d) 丁"): "A1-1 B1-1 C2-2 D2-2",
    ("A. 甲", "C. 丙", "B. 乙"): "A1-1 C2-2 B3-3",
    # tight marks after enclosed digits; a comma as separator
    ("A.①②B. ①④C. ②③D，③④",): "A1-1 B1-1 C1-1 D1-1",
    # a letter right after a mark is text, one after other text is a mark
    ("A. Na、P B. N、Cl C. F、Mg D. O、S",): "A1-1 B1-1 C1-1 D1-1",
    ("A. x", "B. H: O: H", "C. y", "D. z"): "A1-1 B2-2 C3-3 D4-4",
    # part of a Latin word is none
    ("DAB. x+a. y",): "A1-1",
    # glued to a digit: only the next letter, and not before more of a formula
    ("A. x", "B. y C. z 2D. w"): "A1-1 B2-2 C2-2 D2-2",
    ("A. x", "2C. w"): "A1-1",
    ("A. x", "2B.3w"): "A1-1",
    # a blank only: at a line's start, before Chinese, not in prose
    ("A. 甲", "B 乙"): "A1-1 B2-2",
    ("A. 甲", "B 是乙年"): "A1-1",
    ("A. 甲", "C 丙"): "A1-1",
    # lines without a mark: the next option, or more of the last one when A to D are there
    ("A. x", "B. y", "C. z", "plain text"): "A1-1 B2-2 C3-3 D4-4",
    ("A. x", "B. y", "C. z", "D. w", "more of it", "and more"): "A1-1 B2-2 C3-3 D4-6",
    ("A. x", "text one", "text two"): "A1-1 B2-2 C3-3",
    ("A. x", "<img src='a'>", "# head", "---", "12. next", "abc"): "A1-1",
    ("before it", "A. x"): "A2-2",
    ("no marks", "at all"): "A1-1 B2-2",
    ("A. x", "B. y", "H. z", "text after"): "A1-1 B2-2 H3-3",
    ("",): "",
}


def told(marks):
    return " ".join(f"{m['label']}{m['start_line']}-{m['end_line']}" for m in marks)


def test_marks(spark):
    df = spark.createDataFrame([(i, list(c)) for i, c in enumerate(CASES)], "i int, lines array<string>")
    got = df.select("i", O.option_marks(F.col("lines"), F.lit(1), F.size("lines")).alias("m"), O.option_marks(F.concat(F.array(F.lit("题 A. x")), "lines"), F.lit(2), F.lit(99)).alias("moved")).collect()
    for r in got:
        lines, want = list(CASES.items())[r["i"]]
        assert told(r["m"]) == want, lines
        assert [(m["label"], m["start_line"] - 1) for m in r["moved"]] == [(m["label"], m["start_line"]) for m in r["m"]], lines


SPAN = "struct<start:int,end:int>"
UNIT = f"id string, lines array<string>, unit_type string, question_type string, options_lines {SPAN}, questions_lines {SPAN}, options array<{O.MARK}>, label string"
FOUR = ["x", "A. 甲", "B. 乙", "C. 丙", "D. 丁"]


def unit(id, lines=FOUR, span=(2, 5), options=None, kind="standalone_question", questions=None, choice="single_choice"):
    return (id, lines, kind, choice, span, questions, options, "own")


def test_recovery(spark):
    declared = lambda s: [(c, i + 2, i + 2) for i, c in enumerate(s)]
    rows = [
        unit("none"),
        unit("empty", options=[]),
        unit("part", options=declared("AB")),
        unit("all", options=declared("ABCD")),
        unit("phantom", options=[*declared("ABCD"), ("F", 3, 3)]),
        unit("short", lines=["x", "A. 甲", "B. 乙", "C. 丙", ""], options=declared("ABCD")),
        unit("plain", lines=["x", "", "", "", "<p>"]),
        unit("out", span=(2, 9)),
        unit("back", span=(3, 2)),
        unit("null", lines=None),
        unit("unset", span=None),
        unit("composite", span=None, kind="composite_question", questions=(1, 5)),
        unit("open", span=None, kind="composite_question", questions=(1, 5), choice="essay"),
        unit("bare", span=None, kind="composite_question", questions=(1, 1)),
    ]
    got = {r["id"]: (None if r["options"] is None else told(r["options"]), r["option_note"], r["label"]) for r in O.with_options(spark.createDataFrame(rows, UNIT)).collect()}
    full = "A2-2 B3-3 C4-4 D5-5"
    assert got == {
        "none": (full, "FOUND", "own"),
        "empty": (full, "FOUND", "own"),
        "part": (full, "RECOVERED", "own"),
        "all": (full, None, "own"),
        "phantom": (full, "PRUNED", "own"),
        "short": (full, None, "own"),
        "plain": (None, "NO_LABELS", "own"),
        "out": (None, None, "own"),
        "back": (None, None, "own"),
        "null": (None, None, "own"),
        "unset": (None, None, "own"),
        "composite": (full, "COMPOSITE", "own"),
        "open": (None, None, "own"),
        "bare": (None, None, "own"),
    }


def test_recovery_of_nothing(spark):
    assert O.with_options(spark.createDataFrame([], UNIT)).count() == 0


def test_recovery_is_a_projection(spark):
    plan = O.with_options(spark.createDataFrame([unit("a")], UNIT))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("n", [3000])
def test_long_spans(spark, n):
    df = spark.createDataFrame([(["A. x", "B. y", "C. z", "D. w"] + ["more text"] * n,)], "l array<string>")
    got = df.select(O.option_marks(F.col("l"), F.lit(1), F.size("l")).alias("m")).first()["m"]
    assert told(got) == f"A1-1 B2-2 C3-3 D4-{n + 4}"
