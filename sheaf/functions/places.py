"""Places in the raw text of hits in its compact form (see text.compact), and likenesses of short texts.

Folding full-width forms keeps every character's place; only white space goes. So the map from compact
to raw places is the lengths of what went and what stayed, run by run, and one place is one fold over
it: nothing is as long as the text squared, and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.text import SPACE, compact, find_all, let

_GAP = f"(?U)[{SPACE}]+"


def runs(text: Column) -> Column:
    """The index map of a text: array<struct<gap, kept>>, numbers of characters, in order."""
    gaps = F.concat(F.array(F.lit("")), find_all(text, _GAP))
    return F.zip_with(gaps, F.split(text, _GAP, -1), lambda g, k: F.struct(F.char_length(g).alias("gap"), F.char_length(k).alias("kept")))


def raw_place(index: Column, at: Column) -> Column:
    """The place (from 0) in the raw text of the compact text's character ``at`` (from 0); null beyond."""

    def step(acc: Column, r: Column) -> Column:
        here = acc["place"].isNull() & (acc["left"] < r["kept"])
        place = F.when(here, acc["raw"] + r["gap"] + acc["left"]).otherwise(acc["place"])
        return F.struct((acc["left"] - r["kept"]).alias("left"), (acc["raw"] + r["gap"] + r["kept"]).alias("raw"), place.alias("place"))

    start = F.struct(at.cast("int").alias("left"), F.lit(0).alias("raw"), F.lit(None).cast("int").alias("place"))
    return F.when(at >= 0, F.aggregate(index, start, step, lambda acc: acc["place"]))


def find_compact(hay: Column, needle: Column) -> Column:
    """Half-open span, in places of the raw ``hay``, of the first place where the compact ``needle``
    stands in the compact ``hay``; null without one, for an empty needle and for nulls."""

    def spans(x: Column) -> Column:
        at = F.instr(x["h"], x["n"]) - 1
        found = F.struct(raw_place(x["index"], at).alias("start"), (raw_place(x["index"], at + F.char_length(x["n"]) - 1) + 1).alias("end"))
        return F.when((F.char_length(x["n"]) > 0) & (at >= 0), found)

    return let(F.struct(compact(hay).alias("h"), compact(needle).alias("n"), runs(hay).alias("index")), spans)


def characters(text: Column) -> Column:
    """The text's code points; splitting by nothing knows them, but makes one of an empty text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def is_subsequence(a: Column, b: Column) -> Column:
    """Whether a's characters stand in b in their order: one pass over b."""
    seen = lambda cs: F.aggregate(characters(b), F.lit(0), lambda i, c: F.when(F.get(cs, i) == c, i + 1).otherwise(i)) == F.size(cs)
    return F.when(a.isNotNull() & b.isNotNull(), let(characters(a), seen))


def longest_share(a: Column, b: Column) -> Column:
    """Length of the longest text that a and b share, over a's length; 0 for an empty a. By the end
    of the share in a: the best so far can grow by one character only."""
    grown = lambda best, e: F.when(F.contains(b, F.substr(a, e - best, best + 1)), best + 1).otherwise(best)
    ends = F.sequence(F.lit(1), F.char_length(a))
    return F.when(a == "", F.lit(0.0)).otherwise(F.aggregate(ends, F.lit(0), grown).cast("double") / F.char_length(a))
