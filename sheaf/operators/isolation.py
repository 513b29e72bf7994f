"""Batches in which a row that cannot be judged fails alone, with its reason.

An exception in one row ends a Spark job, and catching it would take Python. So what makes a rule
throw is asked first, as guards: where one is broken, the row's fields are emptied before any rule
sees them, and the row comes back as a failure that names the guard. It is one projection: nothing is
filtered, joined or shuffled, and no row is lost or passes in silence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import computed, let
from sheaf.operators import exam

#: A span of more lines than this, and than its text has, is an error of its manifest.
WIDEST = 1_000_000
#: Question numbers beyond this would overflow when they are moved up.
LARGEST = 1_000_000_000
CONTAINED = "QC_CONTAINED"


def parsed_units(rows: DataFrame, manifest: str) -> DataFrame:
    """``rows`` with units from the JSON array in ``manifest``: null where it is null or no such array,
    also where any value has another type, as what is left of a broken manifest must not be judged."""
    whole = F.concat(F.lit('{"units":'), manifest, F.lit("}"))
    got = F.from_json(whole, f"units array<{exam.UNIT}>, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    out = computed(rows, {"_got": got})
    good = F.col("_got._bad").isNull() & F.try_parse_json(manifest).isNotNull()
    return out.withColumn("units", F.when(good, F.col("_got.units"))).drop("_got")


def paper_guards() -> dict[str, Column]:
    """What must hold of a paper before it is judged, by the name that a failure tells."""
    units = F.col("units")
    wide = F.greatest(F.coalesce(F.char_length("text"), F.lit(0)) + 1, F.lit(WIDEST))
    width = lambda s: F.coalesce(s["end"].cast("long") - s["start"].cast("long"), F.lit(0).cast("long"))
    numbers = lambda u: F.coalesce(u["question_numbers"], F.array().cast("array<int>"))
    return {
        "units are missing": units.isNotNull(),
        "a unit is null": F.forall(units, lambda u: u.isNotNull()),
        "a span has one end": F.forall(units, lambda u: F.forall(F.array(*[u[r] for r in exam.ROLES]), lambda s: s["start"].isNull() == s["end"].isNull())),
        "a span is too wide": let(wide, lambda most: F.forall(units, lambda u: F.forall(F.array(*[u[r] for r in exam.ROLES]), lambda s: width(s) < most))),
        "a number is null": F.forall(units, lambda u: F.forall(numbers(u), lambda n: n.isNotNull())),
        "a number is too large": F.forall(units, lambda u: F.forall(numbers(u), lambda n: F.coalesce(n.between(-LARGEST, LARGEST), F.lit(True)))),
    }


def contained(rows: DataFrame, guards: dict[str, Column], judge: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """``judge`` on all rows: its columns, where issues (array<struct<code, severity, detail>>) and
    verdict of a row with a broken guard are one QC_CONTAINED, with the first guard's name, and FAIL.

    ``judge`` is a projection that keeps all columns. It sees nulls in all columns but ``keys`` for
    such rows, which come back with what they had. Rows may repeat; an empty table gives an empty one."""
    error = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in guards.items()])
    held = [c for c in rows.columns if c not in keys and c not in ("issues", "verdict")]
    out = computed(rows.select(*keys, *held), {"_error": error, "_held": F.struct(*[F.col(f"`{c}`") for c in held])})
    out = judge(out.withColumns({c: F.when(F.col("_error").isNull(), F.col(f"`{c}`")) for c in held}))
    failed = F.array(F.struct(F.lit(CONTAINED).alias("code"), F.lit("FAIL").alias("severity"), F.col("_error").alias("detail")))
    bad = F.col("_error").isNotNull()
    out = out.withColumns({"issues": F.when(bad, failed).otherwise(F.col("issues")), "verdict": F.when(bad, "FAIL").otherwise(F.col("verdict"))})
    return out.withColumns({c: F.col(f"_held.`{c}`") for c in held}).drop("_held", "_error")


def judged(papers: DataFrame) -> DataFrame:
    """exam.with_quality() on papers as they come: those that would end the job fail alone."""
    return contained(papers, paper_guards(), exam.with_quality, ["doc_id"])
