"""Chains of fixers, run until nothing changes; rows that are settled are not touched again.

A fixer takes rows and gives the same rows, each fixed by itself: a projection that keeps all columns
(see operators.fixers). A round is one pass of all fixers over the rows that the round before
changed, so a corpus costs one pass and then what is still moving. Nothing shuffles but the digests
of rows that are looked up in a ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.operators.guarded import row_text
from sheaf.sources.stages import stored

Fix = Callable[[DataFrame], DataFrame]
OWN = ("rounds", "steps", "settled")


def digest(columns: list[str]) -> Column:
    """What a row is known by: SHA-256 of all its fields."""
    return F.sha2(row_text(columns), 256)


def _unordered(kind: T.DataType) -> bool:
    """Whether Spark cannot compare values of a type: maps, variants and what holds them."""
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return any(_unordered(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else isinstance(kind, (T.MapType, T.VariantType))


def _same(rows: DataFrame, columns: list[str], before: str) -> Column:
    """Whether all ``columns`` are what the struct ``before`` holds. Fields are compared, not digested: a
    fixer leaves most as they are."""
    text = lambda c: F.to_json(F.struct(c.alias("v")))
    out = F.lit(True)
    for c in columns:
        a, b = F.col(f"`{c}`"), F.col(f"{before}.`{c}`")
        out = out & (text(a).eqNullSafe(text(b)) if _unordered(rows.schema[c].dataType) else a.eqNullSafe(b))
    return out


def _round(rows: DataFrame, columns: list[str], fixers: dict[str, Fix]) -> DataFrame:
    """One pass of all fixers. ``steps`` gains those that changed the row, ``settled`` tells that it is what it was."""
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    out = rows.withColumn("_first", whole)
    for k, (name, fix) in enumerate(fixers.items()):
        before = "_last" if k else "_first"
        out = fix(out.withColumn("_last", whole) if k else out)
        moved = ~_same(out, columns, before)
        out = out.withColumn("steps", F.when(moved, F.array_union("steps", F.array(F.lit(name)))).otherwise(F.col("steps"))).drop("_last")
    return out.withColumns({"rounds": F.col("rounds") + 1, "settled": _same(out, columns, "_first")}).drop("_first")


def fixpoint(rows: DataFrame, fixers: dict[str, Fix], most: int = 10) -> DataFrame:
    """``rows`` with rounds (int, passes that a row took, the last of which changed nothing), steps
    (array<string>, the fixers that changed it, in the order in which they first did) and settled.

    Rows that still change after ``most`` rounds come back as they are then, settled false: fixers that
    undo each other are told, not hidden. Rows may repeat, any column may be null, and an empty table
    gives an empty one; columns named like the results are replaced. Each round is written to the
    shared folder, so a round that is lost starts from the one before.
    """
    columns = [c for c in rows.columns if c not in OWN]
    moving = rows.select(*columns).withColumns({"rounds": F.lit(0), "steps": F.array().cast("array<string>"), "settled": F.lit(False)})
    parts = []
    for i in range(most):
        done = stored(_round(moving, columns, fixers), "chain")
        parts.append(done.where("settled") if i + 1 < most else done)
        moving = done.where("NOT settled")
        if moving.isEmpty():
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unsettled(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows that the ledger (digest) does not hold. Only digests decide: a row that is changed by
    anybody is open again, and one that comes back as it was is not."""
    known = ledger.select(F.col("digest").alias("_known")).distinct()
    return rows.withColumn("_digest", digest(rows.columns)).join(known, F.col("_digest") == F.col("_known"), "left_anti").drop("_digest")


def settled_digests(fixed: DataFrame) -> DataFrame:
    """The ledger's new entries of what fixpoint() gave: one a distinct settled row."""
    columns = [c for c in fixed.columns if c not in OWN]
    return fixed.where("settled").select(digest(columns).alias("digest")).distinct()
