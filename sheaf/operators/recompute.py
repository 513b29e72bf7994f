"""Claims against what is recomputed, field by field.

A report's row of claims and a recomputed row of facts become long: key, field, kind and value. They
meet once, by key and field; numbers may differ by a tolerance of their field, other kinds not at all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How a field of claims and facts may compare.
STATES = ("match", "differ", "claim_only", "fact_only", "disputed")


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    return "flag" if isinstance(kind, T.BooleanType) else "time" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "text"


def long_form(rows: DataFrame, key: list[str], fields: Mapping[str, Column]) -> DataFrame:
    """key, field, kind, value (string), one row a field; null values have no row. Numbers keep all
    digits: those of integers and decimals as they stand, doubles in their shortest form."""
    wide = rows.select(*key, *[c.alias(f"_f{i}") for i, c in enumerate(fields.values())])
    kinds = {f"_f{i}": _kind(wide.schema[f"_f{i}"].dataType) for i in range(len(fields))}
    texts = wide.select(*key, *[F.col(c).cast("string").alias(c) for c in kinds])
    out = texts.unpivot(key, list(kinds), "_column", "value").where("value IS NOT NULL")
    named = F.create_map(*[F.lit(x) for i, name in enumerate(fields) for x in (f"_f{i}", name)])
    typed = F.create_map(*[F.lit(x) for c, k in kinds.items() for x in (c, k)])
    return out.select(*key, named[F.col("_column")].alias("field"), typed[F.col("_column")].alias("kind"), "value")


def compared(claims: DataFrame, facts: DataFrame, key: list[str], tolerance: Mapping[str, float] | None = None) -> DataFrame:
    """key, field, claimed, found, status of two long forms.

    match; differ; claim_only, where nothing was recomputed; fact_only, where nothing is claimed;
    disputed, where a key has several different claims of a field or facts (the smallest and largest
    are shown). Equal repeats are one. Numbers match if they are ``tolerance`` apart at most (by
    field, else equal; integers by all their digits); NaN matches NaN. Null keys meet. Kinds that differ do not match.
    Both sides are grouped before they meet, so a repeated key is one row a field.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        v = F.struct("kind", "value")
        return df.groupBy(*key, "field").agg(F.min(v).alias(f"_{name}"), F.max(v).alias(f"_{name}_most"))

    a, b = side(claims, "c"), side(facts, "f")
    b = b.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("field").alias("_field"), "_f", "_f_most")
    same = F.col("field") == F.col("_field")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = a.join(b, same, "full_outer")
    x, y = F.col("_c.value").try_cast("double"), F.col("_f.value").try_cast("double")
    name = F.coalesce("field", "_field")
    allowed = F.lit(0.0)
    for f, t in (tolerance or {}).items():
        allowed = F.when(name == f, F.lit(float(t))).otherwise(allowed)
    exact = [F.when(F.col(f"_{s}.value").rlike(r"^-?\d{1,37}$"), F.col(f"_{s}.value").try_cast("decimal(38,0)")) for s in "cf"]
    apart = F.coalesce(F.abs(exact[0] - exact[1]).cast("double"), F.abs(x - y))  # doubles are too short for long integers
    close = (F.col("_c.value") == F.col("_f.value")) | ((F.col("_c.kind") == "number") & (apart <= allowed))
    status = (
        F.when(F.col("_f").isNull(), F.when(F.col("_c") == F.col("_c_most"), "claim_only").otherwise("disputed"))
        .when(F.col("_c").isNull(), F.when(F.col("_f") == F.col("_f_most"), "fact_only").otherwise("disputed"))
        .when((F.col("_c") != F.col("_c_most")) | (F.col("_f") != F.col("_f_most")), "disputed")
        .when((F.col("_c.kind") == F.col("_f.kind")) & F.coalesce(close, F.lit(False)), "match")
        .otherwise("differ")
    )
    shown = lambda s: F.when(F.col(f"_{s}") == F.col(f"_{s}_most"), F.col(f"_{s}.value")).otherwise(F.concat(F.col(f"_{s}.value"), F.lit(" | "), F.col(f"_{s}_most.value")))
    keys = [F.when(F.col("field").isNotNull(), F.col(k)).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(key)]
    return rows.select(*keys, name.alias("field"), shown("c").alias("claimed"), shown("f").alias("found"), status.alias("status"))


def report(found: DataFrame) -> DataFrame:
    """Per field how many keys are in each state, and the verdict: PASS where all match, FAIL where any
    differ or are disputed, else PENDING_REVIEW (what is on one side only proves nothing)."""
    rows = found.groupBy("field").agg(F.count("*").alias("n"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATES])
    return rows.withColumn("verdict", F.when(F.col("n_differ") + F.col("n_disputed") > 0, "FAIL").when(F.col("n_match") == F.col("n"), "PASS").otherwise("PENDING_REVIEW"))
