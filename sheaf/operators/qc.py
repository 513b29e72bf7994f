"""Rules to issues to verdicts, and number coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Severity order of verdicts: unknown never counts as passed.
LADDER = ("PASS", "PENDING_REVIEW", "FAIL")


def verdicts(rows: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """``rows`` with ``issues`` (array<struct<code, severity>> of the rules that hold, in their
    order) and ``verdict``, the most severe. Rules are (code, severity, condition) on the row."""
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"))) for code, sev, c in rules]))
    return rows.withColumn("issues", found).withColumn("verdict", worst(F.transform("issues", lambda i: i["severity"])))


def worst(severities: Column) -> Column:
    """The most severe of an array of severities."""
    out = F.lit(LADDER[0])
    for level in LADDER[1:]:
        out = F.when(F.array_contains(severities, level), F.lit(level)).otherwise(out)
    return out


def number_gaps(rows: DataFrame, key: str, number: Column) -> DataFrame:
    """``key``, first_missing, last_missing: the ranges that lack in 1..max of a key's numbers, one row
    each, however wide. Repeats go before the shuffle; a key's distinct numbers are sorted in one
    task, which spills. Null numbers and those below 1 are not looked at."""
    n = rows.select(key, number.cast("long").alias("_n")).where("_n >= 1").distinct()
    before = F.lag("_n", 1, 0).over(Window.partitionBy(key).orderBy("_n"))
    gaps = n.select(key, (before + 1).alias("first_missing"), (F.col("_n") - 1).alias("last_missing"))
    return gaps.where("first_missing <= last_missing")


def number_coverage(rows: DataFrame, key: str, number: Column) -> DataFrame:
    """Per key: top (its largest number), n_missing (of 1..top) and n_repeated (numbers beyond the
    first of each). Sums over distinct numbers: nothing is as long as the largest number."""
    each = rows.select(key, number.cast("long").alias("_n")).groupBy(key, "_n").count()
    inside = F.count_if(F.col("_n") >= 1)
    return each.groupBy(key).agg(F.max("_n").alias("top"), F.greatest(F.coalesce(F.max("_n"), F.lit(0)) - inside, F.lit(0)).alias("n_missing"), F.coalesce(F.sum(F.when(F.col("_n").isNotNull(), F.col("count") - 1)), F.lit(0)).alias("n_repeated"))


def missing_numbers(rows: DataFrame, key: str, number: Column) -> DataFrame:
    """Per key: missing (array<long>, the numbers that lack in 1..max, in order) and n_repeated (numbers
    beyond the first of each). The gaps between a key's sorted distinct numbers are filled, so what is
    held is as long as the key's numbers and what they lack. Null numbers are not looked at."""
    each = rows.select(key, number.cast("long").alias("_n")).groupBy(key, "_n").count()
    own = each.groupBy(key).agg(F.sort_array(F.collect_list("_n")).alias("_ns"), F.coalesce(F.sum(F.when(F.col("_n").isNotNull(), F.col("count") - 1)), F.lit(0)).alias("n_repeated"))
    none = F.array().cast("array<bigint>")
    before = lambda i: F.greatest(F.coalesce(F.get("_ns", i - 1), F.lit(0)), F.lit(0))
    gap = lambda n, i: F.when(n - before(i) > 1, F.sequence(before(i) + 1, n - 1)).otherwise(none)
    return own.select(key, F.flatten(F.transform("_ns", gap)).alias("missing"), "n_repeated")
