"""Deterministic samples: by hash rank, evenly spaced, stratified. Python's random numbers are
replaced by hash order, which does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_sample(rows: DataFrame, group: str, key: Column, n: int) -> DataFrame:
    """Per group the first ``n`` rows by SHA-256 of ``key``."""
    by = Window.partitionBy(group).orderBy(F.sha2(key, 256), key)
    return rows.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= n).drop("_n")


def even_sample(rows: DataFrame, group: str, order: list[str], n: int, buckets: int = 64) -> DataFrame:
    """Per group of m rows, those at floor(i * m / n) for i below n; all if there are fewer.

    Ranks are exact: the first column of ``order``, if it is a number, is dealt by its quantiles
    in each group into ``buckets``, whose sizes give the ranks before each; so a task ranks a
    part of a group. Other columns are ranked group by group."""
    from pyspark.sql.types import NumericType

    parts = F.lit(0)
    if isinstance(rows.schema[order[0]].dataType, NumericType):
        at = [i / buckets for i in range(1, buckets)]
        cuts = rows.groupBy(F.col(group).alias("_g")).agg(F.percentile_approx(order[0], at, 1000).alias("_cuts"))
        rows = rows.join(cuts, F.col(group).eqNullSafe(F.col("_g")), "left")
        parts = F.size(F.filter("_cuts", lambda c: c < F.col(order[0])))
    names = [c for c in rows.columns if c not in ("_g", "_cuts")]
    rows = rows.select(*names, parts.alias("_p"))
    sizes = rows.groupBy(F.col(group).alias("_h"), F.col("_p").alias("_q")).agg(F.count("*").alias("_n"))
    before, whole = Window.partitionBy("_h").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_h")
    sizes = sizes.select("_h", "_q", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_m"))
    by = Window.partitionBy(group, "_p").orderBy(*order)
    rows = rows.withColumn("_k", F.row_number().over(by)).join(sizes, F.col(group).eqNullSafe(F.col("_h")) & (F.col("_p") == F.col("_q")))
    i = F.col("_before") + F.col("_k") - 1
    slot = F.ceil(i * n / F.col("_m"))
    hit = (F.col("_m") <= n) | ((slot < n) & (F.floor(slot * F.col("_m") / n) == i))
    return rows.where(hit).select(*names)


def largest_then_strata(rows: DataFrame, size: str, stratum: str, key: str, n_largest: int, each: int) -> DataFrame:
    """The ``n_largest`` rows by size, then ``each`` of the rest per stratum by hash rank."""
    top = rows.orderBy(F.desc(size), key).limit(n_largest).withColumn("pick", F.lit("largest"))
    rest = rows.join(top.select(key), key, "left_anti")
    return top.unionByName(hash_sample(rest, stratum, F.col(key).cast("string"), each).withColumn("pick", F.lit("stratum")))
