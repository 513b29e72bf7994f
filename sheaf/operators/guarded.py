"""Previews of a plan, and its application only to what was previewed.

A table's digest is a sum over its rows, so neither order nor partitions count, digests of parts add up
to that of the whole, and a plan's rows take one pass. A preview holds the digests of the base and of
the plan; a commit is refused where either is not the same any more, and afterwards the new base must
be the sum of both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lanes of 15 hex digits of a row's SHA-256, each summed modulo 2**60.
LANES, LANE = 4, 15
MODULUS = 1 << (4 * LANE)


class Refused(RuntimeError):
    """The base or the plan is not what was previewed."""


@dataclass(frozen=True)
class Digest:
    """A multiset of rows: its size and lanes. Adding two is the digest of both together."""

    n: int
    lanes: tuple[int, ...]

    def __add__(self, other: Digest) -> Digest:
        return Digest(self.n + other.n, tuple((a + b) % MODULUS for a, b in zip(self.lanes, other.lanes, strict=True)))

    def text(self) -> str:
        return f"{self.n}:" + "".join(f"{x:0{LANE}x}" for x in self.lanes)


@dataclass(frozen=True)
class Preview:
    base: Digest
    plan: Digest


def row_text(columns: list[str]) -> Column:
    """All fields of a row: `-` where null, else characters, a colon and the value."""
    part = lambda c: F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(*[part(F.when(F.col(f"`{c}`").isNotNull(), F.to_json(F.struct(F.col(f"`{c}`").alias("v"))))) for c in sorted(columns)])


def lanes(text: Column) -> list[Column]:
    """Aggregates: the lanes' sums, not yet reduced (decimals, so that no table overflows them)."""
    sha = F.sha2(text, 256)
    part = lambda i: F.conv(F.substring(sha, 1 + i * LANE, LANE), 16, 10).cast("decimal(38,0)")
    return [F.sum(part(i)).alias(f"lane{i}") for i in range(LANES)]


def digests(rows: DataFrame, text: Column, group: list[str]) -> DataFrame:
    """``group``, n and digest (text) of each group's rows, in any order; partial sums go before the
    shuffle, so a group of any size is a row a task."""
    out = rows.groupBy(*group).agg(F.count("*").alias("n"), *lanes(text))
    # a decimal's remainder, then 15 hex digits
    hexed = [F.lpad(F.lower(F.hex(F.pmod(F.col(f"lane{i}"), F.lit(str(MODULUS)).cast("decimal(38,0)")).cast("long"))), LANE, "0") for i in range(LANES)]
    return out.select(*group, "n", F.concat(F.col("n").cast("string"), F.lit(":"), *hexed).alias("digest"))


def digest_of(rows: DataFrame) -> Digest:
    """The digest of all rows and columns; column order does not count, names do not either."""
    r = rows.agg(F.count("*").alias("n"), *lanes(row_text(rows.columns))).first()
    return Digest(r["n"], tuple(int(r[f"lane{i}"] or 0) % MODULUS for i in range(LANES)))


def preview(base: DataFrame, plan: DataFrame) -> Preview:
    return Preview(digest_of(base), digest_of(plan))


def check(seen: Preview, base: DataFrame, plan: DataFrame) -> None:
    """Refuses a base or a plan that changed since the preview."""
    if digest_of(base) != seen.base:
        raise Refused("the base is not what was previewed")
    if digest_of(plan) != seen.plan:
        raise Refused("the plan is not what was previewed")


def append(path: str, plan: DataFrame, seen: Preview) -> DataFrame:
    """Adds the plan's rows to the table at ``path`` (Parquet, a folder for each append) and returns the
    table. Refused unless base and plan are what was previewed. A run again after a commit, or after a
    loss in the middle of one, adds nothing twice: the plan's folder is named by its digest and the
    base's, is written whole or, without its success mark, written anew, and is not part of the base.

    An append that is found committed is only checked. The table afterwards must be the sum of both.
    """
    spark = plan.sparkSession
    jvm = spark.sparkContext._jvm
    folder = f"{path.rstrip('/')}/append={_name(seen)}"
    done = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    committed = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)
    if not committed:
        check(seen, _without(path, folder, plan), plan)
        plan.write.mode("overwrite").parquet(folder)
    if digest_of(base_of(path, plan)) != seen.base + seen.plan:
        raise Refused("the table is not the sum of its base and the plan")
    return base_of(path, plan)


def _name(seen: Preview) -> str:
    return f"{seen.base.text()}-{seen.plan.text()}".replace(":", "_")


def base_of(path: str, plan: DataFrame) -> DataFrame:
    """The rows of all committed appends at ``path``; none where there is no table yet."""
    return _without(path, "", plan)


def _without(path: str, folder: str, plan: DataFrame) -> DataFrame:
    spark = plan.sparkSession
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return plan.limit(0)
    name = folder.rsplit("/", 1)[-1]
    kept = [str(s.getPath()) for s in fs.listStatus(top) if s.getPath().getName().startswith("append=") and s.getPath().getName() != name]
    done = [k for k in kept if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{k}/_SUCCESS"))]
    return spark.read.schema(plan.schema).parquet(*done) if done else plan.limit(0)
