"""Merkle manifest of a dataset: leaves are rows, three nodes make one, by source and then over sources.

Each parent is stored as its preimage, the digests of its children one after another. A leaf meets
the preimages of its ancestors: without its own 64 characters one is its siblings there, with
another digest in their place it is the preimage that a changed row would have made.

Nodes are joined in blocks of 81, four levels of a tree at a time. A block holds its nodes and all
their preimages in one row, of bounded size, and four levels cost one shuffle of digests; texts are
read once, where they are, and never shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.shared import discard, partitions, stored

FAN, LEVELS = 3, 4
BLOCK = FAN**LEVELS
DIGEST = 64
#: What a leaf digests, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


class Tree(NamedTuple):
    """rounds: a table of blocks for each round of four levels, from the leaves up; tops: key, top."""

    rounds: list[DataFrame]
    tops: DataFrame


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as `-` where null, else bytes, a colon and the value."""
    value = [f.cast("string") for f in fields]
    part = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in value]
    return F.sha2(F.concat(*part), 256)


def source_key(source: Column) -> Column:
    """Not null; sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds rank (from 0) and n, within ``key``, by ``order``. Rows are dealt by range of key and order
    and written; each range counts its own, so a key of any size is spread over ranges, and what one
    window sums up is a row a range."""
    at = rows.repartitionByRange(partitions(rows.sparkSession), "key", *order).withColumn("range", F.spark_partition_id())
    at = stored(at, "ranges")
    counts = at.groupBy("key", "range").count()
    by_key = Window.partitionBy("key")
    before = F.sum("count").over(by_key.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("key", "range", F.coalesce(before, F.lit(0)).alias("before"), F.sum("count").over(by_key).alias("n"))
    here = F.row_number().over(Window.partitionBy("key", "range").orderBy(*order)) - 1
    return at.withColumn("here", here).join(counts, ["key", "range"]).withColumn("rank", F.col("before") + F.col("here")).drop("range", "here", "before")


def blocks(nodes: DataFrame) -> DataFrame:
    """One row per 81 consecutive nodes of a key: key, block, items (the nodes by rank), pre (by level,
    the preimages of the parents there), top (the block's digest) and n (blocks of the key).

    A key's levels end where one node is left; levels above have no preimages.
    """
    rest = [c for c in nodes.columns if c not in ("key", "n")]
    out = nodes.groupBy("key", F.floor(F.col("rank") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("rank", *[c for c in rest if c != "rank"]))).alias("items"), F.first("n").alias("n"))
    out = out.withColumn("h", F.col("items.hash"))
    pre = []
    for level in range(LEVELS):
        parents = F.sequence(F.lit(0), F.floor((F.size("h") - 1) / FAN).cast("int"))
        joined = F.transform(parents, lambda i: F.array_join(F.slice("h", i * FAN + 1, FAN), ""))
        out = out.withColumn(f"pre{level}", F.when(F.col("n") > FAN**level, joined))
        out = out.withColumn("h", F.when(F.col(f"pre{level}").isNull(), F.col("h")).otherwise(F.transform(f"pre{level}", lambda p: F.sha2(p, 256))))
        pre.append(f"pre{level}")
    return out.select("key", "block", "items", F.array_compact(F.array(*pre)).alias("pre"), F.get("h", F.lit(0)).alias("top"), F.ceil(F.col("n") / BLOCK).alias("n"))


def tree(nodes: DataFrame) -> Tree:
    """The trees of all keys over nodes (key, rank, n, hash, more): all keys go through as many rounds
    as the largest needs."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = []
    while True:
        rounds.append(stored(blocks(nodes), "blocks"))
        most = -(-most // BLOCK)
        nodes = rounds[-1].select("key", F.col("block").alias("rank"), "n", F.col("top").alias("hash"))
        if most <= 1:
            return Tree(rounds, nodes.select("key", F.col("hash").alias("top")))


def _path(k: Column) -> Column:
    """Preimages and own slots of the block's item ``k``, from the parent up to the block's top."""
    power = F.array(*[F.lit(FAN**i) for i in range(LEVELS + 1)])
    step = lambda p, i: F.struct(F.get(p, F.floor(k / F.get(power, i + 1)).cast("int")).alias("pre"), F.pmod(F.floor(k / F.get(power, i)).cast("int"), F.lit(FAN)).alias("slot"))
    return F.transform("pre", step)


def paths(built: Tree, above: DataFrame | None = None) -> DataFrame:
    """The leaves' blocks, each with path: the preimages up to the key's top and their slots, and after
    them what ``above`` (key, path, more) has for the key. From the top, where a key has one block,
    down; a round's blocks meet those of the next by key and rank."""
    top, more = built.rounds[-1], [c for c in above.columns if c not in ("key", "path")] if above is not None else []
    here = top.join(above, "key") if above is not None else top.withColumn("path", F.array().cast("array<struct<pre: string, slot: int>>"))
    for below in reversed(built.rounds[:-1]):
        items = F.transform("items", lambda x, k: F.struct(x["rank"].alias("block"), F.concat(_path(k), "path").alias("path")))
        here = below.join(here.select("key", *more, F.inline(items)), ["key", "block"])
    return here


def siblings(path: Column) -> Column:
    """All siblings on the path in order: each preimage without its own slot."""
    return F.array_join(F.transform(path, lambda s: F.concat(F.substring(s["pre"], F.lit(1), s["slot"] * DIGEST), F.substring(s["pre"], (s["slot"] + 1) * DIGEST + 1, F.length(s["pre"])))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that the leaf gives: each preimage takes the digest so far in its slot."""
    spliced = lambda h, s: F.concat(F.substring(s["pre"], F.lit(1), s["slot"] * DIGEST), h, F.substring(s["pre"], (s["slot"] + 1) * DIGEST + 1, F.length(s["pre"])))
    return F.aggregate(path, leaf, lambda h, s: F.sha2(spliced(h, s), 256))


def verified(docs: DataFrame, claimed: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, siblings (digests, one after another),
    folded_root (of the row with ``claimed`` as its text) and verified.

    Null fields are `-`; an empty text is `0:`. Null sources are a source, the first; null doc_ids
    come first in theirs, rows that share one are in order of their leaves, and rows that are equal
    in all fields change places without effect on a digest. A lone row is its source's subroot, and
    a lone source's subroot the root. Columns beyond the five are not read. An empty table gives no
    rows. Texts of any length are read once, where they are.
    """
    own = [F.col(f"`{c}`") for c in FIELDS]
    changed = F.when(F.col("text").isNotNull() & claimed.isNotNull() & (claimed != F.col("text")), row_digest([*own[:-1], claimed]))
    leaves = stored(docs.select(source_key(F.col("source")).alias("key"), "doc_id", row_digest(own).alias("hash"), changed.alias("changed")), "leaves")
    built = tree(ranked(leaves, ["doc_id", "hash"]))
    over = tree(ranked(built.tops.select(F.lit("").alias("key"), F.col("key").alias("source"), F.col("top").alias("hash")), ["source"]))
    discard(leaves)
    top = over.tops.first()
    root = F.lit(top["top"] if top else None).cast("string")
    item = F.transform("items", lambda x, k: F.struct(x["source"].alias("key"), x["hash"].alias("subroot"), F.concat(_path(k), "path").alias("path")))
    sources = paths(over).select(F.inline(item))
    item = F.transform("items", lambda x, k: F.struct(x["doc_id"].alias("doc_id"), x["hash"].alias("leaf"), x["changed"].alias("changed"), F.concat(_path(k), "path").alias("path")))
    rows = paths(built, sources).select("subroot", F.inline(item))
    rows = rows.select("doc_id", "leaf", "subroot", root.alias("root"), siblings(F.col("path")).alias("siblings"), folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    claimed = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = verified(docs, claimed)
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")


def _oracle() -> str:
    """Levels unrolled: of a tree of up to 3**16 leaves, and of the tree over up to 3**8 sources."""
    out = [
        r"""
WITH d AS MATERIALIZED (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
       lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, (a & 1) * 3988292384))), 4294967295) & 1 AS odd FROM documents),
e AS (SELECT *, CASE WHEN odd = 0 THEN replace(text, chr(10), '') ELSE text END AS claimed,
       coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
       || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front FROM d),
l AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS key, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS h, sha256(front || coalesce(strlen(claimed) || ':' || claimed, '-')) AS f FROM e),
a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY key) AS n FROM l),
as0 AS MATERIALIZED (SELECT doc_id, key, h, f, i, n, '' AS proof FROM a0)"""
    ]

    def levels(p: str, count: int, more: str) -> None:
        for k in range(count):
            out.append(f"{p}p{k} AS MATERIALIZED (SELECT key, i // 3 AS i, string_agg(h, '' ORDER BY i) AS pre, (max(n) + 2) // 3 AS n FROM {p}{k} WHERE n > 1 GROUP BY key, i // 3)")
            out.append(f"{p}{k + 1} AS MATERIALIZED (SELECT key, i, n, sha256(pre) AS h FROM {p}p{k} UNION ALL SELECT key, i, n, h FROM {p}{k} WHERE n = 1)")
            slot = f"substr(pre, 1, 64 * (s.i % 3)::INT) || {{}} || substr(pre, 64 * (s.i % 3)::INT + 65)"
            out.append(
                f"{p}s{k + 1} AS MATERIALIZED (SELECT doc_id, s.key, s.h, {more}CASE WHEN pre IS NULL THEN f ELSE sha256({slot.format('f')}) END AS f, s.i // 3 AS i, s.n, "
                f"CASE WHEN pre IS NULL THEN proof ELSE proof || {slot.format(chr(39) * 2)} END AS proof FROM {p}s{k} s LEFT JOIN {p}p{k} p ON s.key = p.key AND s.i // 3 = p.i)"
            )

    levels("a", 16, "")
    out.append("b0 AS MATERIALIZED (SELECT '' AS key, key AS source, h, row_number() OVER (ORDER BY key) - 1 AS i, count(*) OVER () AS n FROM a16)")
    out.append("bs0 AS MATERIALIZED (SELECT doc_id, '' AS key, s.h, b0.h AS subroot, f, b0.i, b0.n, proof FROM as16 s JOIN b0 ON b0.source = s.key)")
    levels("b", 8, "subroot, ")
    return ",\n".join(out) + "\nSELECT doc_id, s.h AS leaf, subroot, b8.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b8.h AS verified FROM bs8 s JOIN b8 ON b8.key = s.key\n"


ORACLE = _oracle()
