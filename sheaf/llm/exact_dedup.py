"""Exact dedup: two-pass Bloom filtering, then exact groups of what may repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import discard, partitions, stored, text_of, without_blanks

BLOCK = 32_768  # bits of a block, 4 KB
#: Most bits of a filter that is broadcast (32 MB); the blocks of a larger one are joined.
MOST_BITS = 1 << 28


def text_digest(text="text"):
    """SHA-256 (binary) of the text without blanks."""
    return F.unhex(F.sha2(without_blanks(text_of(text)), 256))


def _places(sha: str):
    """A row's block and its two bits there, from hashes of the digest."""
    h1, h2 = F.xxhash64(F.col(sha)), F.xxhash64(F.col(sha), F.lit(1))
    return h1, F.pmod(h2, F.lit(BLOCK)), F.pmod(F.shiftrightunsigned(h2, 20), F.lit(BLOCK))


def bloom(digests: DataFrame, least: int = 1, sha: str = "sha", most_bits: int | None = None) -> tuple[DataFrame, int]:
    """A blocked Bloom filter, sixteen bits a row (or ``most_bits`` in all, where fewer bits a row pass
    more that are not in it), of the places hit ``least`` times or more: one row a block (block
    long, bits binary), and the number of blocks."""
    blocks = max(1, -(-16 * digests.count() // BLOCK))
    blocks = min(blocks, max(1, most_bits // BLOCK)) if most_bits else blocks
    h, b1, b2 = _places(sha)
    hits = digests.select(F.pmod(h, F.lit(blocks)).alias("block"), F.explode(F.array_distinct(F.array(b1, b2))).alias("bit"))
    often = hits.groupBy("block", "bit").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return often.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")), blocks


def repeat_filter(digests: DataFrame, sha: str = "sha") -> tuple[DataFrame, int]:
    """First pass: the filter of what occurs twice or more."""
    return bloom(digests, 2, sha)


def mark_possible(rows: DataFrame, found: tuple[DataFrame, int], sha: str = "sha", most_bits: int = MOST_BITS) -> DataFrame:
    """Second pass: ``possible`` is false only where the filter surely lacks the digest. A filter of
    up to ``most_bits`` is broadcast; with more, the rows (digests, never texts) meet its blocks
    by a join on the block, so the same filter decides at any size."""
    bits, blocks = found
    h, b1, b2 = _places(sha)

    def has(b):
        byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(b, F.lit(8)))), F.lit(2)) == 1

    bits = bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    out = rows.join(F.broadcast(bits) if blocks * BLOCK <= most_bits else bits, F.pmod(h, F.lit(blocks)) == F.col("_block"), "left")
    return out.withColumn("possible", F.coalesce(has(b1) & has(b2), F.lit(False))).drop("_block", "_bits")


def groups_of(possible: DataFrame) -> DataFrame:
    """Per digest that occurs twice or more: size and the row that stays. Pre-aggregated in
    each task, so a group of any size is one row a task in the shuffle."""
    best = F.max(F.struct(F.col("n_cp"), (-F.col("doc_id")).alias("neg")))
    return possible.groupBy("sha").agg(F.count("*").alias("size"), best.alias("b")).where("size > 1").select("sha", "size", (-F.col("b.neg")).alias("keep"))


def with_groups(possible: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """``possible`` with size and keep of its digest's group, null without one.

    Groups of more than 1/4p of the ``n`` rows, p the number of partitions, are 4p at most: they
    are broadcast, and their rows stay where they are. Only rows of smaller groups shuffle.
    """
    most = n / (4 * partitions(possible.sparkSession))
    large = groups.where(F.col("size") > most).select(F.col("sha").alias("_sha"), F.col("size").alias("_size"), F.col("keep").alias("_keep"))
    rows = possible.join(F.broadcast(large), F.col("sha") == F.col("_sha"), "left")
    near = rows.where("_sha IS NOT NULL").select(*possible.columns, F.col("_size").alias("size"), F.col("_keep").alias("keep"))
    rest = rows.where("_sha IS NULL").select(*possible.columns).join(groups.where(F.col("size") <= most), "sha", "left")
    return near.unionByName(rest.select(*near.columns))


def exact_dedup(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are without blanks (null: empty). Of equal ones the longest in
    code points stays, then the one with the smallest doc_id. Rows that share a doc_id and tie
    share the decision; a null doc_id loses to any other of its length, and is compared
    null-safe. Other columns are not read. An empty table gives no rows. The whole text, however
    long, is read once; the filter, the groups and the join work on the stored digests.
    """
    rows = stored(docs.select("doc_id", F.char_length(text_of()).alias("n_cp"), text_digest().alias("sha")), "digests")
    marked = stored(mark_possible(rows, repeat_filter(rows), most_bits=most_bits), "marked")
    discard(rows)
    possible = stored(marked.where("possible").select("doc_id", "n_cp", "sha"), "possible")
    groups = stored(groups_of(possible), "groups")
    hexed = F.lower(F.hex("sha")).alias("text_sha256")
    once = marked.where("NOT possible").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), hexed)
    rest = with_groups(possible, groups, marked.count())
    size = F.coalesce("size", F.lit(1).cast("long"))
    rest = rest.withColumn("keep", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")))
    rest = rest.select("doc_id", F.col("keep").alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep")).alias("kept"), hexed)
    return once.unionByName(rest)


def drop_copies(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group. Of rows that share
    doc_id and length in code points, the one with the smallest text, then any, stays.

    A second filter, of the digests of groups, is broadcast to the pass over the texts: only rows
    that may belong to a group shuffle, the others pass straight through. It has ``most_bits`` at
    most; beyond 16.8 million groups more rows that belong to none shuffle too, and stay.
    """
    names = docs.columns
    rows = stored(docs.select("doc_id", F.char_length(text_of()).alias("n_cp"), text_digest().alias("sha")), "digests")
    possible = mark_possible(rows, repeat_filter(rows), most_bits=most_bits).where("possible").select("doc_id", "n_cp", "sha")
    groups = stored(groups_of(possible), "groups")
    discard(rows)
    # no name can clash inside a struct
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text_digest().alias("sha"))
    marked = mark_possible(whole, bloom(groups, most_bits=most_bits), most_bits=max(most_bits, BLOCK))
    rest = marked.where("possible").withColumns({"doc_id": F.col("row.doc_id"), "n_cp": F.char_length(text_of("row.text"))})
    hot = with_groups(rest, groups, groups.agg(F.sum("size")).first()[0] or 0)
    alone = hot.where("size IS NULL").select("row.*")
    best = hot.where(F.col("size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep")))
    best = best.groupBy("sha").agg(F.min_by("row", F.struct(-F.col("n_cp"), text_of("row.text"))).alias("row")).select("row.*")
    return marked.where("NOT possible").select("row.*").unionByName(alone).unionByName(best)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
r AS (SELECT doc_id, h, count(*) OVER (PARTITION BY h) AS group_size,
             first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM r
"""
