"""Line dedup: range-partitioned line hashes, first occurrences, keep bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.exact_dedup import MOST_BITS, bloom, mark_possible
from sheaf.llm.shared import BLANKS, ascii_lower, partitions, stored, text_of


def _lines():
    return F.split(text_of(), "\n", -1)


def occurrences(docs: DataFrame, least: int = 20) -> DataFrame:
    """One row per line whose key has ``least`` code points or more: doc_id, th (hash of the
    whole text, so that rows which share a doc_id stay apart), pos, and two hashes of the key."""
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("th"), F.posexplode(_lines()).alias("pos", "line"))
    rows = rows.select("doc_id", "th", "pos", key.alias("k")).where(F.char_length("k") >= least)
    return rows.select("doc_id", "th", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit("line"), F.col("k")).alias("h2"))


def _prefix():
    """The first 48 bits of h1: percentile_approx computes in doubles, which hold them exactly."""
    return F.shiftright("h1", 16)


def hot_hashes(occ: DataFrame, n: int) -> list[int]:
    """Prefixes of hashes that hold more than about 1/4n of all rows: those that fill two
    neighbouring 4n-quantiles. At most 2n values, whatever the size of the table."""
    n *= 4
    cuts = [i / n for i in range(1, n)]
    got = occ.agg(F.percentile_approx(_prefix(), cuts, 10 * n + 1000).alias("q")).first()["q"] or []
    return sorted({a for a, b in zip(got, got[1:]) if a == b})


def dropped_lines(occ: DataFrame, n: int, least_docs: int = 3) -> DataFrame:
    """doc_id, th, pos of the lines that go.

    Hashes are dealt by range and sorted within, each by document (largest first) and position;
    a pass in that order sees the first line of each document. A hot hash is not dealt at all:
    its documents are counted with partial sums, and its two figures (at most 2n hashes, so
    broadcast) go to its rows where they are.
    """
    hot = hot_hashes(occ, n)
    key = ["h1", "h2"]
    order = Window.partitionBy(*key).orderBy(F.col("doc_id").desc_nulls_last(), "th", "pos")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cold = occ.where(~_prefix().isin(hot)) if hot else occ
    cold = cold.repartitionByRange(n, *key).sortWithinPartitions(F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), "th", "pos")
    new_doc = (F.row_number().over(order) == 1) | ~F.lag("doc_id").over(order).eqNullSafe(F.col("doc_id"))
    cold = cold.withColumn("fresh", new_doc.cast("int")).withColumn("docs", F.sum("fresh").over(whole)).withColumn("top", F.first("doc_id").over(whole))
    gone = (F.col("docs") >= least_docs) & ~F.col("doc_id").eqNullSafe(F.col("top"))
    out = cold.where(gone).select("doc_id", "th", "pos")
    if hot:
        rows = occ.where(_prefix().isin(hot))
        sums = rows.groupBy(*key, "doc_id").agg(F.lit(1).alias("one")).groupBy(*key).agg(F.count("*").alias("docs"), F.max("doc_id").alias("top"))
        out = out.unionByName(rows.join(F.broadcast(sums), key).where(gone).select("doc_id", "th", "pos"))
    return out


def keep_bitmaps(gone: DataFrame) -> DataFrame:
    """Per document that loses lines, its keep bitmap as run lengths: ``runs``, an array of the
    first and last position of each run of zeros; all other bits are ones."""
    p = F.array_sort(F.collect_set("pos"))
    edge = lambda step, far: lambda x, i: (i == far) | (F.get("p", i + step) != x + step)
    rows = gone.groupBy("doc_id", "th").agg(p.alias("p"))
    first, last = F.filter("p", edge(-1, F.lit(0))), F.filter("p", edge(1, F.size("p") - 1))
    return rows.select("doc_id", "th", F.arrays_zip(first.alias("first"), last.alias("last")).alias("runs"))


def bits_of(runs, n):
    """The bitmap as an array of n booleans."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(runs, i - 1)["last"])
    parts = F.transform(runs, lambda r, i: F.concat(F.array_repeat(F.lit(True), r["first"] - before(i) - 1), F.array_repeat(F.lit(False), r["last"] - r["first"] + 1)))
    return F.concat(F.flatten(parts), F.array_repeat(F.lit(True), n - 1 - F.element_at(runs, -1)["last"]))


def line_dedup(docs: DataFrame, least: int = 20, least_docs: int = 3) -> DataFrame:
    """Keep bitmaps (doc_id, th, runs) of the documents that lose lines.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of ``least`` code
    points or more in ``least_docs`` documents or more stay only in the largest doc_id that has
    them. A null text is one empty line; a null doc_id is the smallest, and all its rows one
    document. Rows that share a doc_id are one document to the counts and keep bitmaps of their
    own. An empty table gives no rows; other columns are not read.
    """
    occ = stored(occurrences(docs, least), "lines")
    return keep_bitmaps(dropped_lines(occ, partitions(docs.sparkSession), least_docs))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_dropped and ``kept``, the text of the lines that stay; columns
    of these names are replaced.

    A filter of the documents that lose lines (of bounded size) is broadcast; only texts it lets
    through meet the bitmaps by a shuffle, the others stay where they are.
    """
    maps = stored(bitmaps.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "runs"), "bitmaps")
    losing = bloom(maps.select(F.xxhash64("_id", "_th").alias("_key")), sha="_key", most_bits=MOST_BITS)
    old = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept")]
    rows = docs.select(F.struct(*old).alias("row"), F.col("doc_id").alias("_doc"), text_of().alias("t"), F.xxhash64(text_of()).alias("_h"))
    rows = mark_possible(rows.withColumn("_key", F.xxhash64("_doc", "_h")), losing, "_key")
    some = rows.where("possible").join(maps, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left").select("row", "t", "runs")
    rows = some.unionByName(rows.where("NOT possible").select("row", "t", F.lit(None).cast(maps.schema["runs"].dataType).alias("runs")))
    rows = rows.withColumn("lines", F.split("t", "\n", -1))
    sizes = F.transform("runs", lambda r: (r["last"] - r["first"] + 1).cast("long"))
    lost = F.coalesce(F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    left = F.array_compact(F.zip_with("lines", bits_of(F.col("runs"), F.size("lines")), lambda x, k: F.when(k, x)))
    kept = F.when(F.col("runs").isNull(), F.col("t")).otherwise(F.array_join(left, "\n"))
    rows = rows.select("row", F.struct(F.size("lines").cast("long").alias("n_lines"), lost.alias("n_dropped"), kept.alias("kept")).alias("new"))
    return rows.select("row.*", "new.*")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return apply_bitmaps(docs, line_dedup(docs)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, g.top IS NOT NULL AND g.top <> k.doc_id AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
