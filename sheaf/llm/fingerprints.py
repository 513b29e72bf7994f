"""Document fingerprints: threshold-scaled sketches of word shingles, and what one holds of another.

A sketch keeps every distinct shingle hash below a fixed fraction (1/16) of the hash space, so it
grows with its document, and the sketch of a union is made of its parts' sketches alone. Two
sketches are compared where both are complete: of documents as unequal as a line and a book, the
share of the one's hashes that the other has is an estimate of how much of it is in there.

Sketches of fewer than FLOOR hashes below the fraction are filled up with their next smallest ones.
They are complete up to the last of these, and merge like the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from sheaf.llm.shared import ascii_lower, longs, partitions, range_ends, range_of, text_of

#: Words of a shingle, hashes that a sketch has at least (if its document has as many), and what
#: hashes below the fraction start with: a sixteenth of all hex strings is less than "1".
WIDTH, FLOOR, BELOW = 5, 16, "1"
#: A sketch of fewer than FLOOR hashes holds all; any hash is less than this.
ALL = "g"
#: Shingles that are hashed before those above the fraction go.
CHUNK = 4096


def words(text: Column) -> Column:
    """Words between blanks, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(ascii_lower(text), "\t\n\x0b\x0c\r", "     "), " "), "")


def _hash(w: Column, i: Column) -> Column:
    return F.md5(F.concat_ws(" ", *[F.get(w, i + k) for k in range(WIDTH)]))


def hashes(w: Column, start: Column, end: Column, keep=None) -> Column:
    """Hashes (16 hex digits) of the shingles that begin at words ``start`` to ``end``, those for
    which ``keep`` holds, in order; with fewer than WIDTH words all of them are one shingle."""
    end = F.least(end, F.greatest(F.size(w) - WIDTH, F.lit(0)))

    def chunk(at: Column) -> Column:
        found = F.transform(F.sequence(at, F.least(at + (CHUNK - 1), end)), lambda i: _hash(w, i))
        return F.transform(F.filter(found, keep) if keep else found, lambda h: F.substring(h, 1, 16))

    # a sequence runs backwards where its end is before its start
    some = F.flatten(F.transform(F.sequence(start, end, F.lit(CHUNK)), chunk))
    return F.when((F.size(w) > 0) & (start <= end), some).otherwise(F.array().cast("array<string>"))


def below(w: Column, start: Column, end: Column) -> Column:
    return hashes(w, start, end, lambda h: h < BELOW)


def _last(w: Column) -> Column:
    return F.size(w) - 1


def cut(found: Column) -> Column:
    """The sketch of hashes that hold all below the fraction and the FLOOR smallest."""
    s = F.array_sort(F.array_distinct(found))
    return F.slice(s, 1, F.greatest(F.size(F.filter(s, lambda h: h < BELOW)), F.lit(FLOOR)))


def filled(some: Column, w: Column) -> Column:
    """The sketch, given all hashes below the fraction: where they are too few, all are taken."""
    s = F.array_distinct(some)
    return F.when(F.size(s) >= FLOOR, F.array_sort(s)).otherwise(cut(hashes(w, F.lit(0), _last(w))))


def sketch(w: Column) -> Column:
    """The sketch of a text's words: sorted distinct hashes. ``w`` must be a stored column."""
    return filled(below(w, F.lit(0), _last(w)), w)


def merged(a: Column, b: Column) -> Column:
    """The sketch of both documents' shingles together."""
    return cut(F.concat(a, b))


def bound(s: Column) -> Column:
    """The sketch has all of its document's hashes up to this one."""
    return F.when(F.size(s) < FLOOR, F.lit(ALL)).otherwise(F.greatest(F.lit(BELOW), F.element_at(s, -1)))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds near_``name``, an estimate of the share of a's shingles that b has, and alike_``name``, of
    their resemblance (both of all). Only hashes up to the lower of the bounds count. Without any
    there, 0; two empty sketches are alike."""
    df = df.withColumn("_most", F.least(bound(F.col(a)), bound(F.col(b))))
    df = df.withColumns({"_a": F.filter(a, lambda h: h <= F.col("_most")), "_b": F.filter(b, lambda h: h <= F.col("_most"))})
    df = df.withColumn("_k", F.size(F.array_intersect("_a", "_b")))
    empty = (F.size(a) == 0) & (F.size(b) == 0)
    ratio = lambda n: F.when(empty, F.lit(1.0)).when(n == 0, F.lit(0.0)).otherwise(F.col("_k").cast("double") / n)
    return df.withColumns({f"near_{name}": ratio(F.size("_a")), f"alike_{name}": ratio(F.size("_a") + F.size("_b") - F.col("_k"))}).drop("_most", "_a", "_b", "_k")


def with_next(docs: DataFrame, per_partition: int = 4) -> tuple[DataFrame, WindowSpec]:
    """Rows (doc_id, text; null: empty), dealt so that in the window the row after each is the next by
    descending doc_id, and after the last the first. Null ids come last, rows of one id by hash of
    their text. ``guest`` rows are there for those before them only.

    Whole texts shuffle once, by ranges of doc_id (``per_partition`` to a partition). A row with the
    largest id of its range also goes, as a guest, to the range above, where the row before it ends;
    those with the largest of all go to the lowest range. Rows that share one id meet in one
    range, which spills.
    """
    ends = range_ends(docs.select("doc_id"), per_partition * partitions(docs.sparkSession))
    at = range_of(F.col("doc_id"), ends)
    is_end = F.get(longs(ends), "range").eqNullSafe(F.col("doc_id"))
    to = F.when(is_end, F.array(F.struct("range", F.lit(False).alias("guest")), F.struct(F.pmod(F.col("range") + 1, F.lit(max(len(ends), 1))).alias("range"), F.lit(True).alias("guest"))))
    rows = docs.select("doc_id", text_of().alias("text"), at.alias("range"))
    rows = rows.select("doc_id", "text", F.inline(F.coalesce(to, F.array(F.struct("range", F.lit(False).alias("guest"))))))
    return rows.repartition("range"), Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited (text), sketch and edited_sketch (sorted
    hashes), near_edited and near_next (share of the sketch's hashes that the edited text's and the
    next document's have), alike_edited and alike_next (resemblance).

    Null and empty texts have empty sketches, alike to each other (1) and to no others (0). A single
    row is its own next one. Repeated rows, and rows that share an id, follow each other. Other
    columns are not read. An empty table gives no rows. Texts of any length are hashed whole, CHUNK
    shingles at a time. The edited text keeps the hashes of its unchanged part: only shingles from
    there on are hashed anew.
    """
    rows, order = with_next(docs)
    n = F.char_length("text")
    # the shingles of the first part end before its last word, which the edit may change
    rows = rows.withColumn("w", words(F.col("text"))).withColumn("kept_chars", n - F.floor(n / 3).cast("int"))
    rows = rows.withColumn("head_words", F.greatest(F.size(words(F.substring("text", F.lit(1), F.col("kept_chars")))) - WIDTH, F.lit(0)))
    rows = rows.withColumn("head", below(F.col("w"), F.lit(0), F.col("head_words") - 1)).withColumn("tail", below(F.col("w"), F.col("head_words"), _last(F.col("w"))))
    rows = rows.withColumn("sketch", filled(F.concat("head", "tail"), F.col("w"))).drop("w", "tail")
    rows = rows.withColumn("next", F.lead(F.struct("text", "sketch")).over(order)).where("NOT guest")
    edited = F.concat(F.substring("text", F.lit(1), F.col("kept_chars")), F.substring("next.text", F.lit(1), n - F.col("kept_chars")))
    rows = rows.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "sketch", "head", "head_words", F.col("next.sketch").alias("next_sketch"))
    rows = rows.withColumn("w", words(F.col("edited")))
    rows = rows.withColumn("tail", below(F.col("w"), F.col("head_words"), _last(F.col("w"))))
    rows = rows.withColumn("edited_sketch", filled(F.concat("head", "tail"), F.col("w"))).drop("w", "head", "tail", "head_words")
    rows = with_likeness(with_likeness(rows, "sketch", "edited_sketch", "edited"), "sketch", "next_sketch", "next")
    return rows.drop("next_sketch").withColumn("n_chars", F.col("n_chars").cast("long"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    join = lambda c: F.array_join(c, ",")
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), join("sketch").alias("fingerprint"), join("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next", "alike_edited", "alike_next")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS nt FROM d),
e AS (SELECT *, substr(t, 1, n - n // 3) || substr(nt, 1, n // 3) AS et FROM o),
x AS (SELECT t FROM d UNION SELECT et FROM e),
w AS (SELECT t, list_filter(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda q: q <> '') AS ws FROM x),
h AS (SELECT t, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
      lambda i: substr(md5(array_to_string(ws[i:i + 4], ' ')), 1, 16)))) END AS hs FROM w),
s AS (SELECT t, hs[1:greatest(16, len(list_filter(hs, lambda q: q < '1')))] AS sk FROM h),
b AS (SELECT t, sk, CASE WHEN len(sk) < 16 THEN 'g' ELSE greatest('1', sk[-1]) END AS top FROM s),
p AS (SELECT e.doc_id, e.n, e.et, a.sk, c.sk AS esk, a.sk AS x1, list_filter(a.sk, lambda q: q <= least(a.top, c.top)) AS ae, list_filter(c.sk, lambda q: q <= least(a.top, c.top)) AS ce,
      list_filter(a.sk, lambda q: q <= least(a.top, f.top)) AS af, list_filter(f.sk, lambda q: q <= least(a.top, f.top)) AS cf, f.sk AS nsk
      FROM e JOIN b a ON a.t = e.t JOIN b c ON c.t = e.et JOIN b f ON f.t = e.nt),
k AS (SELECT *, len(list_intersect(ae, ce)) AS ke, len(list_intersect(af, cf)) AS kf FROM p)
SELECT doc_id, n::BIGINT AS n_chars, sha256(et) AS edited_sha256, array_to_string(sk, ',') AS fingerprint, array_to_string(esk, ',') AS edited_fingerprint,
       CASE WHEN len(sk) = 0 AND len(esk) = 0 THEN 1.0::DOUBLE WHEN len(ae) = 0 THEN 0.0 ELSE ke::DOUBLE / len(ae) END AS near_edited,
       CASE WHEN len(sk) = 0 AND len(nsk) = 0 THEN 1.0::DOUBLE WHEN len(af) = 0 THEN 0.0 ELSE kf::DOUBLE / len(af) END AS near_next,
       CASE WHEN len(sk) = 0 AND len(esk) = 0 THEN 1.0::DOUBLE WHEN len(ae) + len(ce) = ke THEN 0.0 ELSE ke::DOUBLE / (len(ae) + len(ce) - ke) END AS alike_edited,
       CASE WHEN len(sk) = 0 AND len(nsk) = 0 THEN 1.0::DOUBLE WHEN len(af) + len(cf) = kf THEN 0.0 ELSE kf::DOUBLE / (len(af) + len(cf) - kf) END AS alike_next
FROM k
"""
