"""Corpus scans, JSON Lines, manifests, recognition results, chat replies, and sinks."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.text import split_lines, strip

PAGE_BREAK = "\n\n---\n\n"
#: Derived trees below a corpus root: never sources.
DERIVED_NAMES, DERIVED_PREFIXES = ("_imgs", ".cache"), ("auto-annotated", "reslice")


def is_source_dir(top: Column) -> Column:
    out = ~top.isin(*DERIVED_NAMES)
    for p in DERIVED_PREFIXES:
        out = out & ~top.startswith(p)
    return out


@F.pandas_udf(T.StringType())
def _decoded_nfc(content: pd.Series) -> pd.Series:
    """Strict UTF-8, composed; null where the bytes are no UTF-8."""

    def one(b: bytes) -> str | None:
        try:
            return unicodedata.normalize("NFC", b.decode("utf-8"))
        except UnicodeDecodeError:
            return None

    return content.map(one)


def normalised_sha256(text: Column) -> Column:
    """SHA-256 of the text with LF ends, without white space at line ends and around it all."""
    lines = F.transform(F.split(text, r"\r\n|\r|\n", -1), lambda x: F.regexp_replace(x, r"(?U)[\s\x1c-\x1f]+$", ""))
    return F.sha2(strip(F.array_join(lines, "\n")), 256)


def scan(spark: SparkSession, root: str, pattern: str = "*.md", derived: bool = False) -> DataFrame:
    """Files below ``root``: rel_path, top_dir, parent_dir, basename, stem, size, mtime, sha256,
    text (null if no UTF-8) and norm_sha256. Derived trees are left out unless asked for."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    local = "://" not in root or root.startswith("file:")
    base = "file:" + root.removeprefix("file://").removeprefix("file:") if local else root
    rows = rows.withColumn("rel_path", F.replace("path", F.lit(base.rstrip("/") + "/"), F.lit("")))
    parts = F.split("rel_path", "/")
    rows = rows.withColumns({"top_dir": F.when(F.size(parts) > 1, parts[0]).otherwise(""), "parent_dir": F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise(""), "basename": F.element_at(parts, -1)})
    if not derived:
        rows = rows.where(is_source_dir(F.col("top_dir")))
    rows = rows.withColumns({"text": _decoded_nfc("content"), "sha256": F.sha2("content", 256), "stem": F.regexp_replace("basename", r"\.[^.]*$", "")})
    return rows.select("rel_path", "top_dir", "parent_dir", "basename", "stem", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), "sha256", "text", normalised_sha256(F.col("text")).alias("norm_sha256"))


def first_path(files: DataFrame, key: str = "stem", order: str = "rel_path") -> DataFrame:
    """One path a key, the first by ``order``."""
    return files.groupBy(key).agg(F.min_by("rel_path", order).alias("rel_path"), F.count("*").alias("n"))


def paths_by_key(files: DataFrame) -> DataFrame:
    """key_kind, key, paths: by stem, by its lower case, and without a trailing ``(N)``."""
    kinds = {"exact": F.col("stem"), "casefold": F.lower("stem"), "stripped": F.regexp_replace("stem", r"\s*[(（]\d+[)）]$", "")}
    rows = files.select("rel_path", F.explode(F.array(*[F.struct(F.lit(k).alias("key_kind"), c.alias("key")) for k, c in kinds.items()])).alias("k"))
    return rows.groupBy("k.key_kind", "k.key").agg(F.array_sort(F.collect_list("rel_path")).alias("paths"))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad ones as (line). With ``strict`` a bad row is an error."""
    raw = spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("line"), F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}).alias("r"))
    bad = raw.where("r IS NULL OR r._bad IS NOT NULL").select("line")
    if strict and (first := bad.head(1)):
        raise ValueError(f"not JSON: {first[0]['line'][:200]}")
    return raw.where("r._bad IS NULL AND r IS NOT NULL").select("r.*").drop("_bad"), bad


def read_manifests(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Manifest files below ``root`` with the given columns and ``extra``, the whole object as a
    map, so that unknown keys are carried through."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.manifest.json")
    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema).alias("m"), F.from_json("value", "map<string,string>").alias("extra"))
    return rows.select("path", "m.*", "extra")


RECOGNISED = "result struct<layoutParsingResults array<struct<markdown struct<text string, images map<string,string>>>>>"


def recognised_text(lines: DataFrame) -> DataFrame:
    """doc_id, pages, text, images of recognition results (doc_id, line_no, line: one JSON object
    a line): pages in order, joined by page breaks. Bad lines are skipped and counted."""
    rows = lines.select("doc_id", "line_no", F.from_json("line", RECOGNISED)["result"]["layoutParsingResults"].alias("p"))
    got = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("line_no", "p"))), lambda a, b: F.when(a["line_no"] < b["line_no"], -1).otherwise(1)).alias("all"), F.count_if(F.col("p").isNull()).alias("bad_lines"))
    pages = F.flatten(F.transform("all", lambda r: r["p"]))
    got = got.select("doc_id", "bad_lines", pages.alias("pages"))
    images = F.flatten(F.transform("pages", lambda p: F.coalesce(F.map_entries(p["markdown"]["images"]), F.array().cast("array<struct<key:string,value:string>>"))))
    return got.select("doc_id", F.size("pages").alias("pages"), F.array_join(F.transform("pages", lambda p: F.coalesce(p["markdown"]["text"], F.lit(""))), PAGE_BREAK).alias("text"), images.alias("images"), "bad_lines")


def result_status(pages_read: Column, records: Column, bad: Column, expected: Column) -> Column:
    """Whether a recognition result is whole: its lines parse and its pages are as many as the
    document's."""
    return F.when(F.coalesce(records, F.lit(0)) == 0, "MISSING").when(bad > 0, "BAD_JSON").when(expected.isNull(), "UNVERIFIED").when(pages_read != expected, "PAGE_MISMATCH").otherwise("OK")


def numbered_pages(lines: DataFrame) -> DataFrame:
    """Lines (doc_id, line_no, line) with ``page``: one more than the breaks up to them."""
    from pyspark.sql import Window

    by = Window.partitionBy("doc_id").orderBy("line_no")
    return lines.withColumn("page", 1 + F.sum(F.when(strip(F.col("line")) == "---", 1).otherwise(0)).over(by))


def with_boxes(lines: DataFrame) -> DataFrame:
    """``prompt_text``: image lines with page and box appended; the line itself stays as it is."""
    rows = numbered_pages(lines)
    box = F.regexp_extract("line", r"box_(\d+_\d+_\d+_\d+)", 1)
    is_image = F.col("line").rlike(r"<img\s|!\[[^\]]*\]\(")
    tail = F.concat(F.lit(" [p"), F.col("page").cast("string"), F.when(box != "", F.concat(F.lit(" box "), F.translate(box, "_", ","))).otherwise(""), F.lit("]"))
    return rows.withColumn("prompt_text", F.when(is_image, F.concat("line", tail)).otherwise(F.col("line")))


def reply_object(reply: Column, schema: str) -> Column:
    """The JSON object of a chat reply as ``schema``: what is fenced, else from the first brace to
    the last; as it is, or without trailing commas, without control characters, with commas
    between neighbours of two lines. Null where none of these parses."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(\{.*\})\s*```", 1)
    braced = F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    no_tail = lambda c: F.regexp_replace(c, r",\s*([}\]])", "$1")
    commas = lambda c: F.regexp_replace(c, r"([}\]\"\d])\s*\n\s*([\"{\[])", "$1,$2")
    plain = lambda c: F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    tries = [f(c) for c in (fenced, braced) for f in (lambda x: x, no_tail, plain, commas, lambda x: commas(no_tail(x)))]
    ok = lambda c: F.when((c != "") & F.from_json(c, "map<string,string>", {"mode": "PERMISSIVE"}).isNotNull() & (F.json_object_keys(c).isNotNull()), c)
    return F.from_json(F.coalesce(*[ok(c) for c in tries]), schema)


def prompt(header: Column, text: Column) -> Column:
    """A prompt: header, then the numbered lines."""
    return F.concat(header, F.lit("\n"), F.array_join(F.transform(split_lines(text), lambda x, i: F.format_string("[L%04d] %s", i + 1, x)), "\n"))


def delivered(refs: DataFrame, assets: DataFrame) -> DataFrame:
    """Image references (doc_id, line_no, ref) with their asset (ref, sha256, bytes, magic) and
    status, in this order: REMOTE, UNSAFE, NOT_FOUND, BAD_IMAGE, COLLISION (another document has
    other bytes under the name), OK."""
    from pyspark.sql import Window

    from sheaf.functions.text import first_match, ref_kind, safe_path

    rows = refs.join(assets, "ref", "left")
    name = F.element_at(F.split("ref", "/"), -1)
    first = F.first("sha256", True).over(Window.partitionBy(name).orderBy("doc_id", "line_no", "ref").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    magic = F.col("magic").rlike("^(FFD8FF|89504E47|47494638|52494646)")
    status = first_match([("REMOTE", ref_kind(F.col("ref")) == "remote"), ("UNSAFE", ~safe_path(F.col("ref"))), ("NOT_FOUND", F.col("sha256").isNull()), ("BAD_IMAGE", ~magic), ("COLLISION", F.col("first_sha") != F.col("sha256"))], "OK")
    return rows.withColumn("first_sha", first).withColumn("status", status).drop("first_sha")


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """Rows under one folder a value of ``by``, committed by the writer as a whole."""
    df.write.mode(mode).partitionBy(*by).parquet(path)


LEDGER_RULES = {
    "source_rel": "source_rel IS NOT NULL AND source_rel <> '' AND source_rel NOT LIKE '%..%'",
    "sha256": "source_sha256 RLIKE '^[0-9a-f]{64}$'",
    "pages": "pages > 0 OR (pages IS NULL AND provenance IS NOT NULL)",
}


def append_ledger(entries: DataFrame, path: str) -> None:
    """Append entries if all keep LEDGER_RULES; else nothing is written."""
    bad = entries.where("NOT (" + " AND ".join(f"coalesce(({r}), false)" for r in LEDGER_RULES.values()) + ")").head(1)
    if bad:
        raise ValueError(f"a ledger entry breaks the rules: {bad[0].asDict()}")
    entries.write.mode("append").parquet(path)




def pdf_pages(content: Column) -> Column:
    """Page objects that a PDF's plain part shows; null where it shows none, as when all objects
    are in compressed streams, or where the bytes are no PDF. See ``pdf_pages_by_library``."""
    text = F.decode(content, "ISO-8859-1")
    n = F.regexp_count(text, F.lit(r"/Type\s*/Page(?![A-Za-z])"))
    return F.when(text.startswith("%PDF") & (n > 0), n)


@F.pandas_udf(T.IntegerType())
def pdf_pages_by_library(content: pd.Series) -> pd.Series:
    """Page counts by an optional PDF library; null without one, and where it fails."""
    try:
        import pypdfium2
    except ImportError:
        return pd.Series([None] * len(content), dtype="Int32")

    def one(b: bytes) -> int | None:
        try:
            return len(pypdfium2.PdfDocument(b))
        except Exception:  # noqa: BLE001  a file that cannot be read is a null, not a failed job
            return None

    return pd.Series([one(b) for b in content], dtype="Int32")


def text_layer(pages: DataFrame, least_chars: int = 50, least_share: float = 0.6) -> DataFrame:
    """doc_id, n_pages, kind: native_text where enough pages (doc_id, page, chars) have text."""
    share = F.avg((F.col("chars") >= least_chars).cast("int"))
    return pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"), F.when(share >= least_share, "native_text").otherwise("scanned").alias("kind"))
