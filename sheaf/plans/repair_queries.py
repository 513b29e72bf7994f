"""Queries of fix chains, migrations, moves and contained batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators import chain, exam, fixers, isolation, versions
from sheaf.operators.guarded import digest_of
from sheaf.plans.catalog import query
from sheaf.plans.exam_queries import _PAPERS, papers
from sheaf.sources.stages import new_folder, stored
from sheaf.sources.tables import table

#: What is wrong with a paper after its images are attached and its numbers moved up.
_AFTER = """CASE WHEN source = 'src3' THEN 'C15_PROVENANCE' ELSE array_to_string(list_filter([CASE WHEN cut THEN 'C2_NUMBERS' END,
    CASE source WHEN 'src2' THEN 'C3_ANSWERS' WHEN 'src6' THEN 'C4_COMPOSITE' WHEN 'src5' THEN CASE WHEN cut THEN 'C5_IMAGES' END END], lambda x: x IS NOT NULL), ',') END"""
CHAIN = {
    "explanations": fixers.trim_explanations,
    "images": fixers.attach_orphan_images,
    "headings": fixers.plain_numbered_lines,
    "numbers": fixers.shift_numbers,
    "spans": fixers.clamp_spans,
}


@query(
    "fix_chain",
    _PAPERS
    + f""", s AS (SELECT *, CASE WHEN source = 'src3' THEN '' ELSE array_to_string(list_filter([CASE WHEN source = 'src5' AND NOT cut THEN 'images' END, CASE WHEN lang = 'de' THEN 'headings' END,
      CASE WHEN source = 'src1' AND n - cut::INT > 1 THEN 'numbers' END, CASE WHEN source = 'src4' THEN 'spans' END], lambda x: x IS NOT NULL), ',') END AS steps FROM p)
    SELECT doc_id::VARCHAR AS doc_id, steps, CASE steps WHEN '' THEN 1 ELSE 2 END AS rounds, TRUE AS settled, {_AFTER} AS codes FROM s""",
)
def fix_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers, of which German ones have heading marks before their numbers, through a chain of fixers
    until nothing changes, then made anew and judged."""
    german = F.coalesce(F.col("_lang") == "de", F.lit(False))
    rows = papers(spark, sf_dir, "lang").withColumn("text", F.when(german, F.regexp_replace("text", r"(?m)^(?=\d+\. )", "### ")).otherwise(F.col("text")))
    fixed = chain.fixpoint(rows.drop("_lang"), CHAIN)
    done = exam.with_quality(exam.annotated(exam.with_lines(fixed)))
    return done.select("doc_id", F.array_join("steps", ",").alias("steps"), "rounds", "settled", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))


def _upgrade(rows: DataFrame) -> DataFrame:
    out = fixers.shift_numbers(fixers.attach_orphan_images(exam.with_lines(rows))).withColumn("numbers", F.transform("units", lambda u: u["question_numbers"]))
    return exam.with_quality(exam.annotated(out.withColumn("identity_version", F.lit(2))))


@query(
    "migrated_papers",
    _PAPERS
    + f""", v2 AS (SELECT *, array_to_string(list_filter([CASE WHEN source = 'src1' AND n - cut::INT > 1 THEN 'FACT:numbers' END, CASE WHEN {_AFTER} <> '' THEN 'QUALITY' END], lambda x: x IS NOT NULL), ',') AS violations FROM p)
    SELECT doc_id::VARCHAR AS doc_id, violations, violations = '' AS upgraded FROM v2""",
)
def migrated_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers moved to the second identity, each put back where its numbers would change or where it
    would not pass."""
    rows = papers(spark, sf_dir).withColumn("numbers", F.transform("units", lambda u: u["question_numbers"]))
    out = versions.migrated(rows, _upgrade, ["text", "rendered", "numbers"], {"QUALITY": lambda p: F.col("verdict") == "PASS"})
    return out.select("doc_id", F.array_join("violations", ",").alias("violations"), "upgraded")


@query(
    "applied_moves",
    """
    WITH m AS (SELECT doc_id, coalesce(source, 'none') || '/' || doc_id || '.md' AS a, coalesce(lang, 'und') || '/' || sha256(coalesce(text, '')) || '.md' AS b FROM documents),
    c AS (SELECT *, count(*) OVER (PARTITION BY b) > 1 AS twice FROM m)
    SELECT doc_id, CASE WHEN twice THEN a ELSE b END AS path, CASE WHEN twice THEN 'BATCH' END AS gate, CASE WHEN twice THEN 'target_twice' END AS detail FROM c
    """,
)
def applied_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of texts by source becomes one by language and content. What the gates refuse, here copies
    that would take one place, stays; the rest moves as one version, which is read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("source", F.lit("none")).alias("source"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    docs = stored(docs, "digests")  # texts are read once; what follows is asked many times
    files = docs.select("doc_id", F.concat_ws("", "source", F.lit("/"), "doc_id", F.lit(".md")).alias("path"), "sha256")
    plan = docs.select(F.concat_ws("", "source", F.lit("/"), "doc_id", F.lit(".md")).alias("from_rel"), F.concat(F.coalesce("lang", F.lit("und")), F.lit("/"), "sha256", F.lit(".md")).alias("to_rel"), "sha256")
    store = versions.Versions(spark, new_folder(spark, "tree"))
    lease = store.acquire("applied_moves", 86_400)
    store.put(lease, files)
    refused = stored(versions.refused_moves(plan, store.read()), "refused")
    allowed = stored(plan.join(refused.select("from_rel"), "from_rel", "left_anti").select(*plan.columns), "allowed")
    versions.apply_moves(store, lease, allowed, digest_of(allowed))
    store.release(lease)
    why = refused.select(F.col("from_rel").alias("_from"), "gate", "detail")
    return store.read().join(why, F.col("path") == F.col("_from"), "left").select("doc_id", "path", "gate", "detail")


@query(
    "contained_verdicts",
    _PAPERS
    + """, c AS (SELECT *, CASE WHEN source = 'src3' THEN 'C15_PROVENANCE' ELSE array_to_string(list_filter([
        CASE WHEN cut THEN 'C2_NUMBERS' END, CASE source WHEN 'src2' THEN 'C3_ANSWERS' WHEN 'src6' THEN 'C4_COMPOSITE' WHEN 'src5' THEN 'C5_IMAGES' WHEN 'src1' THEN CASE WHEN n - cut::INT > 1 THEN 'C13_SAME_SECTION' END END],
        lambda x: x IS NOT NULL), ',') END AS codes,
      CASE WHEN source IN ('src7', 'src10') THEN 'units are missing' WHEN source = 'src8' THEN 'a span is too wide' WHEN source = 'src9' THEN 'a unit is null' WHEN source = 'src11' THEN 'a number is too large' END AS error FROM p)
    SELECT doc_id::VARCHAR AS doc_id, CASE WHEN error IS NULL AND codes = '' THEN 'PASS' ELSE 'FAIL' END AS verdict, CASE WHEN error IS NULL THEN codes ELSE 'QC_CONTAINED' END AS codes, error FROM c""",
)
def contained_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose manifests come as JSON. Those of src7 end in the middle, src8 has a span of two thousand
    million lines, src9 a null unit, src10 a word for a number, src11 a number near the largest: each
    would end a job or pass unseen, and fails alone."""
    of = lambda s: F.col("_source") == s
    rows = papers(spark, sf_dir, "source")
    text = F.to_json("units")
    number = '"question_numbers":\\[\\d+'
    text = (
        F.when(of("src7"), F.substring(text, 1, F.char_length(text) - 5))
        .when(of("src8"), F.concat(F.lit('[{"stem":{"start":1,"end":2000000000}},'), F.substr(text, F.lit(2))))
        .when(of("src9"), F.concat(F.lit("[null,"), F.substr(text, F.lit(2))))
        .when(of("src10"), F.regexp_replace(text, number, '"question_numbers":["x"'))
        .when(of("src11"), F.regexp_replace(text, number, '"question_numbers":[2147483647'))
        .otherwise(text)
    )
    rows = isolation.parsed_units(rows.withColumn("manifest", text).drop("units", "_source"), "manifest").drop("manifest")
    out = isolation.contained(rows, isolation.paper_guards(), lambda p: exam.with_quality(exam.annotated(p)), ["doc_id"])
    error = F.get(F.filter("issues", lambda i: i["code"] == isolation.CONTAINED), F.lit(0))["detail"]
    return out.select("doc_id", "verdict", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"), error.alias("error"))
