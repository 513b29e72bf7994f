"""Queries of the exam operators over papers made from every row of ``documents``.

A document of n lines becomes a paper of 2n + 3: a title, the lines as questions 1 to n, a
heading, and n answers; a unit for each question. What is wrong with a paper depends on its
source and language (see papers()), so the SQL twins tell each outcome from the table alone,
without the rules. Answer texts are made from ``lineitem``, ``orders`` and ``part`` likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import exam_text as X
from sheaf.functions.text import OTHER_ENDS, computed, has_other_ends, split_lines
from sheaf.operators import audit, binding, exam, fixers, ledger, mutants
from sheaf.plans.catalog import query
from sheaf.sources.tables import table

#: Line ends that the engine knows besides the line feed; papers have blanks in their place.
ENDS = OTHER_ENDS
_CODES = "||".join(f"chr({ord(c)})" for c in ENDS)
_PAPERS = f"""
WITH d AS (SELECT doc_id, source, lang, string_split(translate(coalesce(text, ''), {_CODES}, '{" " * len(ENDS)}'), chr(10)) AS ls FROM documents),
p AS (SELECT *, len(ls) AS n, lang = 'fr' AND len(ls) > 1 AS cut FROM d),
u AS (SELECT doc_id, source, lang, n, cut, unnest(ls) AS line, unnest(range(1, n + 1)) AS k FROM p),
v AS (SELECT *, k = 1 + cut::INT AS is_first FROM u WHERE NOT (cut AND k = 1))
"""


def document_lines() -> Column:
    """Lines of a document's text, null as empty, with blanks for ENDS."""
    text = F.coalesce("text", F.lit(""))
    return F.split(F.when(has_other_ends(text), F.translate(text, ENDS, " " * len(ENDS))).otherwise(text), "\n", -1)


def papers(spark: SparkSession, sf_dir: str, *carried: str, keep_lines: bool = False) -> DataFrame:
    """Papers with one fault each, by source: src1 claims a number twice, src2 shows a short answer,
    src3 has no source text, src4 cites lines that are not there, src5 has an image outside of all
    spans, src6 a composite unit without a text. In French ones the first unit is missing.
    ``carried``: source or lang, as _source and _lang; ``keep_lines``: see exam.with_lines()."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", document_lines().alias("ls"))
    rows = computed(rows, {"n": F.size("ls"), "ls": F.col("ls")})
    numbered = F.transform("ls", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x))
    answers = F.transform("ls", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". A")))
    title = F.when(F.col("source") == "src5", '<img src="a.png">').otherwise(F.concat(F.lit("# "), "source"))
    rows = computed(rows, {"q": numbered, "a": answers, "cut": (F.col("lang") == "fr") & (F.col("n") > 1)})
    lines = F.concat(F.array(title), "q", F.array(F.concat(F.lit("## 二、"), "lang"), F.lit("【答案】")), "a")
    span = lambda a, z: F.struct(a.cast("int").alias("start"), z.cast("int").alias("end"))
    none = F.lit(None).cast(exam.SPAN)
    of = lambda s: F.col("source") == s

    def unit(x: Column, i: Column) -> Column:
        first = i == F.col("cut").cast("int")
        twice = of("src1") & first & (i + 2 <= F.col("n"))
        spans = {
            "stem": span(i + 2, i + 2),
            "answer": span(F.col("n") + 4 + i, F.when(of("src4") & first, 2 * F.col("n") + 99).otherwise(F.col("n") + 4 + i)),
        }
        return F.struct(
            F.concat(F.lit("Q"), (i + 1).cast("string")).alias("unit_id"),
            F.when(of("src6") & first, "composite_question").otherwise("standalone_question").alias("unit_type"),
            F.when(twice, F.array(i + 1, i + 2)).otherwise(F.array(i + 1)).alias("question_numbers"),
            F.array((i + 1).cast("string")).alias("printed_number"),
            *[F.lit(None).cast("string").alias(c) for c in ("section", "section_ref", "basis", "basis_evidence")],
            *[spans.get(r, none).alias(r) for r in exam.ROLES],
        )

    def shown(x: Column, i: Column) -> Column:
        short = of("src2") & (i == F.col("cut").cast("int"))
        said = F.when(short, "A").otherwise(F.get("a", i))
        (a, b), (c, d) = exam.ZONES["stem"], exam.ZONES["answer"]
        return F.concat(F.lit(a + "\n"), x, F.lit("\n" + b + c + "\n"), said, F.lit("\n" + d))

    kept = lambda c: F.slice(c, F.col("cut").cast("int") + 1, F.col("n"))
    text = F.array_join(lines, "\n")
    # where none of them has a comment or an end, they are the text's lines, which are not split again
    whole = F.coalesce(~F.exists(lines, lambda x: F.contains(x, F.lit("META:"))) & ~has_other_ends(F.concat("source", "lang")) & ~F.contains(F.concat("source", "lang"), F.lit("\n")), F.lit(False))
    own = {exam.LINES: F.when(~of("src3"), F.when(whole, lines).otherwise(exam.text_lines(text)))} if keep_lines else {}
    rows = rows.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(~of("src3"), text).alias("text"),
        F.array_join(kept(F.transform("q", shown)), "\n").alias("rendered"),
        F.lit(None).cast("string").alias("annotated"),
        F.lit("p.md").alias("source_file"),
        F.lit(1).alias("identity_version"),
        kept(F.transform("ls", unit)).cast(f"array<{exam.UNIT}>").alias("units"),
        *[F.col(c).alias(f"_{c}") for c in carried],
        *[c.alias(k) for k, c in own.items()],
    )
    return exam.assign_identity(rows, keep_lines)


def annotated_papers(spark: SparkSession, sf_dir: str, *carried: str) -> DataFrame:
    return exam.annotated(papers(spark, sf_dir, *carried, keep_lines=True))


@query(
    "exam_sections",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, 'S0' AS id, NULL AS title, 1 AS start_line, n + 1 AS end_line FROM p WHERE source <> 'src3'
    UNION ALL SELECT doc_id::VARCHAR, 'S1', '二、' || lang, n + 2, 2 * n + 3 FROM p WHERE source <> 'src3'""",
)
def exam_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of each paper that has a text."""
    rows = papers(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.inline("sections"))
    return rows.select("doc_id", "id", "title", F.col("start_line").cast("long").alias("start_line"), F.col("end_line").cast("long").alias("end_line"))


_VERDICT = """, c AS (SELECT *, CASE WHEN source = 'src3' THEN 'C15_PROVENANCE' ELSE array_to_string(list_filter([
    CASE WHEN cut THEN 'C2_NUMBERS' END, CASE source WHEN 'src2' THEN 'C3_ANSWERS' WHEN 'src6' THEN 'C4_COMPOSITE' WHEN 'src5' THEN 'C5_IMAGES' WHEN 'src1' THEN CASE WHEN n - cut::INT > 1 THEN 'C13_SAME_SECTION' END END],
    lambda x: x IS NOT NULL), ',') END AS codes FROM p)
"""


@query("exam_verdicts", _PAPERS + _VERDICT + "SELECT doc_id::VARCHAR AS doc_id, CASE codes WHEN '' THEN 'PASS' ELSE 'FAIL' END AS verdict, codes FROM c")
def exam_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules C1 to C15 on every paper."""
    return exam.quality(annotated_papers(spark, sf_dir)).select("doc_id", "verdict", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))


@query(
    "exam_dispositions",
    _PAPERS
    + _VERDICT
    + """SELECT doc_id::VARCHAR AS doc_id, CASE WHEN source = 'src3' THEN 'MISSING' WHEN source = 'src4' THEN 'REJECTED_STALE' WHEN codes <> '' THEN 'REJECTED_QC_FAIL' ELSE 'ADMITTED' END AS disposition FROM c""",
)
def exam_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a consumer may use of every paper."""
    return exam.dispositions(annotated_papers(spark, sf_dir)).select("doc_id", "disposition")


@query(
    "exam_records",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, 'Q' || k AS unit_id, 'S0' AS section_ref, k || '. ' || line AS stem, CASE WHEN NOT (source = 'src4' AND is_first) THEN k || '. A' END AS answer
    FROM v WHERE source <> 'src3'""",
)
def exam_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a unit with its texts."""
    rows = exam.unit_records(papers(spark, sf_dir).where("text IS NOT NULL"))
    return rows.select("doc_id", "unit_id", "section_ref", F.array_join("stem", "/").alias("stem"), F.array_join("answer", "/").alias("answer"))


@query(
    "exam_manifest_checks",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, array_to_string(list_filter([CASE WHEN true THEN 'C_A4' END, CASE source WHEN 'src6' THEN 'NO_TEXT' END, CASE WHEN source = 'src1' AND n - cut::INT > 1 THEN 'NUMBER_TWICE' END,
      CASE source WHEN 'src4' THEN 'SPAN' END], lambda x: x IS NOT NULL), ',') AS codes FROM p WHERE source <> 'src3'""",
)
def exam_manifest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a manifest must hold: here the answers' heading is in no span of any paper."""
    got = fixers.validated(papers(spark, sf_dir).where("text IS NOT NULL"))
    return got.select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform("issues", lambda i: i["code"]))), ",").alias("codes"))


@query(
    "exam_anchors",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, kind, 'Q' || k AS tag, CASE kind WHEN 'answer' THEN n + 3 + k ELSE k + 1 END AS start_line,
      CASE WHEN kind = 'stem' THEN k + 1 WHEN source = 'src4' AND is_first THEN 2 * n + 3 ELSE n + 3 + k END AS end_line
    FROM v, (VALUES ('unit'), ('stem'), ('answer')) AS t(kind) WHERE source <> 'src3'""",
)
def exam_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of the annotated papers, paired. Marks beyond the last line are told at it."""
    rows = exam.anchors(annotated_papers(spark, sf_dir).where("text IS NOT NULL"))
    return rows.select("doc_id", "kind", "tag", F.col("start_line").cast("long").alias("start_line"), F.col("end_line").cast("long").alias("end_line"))


@query(
    "anchor_drift",
    _PAPERS + "SELECT doc_id::VARCHAR AS doc_id, kind, 'Q' || k AS tag, CASE WHEN source = 'src3' OR kind = 'answer' AND source = 'src4' AND is_first THEN 'DRIFT' ELSE 'MATCH' END AS status FROM v, (VALUES ('stem'), ('answer')) AS t(kind)",
)
def anchor_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every unit against the marks of the annotated paper."""
    return audit.anchor_drift(annotated_papers(spark, sf_dir)).select("doc_id", "kind", "tag", "status")


@query(
    "zone_consistency",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, k - 1 - cut::INT AS unit_ord, zone, CASE WHEN is_first AND (zone = 'stem' AND source = 'src6' OR zone = 'answer' AND source IN ('src2', 'src4')) THEN 'DRIFT' ELSE 'MATCH' END AS status
    FROM v, (VALUES ('stem'), ('answer')) AS t(zone) WHERE source <> 'src3' UNION ALL SELECT doc_id::VARCHAR, -1, 'provenance', 'DRIFT' FROM p WHERE source = 'src3'""",
)
def zone_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rendered papers show against what their spans say, unit by unit."""
    return audit.consistency(papers(spark, sf_dir)).select("doc_id", F.col("unit_ord").cast("long").alias("unit_ord"), "zone", "status")


@query(
    "contract_preflight",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, array_to_string(list_filter(CASE WHEN source = 'src3' THEN ['PC10'] ELSE [CASE WHEN source = 'src1' AND n - cut::INT > 1 THEN 'PC2' END, CASE lang WHEN 'de' THEN 'PC5' END, CASE lang WHEN 'es' THEN 'PC7' END,
      CASE source WHEN 'src4' THEN 'PC9' END] END, lambda x: x IS NOT NULL), ',') AS codes FROM p""",
)
def contract_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumer's contract; German papers have no basis, Spanish ones contradict their provenance."""
    rows, lang = annotated_papers(spark, sf_dir, "lang"), F.col("_lang")
    basis, prov = F.when(~lang.eqNullSafe("de"), "unverified"), F.when(lang == "es", "unknown").otherwise("source_line")
    rows = rows.withColumn("units", F.transform("units", lambda u: u.withField("basis", basis).withField("printed_provenance", prov))).drop("_lang")
    return audit.preflight(rows).select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform("findings", lambda i: i["code"]))), ",").alias("codes"))


@query(
    "semantic_probes",
    _PAPERS
    + """SELECT doc_id::VARCHAR AS doc_id, k - 1 - cut::INT AS unit_ord, "check", detail FROM (
      SELECT *, 'P14' AS "check", k::VARCHAR AS detail FROM v WHERE lang = 'de' AND k <= 999 AND NOT (source = 'src6' AND is_first)
      UNION ALL SELECT *, 'P15', k::VARCHAR FROM v WHERE lang = 'de' AND k <= 999 AND NOT (source = 'src4' AND is_first)
      UNION ALL SELECT *, 'P13', CASE lang WHEN 'es' THEN '-' ELSE k || '. A' END FROM v WHERE NOT (source = 'src4' AND is_first)) WHERE source <> 'src3'""",
)
def semantic_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes on papers whose German units claim other numbers, and whose Spanish answers are "-". One
    number with one letter is no form of an answer."""
    lang = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("_id"), "lang", F.size(document_lines()).alias("n"))
    rows = papers(spark, sf_dir).where("text IS NOT NULL").join(lang, F.col("doc_id") == F.col("_id"))
    plain = F.regexp_replace("text", r"(?<=\n)\d+\. A(?=\n|$)", "-")
    rows = rows.withColumns({"text": F.when(F.col("lang") == "es", plain).otherwise(F.col("text")), "units": F.when(F.col("lang") == "de", F.transform("units", lambda u: u.withField("question_numbers", F.array(F.lit(-1))))).otherwise(F.col("units"))})
    return exam.probes(rows.drop("_id", "lang", "n")).select("doc_id", F.col("unit_ord").cast("long").alias("unit_ord"), "check", "detail")


# --- answers and numbers -------------------------------------------------------------------------

_ORDERS = "WITH o AS (SELECT l_orderkey, count(*) AS n, string_agg(chr((65 + l_partkey % 4)::INT), '' ORDER BY l_linenumber, l_partkey, l_suppkey) AS letters FROM lineitem GROUP BY l_orderkey)"


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order the number of its lines and a letter A to D of each, in order."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    letter = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda r: F.substr(F.lit("ABCD"), (r["l_partkey"] % 4 + 1).cast("int"), F.lit(1)))
    return rows.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_join(letter, "").alias("letters"))


@query(
    "range_answers",
    _ORDERS + "SELECT l_orderkey, (l_orderkey % 50 + i)::INT AS n, letters[i] AS value FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM o WHERE n > 1)",
)
def range_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers written as a range of numbers and a run of letters, in several forms of dash."""
    rows = _letters(spark, sf_dir)
    first = F.col("l_orderkey") % 50 + 1
    dash = F.when(F.col("l_orderkey") % 3 == 0, "–").when(F.col("l_orderkey") % 3 == 1, "~").otherwise(" - ")
    wide = F.when(F.col("l_orderkey") % 2 == 0, F.translate("letters", "ABCD", "ＡＢＣＤ")).otherwise(F.col("letters"))
    text = F.concat(F.lit("参考 "), first.cast("string"), dash, (first + F.col("n") - 1).cast("string"), F.lit(" "), wide, F.lit("。"))
    return rows.select("l_orderkey", F.explode(X.range_answers(text)).alias("n", "value"))


@query("inline_answers", _ORDERS + "SELECT l_orderkey, i::INT AS n, letters[i] AS value FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM o WHERE n > 1)")
def inline_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in one line, as a number, a dot and a letter each."""
    rows = _letters(spark, sf_dir)
    pairs = F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.concat(i.cast("string"), F.when(i % 2 == 0, "\\. ").otherwise(". "), F.substr("letters", i, F.lit(1))))
    return rows.select("l_orderkey", F.explode(X.inline_answers(split_lines(F.concat(F.array_join(pairs, " "), F.lit("\n9. Z"))))).alias("n", "value"))


@query("table_answers", _ORDERS + "SELECT l_orderkey, i::INT AS n, letters[i] AS value FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM o WHERE n >= 3)")
def table_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a table: a row of numbers over one of letters."""
    rows = _letters(spark, sf_dir)
    cells = lambda f: F.array_join(F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.concat(F.lit("<td>"), f(i), F.lit("</td>"))), "")
    text = F.concat(F.lit("<table><tr>"), cells(lambda i: i.cast("string")), F.lit("</tr><tr>"), cells(lambda i: F.substr("letters", i, F.lit(1))), F.lit("</tr></table>"))
    return rows.select("l_orderkey", F.explode(X.table_answers(text)).alias("n", "value"))


@query(
    "labelled_table_values",
    _ORDERS + "SELECT l_orderkey, CASE WHEN n >= 2 THEN letters[2] END AS value FROM o",
)
def labelled_table_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second answer of a table whose rows begin with their labels."""
    rows = _letters(spark, sf_dir)
    cells = lambda f: F.array_join(F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.concat(F.lit("<td>"), f(i), F.lit("</td>"))), "")
    text = F.concat(F.lit("<table><tr><td>题号</td>"), cells(lambda i: i.cast("string")), F.lit("</tr><tr><td>答案</td>"), cells(lambda i: F.substr("letters", i, F.lit(1))), F.lit("</tr></table>"))
    return rows.select("l_orderkey", binding.table_value(text, F.lit(2)).alias("value"))


@query(
    "answer_invariants",
    _ORDERS
    + """SELECT l_orderkey, code, number FROM (SELECT l_orderkey, 'OVERLAP' AS code, 1 AS number FROM o WHERE n % 2 = 0
    UNION ALL SELECT l_orderkey, 'UNTOLD', (n + 1)::INT FROM o WHERE n % 3 <> 0 UNION ALL SELECT l_orderkey, 'EMPTY', n::INT FROM o)""",
)
def answer_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed tables in which the last answer is empty; orders of even size tell the first number
    twice, and those whose size three does not divide leave one out."""
    rows = _letters(spark, sf_dir).withColumn("m", F.col("n").cast("int"))
    numbers = F.sequence(F.lit(1), F.col("m") + 1)
    answers = F.map_from_arrays(F.sequence(F.lit(1), F.col("m")), F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: F.when(i == F.col("m"), " ").otherwise("A")))
    open_ = F.concat(F.when(F.col("m") % 2 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")), F.when(F.col("m") % 3 == 0, F.array(F.col("m") + 1)).otherwise(F.array().cast("array<int>")))
    return rows.select("l_orderkey", F.explode(audit.answer_invariants(numbers, answers, open_)).alias("f")).select("l_orderkey", "f.*")


@query(
    "question_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 4 < 3 AND l_suppkey < 1000 THEN l_suppkey::INT END AS n, CASE WHEN l_linenumber % 4 < 3 AND l_suppkey < 1000 THEN '题 ' || l_partkey END AS rest FROM lineitem""",
)
def question_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers at a line's start behind marks of several kinds; every fourth line has none."""
    k, n = F.col("l_linenumber") % 4, F.col("l_suppkey").cast("string")
    wide = F.translate(n, "0123456789", "０１２３４５６７８９")
    body = F.concat(F.lit("题 "), F.col("l_partkey").cast("string"))
    line = F.when(k == 0, F.concat(F.lit("### **"), wide, F.lit("．"), body)).when(k == 1, F.concat(n, F.lit("\\. "), body)).when(k == 2, F.concat(F.lit("　"), n, F.lit("、"), body)).otherwise(F.concat(n, F.lit(" 年")))
    q = X.question_number(line)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", q["n"].alias("n"), q["rest"].alias("rest"))


@query(
    "exam_kinds",
    """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '高考真题' WHEN 1 THEN '会考' WHEN 2 THEN '竞赛自招' WHEN 3 THEN '等级考' ELSE '其他汇编' END AS kind,
      CASE p_size % 5 WHEN 0 THEN '文件名' WHEN 1 THEN '内容' WHEN 2 THEN '文件名' WHEN 3 THEN '内容' ELSE '未判定' END AS reason,
      CASE p_partkey % 4 WHEN 0 THEN '英语' WHEN 1 THEN '理综' WHEN 2 THEN '数学' ELSE '未分类' END AS subject FROM part""",
)
def exam_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and subject of papers by name, folder and text."""
    k, s = F.col("p_size") % 5, F.col("p_partkey") % 4
    name = F.concat(F.when(k == 0, "高考真题").when(k == 2, "强基").otherwise("卷"), F.when(s == 0, "英语").when(s == 1, "理综").otherwise(""), "p_name")
    text = F.when(k == 1, "会考").when(k == 3, "等级考").otherwise("x")
    folder = F.when(s == 2, "数学").otherwise("p")
    rows = table(spark, sf_dir, "part").select("p_partkey", X.exam_kind(name, text).alias("k"), X.subject(name, folder, text).alias("s"))
    return rows.select("p_partkey", "k.kind", "k.reason", "s.subject")


_BOUND = """SELECT o_orderkey, rule, bound, first FROM (SELECT *, o_orderkey % 7 AS k FROM orders) JOIN (VALUES
    (0, 'R-SHARED-LABEL', 'entry_bound', '乙'), (1, 'R-INLINE', 'entry_bound', 'C'), (2, 'R-RANGE', 'entry_bound', 'F'), (3, 'R-LABELED-LINE', 'region_bound', '甲'),
    (4, 'R-WHOLE', 'region_bound', '全文'), (5, 'R-NONE', 'none', NULL), (6, 'R-TABLE', 'entry_bound', 'D')) AS t(k2, rule, bound, first) ON k = k2"""


@query("binding_candidates", _BOUND)
def binding_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that binds an answer, and the first candidate it takes from the cited block."""
    k = (F.col("o_orderkey") % 7).cast("int") + 1
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x).cast("string") for x in xs]), k)
    table_block = "<table><tr><td>题号</td><td>1</td><td>2</td></tr><tr><td>答案</td><td>A</td><td>Ｄ</td></tr></table>"
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pick(None, "inline_in_explanation", "range_string", None, None, None, "answer_table").alias("evidence"),
        pick("v", "v", "v", "v", "v", "", "v").alias("value"),
        pick("1. 甲 2. 乙", "因此故选：C", "1-3：EFG", "【答案】甲", "全文", "x", table_block).alias("block"),
    )
    rows = rows.withColumn("rule", binding.rule(F.col("evidence"), F.col("value"), F.col("block")))
    got = rows.select("o_orderkey", "rule", binding.candidates(F.col("rule"), F.col("block"), F.array(F.lit(2)), F.lit(None).cast("string")).alias("c"))
    return got.select("o_orderkey", "rule", "c.bound", F.get("c.values", F.lit(0)).alias("first"))


@query(
    "label_anchors",
    "SELECT o_orderkey, n::VARCHAR AS label, CASE n WHEN 1 THEN 0 ELSE 3 + length(o_orderpriority) + 1 END AS start, CASE n WHEN 1 THEN 2 ELSE 3 + length(o_orderpriority) + 3 END AS \"end\" FROM orders, (VALUES (1), (2)) AS t(n)",
)
def label_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a block of two answers, with their places."""
    block = F.concat(F.lit("1. "), F.translate("o_orderpriority", "-12345 ", "xxxxxxx"), F.lit(" 2. z"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.inline(binding.anchors(block)))
    return rows.select("o_orderkey", "label", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query(
    "conflict_versions",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'source_substring' WHEN 1 THEN 'source_substring' ELSE 'mismatch_withheld' END AS tier, CASE o_orderkey % 4 WHEN 0 THEN 'normalized' ELSE 'none' END AS match,
      CASE o_orderkey % 4 WHEN 1 THEN 'outside_region' WHEN 2 THEN 'absent_from_doc' WHEN 3 THEN 'locator_invalid' END AS mismatch_class FROM orders""",
)
def conflict_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of disputed answers against their block and document."""
    k = F.col("o_orderkey") % 4
    value = F.concat(F.lit("值 "), "o_orderpriority")
    block = F.when(k == 0, F.concat(F.lit("x"), F.replace(value, F.lit(" "), F.lit("　")))).when(k < 3, "y")
    doc = F.when(k == 1, F.concat(F.lit("z "), value)).otherwise("w")
    return table(spark, sf_dir, "orders").select("o_orderkey", binding.conflict_tier(value, block, doc).alias("t")).select("o_orderkey", "t.*")


@query(
    "display_forms",
    "SELECT l_orderkey, l_linenumber, l_partkey, 'x' || translate(l_linenumber::VARCHAR || l_suppkey::VARCHAR, '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') || ' + 1/' || l_partkey || ' ≤ α H_{2}O 5 cm \\foo 50%' AS shown FROM lineitem",
)
def display_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LaTeX as plain text."""
    s = lambda c: F.col(c).cast("string")
    t = F.concat(F.lit("$x^{"), s("l_linenumber"), s("l_suppkey"), F.lit("} + \\frac{1}{"), s("l_partkey"), F.lit("}$ \\le \\alpha H_{2}O 5\\,\\mathrm{cm} \\foo 50\\%"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", binding.display(t).alias("shown"))


@query(
    "answer_completeness",
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'unknown' WHEN 1 THEN 'partial' WHEN 2 THEN 'full' WHEN 3 THEN 'partial' WHEN 4 THEN 'full' ELSE 'unknown' END AS state FROM part""",
)
def answer_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an answer's value and its cited lines prove: a placeholder, one beside a value, a value
    that stands there, one of several parts, a word that only looks like a placeholder, no answer."""
    k = (F.col("p_size") % 6 + 1).cast("int")
    name = F.col("p_name")
    at = lambda *xs: F.element_at(F.array(*[x if isinstance(x, Column) else F.lit(x) for x in xs]), k)
    value = at("详见解析。", F.concat(name, F.lit("；（2）见解析")), name, name, "战略", "无答案")
    block = at("详见解析", "x", F.concat(F.lit("得 "), name), F.concat(F.lit("(1) "), name, F.lit("\n(2) y")), "国家战略", "z")
    return table(spark, sf_dir, "part").select("p_partkey", fixers.completeness(value, block, F.lit(True)).alias("state"))


@query(
    "proved_answers",
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 3 WHEN 3 THEN NULL END::INT AS line, CASE p_size % 4 WHEN 0 THEN 'D' END AS value, CASE p_size % 4 WHEN 1 THEN 'B' END AS from_table FROM part""",
)
def proved_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that a solution states once, or that a shared table gives; others are not guessed."""
    k = F.col("p_size") % 4
    tbl = "<table><tr><td>题号</td><td>7</td><td>8</td></tr><tr><td>答案</td><td>Ｂ</td><td>C</td></tr></table>"
    last = F.when(k == 0, "所以故选：d").when(k == 1, tbl).when(k == 2, "故选：A，故选：B").otherwise("没有")
    lines = F.array("p_name", F.lit("【解答】"), last)
    span = F.struct(F.lit(2).alias("start"), F.lit(3).alias("end"))
    rows = table(spark, sf_dir, "part").select("p_partkey", audit.inline_evidence(lines, span).alias("e"), audit.table_evidence(lines, span, F.array(F.lit(7))).alias("from_table"))
    return rows.select("p_partkey", "e.line", "e.value", "from_table")


# --- older annotations, fidelity, plans ----------------------------------------------------------


@query(
    "mark_verdicts",
    _PAPERS.replace("n, cut, unnest(ls)", "n, cut, ls, unnest(ls)")
    + """SELECT doc_id::VARCHAR AS doc_id, CASE WHEN source = 'src1' THEN 'FAIL' WHEN source IN ('src2', 'src4') THEN 'REPAIR' WHEN source = 'src5' AND n > 2 THEN 'HINT' ELSE 'PASS' END AS verdict,
      CASE WHEN source = 'src1' THEN 'ANSWER_EMPTY' WHEN source = 'src2' THEN 'ANSWER_LABEL_DUP' WHEN source = 'src4' THEN 'IMAGE_DANGLING' WHEN source = 'src5' AND n > 2 THEN 'QNUM_GAP' ELSE '' END AS codes FROM p""",
)
def mark_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations of the older form: src1 has an empty answer, src2 an answer's number twice, src4 an
    image outside of all blocks, src5 no second question."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", document_lines().alias("ls"))
    rows = computed(rows, {"n": F.size("ls"), "ls": F.col("ls")})
    of = lambda s: F.col("source") == s
    mark = lambda kind, end, i: F.concat(F.lit(f"<!-- META:{kind}:{end}:"), (i + 1).cast("string"), F.lit(",x" if (kind, end) == ("question", "start") else ""), F.lit(" -->\n"))
    numbered = lambda i: F.concat((i + 1).cast("string"), F.lit(". 题\n"))
    answer = lambda i: F.when(of("src1") & (i == 0), "\n").otherwise(F.concat((i + 1).cast("string"), F.lit(". A\n")))

    def one(x: Column, i: Column) -> Column:
        a = F.concat(mark("answer", "start", i), answer(i), mark("answer", "end", i))
        twice = F.when(of("src2") & (i == 0), a).otherwise("")
        return F.concat(mark("question", "start", i), numbered(i), mark("question", "end", i), a, twice)

    gap = lambda i: of("src5") & (F.col("n") > 2) & (i == 1)
    blocks = F.transform("ls", lambda x, i: F.when(gap(i), "").otherwise(one(x, i)))
    text = F.concat(F.when(of("src4"), "![a](b.png)\n").otherwise(""), F.array_join(blocks, ""))
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), audit.mark_issues(text).alias("issues"))
    return rows.select("doc_id", audit.mark_verdict(F.col("issues")).alias("verdict"), F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))


@query(
    "layer_fidelity",
    r"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    s AS (SELECT *, list_filter(list_transform(string_split_regex(t, '[,.;:!?()，。、；：！？\r\n]'), lambda x: regexp_replace(x, '[^0-9A-Za-z一-鿿]+', '', 'g')), lambda x: length(x) >= 12) AS ps,
          regexp_replace(regexp_replace(array_to_string(CASE WHEN source = 'src1' THEN ls[2:] ELSE ls END, chr(10)), '<[^>]+>', '', 'g'), '[^0-9A-Za-z一-鿿]+', '', 'g') AS near FROM d),
    f AS (SELECT *, list_filter(ps, lambda x: contains(near, x) OR contains(near, x[1:10]) OR contains(near, x[-10:])) AS fs,
          CASE WHEN length(regexp_replace(t, '[^0-9A-Za-z一-鿿]+', '', 'g')) < 50 THEN 'no_text_layer' WHEN len(ps) = 0 THEN 'no_prose' ELSE 'ok' END AS status FROM s)
    SELECT doc_id, status, CASE status WHEN 'ok' THEN len(ps) END AS n_prose, CASE status WHEN 'ok' THEN len(fs) END AS n_found FROM f
    """,
)
def layer_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts against the layer of their original; those of src1 lost their first line."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    # a mark of the layer for each ASCII one of the source: the layer parts there, the source does not
    marks = "，。、；：！？\r"
    layer = F.translate(F.coalesce("text", F.lit("")), ",.;:!?()", marks)
    source = F.array_join(F.when(F.col("source") == "src1", F.slice(lines, 2, F.size(lines))).otherwise(lines), "\n")
    rows = table(spark, sf_dir, "documents")
    rows = computed(computed(rows.select("doc_id", source.alias("s"), layer.alias("l")), {"s": F.col("s"), "l": F.col("l")}), {"f": audit.fidelity(F.col("s"), F.col("l"))})
    return rows.select("doc_id", "f.status", F.col("f.n_prose").cast("long").alias("n_prose"), F.col("f.n_found").cast("long").alias("n_found"))


@query(
    "expected_outputs",
    r"""SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN CASE p_partkey % 2 WHEN 0 THEN '高一' ELSE '未分类' END || '/' || CASE p_brand WHEN 'Brand#1' THEN '数学' ELSE '未分类' END WHEN 1 THEN '高二/未分类' ELSE '高三/物理' END
      || '/' || CASE WHEN p_size % 3 = 0 AND p_partkey % 2 = 0 THEN '高1' ELSE '' END || CASE WHEN p_size % 3 = 0 AND p_brand = 'Brand#1' THEN '数学' ELSE '' END || p_name || '_' || p_type || '.md' AS path FROM part""",
)
def expected_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the text of a source file goes, by its folders or, at the top, its name."""
    k = F.col("p_size") % 3
    name = F.concat(F.when((k == 0) & (F.col("p_partkey") % 2 == 0), "高1").otherwise(""), F.when((k == 0) & (F.col("p_brand") == "Brand#1"), "数学").otherwise(""), "p_name", F.lit(":"), "p_type", F.lit(".pdf"))
    path = F.concat(F.when(k == 0, "").when(k == 1, "高二/").otherwise("高三/物理/x/"), name)
    got = audit.expected_output(path, {"高一|高1": "高一", "高二|高2": "高二", "高三|高3": "高三"}, X.SUBJECTS, "未分类")
    return table(spark, sf_dir, "part").select("p_partkey", got.alias("path"))


@query(
    "move_gates",
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'PATH' WHEN 1 THEN 'SOURCE' WHEN 2 THEN 'SOURCE' WHEN 3 THEN 'TARGET' WHEN 4 THEN 'TARGET' END AS gate,
      CASE p_size % 6 WHEN 0 THEN 'not_plain' WHEN 1 THEN 'source_missing' WHEN 2 THEN 'sha256_drift' WHEN 3 THEN 'parent_is_file' WHEN 4 THEN 'case_variant_exists:To/X' || p_partkey END AS detail FROM part""",
)
def move_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan of moves against the tree: each part is a file to move, and one in six may go."""
    k, i = F.col("p_size") % 6, F.col("p_partkey").cast("string")
    rows = table(spark, sf_dir, "part").select("p_partkey", k.alias("k"), F.concat(F.lit("from/"), i).alias("from_rel"), F.concat(F.when(k == 0, "../").otherwise(""), F.when(k == 3, F.concat(F.lit("block/"), i, F.lit("/y"))).otherwise(F.concat(F.lit("To/x"), i))).alias("to_rel"), F.sha2("p_name", 256).alias("sha256"))
    sources = rows.where("k <> 1").select(F.col("from_rel").alias("path"), F.when(F.col("k") == 2, "other").otherwise(F.col("sha256")).alias("sha256"))
    blocks = rows.where("k = 3").select(F.regexp_replace("to_rel", "/y$", "").alias("path"), F.lit("f").alias("sha256"))
    variants = rows.where("k = 4").select(F.replace("to_rel", F.lit("x"), F.lit("X")).alias("path"), F.lit("g").alias("sha256"))
    folders = rows.select(F.explode(F.array(F.lit("from"), F.lit("To"), F.lit("block"))).alias("path")).distinct().withColumn("sha256", F.lit(None).cast("string"))
    tree = sources.unionByName(blocks).unionByName(variants).unionByName(folders)
    return ledger.move_violations(rows, tree).select("p_partkey", "gate", "detail")


@query(
    "victim_split",
    """
    WITH m AS (SELECT o_custkey AS stem, list_sort(list(DISTINCT o_orderkey::VARCHAR) FILTER (WHERE o_orderstatus = 'F')) AS core, list_sort(list(DISTINCT o_orderkey::VARCHAR) FILTER (WHERE o_orderstatus <> 'F')) AS excluded FROM orders GROUP BY o_custkey)
    SELECT c_custkey, coalesce(array_to_string(core, ','), '') AS core, coalesce(array_to_string(excluded, ','), '') AS excluded, stem IS NOT NULL AS found FROM customer LEFT JOIN m ON stem = c_custkey
    """,
)
def victim_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that have outputs under their name already, in the core tree or outside it, and those
    that have none."""
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("string").alias("name"), "o_orderstatus")
    out = ledger.semi_split(table(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey", {"core": F.col("o_orderstatus") == "F", "excluded": F.col("o_orderstatus") != "F"})
    return out.select("c_custkey", F.array_join("core", ",").alias("core"), F.array_join("excluded", ",").alias("excluded"), "found")


@query(
    "input_drift",
    """SELECT doc_id, CASE WHEN source = 'src2' THEN 'missing' ELSE 'changed' END AS why FROM documents WHERE source IN ('src1', 'src2')""",
)
def input_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that changed or went between two snapshots: texts of src1 changed, those of src2 went."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    after = rows.where("source <> 'src2'").withColumn("sha", F.when(F.col("source") == "src1", F.reverse("sha")).otherwise(F.col("sha")))
    return ledger.drift(rows, after, "doc_id", "sha")


@query(
    "stage_tracks",
    """
    WITH q AS (SELECT doc_id, CASE WHEN min(quality) = 1 THEN 'OK' ELSE 'FAIL' END AS qc FROM labels GROUP BY doc_id)
    SELECT d.doc_id, 'OK' AS source, CASE WHEN length(text) < 50 THEN 'EMPTY' ELSE 'OK' END AS ocr, coalesce(q.qc, 'NOT_BUILT') AS qc,
      CASE WHEN length(text) < 50 THEN 'ocr' WHEN coalesce(q.qc, 'NOT_BUILT') <> 'OK' THEN 'qc' END AS stopped_at FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id
    """,
)
def stage_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document stands: its stages side by side, and the first that is not done."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", F.char_length("text").alias("n")), table(spark, sf_dir, "labels").select("doc_id", "quality")
    named = {"source": (docs, F.lit("OK")), "ocr": (docs, F.when(F.col("n") < 50, "EMPTY").otherwise("OK")), "qc": (labels, F.when(F.col("quality") == 1, "OK").otherwise("FAIL"))}
    return ledger.stages(docs, "doc_id", named)


_KILLS = """
, t AS (SELECT count(*) AS n, count(*) FILTER (WHERE source <> 'src3') AS live, count(*) FILTER (WHERE source <> 'src6') AS plain, count(*) FILTER (WHERE source NOT IN ('src3', 'src6')) AS live_plain,
  count(*) FILTER (WHERE source NOT IN ('src3', 'src4')) AS bounded, count(*) FILTER (WHERE source <> 'src3' AND n - cut::INT > 1) AS several,
  count(*) FILTER (WHERE source NOT IN ('src2', 'src3', 'src5', 'src6') AND n - cut::INT = 1) AS alone FROM p)
SELECT 'annotation_edited' AS mutant, 'C8_DIFFERS' AS target, live AS n, live AS n_hit, 0::BIGINT AS n_silent FROM t
UNION ALL SELECT 'annotation_lost', 'C8_NO_ANNOTATED', live, live, 0 FROM t UNION ALL SELECT 'answer_emptied', 'C3_ANSWERS', n, live, 0 FROM t
UNION ALL SELECT 'image_added', 'C5_IMAGES', live, bounded, 0 FROM t UNION ALL SELECT 'table_added', 'C6_TABLES', live, bounded, 0 FROM t
UNION ALL SELECT 'instruction_added', 'C7_INSTRUCTIONS', n, live, 0 FROM t UNION ALL SELECT 'mark_renamed', 'C10_UNPAIRED', live, live, 0 FROM t
UNION ALL SELECT 'number_lost', 'C2_NUMBERS', n, several, alone FROM t UNION ALL SELECT 'number_twice', 'C13_SAME_SECTION', n, live, 0 FROM t
UNION ALL SELECT 'paper_line_taken', 'C9_PAPER_LINES', n, live, 0 FROM t UNION ALL SELECT 'parts_crossed', 'C12_NOT_NESTED', n, live, 0 FROM t
UNION ALL SELECT 'parts_lost', 'C4_COMPOSITE', plain, live_plain, 0 FROM t UNION ALL SELECT 'section_lost', 'C14_SCOPE_MISSING', live, live, 0 FROM t
UNION ALL SELECT 'source_lost', 'C15_PROVENANCE', live, live, 0 FROM t UNION ALL SELECT 'stem_as_explanation', 'C11_REPEATED_STEM', n, live, 0 FROM t
UNION ALL SELECT 'zone_mark_lost', 'C1_NO_STEM_START', n, live, 0 FROM t
"""


@query("rule_kills", _PAPERS + _KILLS)
def rule_kills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule's mutant of every paper: how many it changed, how many the rule told, how many passed."""
    return mutants.survivors(mutants.judged_mutants(annotated_papers(spark, sf_dir)))
