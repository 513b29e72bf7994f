"""Queries of option recovery, index maps and near copies over lines of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.text import compact, computed
from sheaf.operators import copies, exam, options
from sheaf.plans.catalog import query
from sheaf.sources.tables import table

_SEPS = ".．、:，。)）"
_C = "substr('ABCDE', (p % 5 + 1)::INT, 1)"
_OPTIONS = rf"""
WITH RECURSIVE d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
s AS (SELECT doc_id, unnest(ls) AS x, unnest(range(len(ls))) AS p FROM d),
l AS MATERIALIZED (SELECT doc_id, p // 5 AS block, p % 5 + 1 AS k, x,
  CASE length(x) % 7 WHEN 0 THEN {_C} || '. ' || x WHEN 1 THEN '7' || {_C} || '. ' || x WHEN 2 THEN {_C} || ' 文' || x WHEN 3 THEN x WHEN 4 THEN {_C} || '. F、' || x
    WHEN 5 THEN lower({_C}) || ') ' || x ELSE {_C} || ' 是' || x END AS t FROM s),
u AS MATERIALIZED (SELECT doc_id, block, CASE length(min(x) FILTER (WHERE k = 1)) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'ABCDF' ELSE '' END AS declared FROM l GROUP BY ALL),
m AS MATERIALIZED (SELECT *, string_split(regexp_replace(regexp_replace(t, '([{_SEPS}])', '\1 ', 'g'), '(^|[^A-Za-z0-9_])([A-Ha-h]\s*[{_SEPS}])', '\1' || chr(1) || '\2' || chr(2), 'g'), chr(1)) AS q,
  len(regexp_extract_all(t, '(?:^|[^A-Za-z0-9_])[0-9]([A-H])\s*[.．、]')) > 0 AS glue, regexp_matches(t, '^[ \x{{00a0}}]*[A-Ha-h][ \x{{00a0}}]{{1,3}}[\x{{4e00}}-\x{{9fff}}]') AS spaced,
  regexp_matches(t, '^[ \x{{00a0}}]*[A-Ha-h][ \x{{00a0}}]+(是|有|在|了|和|与|或|被|把|对|从|到|为|要|会|能|可|这|那|其|年|月|日)') AS prose FROM l),
g AS (SELECT doc_id, block, k, unnest(q) AS seg, unnest(range(len(q))) AS j, unnest(list_prepend('', q)) AS pre FROM m),
e0 AS (SELECT doc_id, block, 1 AS kind, k, j, upper(substr(seg, 1, 1)) AS label FROM g WHERE j > 0 AND seg IS NOT NULL AND (j = 1 OR trim(string_split(pre, chr(2))[2], ' ' || chr(9) || chr(11) || chr(12) || chr(13) || chr(160)) <> '')
  UNION ALL SELECT doc_id, block, 2, k, 0, unnest(regexp_extract_all(regexp_replace(t, '([.．、])', '\1 ', 'g'), '(?:^|[^A-Za-z0-9_])[0-9]([A-H])\s*[.．、] (?:[^0-9\\^_{{}}]|$)', 1)) FROM m
  UNION ALL SELECT doc_id, block, 3, k, 0, upper(regexp_extract(t, '[A-Ha-h]')) FROM m WHERE spaced AND NOT prose
  UNION ALL SELECT doc_id, block, 4, k, 0, '' FROM m WHERE NOT spaced AND NOT prose AND NOT glue AND len(q) = 1 AND length(trim(t)) >= 4 AND NOT regexp_matches(trim(t), '^(<|#|---|[0-9]+\s*[.．、\\])')),
e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, block ORDER BY kind, k, j) AS i FROM e0),
r AS (SELECT doc_id, block, 0::BIGINT AS i, 0::BIGINT AS last, []::STRUCT(l VARCHAR, a BIGINT, z BIGINT)[] AS ms FROM u
  UNION ALL
  SELECT doc_id, block, i, CASE WHEN fresh OR more THEN greatest(last, k) ELSE last END,
    CASE WHEN fresh THEN list_append(ms, {{'l': got, 'a': k, 'z': k}}) WHEN more THEN list_append(ms[1:len(ms) - 1], {{'l': ms[-1].l, 'a': ms[-1].a, 'z': k}}) ELSE ms END
  FROM (SELECT *, CASE kind WHEN 4 THEN nxt ELSE label END AS got, kind = 4 AND k > last AND fullset AS more,
          CASE kind WHEN 1 THEN NOT has WHEN 4 THEN k > last AND NOT fullset AND nxt <> '' ELSE label = nxt END AS fresh
        FROM (SELECT r.doc_id, r.block, e.i, r.last, r.ms, e.kind, e.k, e.label, list_contains(list_transform(r.ms, lambda y: y.l), e.label) AS has,
                list_has_all(list_transform(r.ms, lambda y: y.l), ['A', 'B', 'C', 'D']) AS fullset,
                CASE WHEN len(r.ms) = 0 THEN 'A' ELSE substr('ABCDEFGH', instr('ABCDEFGH', list_max(list_transform(r.ms, lambda y: y.l))) + 1, 1) END AS nxt
              FROM r JOIN e ON e.doc_id = r.doc_id AND e.block = r.block AND e.i = r.i + 1))),
f AS (SELECT doc_id, block, arg_max(ms, i) AS ms FROM r GROUP BY ALL),
h AS (SELECT f.doc_id, f.block, list_sort(list_transform(ms, lambda y: {{'a': y.a, 'z': y.z, 'l': y.l}})) AS ms, declared, list_filter(string_split(declared, ''), lambda y: y <> '') AS ds FROM f JOIN u ON u.doc_id = f.doc_id AND u.block = f.block),
o AS (SELECT *, list_transform(ms, lambda y: y.l) AS ls, len(ms) BETWEEN 4 AND 8 AND array_to_string(list_transform(ms, lambda y: y.l), '') = substr('ABCDEFGH', 1, len(ms)) AS run FROM h),
n AS (SELECT *, CASE WHEN declared = '' AND len(ms) = 0 THEN 'NO_LABELS' WHEN declared = '' THEN 'FOUND' WHEN run AND len(list_filter(ds, lambda y: NOT list_contains(ls, y))) > 0 THEN 'PRUNED'
        WHEN len(list_filter(ls, lambda y: NOT list_contains(ds, y))) > 0 THEN 'RECOVERED' END AS note FROM o)
SELECT doc_id, block, note AS option_note, array_to_string(list_transform(CASE WHEN note IN ('FOUND', 'PRUNED') THEN ms WHEN note = 'RECOVERED'
    THEN list_sort(list_concat(list_transform(ds, lambda y: {{'a': 1::BIGINT, 'z': 1::BIGINT, 'l': y}}), list_filter(ms, lambda y: NOT list_contains(ds, y.l))))
    ELSE list_transform(ds, lambda y: {{'a': 1::BIGINT, 'z': 1::BIGINT, 'l': y}}) END, lambda y: y.l || y.a || '-' || y.z), ' ') AS options FROM n
"""


@query("option_recovery", _OPTIONS)
def option_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every five lines of a document are options; how a line is marked follows from its length, what is
    declared from that of the first. All four kinds of mark, text that looks like a mark, and what the
    documents themselves hold."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("ls"))
    rows = rows.select("doc_id", "ls", F.explode(F.sequence(F.lit(0), F.floor((F.size("ls") - 1) / 5).cast("int"))).alias("block"))
    rows = computed(rows.select("doc_id", F.col("block").cast("long").alias("block"), F.slice("ls", F.col("block") * 5 + 1, 5).alias("xs")), {"xs": F.col("xs")})

    def marked(x, i):
        c = F.substr(F.lit("ABCDE"), i + 1, F.lit(1))
        n = F.char_length(x) % 7
        out = F.when(n == 0, F.concat(c, F.lit(". "), x)).when(n == 1, F.concat(F.lit("7"), c, F.lit(". "), x)).when(n == 2, F.concat(c, F.lit(" 文"), x)).when(n == 3, x)
        return out.when(n == 4, F.concat(c, F.lit(". F、"), x)).when(n == 5, F.concat(F.lower(c), F.lit(") "), x)).otherwise(F.concat(c, F.lit(" 是"), x))

    first = F.char_length(F.get("xs", F.lit(0))) % 3
    declared = F.when(first == 0, F.array(F.lit("A"))).when(first == 1, F.array(*map(F.lit, "ABCDF")))
    declared = F.transform(declared, lambda c: F.struct(c.alias("label"), F.lit(1).alias("start_line"), F.lit(1).alias("end_line")))
    units = rows.select(
        "doc_id",
        "block",
        F.transform("xs", marked).alias("lines"),
        F.lit("standalone_question").alias("unit_type"),
        F.lit("single_choice").alias("question_type"),
        F.struct(F.lit(1).alias("start"), F.size("xs").alias("end")).alias("options_lines"),
        F.lit(None).cast("struct<start:int,end:int>").alias("questions_lines"),
        declared.alias("options"),
    )
    out = options.with_options(computed(units, {"lines": F.col("lines")}))
    told = F.transform(F.coalesce("options", F.array().cast(f"array<{options.MARK}>")), lambda m: F.concat(m["label"], m["start_line"].cast("string"), F.lit("-"), m["end_line"].cast("string")))
    return out.select("doc_id", "block", "option_note", F.array_join(told, " ").alias("options"))


_WIDE, _NARROW = ("".join(chr(c - shift) for c in range(0xFF01, 0xFF5F)).replace("'", "''") for shift in (0, 0xFEE0))
_BLANK = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SUB = "list_reduce(range(1, length({b}) + 1), lambda i, k: CASE WHEN substr({a}, i + 1, 1) = substr({b}, k, 1) AND i < length({a}) THEN i + 1 ELSE i END, 0::BIGINT) = length({a})"


def _binding_oracle() -> str:
    c = lambda x: f"regexp_replace(translate({x}, '{_WIDE}', '{_NARROW}'), '{_BLANK}', '', 'g')"
    sub = lambda a, b: _SUB.format(a=a, b=b)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS document, string_split(coalesce(text, ''), chr(10)) AS ls, length(coalesce(text, '')) % 7 AS k FROM documents),
b AS (SELECT *, ls[(len(ls) + 1) // 2] AS block, ls[-1] AS final FROM d),
e AS (SELECT *, substr(block, 1, length(block) * 9 // 10) || substr(block, length(block) * 9 // 10 + 2) AS edited FROM b),
v AS (SELECT doc_id, document, block, CASE WHEN k IN (3, 4) THEN 'compressed' ELSE 'verbatim' END AS form, k,
  regexp_replace(CASE k WHEN 0 THEN block WHEN 1 THEN replace(translate(block, 'ABCDEFabcdef', 'ＡＢＣＤＥＦａｂｃｄｅｆ'), ' ', '　 ') WHEN 2 THEN final WHEN 3 THEN edited WHEN 4 THEN block || final WHEN 5 THEN edited ELSE reverse(block) END, '^{_BLANK}|{_BLANK}$', '', 'g') AS v,
  CASE k WHEN 0 THEN [final, block] WHEN 5 THEN ['Q'] ELSE [] END AS cands FROM e),
n AS (SELECT *, {c("v")} AS nv, {c("block")} AS nb, {c("document")} AS nd, list_filter(cands, lambda x: {c("x")} = {c("v")})[1] AS hit FROM v),
s AS (SELECT *, v <> '' AND hit IS NULL AND contains(nb, nv) AS inside FROM n),
f AS (SELECT *, CASE WHEN v <> '' AND hit IS NULL AND NOT inside THEN {sub("nv", "nb")} END AS sub FROM s),
r AS (SELECT *, CASE WHEN sub IS NOT NULL AND form = 'compressed' THEN CASE WHEN nv = '' THEN 0.0::DOUBLE ELSE list_reduce(range(1, length(nv) + 1), lambda best, i: CASE WHEN contains(nb, substr(nv, i - best, best + 1)) THEN best + 1 ELSE best END, 0::BIGINT)::DOUBLE / length(nv) END END AS share FROM f),
t AS (SELECT *, CASE WHEN v = '' THEN 'not_applicable' WHEN hit IS NOT NULL THEN 'rule_candidate' WHEN inside AND form = 'verbatim' THEN 'source_substring' WHEN inside THEN 'compressed_strong'
       WHEN form = 'compressed' AND sub AND share >= 0.8 THEN 'compressed_weak' WHEN k = 5 THEN 'mismatch_recovered' ELSE 'mismatch_withheld' END AS tier FROM r)
SELECT doc_id, tier, CASE WHEN tier = 'rule_candidate' THEN CASE WHEN hit = v THEN 'exact' ELSE 'normalized' END WHEN inside THEN CASE WHEN contains(block, v) THEN 'exact' ELSE 'normalized' END ELSE 'none' END AS match,
  CASE WHEN tier LIKE 'mismatch%' THEN CASE WHEN contains(nd, nv) THEN 'outside_region' WHEN sub THEN 'in_region_edit' WHEN {sub("nv", "nd")} THEN 'outside_region' ELSE 'absent_from_doc' END END AS mismatch_class,
  round(share, 9) AS lcs_share, {c("CASE WHEN tier IN ('rule_candidate') THEN hit WHEN tier = 'source_substring' THEN v WHEN tier IN ('compressed_strong', 'compressed_weak') THEN v WHEN tier = 'mismatch_recovered' THEN 'Q' END")} AS bound
FROM t
"""


@query("answer_binding", _binding_oracle())
def answer_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle line of each document is what an answer cites; the answer is that line as it is, spaced
    and widened, with a character lost, with more behind it, backwards, or another line."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("document"))
    d = computed(d, {"ls": F.split("document", "\n", -1), "k": F.char_length("document") % 7})
    d = d.select("doc_id", "document", "k", F.get("ls", F.floor((F.size("ls") + 1) / 2).cast("int") - 1).alias("block"), F.element_at("ls", -1).alias("final"))
    at = F.floor(F.char_length("block") * 9 / 10).cast("int")
    edited = F.concat(F.substr("block", F.lit(1), at), F.substr("block", at + 2))
    wide = F.replace(F.translate("block", "ABCDEFabcdef", "ＡＢＣＤＥＦａｂｃｄｅｆ"), F.lit(" "), F.lit("　 "))
    k = F.col("k")
    value = F.when(k == 0, F.col("block")).when(k == 1, wide).when(k == 2, F.col("final")).when(k == 4, F.concat("block", "final")).when(k == 6, F.reverse("block")).otherwise(edited)
    cands = F.when(k == 0, F.array("final", "block")).when(k == 5, F.array(F.lit("Q")))
    entries = d.select("doc_id", "document", "block", value.alias("value_text"), F.when(k.isin(3, 4), "compressed").alias("form"), cands.alias("candidates"), F.lit("entry_bound").alias("bind_source"), F.lit(True).alias("cited"))
    out = exam.bound_answers(computed(entries, {"value_text": F.col("value_text")}))
    return out.select("doc_id", "tier", "match", "mismatch_class", F.round("lcs_share", 9).alias("lcs_share"), compact(F.col("bound_value")).alias("bound"))


#: Line ends besides the line feed, which lines of these queries do not have.
_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85  "
_LINES = f"""
WITH d AS (SELECT doc_id, string_split(translate(coalesce(text, ''), {"||".join(f"chr({ord(c)})" for c in _ENDS)}, '{" " * len(_ENDS)}'), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS x, unnest(range(1, len(ls) + 1)) AS k FROM d)
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    return computed(rows.select("doc_id", F.split(F.translate(F.coalesce("text", F.lit("")), _ENDS, " " * len(_ENDS)), "\n", -1).alias("xs")), {"xs": F.col("xs")})


_SHORT = rf"length(regexp_replace(x, '[\s,。，、：:；;（）()\x{{a0}}\x{{3000}}\x{{2000}}-\x{{200a}}]', '', 'g'))"


@query(
    "line_scan",
    _LINES
    + rf"""
, n AS (SELECT doc_id, k, CASE WHEN length(x) % 4 = 3 AND contains(x, '$') THEN 4 ELSE length(x) % 4 END AS s, k <= 999 AND {_SHORT} >= 8 AS told FROM l),
r AS (SELECT doc_id, string_agg((2 * k - 1) || '-' || (2 * k) || ':' || k, ' ' ORDER BY k) FILTER (WHERE told AND s <> 1) AS doubled,
  string_agg((2 * k)::VARCHAR, ' ' ORDER BY k) FILTER (WHERE s = 3 AND k % 2 = 0) AS bare_complex, string_agg((2 * k)::VARCHAR, ' ' ORDER BY k) FILTER (WHERE s = 3 AND k % 2 = 1) AS bare_simple FROM n GROUP BY doc_id)
SELECT doc_id, coalesce(doubled, '') AS doubled, coalesce(bare_simple, '') AS bare_simple, coalesce(bare_complex, '') AS bare_complex FROM r
""",
)
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a document twice with its number: again as it is, as other signs, without its
    blanks, or with a command behind it, which is bare unless the line has a dollar sign."""
    rows = _lines(spark, sf_dir)

    def twice(x, i):
        n, k = F.char_length(x) % 4, (i + 1).cast("string")
        dressed = F.when(i % 2 == 1, F.concat(x, F.lit("\\frac"))).otherwise(F.concat(x, F.lit("\\sqrt")))
        y = F.when(n == 0, x).when(n == 1, F.lit("☂☃☄★☆☇☈☉☊☋")).when(n == 2, F.replace(x, F.lit(" "), F.lit(""))).otherwise(dressed)
        return F.array(F.concat(k, F.lit(". "), x), F.concat(k, F.lit(". "), y))

    docs = rows.select("doc_id", F.array_join(F.flatten(F.transform("xs", twice)), "\n").alias("text"))
    out = copies.line_scan(docs)
    pairs = F.transform("doubled", lambda p: F.concat(p["line"].cast("string"), F.lit("-"), p["again"].cast("string"), F.lit(":"), p["number"]))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
    return out.select("doc_id", F.array_join(pairs, " ").alias("doubled"), joined("bare_simple"), joined("bare_complex"))


@query(
    "copied_lines",
    _LINES
    + """
SELECT doc_id, k - 1 AS unit_ord, 2 * k + len(ls) + 1 AS line_no, round((length(k::VARCHAR) + 25)::DOUBLE / (length(k::VARCHAR) + 33), 9) AS cover
FROM l JOIN d USING (doc_id) WHERE length(x) % 3 = 1 AND k <= 999
""",
)
def copied_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose questions are digests of a document's lines. Before each answer stands its question
    once more: as it is, with a quarter of it changed, or changed all over."""
    rows = _lines(spark, sf_dir)
    digest = lambda x, i: F.md5(F.concat(x, F.lit(":"), (i + 1).cast("string")))
    asked = lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), digest(x, i))
    signs = "☂☃☄★☆☇☈☉"

    def again(x, i):
        n = F.char_length(x) % 3
        y = F.when(n == 0, digest(x, i)).when(n == 1, F.concat(F.substring(digest(x, i), 1, 24), F.lit(signs))).otherwise(F.lit(signs * 4))
        return F.array(F.concat((i + 1).cast("string"), F.lit(". "), y), F.lit("A"))

    rows = computed(rows, {"q": F.transform("xs", asked), "a": F.flatten(F.transform("xs", again)), "n": F.size("xs")})
    spans = {"stem": lambda i: i + 2, "answer": lambda i: F.col("n") + 4 + 2 * i}
    span = lambda r, i: F.struct(spans[r](i).cast("int").alias("start"), spans[r](i).cast("int").alias("end")) if r in spans else F.lit(None).cast(exam.SPAN)
    name = lambda i: F.concat(F.lit("Q"), (i + 1).cast("string"))
    unit = lambda x, i: F.struct(name(i).alias("unit_id"), F.lit("standalone_question").alias("unit_type"), F.array(i + 1).alias("question_numbers"), F.array((i + 1).cast("string")).alias("printed_number"), *[F.lit(None).cast("string").alias(c) for c in ("section", "section_ref", "basis", "basis_evidence")], *[span(r, i).alias(r) for r in exam.ROLES])
    papers = rows.select("doc_id", F.array_join(F.concat(F.array(F.lit("# t")), "q", F.array(F.lit("## a")), "a"), "\n").alias("text"), F.transform("xs", unit).cast(f"array<{exam.UNIT}>").alias("units"))
    out = copies.copied_lines(papers)
    return out.select("doc_id", F.col("unit_ord").cast("long").alias("unit_ord"), F.col("line_no").cast("long").alias("line_no"), F.round("cover", 9).alias("cover"))
