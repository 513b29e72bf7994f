"""Queries of the engine over the driver's tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import text
from sheaf.operators import ledger, qc, sampling, spans
from sheaf.plans.catalog import query
from sheaf.sources.tables import table


@query(
    "line_profile",
    """
    WITH l AS (SELECT lang, source, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT lang, source, count(DISTINCT doc_id) AS n_docs, count(*) AS n_lines,
           count(*) FILTER (WHERE line LIKE '#%') AS n_headings,
           count(*) FILTER (WHERE regexp_matches(line, '^[0-9]')) AS n_numbered,
           count(*) FILTER (WHERE trim(line) = '') AS n_blank
    FROM l GROUP BY lang, source
    """,
)
def line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, headings, numbered and blank lines by language and source."""
    per_doc = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return (
        per_doc.groupBy("lang", "source", "doc_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("line").startswith("#")).alias("h"),
            F.count_if(F.col("line").rlike("^[0-9]")).alias("d"),
            F.count_if(F.trim("line") == "").alias("b"),
        )
        .groupBy("lang", "source")
        .agg(
            F.count("*").alias("n_docs"),
            F.sum("n").alias("n_lines"),
            F.sum("h").alias("n_headings"),
            F.sum("d").alias("n_numbered"),
            F.sum("b").alias("n_blank"),
        )
    )


# --- lines, spans and sections ---------------------------------------------------------------


@query(
    "numbered_lines",
    r"""
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS line_no, len(ls) AS n FROM d)
    SELECT doc_id, line_no, '[L' || lpad(line_no::VARCHAR, greatest(4, length(line_no::VARCHAR))::INTEGER, '0') || '] ' || line AS numbered
    FROM l WHERE NOT (line_no = n AND line = '')
    """,
)
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base relation: every document's lines, as a prompt shows them."""
    lines = spans.lines_of(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), text.numbered_line(F.col("line_no"), F.col("line")).alias("numbered"))


@query(
    "document_counts",
    r"""
    WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents)
    SELECT doc_id, len(ls) - (ls[-1] = '')::INT AS n_lines, length(text) AS n_chars,
           len(list_filter(ls, lambda x: x LIKE '#%')) AS n_headings,
           len(list_filter(ls, lambda x: trim(x) = '---')) AS n_breaks,
           len(list_filter(ls, lambda x: regexp_matches(x, '[0-9]'))) AS n_with_digits
    FROM d
    """,
)
def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a document by array functions on its lines: no explode, no shuffle."""
    n = lambda f: F.size(F.filter("ls", f)).cast("long")
    return table(spark, sf_dir, "documents").withColumn("ls", text.split_lines(F.col("text"))).select(
        "doc_id",
        F.size("ls").cast("long").alias("n_lines"),
        F.char_length("text").cast("long").alias("n_chars"),
        n(lambda x: x.startswith("#")).alias("n_headings"),
        n(lambda x: F.trim(x) == "---").alias("n_breaks"),
        n(lambda x: x.rlike("[0-9]")).alias("n_with_digits"),
    )


@query(
    "span_slices",
    """
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    s AS (SELECT doc_id, ls, 2 AS a, 4 AS b FROM d UNION ALL SELECT doc_id, ls, 1, 1 FROM d)
    SELECT doc_id, a AS start_line, b AS end_line,
           CASE WHEN b <= len(ls) - (ls[-1] = '')::INT THEN sha256(array_to_string(ls[a:b], chr(10))) END AS slice_sha256
    FROM s
    """,
)
def span_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of spans cut out of the row's own lines; null where the span leaves the document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text.split_lines(F.col("text")).alias("ls"))
    rows = docs.select("doc_id", "ls", F.inline(F.array(F.struct(F.lit(2).alias("start_line"), F.lit(4).alias("end_line")), F.struct(F.lit(1).alias("start_line"), F.lit(1).alias("end_line")))))
    return rows.select("doc_id", "start_line", "end_line", F.sha2(spans.span_text(F.col("ls"), F.col("start_line"), F.col("end_line")), 256).alias("slice_sha256"))


@query(
    "clamped_spans",
    """
    SELECT l_orderkey, l_linenumber, greatest(1, least(l_linenumber, 4, 5)) AS dummy_low,
           least(least(greatest(l_linenumber - 2, 1), 5), least(greatest((l_quantity / 10)::INT, 1), 5)) AS start_line,
           greatest(least(greatest(l_linenumber - 2, 1), 5), least(greatest((l_quantity / 10)::INT, 1), 5)) AS end_line
    FROM lineitem
    """.replace("greatest(1, least(l_linenumber, 4, 5)) AS dummy_low,", "").replace("(l_quantity / 10)::INT", "floor(l_quantity / 10)::INT"),
)
def clamped_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans forced into 1..5 with their ends in order."""
    s = spans.clamped(F.col("l_linenumber") - 2, F.floor(F.col("l_quantity") / 10).cast("int"), F.lit(5))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", s["start"].alias("start_line"), s["end"].alias("end_line"))


_TURNS = "WITH t AS (SELECT conv_id, (turn + 1) AS line_no, role, text FROM conversations)"


@query(
    "section_locators",
    _TURNS
    + """, n AS (SELECT conv_id, max(line_no) AS n_lines FROM t GROUP BY conv_id),
    h AS (SELECT conv_id, line_no, text AS title FROM t WHERE role = 'user'
          UNION ALL SELECT conv_id, 1, NULL FROM n),
    g AS (SELECT conv_id, line_no, max(title) AS title FROM h GROUP BY conv_id, line_no)
    SELECT g.conv_id, row_number() OVER (PARTITION BY g.conv_id ORDER BY line_no) AS ordinal, title,
           line_no AS start_line, coalesce(lead(line_no) OVER (PARTITION BY g.conv_id ORDER BY line_no) - 1, n_lines) AS end_line,
           row_number() OVER (PARTITION BY g.conv_id, title ORDER BY line_no) AS occurrence, title IS NULL AS derived
    FROM g JOIN n ON n.conv_id = g.conv_id
    """,
)
def section_locators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings (user turns) as a partition of each conversation."""
    t = _turns(spark, sf_dir)
    heads = t.where("role = 'user'").select("conv_id", "line_no", F.col("text").alias("title"))
    return spans.sections(heads, t.groupBy("conv_id").agg(F.max("line_no").alias("n_lines")), "conv_id")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("line_no"), "role", "text")


@query(
    "located_sections",
    _TURNS
    + """, m AS (SELECT conv_id, line_no, text AS title FROM t WHERE role = 'user')
    SELECT t.conv_id, t.line_no, (SELECT m.title FROM m WHERE m.conv_id = t.conv_id AND m.line_no <= t.line_no ORDER BY m.line_no DESC LIMIT 1) AS title
    FROM t WHERE role = 'assistant'
    """,
)
def located_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join: each answer with the last heading before it."""
    t = _turns(spark, sf_dir)
    heads = t.where("role = 'user'").select("conv_id", "line_no", F.col("text").alias("title"))
    return spans.located(t.where("role = 'assistant'").select("conv_id", "line_no"), heads, "conv_id", "line_no", "title")


@query(
    "covered_lines",
    _TURNS
    + """, s AS (SELECT conv_id, line_no AS a, line_no + 1 AS b, 'S' || line_no AS unit FROM t WHERE role = 'user')
    SELECT t.conv_id, t.line_no, count(s.unit) AS n_spans, min(s.unit) AS first_unit
    FROM t JOIN s ON s.conv_id = t.conv_id AND t.line_no BETWEEN s.a AND s.b GROUP BY ALL
    """,
)
def covered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range join of lines and spans within a document."""
    t = _turns(spark, sf_dir)
    return spans.span_lines(t, _units(t), "conv_id").groupBy("conv_id", "line_no").agg(F.count("unit").alias("n_spans"), F.min("unit").alias("first_unit"))


def _units(t: DataFrame) -> DataFrame:
    return t.where("role = 'user'").select("conv_id", F.col("line_no").alias("start"), (F.col("line_no") + 1).alias("end"), F.concat(F.lit("S"), F.col("line_no")).alias("unit"))


@query(
    "uncovered_lines",
    _TURNS
    + """, s AS (SELECT conv_id, line_no AS a, line_no AS b FROM t WHERE role = 'user')
    SELECT conv_id, line_no, role FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = t.conv_id AND t.line_no BETWEEN s.a AND s.b)
    """,
)
def uncovered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti range join: lines that no span covers."""
    t = _turns(spark, sf_dir)
    own = t.where("role = 'user'").select("conv_id", F.col("line_no").alias("start"), F.col("line_no").alias("end"))
    return spans.uncovered(t, own, "conv_id").select("conv_id", "line_no", "role")


@query(
    "nearest_unit",
    _TURNS
    + """, s AS (SELECT conv_id, line_no AS a, line_no + 1 AS b, 'S' || line_no AS unit FROM t WHERE role = 'user'),
    p AS (SELECT conv_id, line_no FROM t WHERE role <> 'user'),
    g AS (SELECT p.conv_id, p.line_no, s.unit, s.a, greatest(s.a - p.line_no, p.line_no - s.b, 0) AS gap FROM p LEFT JOIN s ON s.conv_id = p.conv_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, line_no ORDER BY gap, a, unit) AS k FROM g)
    SELECT conv_id, line_no, CASE WHEN gap <= 6 THEN unit END AS unit, CASE WHEN gap <= 6 THEN gap END AS gap FROM r WHERE k = 1
    """,
)
def nearest_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines outside questions with the nearest unit within six lines."""
    t = _turns(spark, sf_dir)
    return spans.nearest(t.where("role <> 'user'").select("conv_id", "line_no"), _units(t), "conv_id", "unit", 6)


@query(
    "line_owners",
    _TURNS
    + """, s AS (SELECT conv_id, line_no AS a, line_no + 2 AS b, 'S' || line_no AS unit FROM t WHERE role = 'user'),
    r AS (SELECT t.conv_id, t.line_no, s.unit, row_number() OVER (PARTITION BY t.conv_id, t.line_no ORDER BY s.a, s.unit) AS k
          FROM t JOIN s ON s.conv_id = t.conv_id AND t.line_no BETWEEN s.a AND s.b)
    SELECT conv_id, line_no, unit FROM r WHERE k = 1
    """,
)
def line_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line with the first of the zones that hold it."""
    t = _turns(spark, sf_dir)
    zones = _units(t).withColumn("end", F.col("start") + 2)
    return spans.owners(t, zones, "conv_id", ["start", "unit"]).select("conv_id", "line_no", "unit")


@query(
    "repeated_lines_near",
    """
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS no FROM d),
    f AS (SELECT * FROM l WHERE length(line) >= 8)
    SELECT a.doc_id, a.no AS line_no, b.no AS again_no FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.line = b.line AND b.no - a.no BETWEEN 1 AND 4
    """,
)
def repeated_lines_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line that stands again within four lines. Each line looks ahead by lead() within its
    equals: pairs of a hot line are at most four a line, and there is no self-join."""
    from pyspark.sql import Window

    lines = spans.lines_of(table(spark, sf_dir, "documents")).where(F.char_length("line") >= 8)
    by = Window.partitionBy("doc_id", F.xxhash64("line"), "line").orderBy("line_no")
    rows = lines.select("doc_id", "line_no", F.array(*[F.lead("line_no", i).over(by) for i in range(1, 5)]).alias("ahead"))
    rows = rows.select("doc_id", "line_no", F.explode("ahead").alias("again_no"))
    return rows.where(F.col("again_no") - F.col("line_no") <= 4).select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("again_no").cast("long").alias("again_no"))


# --- inventory, classification ---------------------------------------------------------------


@query(
    "exact_dup_groups",
    """
    SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_doc, count(DISTINCT source) AS n_sources
    FROM documents GROUP BY sha256(text) HAVING count(*) > 1
    """,
)
def exact_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-identical texts. The text is hashed before the shuffle."""
    rows = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"), "doc_id", "source")
    return rows.groupBy("sha256").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.countDistinct("source").alias("n_sources")).where("n > 1")


@query(
    "normalised_dup_groups",
    r"""
    WITH s AS (SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '[ \t]+(\n|$)', '\1', 'g'), '^\n+|\n+$', '', 'g'), ' ')) AS sha256 FROM documents)
    SELECT sha256, count(*) AS n, min(doc_id) AS first_doc FROM s GROUP BY sha256 HAVING count(*) > 1
    """,
)
def normalised_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are equal up to white space at line ends and around the whole."""
    norm = F.trim(F.regexp_replace(F.regexp_replace("text", r"[ \t]+(\n|$)", "$1"), r"^\n+|\n+\z", ""))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2(norm, 256).alias("sha256"))
    return rows.groupBy("sha256").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query(
    "name_collisions",
    """
    WITH p AS (SELECT page_id, url, regexp_extract(url, '([0-9]+)[^/]*$', 1) AS name, coalesce(sha256(html), '?') AS sha FROM pages)
    SELECT name, count(*) AS n, count(DISTINCT sha) AS n_sha, min(url) AS first_path, count(DISTINCT sha) = 1 AS identical
    FROM p GROUP BY name HAVING count(*) > 1
    """,
)
def name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base names that several pages share, and whether these are the same bytes."""
    rows = table(spark, sf_dir, "pages").select("url", F.regexp_extract("url", "([0-9]+)[^/]*$", 1).alias("name"), F.sha2("html", 256).alias("sha"))
    return ledger.collisions(rows, "name", "sha", "url")


@query(
    "rule_classification",
    r"""
    SELECT page_id, CASE WHEN regexp_matches(url, '/en/') THEN 'english' WHEN regexp_matches(url, '/(de|fr)/') THEN 'continental'
           WHEN url LIKE '%example.org%' THEN 'organisation' ELSE 'other' END AS kind,
           CASE WHEN url LIKE 'https:%' THEN 'secure' ELSE 'plain' END AS scheme
    FROM pages
    """,
)
def rule_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rules, first match wins."""
    url = F.col("url")
    kind = text.first_match([("english", url.rlike("/en/")), ("continental", url.rlike("/(de|fr)/")), ("organisation", url.contains("example.org"))], "other")
    return table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"), text.first_match([("secure", url.startswith("https:"))], "plain").alias("scheme"))


@query(
    "subject_score",
    r"""
    WITH s AS (SELECT doc_id, len(regexp_extract_all(text, '[ \n]the[ .,\n]')) AS a, len(regexp_extract_all(text, '[ \n]der[ .,\n]')) AS b, len(regexp_extract_all(text, '[ \n]la[ .,\n]')) AS c FROM documents)
    SELECT doc_id, CASE WHEN greatest(a, b, c) < 3 THEN 'unknown' WHEN a >= b AND a >= c THEN 'the' WHEN b >= c THEN 'der' ELSE 'la' END AS subject FROM s
    """,
)
def subject_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content score: the word class with the most hits, three at least."""
    scores = {w: text.count_of(F.col("text"), rf"[ \n]{w}[ .,\n]") for w in ("the", "der", "la")}
    return table(spark, sf_dir, "documents").select("doc_id", text.best_score(scores, 3, "unknown").alias("subject"))


@query(
    "quality_flags",
    r"""
    SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '\|') THEN 'table' END, CASE WHEN regexp_matches(text, '[%$&#]{3}') THEN 'symbols' END,
           CASE WHEN n_chars > 10000 THEN 'long' END], lambda x: x IS NOT NULL) AS flags,
           len(regexp_extract_all(text, '\|')) AS n_bars, len(regexp_extract_all(text, '[0-9]{3,}')) AS n_numbers
    FROM documents
    """,
)
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern counts and risk flags of each document."""
    t = F.col("text")
    flags = text.tags({"table": t.contains("|"), "symbols": t.rlike("[%$&#]{3}"), "long": F.col("n_chars") > 10000})
    return table(spark, sf_dir, "documents").select("doc_id", flags.alias("flags"), text.count_of(t, r"\|").alias("n_bars"), text.count_of(t, "[0-9]{3,}").alias("n_numbers"))


# --- markup ------------------------------------------------------------------------------------


@query(
    "tag_balance",
    r"""
    WITH c AS (SELECT page_id, len(regexp_extract_all(html, '<p[ >]')) AS p_open, len(regexp_extract_all(html, '</p>')) AS p_close,
                      len(regexp_extract_all(html, '<div[ >]')) AS div_open, len(regexp_extract_all(html, '</div>')) AS div_close FROM pages)
    SELECT *, list_filter([CASE WHEN p_open <> p_close THEN 'p' END, CASE WHEN div_open <> div_close THEN 'div' END], lambda x: x IS NOT NULL) AS unbalanced FROM c
    """,
)
def tag_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render lint: tags that open and close unequally often."""
    counts = {f"{t}_{k}": text.count_of(F.col("html"), p) for t in ("p", "div") for k, p in (("open", f"<{t}[ >]"), ("close", f"</{t}>"))}
    rows = table(spark, sf_dir, "pages").select("page_id", *[c.alias(n) for n, c in counts.items()])
    return rows.withColumn("unbalanced", text.tags({t: F.col(f"{t}_open") != F.col(f"{t}_close") for t in ("p", "div")}))


@query(
    "html_refs",
    r"""
    WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS ref FROM pages)
    SELECT page_id, ref, count(*) AS n, CASE WHEN regexp_matches(ref, '^https?://') THEN 'remote' WHEN ref LIKE 'data:%' THEN 'embedded' ELSE 'local' END AS kind,
           NOT regexp_matches(ref, '^[/\\]|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)') AS safe
    FROM r GROUP BY ALL
    """,
)
def html_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of each page, their kind, and whether they are safe as local paths."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(text.find_all(F.col("html"), 'href="([^"]+)"', 1)).alias("ref"))
    rows = rows.groupBy("page_id", "ref").agg(F.count("*").alias("n"))
    return rows.withColumns({"kind": text.ref_kind(F.col("ref")), "safe": text.safe_path(F.col("ref"))})


@query(
    "url_parts",
    r"""
    SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS top, count(*) AS n,
           count(*) FILTER (WHERE url LIKE '%?%') AS n_with_query
    FROM pages GROUP BY ALL
    """,
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by host and first path segment."""
    rows = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract("url", "^[a-z]+://[^/]+/([^/?#]*)", 1).alias("top"), "url")
    return rows.groupBy("host", "top").agg(F.count("*").alias("n"), F.count_if(F.contains("url", F.lit("?"))).alias("n_with_query"))


@query(
    "shared_parts",
    """
    SELECT l_partkey, count(DISTINCT l_orderkey) AS n_orders, count(*) AS n_refs FROM lineitem
    GROUP BY l_partkey HAVING count(DISTINCT l_orderkey) >= 2
    """,
)
def shared_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two or more units share. Distinct pairs are formed before the keys meet."""
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_orderkey").agg(F.count("*").alias("n"))
    return pairs.groupBy("l_partkey").agg(F.count("*").alias("n_orders"), F.sum("n").alias("n_refs")).where("n_orders >= 2")


# --- numbers, coverage, identity ---------------------------------------------------------------


@query(
    "missing_numbers",
    """
    WITH g AS (SELECT l_orderkey, list(DISTINCT l_linenumber) AS ns, max(l_linenumber) AS top, count(*) AS n FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, list_sort(list_filter(range(1, top + 1), lambda x: NOT list_contains(ns, x))) AS missing, n - len(ns) AS n_repeated FROM g
    """,
)
def missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of 1..max and repeated numbers of each order."""
    return qc.missing_numbers(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_linenumber"))


@query(
    "number_gaps",
    """
    WITH n AS (SELECT DISTINCT l_partkey, l_orderkey AS k FROM lineitem),
    g AS (SELECT l_partkey, k, lag(k, 1, 0) OVER (PARTITION BY l_partkey ORDER BY k) AS b FROM n)
    SELECT l_partkey, b + 1 AS first_missing, k - 1 AS last_missing FROM g WHERE k - b > 1
    """,
)
def number_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of order numbers between the orders of each part."""
    return qc.number_gaps(table(spark, sf_dir, "lineitem"), "l_partkey", F.col("l_orderkey"))


@query(
    "identity_conflicts",
    """
    SELECT l_suppkey AS section, l_partkey AS number, count(*) AS n, count(DISTINCT l_orderkey) AS n_owners, min(l_orderkey) AS first_owner, max(l_orderkey) AS last_owner
    FROM lineitem GROUP BY ALL HAVING count(*) > 1 AND count(*) FILTER (WHERE l_returnflag <> 'N') > 0
    """,
)
def identity_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that several units of a section claim, unless all keep theirs by declaration."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("section"), F.col("l_partkey").alias("number"), F.col("l_orderkey").alias("owner"), (F.col("l_returnflag") == "N").alias("keeps"))
    got = rows.groupBy("section", "number").agg(F.count("*").alias("n"), F.countDistinct("owner").alias("n_owners"), F.min("owner").alias("first_owner"), F.max("owner").alias("last_owner"), F.count_if(~F.col("keeps")).alias("open"))
    return got.where("n > 1 AND open > 0").drop("open")


@query(
    "renumbered_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS new_number,
           max(l_linenumber) OVER (PARTITION BY l_orderkey) AS top
    FROM lineitem
    """,
)
def renumbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in order, and the largest, within one window partitioning."""
    from pyspark.sql import Window

    whole = Window.partitionBy("l_orderkey")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.row_number().over(whole.orderBy("l_linenumber", "l_partkey")).cast("long").alias("new_number"), F.max("l_linenumber").over(whole).alias("top"))


# --- ledgers, plans, gates ----------------------------------------------------------------------


@query(
    "ledger_last_wins",
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1",
)
def ledger_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last entry of each key."""
    return ledger.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query(
    "skip_decision",
    """
    WITH l AS (SELECT user_id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) AS value FROM events GROUP BY user_id)
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'TODO' WHEN l.user_id IS NULL THEN 'NO_MANIFEST_ENTRY'
           WHEN floor(o_totalprice)::BIGINT % 2 <> 0 THEN 'SOURCE_CHANGED' WHEN l.kind IS NULL THEN 'SOURCE_UNVERIFIABLE'
           WHEN l.kind <> 'click' THEN 'SOURCE_CHANGED' ELSE 'MANIFEST_DONE' END AS reason
    FROM orders LEFT JOIN l ON l.user_id = o_custkey
    """,
)
def skip_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs against the ledger: what is done, changed, or to do."""
    last = ledger.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").join(last, F.col("o_custkey") == F.col("user_id"), "left")
    reason = ledger.skip_reason(F.col("o_orderstatus") != "P", F.col("user_id").isNotNull(), F.floor("o_totalprice").cast("long") % 2 == 0, F.col("event_type") == "click")
    return rows.select("o_orderkey", reason.alias("reason"))


@query(
    "quota_cutoff",
    """
    WITH d AS (SELECT event_id, ts::DATE::VARCHAR AS day, (event_id % 40) AS pages FROM events),
    s AS (SELECT *, coalesce(sum(pages) OVER (PARTITION BY day ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used_before FROM d)
    SELECT * FROM s WHERE used_before < 500
    """,
)
def quota_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a daily quota of pages lets through, in order of arrival."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").cast("string").alias("day"), (F.col("event_id") % 40).alias("pages"))
    return ledger.within_quota(rows, "day", ["event_id"], "pages", 500)


@query(
    "log_evidence",
    """
    WITH l AS (SELECT user_id, event_id, event_type, value,
               lead(CASE WHEN event_type = 'purchase' THEN value END, 1) OVER w AS a, lead(CASE WHEN event_type = 'purchase' THEN value END, 2) OVER w AS b
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, arg_max(coalesce(a, b), event_id) AS value, count(*) AS n_evidence FROM l
    WHERE event_type = 'click' AND coalesce(a, b) IS NOT NULL GROUP BY user_id
    """,
)
def log_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figure on one of the two lines after a start line, the latest such start."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return ledger.log_evidence(rows, "user_id", "event_id", F.col("event_type") == "click", F.col("event_type") == "purchase", "value")


@query(
    "near_events",
    """
    WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), b AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase'),
    m AS (SELECT a.event_id, a.user_id, count(b.ts) AS n_log, count(b.ts) FILTER (WHERE abs(epoch(date_trunc('second', b.ts)) - epoch(date_trunc('second', a.ts))) <= 21600) AS n_near
          FROM a LEFT JOIN b ON a.user_id = b.user_id GROUP BY ALL)
    SELECT event_id, user_id, n_log, n_near, CASE WHEN n_near > 0 THEN 'near' WHEN n_log > 0 THEN 'other_time' ELSE 'none' END AS evidence FROM m
    """,
)
def near_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval join: events with log entries of the same key within six hours."""
    e = table(spark, sf_dir, "events")
    out = ledger.near_in_time(e.where("event_type = 'click'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("user_id", "ts"), "user_id", "ts", 21600)
    return out.select("event_id", "user_id", "n_log", F.size("near_times").cast("long").alias("n_near"), "evidence")


@query(
    "plan_buckets",
    """
    WITH p AS (SELECT p_partkey, p_name AS target, p_type, p_size FROM part), c AS (SELECT *, count(*) OVER (PARTITION BY target) AS k FROM p)
    SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'read_error' WHEN p_type IS NULL OR p_size % 5 = 0 THEN 'needs_ruling'
           WHEN target IN (SELECT p_name FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_returnflag = 'R') THEN 'collision' WHEN k > 1 THEN 'conflict' ELSE 'move' END AS bucket FROM c
    """,
)
def plan_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A move plan: what may move, and what must not and why. Names of parts that came back are taken."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("target"), "p_type", "p_size")
    back = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).distinct()
    taken = p.join(back, "p_partkey", "left_semi").select("target")
    out = ledger.plan_buckets(p, "target", F.col("p_type").isNull() | (F.col("p_size") % 5 == 0), F.col("p_size") % 7 == 0, taken)
    return out.select("p_partkey", "bucket")


@query(
    "two_way_gate",
    """
    WITH a AS (SELECT o_orderkey AS k, o_custkey % 5 AS v FROM orders), b AS (SELECT l_orderkey AS k, min(l_suppkey) % 5 AS v FROM lineitem GROUP BY l_orderkey)
    SELECT coalesce(a.k, b.k) AS k, a.v AS before, b.v AS after,
           CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.v IS DISTINCT FROM b.v THEN 'moved' ELSE 'same' END AS change
    FROM a FULL JOIN b ON a.k = b.k
    """,
)
def two_way_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward and backward completeness of two tables, and their fields."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 5).alias("v"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg((F.min("l_suppkey") % 5).alias("v"))
    return ledger.changes(a, b, ["k"], "v")


# --- samples ------------------------------------------------------------------------------------


@query(
    "hash_sample",
    "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256(source || '|' || doc_id), source || '|' || doc_id) AS k FROM documents) WHERE k <= 10",
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten documents of each source by hash rank."""
    return sampling.hash_sample(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", F.concat_ws("|", "source", "doc_id"), 10)


@query(
    "even_sample",
    """
    WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS m FROM documents)
    SELECT lang, doc_id FROM r WHERE m <= 12 OR i IN (SELECT floor(k * m / 12) FROM range(12) t(k))
    """,
)
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve documents of each language, evenly spaced."""
    return sampling.even_sample(table(spark, sf_dir, "documents").select("lang", "doc_id"), "lang", ["doc_id"], 12)


@query(
    "largest_then_strata",
    """
    WITH t AS (SELECT doc_id, n_chars, lang, 'largest' AS pick FROM documents ORDER BY n_chars DESC, doc_id LIMIT 6),
    r AS (SELECT doc_id, n_chars, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id::VARCHAR) AS k FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM t))
    SELECT doc_id, n_chars, lang, pick FROM t UNION ALL SELECT doc_id, n_chars, lang, 'stratum' FROM r WHERE k <= 5
    """,
)
def largest_then_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six longest documents, then five of each language."""
    return sampling.largest_then_strata(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "n_chars", "lang", "doc_id", 6, 5)


# --- summaries ----------------------------------------------------------------------------------


@query(
    "batch_summary",
    """
    SELECT o_orderpriority AS tier, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_ok, round(sum(o_totalprice), 2) AS total,
           round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4) AS ok_rate
    FROM orders GROUP BY ROLLUP (o_orderpriority)
    """,
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By tier, and in total."""
    ok = F.count_if(F.col("o_orderstatus") == "F")
    rows = table(spark, sf_dir, "orders").rollup(F.col("o_orderpriority").alias("tier")).agg(F.count("*").alias("n"), ok.alias("n_ok"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(ok / F.count("*"), 4).alias("ok_rate"))
    return rows.select("tier", "n", "n_ok", "total", "ok_rate")


@query(
    "label_rates",
    """
    SELECT d.lang, count(*) AS n_docs, count(l.doc_id) AS n_labelled, round(count(*) FILTER (WHERE quality = 1) / nullif(count(l.doc_id), 0), 4) AS good_rate,
           round(count(*) FILTER (WHERE toxic = 1) / nullif(count(*) FILTER (WHERE quality = 0), 0), 4) AS toxic_to_bad
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.lang
    """,
)
def label_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates whose denominator may be zero: null then, not zero."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").withColumn("known", F.lit(1)), "doc_id", "left")
    return rows.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.count("known").alias("n_labelled"),
        F.round(F.try_divide(F.count_if(F.col("quality") == 1), F.count("known")), 4).alias("good_rate"),
        F.round(F.try_divide(F.count_if(F.col("toxic") == 1), F.count_if(F.col("quality") == 0)), 4).alias("toxic_to_bad"),
    )


@query("value_domain", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, min(user_id) AS first_user, count(*) FILTER (WHERE value IS NULL) AS n_null FROM events GROUP BY event_type")
def value_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which values a field has, how often, and where."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"), F.min("user_id").alias("first_user"), F.count_if(F.col("value").isNull()).alias("n_null"))


@query(
    "two_model_pivot",
    """
    WITH g AS (SELECT l_suppkey AS paper, avg(l_discount) FILTER (WHERE l_returnflag = 'A') AS a, avg(l_discount) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY l_suppkey)
    SELECT paper, round(a, 6) AS a, round(r, 6) AS r, CASE WHEN round(a, 6) < round(r, 6) THEN 'a' WHEN round(r, 6) < round(a, 6) THEN 'r' WHEN a IS NULL OR r IS NULL THEN NULL ELSE 'tie' END AS winner FROM g
    """,
)
def two_model_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models side by side, the lower figure wins."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("paper"), "l_returnflag", "l_discount")
    rows = rows.groupBy("paper").pivot("l_returnflag", ["A", "R"]).agg(F.round(F.avg("l_discount"), 6))
    a, r = F.col("A"), F.col("R")
    return rows.select("paper", a.alias("a"), r.alias("r"), F.when(a < r, "a").when(r < a, "r").when(a.isNotNull() & r.isNotNull(), "tie").alias("winner"))


@query(
    "verdict_ladder",
    r"""
    WITH i AS (SELECT doc_id, 'EMPTY' AS code, 2 AS severity FROM documents WHERE length(text) < 20
               UNION ALL SELECT doc_id, 'TABLE', 1 FROM documents WHERE text LIKE '%|%'
               UNION ALL SELECT doc_id, 'SYMBOLS', 2 FROM documents WHERE regexp_matches(text, '[%$&#]{3}'))
    SELECT d.doc_id, CASE max(severity) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'PENDING_REVIEW' ELSE 'PASS' END AS verdict, count(code) AS n_issues
    FROM documents d LEFT JOIN i ON i.doc_id = d.doc_id GROUP BY d.doc_id
    """,
)
def verdict_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules to issues to verdicts, FAIL over PENDING_REVIEW over PASS, in one scan."""
    t = F.col("text")
    rules = [("EMPTY", "FAIL", F.char_length(t) < 20), ("TABLE", "PENDING_REVIEW", t.contains("|")), ("SYMBOLS", "FAIL", t.rlike("[%$&#]{3}"))]
    return qc.verdicts(table(spark, sf_dir, "documents"), rules).select("doc_id", "verdict", F.size("issues").cast("long").alias("n_issues"))


@query(
    "issue_counts",
    r"""
    WITH i AS (SELECT doc_id, lang, CASE WHEN regexp_matches(text, '[%$&#]{3}') THEN 'SYMBOLS' WHEN text LIKE '%|%' THEN 'TABLE' WHEN regexp_matches(text, '[A-Z]{6}') THEN 'CAPS' END AS code FROM documents)
    SELECT lang, code, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM i WHERE code IS NOT NULL GROUP BY lang, code
    """,
)
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues by first matching shape."""
    t = F.col("text")
    code = text.first_match([("SYMBOLS", t.rlike("[%$&#]{3}")), ("TABLE", t.contains("|")), ("CAPS", t.rlike("[A-Z]{6}"))])
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", code.alias("code")).where("code IS NOT NULL")
    return rows.groupBy("lang", "code").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(
    "json_props",
    "SELECT event_id, json_valid(props) AS parsed, len(json_keys(props)) AS n_keys, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events",
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON field as a map; rows that do not parse stay, with nulls."""
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", m.isNotNull().alias("parsed"), F.size(F.map_keys(m)).cast("long").alias("n_keys"), F.map_values(m)[0].alias("first_value"))


@query(
    "corpus_digest",
    """
    WITH c AS (SELECT lang, doc_id // 100 AS chunk, count(*) AS n, sha256(string_agg(doc_id || chr(9) || sha256(text) || chr(10), '' ORDER BY doc_id)) AS part FROM documents GROUP BY ALL)
    SELECT lang, sum(n)::BIGINT AS n, sha256(string_agg(part, '' ORDER BY chunk)) AS digest FROM c GROUP BY lang
    """,
)
def corpus_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest of each language's ids and texts, in order, by chunks of 100 ids."""
    rows = table(spark, sf_dir, "documents").select("lang", "doc_id", F.sha2("text", 256).alias("sha"))
    line = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), "sha", F.lit("\n"))
    return ledger.digest(rows, ["lang"], line, F.col("doc_id"), F.floor(F.col("doc_id") / 100))


@query(
    "events_hourly",
    "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time windows; the same code runs on a stream, with a watermark."""
    from sheaf.streaming.ingest import windowed_counts

    return windowed_counts(table(spark, sf_dir, "events").select("ts", "event_type"))


@query(
    "priority_rollup_by_day",
    """
    SELECT o_orderdate::DATE::VARCHAR AS day, o_orderstatus AS state, count(*) AS n, grouping_id(o_orderdate::DATE::VARCHAR, o_orderstatus)::BIGINT AS level
    FROM orders GROUP BY ROLLUP (o_orderdate::DATE::VARCHAR, o_orderstatus)
    """,
)
def priority_rollup_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by day and state, by day, and in total."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("day"), F.col("o_orderstatus").alias("state"))
    return rows.rollup("day", "state").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level")).select("day", "state", "n", "level")
