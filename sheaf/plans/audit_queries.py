"""Queries of recomputed claims and order-free digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators import guarded, recompute
from sheaf.plans.catalog import query
from sheaf.sources.tables import table

#: What orders claim, and what their lines say: money may be a hundredth off.
_CLAIMS = """
WITH f AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice * 100 AS DECIMAL(18, 0))) AS cents, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS s, min(l_shipdate) AS d FROM lineitem GROUP BY 1),
j AS (SELECT coalesce(o_orderkey, k) AS k, CAST(o_totalprice * 100 AS DECIMAL(18, 0)) AS c1, cents AS f1, o_orderstatus AS c2, s AS f2, o_orderdate IS NOT NULL AS c3, d >= o_orderdate AS f3, o_orderkey, f.k AS fk, o_orderdate, d FROM orders FULL JOIN f ON f.k = o_orderkey),
l AS (SELECT k, 'cents' AS field, c1::VARCHAR AS c, f1::VARCHAR AS f, abs(c1 - f1) <= 100000 AS same FROM j UNION ALL SELECT k, 'status', c2, f2, c2 = f2 FROM j
  UNION ALL SELECT k, 'ships_later', CASE WHEN o_orderdate IS NOT NULL THEN 'true' END, (d >= o_orderdate)::VARCHAR, (d >= o_orderdate) FROM j),
t AS (SELECT k AS o_orderkey, field, CASE WHEN f IS NULL THEN 'claim_only' WHEN c IS NULL THEN 'fact_only' WHEN same THEN 'match' ELSE 'differ' END AS status FROM l WHERE c IS NOT NULL OR f IS NOT NULL)
"""


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    cents = lambda c: (F.col(c) * 100).cast("decimal(18,0)")
    claims = recompute.long_form(orders, ["o_orderkey"], {"cents": cents("o_totalprice"), "status": F.col("o_orderstatus"), "ships_later": F.when(F.col("o_orderdate").isNotNull(), F.lit(True))})
    status = F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.min("l_linestatus")).otherwise("P")
    found = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(cents("l_extendedprice")).alias("cents"), status.alias("status"), F.min("l_shipdate").alias("first"))
    found = found.join(orders.select("o_orderkey", "o_orderdate"), "o_orderkey", "left")
    facts = recompute.long_form(found, ["o_orderkey"], {"cents": F.col("cents"), "status": F.col("status"), "ships_later": F.col("first") >= F.col("o_orderdate")})
    return recompute.compared(claims, facts, ["o_orderkey"], {"cents": 100_000})


@query("claim_audit", _CLAIMS + "SELECT * FROM t")
def claim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's claims against its lines: price (to a thousand), status, and that it ships later."""
    return _compared(spark, sf_dir).select("o_orderkey", "field", "status")


@query(
    "claim_report",
    _CLAIMS
    + """SELECT field, count(*) AS n, count(*) FILTER (WHERE status = 'match') AS n_match, count(*) FILTER (WHERE status = 'differ') AS n_differ, count(*) FILTER (WHERE status = 'claim_only') AS n_claim_only,
    count(*) FILTER (WHERE status = 'fact_only') AS n_fact_only, 0::BIGINT AS n_disputed, CASE WHEN count(*) FILTER (WHERE status = 'differ') > 0 THEN 'FAIL' WHEN count(*) FILTER (WHERE status = 'match') = count(*) THEN 'PASS' ELSE 'PENDING_REVIEW' END AS verdict
    FROM t GROUP BY field""",
)
def claim_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompute.report(_compared(spark, sf_dir))


@query(
    "multiset_digests",
    """
    WITH h AS (SELECT source, sha256(doc_id || ':' || coalesce(lang, '-') || ':' || coalesce(text, '-')) AS h FROM documents),
    l AS (SELECT source, count(*) AS n, """
    + ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::BIGINT) % 1152921504606846976 AS s{i}" for i in range(4))
    + """ FROM h GROUP BY source)
    SELECT source, n, n || ':' || """
    + " || ".join(f"lpad(lower(to_hex(s{i}::BIGINT)), 15, '0')" for i in range(4))
    + """ AS digest FROM l""",
)
def multiset_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's documents in any order, as one digest."""
    text = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.coalesce("lang", F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("-")))
    out = guarded.digests(table(spark, sf_dir, "documents"), text, ["source"])
    return out.select("source", "n", F.lower("digest").alias("digest"))
