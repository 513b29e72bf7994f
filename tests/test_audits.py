"""Claims against facts, and guarded appends, against loops and after interruptions."""

import hashlib
import itertools
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sheaf.operators import guarded as G
from sheaf.operators import recompute as R


def test_long_form_and_comparison(spark):
    claims = spark.createDataFrame(
        [("a", 1, 10.0, "x", True), ("b", 2, 10.004, "y", None), ("c", 3, None, "z", False), ("d", 4, float("nan"), None, None), ("r", 1, 1.0, "q", None), ("r", 2, 1.0, "q", None), (None, 7, None, None, None)],
        "k string, n int, v double, t string, f boolean",
    )
    facts = spark.createDataFrame(
        [("a", 1, 10.0, "x", False), ("b", 2, 10.0, "Y", None), ("c", 4, 1.0, "z", False), ("d", 4, float("nan"), "new", None), ("r", 1, 1.0, "q", None), ("e", 9, None, None, None), (None, 7, None, None, None)],
        "k string, n long, v double, t string, f boolean",
    )
    fields = lambda df: {c: F.col(c) for c in df.columns[1:]}
    out = R.compared(R.long_form(claims, ["k"], fields(claims)), R.long_form(facts, ["k"], fields(facts)), ["k"], {"v": 0.01})
    got = {(r["k"], r["field"]): r["status"] for r in out.collect()}
    assert got == {
        ("a", "n"): "match", ("a", "v"): "match", ("a", "t"): "match", ("a", "f"): "differ",
        ("b", "n"): "match", ("b", "v"): "match", ("b", "t"): "differ",
        ("c", "n"): "differ", ("c", "v"): "fact_only", ("c", "t"): "match", ("c", "f"): "match",
        ("d", "n"): "match", ("d", "v"): "match", ("d", "t"): "fact_only",
        ("e", "n"): "fact_only", (None, "n"): "match",
        ("r", "n"): "disputed", ("r", "v"): "match", ("r", "t"): "match",
    }
    told = {r["field"]: (r["n"], r["n_match"], r["n_fact_only"], r["verdict"]) for r in R.report(out).collect()}
    assert told == {"n": (7, 4, 1, "FAIL"), "v": (5, 4, 1, "PENDING_REVIEW"), "t": (5, 3, 1, "FAIL"), "f": (2, 1, 0, "FAIL")}
    shown = {(r["k"], r["field"]): (r["claimed"], r["found"]) for r in out.collect()}
    assert shown["r", "n"] == ("1 | 2", "1") and shown["e", "n"] == (None, "9")


def test_numbers_of_other_kinds_and_large_ones(spark):
    a = spark.createDataFrame([(1, 2**60 + 1, "5")], "k int, big long, t string")
    b = spark.createDataFrame([(1, 2**60 + 2, 5)], "k int, big long, t int")
    fields = lambda df: {c: F.col(c) for c in ("big", "t")}
    got = {r["field"]: r["status"] for r in R.compared(R.long_form(a, ["k"], fields(a)), R.long_form(b, ["k"], fields(b)), ["k"]).collect()}
    assert got == {"t": "differ", "big": "differ"}
    got = R.compared(R.long_form(a, ["k"], {"big": F.col("big")}), R.long_form(b, ["k"], {"big": F.col("big")}), ["k"], {"big": 1}).first()
    assert got["status"] == "match"


def rows(spark, n, start=0):
    return spark.createDataFrame([(i, f"v{i}" if i % 3 else None, [i, i + 1]) for i in range(start, start + n)], "k long, v string, xs array<long>")


def test_digests_add_up_and_know_every_change(spark):
    df = rows(spark, 50)
    whole = G.digest_of(df)
    assert whole == G.digest_of(df.repartition(7).orderBy(F.desc("k"))) == G.digest_of(df.select("xs", "v", "k"))
    assert whole == G.digest_of(df.where("k < 20")) + G.digest_of(df.where("k >= 20"))
    assert G.digest_of(df.limit(0)) == G.Digest(0, (0,) * G.LANES)
    others = [df.where("k <> 7"), df.union(df.where("k = 7")), df.withColumn("v", F.when(F.col("k") == 7, "w").otherwise(F.col("v"))), df.withColumn("v", F.coalesce("v", F.lit(""))), df.withColumn("xs", F.when(F.col("k") == 1, F.array(F.lit(2).cast("long"), F.lit(1).cast("long"))).otherwise(F.col("xs")))]
    assert all(G.digest_of(o) != whole for o in others)
    r = spark.createDataFrame([("a",), ("a",), ("b",)], "x string").groupBy("x").agg(F.count("*").alias("n"))
    by = G.digests(spark.createDataFrame([("a",), ("a",), ("b",)], "x string"), F.col("x"), ["x"]).collect()
    for d in by:
        n = {x["x"]: x["n"] for x in r.collect()}[d["x"]]
        h = hashlib.sha256(d["x"].encode()).hexdigest()
        assert d["digest"] == f"{n}:" + "".join(f"{n * int(h[15 * i : 15 * i + 15], 16) % 2**60:015x}" for i in range(4))


def test_guarded_append(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    first, second = rows(spark, 5), rows(spark, 4, 10)
    seen = G.preview(G.base_of(path, first), first)
    assert G.append(path, first, seen).count() == 5
    later = G.preview(G.base_of(path, second), second)
    # a changed plan, and a plan with one row less, are refused, and nothing is written
    for other in (second.withColumn("v", F.lit("!")), second.limit(3)):
        with pytest.raises(G.Refused, match="plan"):
            G.append(path, other, later)
    assert G.base_of(path, first).count() == 5
    # the base moved on after the preview
    extra = rows(spark, 1, 99)
    G.append(path, extra, G.preview(G.base_of(path, extra), extra))
    with pytest.raises(G.Refused, match="base"):
        G.append(path, second, later)
    again = G.preview(G.base_of(path, second), second)
    assert G.append(path, second.repartition(3), again).count() == 10
    # the same append once more adds nothing
    assert G.append(path, second, again).count() == 10


def test_append_after_a_loss(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    plan = rows(spark, 6).repartition(2)
    seen = G.preview(G.base_of(path, plan), plan)
    G.append(path, plan, seen)
    (folder,) = Path(f"{tmp_path}/ledger").iterdir()
    # the driver died before the commit: some files, no mark
    for victim in itertools.chain(folder.glob("_SUCCESS"), list(folder.glob("part-*"))[:1]):
        victim.unlink()
    assert G.base_of(path, plan).count() == 0
    assert G.append(path, plan, seen).count() == 6
    # a committed folder that lost a file is told
    next(folder.glob("part-*")).unlink()
    with pytest.raises(G.Refused, match="sum"):
        G.append(path, plan, seen)


def test_preview_can_be_kept_as_text(spark):
    seen = G.preview(rows(spark, 2).limit(0), rows(spark, 2))
    kept = json.loads(json.dumps({"base": seen.base.text(), "plan": seen.plan.text()}))
    assert kept["plan"].startswith("2:") and len(kept["plan"]) == 2 + 60
