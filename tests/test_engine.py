"""Queries against their SQL twins, line splitting, samples, the ledgered stream."""

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from sheaf.functions import text as T
from sheaf.operators import ledger, sampling, spans
from sheaf.plans import catalog, exam_queries, library  # noqa: F401
from sheaf.streaming import ingest

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(_norm(x) for x in v) if isinstance(v, list | tuple) else v


@pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    con.execute(catalog.oracles()[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == cols
    want = [tuple(_norm(r[names.index(c)]) for c in cols) for r in con.fetchall()]
    got = [tuple(_norm(x) for x in r) for r in df.select(*cols).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_lines_split_as_python_does(spark):
    texts = ["a\nb", "a\n", "", "\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k", "a\n\nb\n\n", "　x　\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["l"], r["s"]) for r in rows.select("i", T.split_lines(F.col("t")).alias("l"), T.strip(F.col("t")).alias("s")).collect()}
    assert got == {i: (t.splitlines(), t.strip()) for i, t in enumerate(texts)}


def test_refs_paths_and_redaction(spark):
    t = spark.createDataFrame([('![a](x/y.png) <img src="../z.png"> ![b](http://h/i.png)',)], "t string").select(T.image_refs(F.col("t")).alias("r"))
    got = [(r["r"], r["k"], r["s"]) for r in t.select(F.explode("r").alias("r")).select("r", T.ref_kind(F.col("r")).alias("k"), T.safe_path(F.col("r")).alias("s")).collect()]
    assert got == [("../z.png", "local", False), ("x/y.png", "local", True), ("http://h/i.png", "remote", True)]
    assert spark.sql("SELECT 'key sk-abcdefgh12345 end' AS t").select(T.redact(F.col("t"))).first()[0] == "key sk-*** end"


def test_range_join_is_a_hash_join(spark):
    lines = spans.lines_of(spark.createDataFrame([("d", "a\nb\nc")], "doc_id string, text string"))
    s = spark.createDataFrame([("d", 1, 2)], "doc_id string, start int, end int")
    plan = spans.span_lines(lines, s)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert [r["line"] for r in spans.uncovered(lines, s).collect()] == ["c"]


def test_even_sample_places(spark):
    rows = spark.createDataFrame([("g", i) for i in range(100)], "g string, i int")
    for n in (1, 3, 7, 99, 100, 150):
        got = sorted(r["i"] for r in sampling.even_sample(rows, "g", ["i"], n).collect())
        assert got == ([i * 100 // n for i in range(n)] if n <= 100 else list(range(100)))


def test_last_wins_and_quota(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, at int, v string")
    assert {(r["k"], r["v"]) for r in ledger.last_wins(rows, "k", "at").collect()} == {("a", None), ("b", "y")}
    days = spark.createDataFrame([("d", i, 4) for i in range(5)], "day string, i int, pages int")
    assert sorted(r["i"] for r in ledger.within_quota(days, "day", ["i"], "pages", 10).collect()) == [0, 1, 2]


def test_stream_does_each_file_once_within_the_quota(spark, tmp_path):
    src, led, out = tmp_path / "in", str(tmp_path / "ledger"), str(tmp_path / "out")
    schema = "source_rel string, sha256 string, pages int"

    def arrive(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))

    def run(day, quota=10):
        stream = spark.readStream.schema(schema).parquet(str(src))
        q = ingest.start(stream, led, lambda d: d.select("source_rel", "sha256"), out, str(tmp_path / f"cp"), lambda: day, quota)
        q.awaitTermination()

    arrive("1", [("a", "1", 4), ("b", "1", 4), ("c", "1", 4), ("d", "1", 4)])
    run("2024-01-01")
    done = lambda: sorted((r["source_rel"], r["sha256"]) for r in spark.read.parquet(out).collect())
    assert done() == [("a", "1"), ("b", "1"), ("c", "1")]
    arrive("2", [("a", "1", 4), ("a", "2", 4)])
    run("2024-01-01")  # the quota is used up: all of it waits, d too
    assert done() == [("a", "1"), ("b", "1"), ("c", "1")]
    run("2024-01-02", 5)  # nothing new arrives, and d was read long ago; one file goes over the quota
    assert done() == [("a", "1"), ("a", "2"), ("b", "1"), ("c", "1"), ("d", "1")]
    run("2024-01-03")
    assert len(done()) == 5


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    led, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    schema = "source_rel string, sha256 string, pages int"
    do = lambda rows, i, quota=10: ingest.work_off(spark, spark.createDataFrame(rows, schema), f"{i:012d}", led, lambda d: d, out, "d", quota)
    first = [(x, "1", 4) for x in "abcd"]
    do(first, 0)
    tables = lambda: [sorted(map(str, spark.read.parquet(p).collect())) for p in (out, led, f"{led}_backlog")]
    one = tables()
    do(first, 0)
    assert tables() == one
    do([("e", "1", 1)], 1, 100)
    two = tables()
    do([("e", "1", 1)], 1, 100)
    assert tables() == two and len(two[0]) == 5
    assert len({str(r) for r in spark.read.parquet(out).select("source_rel", "sha256").collect()}) == 5


def test_entry_imports_without_the_optional_parts(tmp_path):
    import shutil
    import subprocess

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "sheaf", tmp_path / "sheaf", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'line_profile' in e.queries() and 'pipeline' not in e.queries(); e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0


def test_missing_numbers_of_each_key(spark):
    from sheaf.operators import qc

    rows = spark.createDataFrame([(1, 5), (1, 2), (1, 2), (2, None), (3, 1), (3, -4), (4, 3), (5, 0)], "k long, n int")
    got = {r["k"]: (r["missing"], r["n_repeated"]) for r in qc.missing_numbers(rows, "k", F.col("n")).collect()}
    assert got == {1: ([1, 3, 4], 1), 2: ([], 0), 3: ([], 0), 4: ([1, 2], 0), 5: ([], 0)}
    assert catalog.queries()["missing_numbers"](spark, "/root/testdata/sf0.001").columns == ["l_orderkey", "missing", "n_repeated"]
