"""Fix chains, versions with recovery, moves, migrations, contained batches and ledger compaction."""

import json

import pytest
from pyspark.sql import functions as F

from sheaf.operators import chain, exam, isolation, versions
from sheaf.operators.guarded import Refused, digest_of
from sheaf.streaming import ingest

SQUEEZE = {"twice": lambda r: r.withColumn("t", F.regexp_replace("t", "xx", "x")), "end": lambda r: r.withColumn("t", F.rtrim("t"))}


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t string")


def test_a_chain_runs_until_nothing_changes(spark):
    rows = texts(spark, "xxxxxxxx", "ab ", "ab", None, "", "xx ")
    got = {r["id"]: (r["t"], r["rounds"], r["steps"], r["settled"]) for r in chain.fixpoint(rows, SQUEEZE).collect()}
    assert got[0] == ("x", 4, ["twice"], True)  # 8, 4, 2, 1, and a pass that changes nothing
    assert got[1] == ("ab", 2, ["end"], True) and got[2] == ("ab", 1, [], True)
    assert got[3] == (None, 1, [], True) and got[4] == ("", 1, [], True)
    assert got[5] == ("x", 2, ["twice", "end"], True)


def test_a_second_run_touches_no_row(spark):
    rows = texts(spark, "xxxx", "b", None, "b ", "c")
    seen = spark.createDataFrame([], "digest string")
    fixed = chain.fixpoint(chain.unsettled(rows, seen), SQUEEZE)
    seen = seen.unionByName(chain.settled_digests(fixed))
    after = fixed.select("id", "t")
    assert chain.unsettled(after, seen).count() == 0
    one = after.withColumn("t", F.when(F.col("id") == 4, "cxx").otherwise(F.col("t")))
    assert [r["id"] for r in chain.unsettled(one, seen).collect()] == [4]


def test_fixers_that_undo_each_other_are_told(spark):
    flip = {"flip": lambda r: r.withColumn("t", F.translate("t", "ab", "ba"))}
    got = {r["id"]: (r["rounds"], r["settled"]) for r in chain.fixpoint(texts(spark, "a", "c"), flip, most=3).collect()}
    assert got == {0: (3, False), 1: (1, True)}


def test_chain_of_repeats_empty_tables_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, "xx", "mine")] * 3, "id int, t string, steps string")
    got = chain.fixpoint(rows, SQUEEZE).collect()
    assert len(got) == 3 and {tuple(r["steps"]) for r in got} == {("twice",)}
    assert chain.fixpoint(texts(spark, "a").limit(0), SQUEEZE).count() == 0


# --- versions ------------------------------------------------------------------------------------


def store_of(spark, tmp_path, clock=None):
    return versions.Versions(spark, f"file://{tmp_path}/s", (lambda: clock[0]) if clock else __import__("time").time)


def values(df):
    return sorted(r["t"] for r in df.collect())


def test_a_crash_after_any_step_ends_or_undoes(spark, tmp_path):
    clock = [0.0]
    new = texts(spark, "new")
    for stop, want in (("lease", "old"), ("intent", "old"), ("half", "old"), ("wrong", "old"), ("stage", "new"), ("end", "new")):
        store = store_of(spark, tmp_path / stop, clock)
        lease = store.acquire("a", 10)
        store.put(lease, texts(spark, "old"))
        if stop != "lease":
            n = store.intend(lease, new)
        if stop == "half":
            store.stage(n, new)
            store.files.delete(f"v/{n:012d}/_SUCCESS")
        elif stop == "wrong":
            store.stage(n, texts(spark, "other"))
        elif stop in ("stage", "end"):
            store.stage(n, new)
        if stop == "end":
            store.end(lease, n)
        assert values(store.read()) == ["new" if stop == "end" else "old"]
        clock[0] += 100  # the writer is dead, its lease is over
        again = store_of(spark, tmp_path / stop, clock)
        other = again.acquire("b", 10)
        assert values(again.read()) == [want], stop
        assert again.recover(other) == {}
        again.put(other, texts(spark, "next"))
        assert values(again.read()) == ["next"]


def test_of_two_writers_one_wins(spark, tmp_path):
    clock = [0.0]
    store = store_of(spark, tmp_path, clock)
    first = store.acquire("a", 10)
    with pytest.raises(versions.Fenced):
        store.acquire("b", 10)
    n = store.intend(first, texts(spark, "slow"))
    clock[0] = 11
    second = store.acquire("b", 10)  # undoes what a announced
    assert second.number == 2 and store.ends() == {n: "undone"}
    store.stage(n, texts(spark, "slow"))  # a wakes up
    with pytest.raises(versions.Fenced):
        store.end(first, n)
    store.put(second, texts(spark, "b"))
    assert values(store.read()) == ["b"]
    store.recover(second)
    assert not store.files.exists(f"v/{n:012d}")  # what a wrote late is cleaned
    store.release(second)
    assert store.acquire("c", 10).number == 3


def test_an_end_is_written_once(spark, tmp_path):
    store = store_of(spark, tmp_path)
    lease = store.acquire("a")
    n = store.put(lease, texts(spark, "a"))
    with pytest.raises(versions.Fenced):
        store.end(lease, n)
    assert not store.files.create(f"journal/{n:012d}.end", "undone") and store.ends() == {n: "done"}


def test_roll_back_is_a_new_version(spark, tmp_path):
    store = store_of(spark, tmp_path)
    lease = store.acquire("a")
    assert store.read() is None
    one = store.put(lease, texts(spark, "one"))
    store.put(lease, texts(spark, "two"))
    store.roll_back(lease, one)
    assert values(store.read()) == ["one"] and values(store.read(2)) == ["two"]
    with pytest.raises(Refused):
        store.roll_back(lease, 99)


def test_moves_go_as_a_whole_or_not_at_all(spark, tmp_path):
    tree = spark.createDataFrame([("a", None, 0), ("a/1", "s1", 1), ("a/2", "s2", 2), ("b", None, 3)], "path string, sha256 string, size int")
    store = store_of(spark, tmp_path)
    lease = store.acquire("a")
    plan = lambda *rows: spark.createDataFrame(list(rows), "from_rel string, to_rel string, sha256 string")
    with pytest.raises(Refused, match="no tree"):
        versions.apply_moves(store, lease, plan(("a/1", "b/1", "s1")), digest_of(plan(("a/1", "b/1", "s1"))))
    store.put(lease, tree)
    for bad in (
        [("a/1", "b/1", "s1"), ("a/2", "b/1", "s2")],
        [("a/1", "b/1", "s1"), ("a/1", "b/2", "s1")],
        [("a/1", "b/1", "drift")],
        [("a/9", "b/1", "s1")],
        [("a/1", "a/2", "s1")],
        [("a/1", "../x", "s1"), ("a/2", "b/2", "s2")],
    ):
        with pytest.raises(Refused, match="refused"):
            versions.apply_moves(store, lease, plan(*bad), digest_of(plan(*bad)))
    good = plan(("a/1", "b/1", "s1"), ("a/2", "b/2", "s2"))
    with pytest.raises(Refused, match="approved"):
        versions.apply_moves(store, lease, good, digest_of(plan(("a/1", "b/1", "s1"))))
    assert store.current() == 1
    versions.apply_moves(store, lease, good, digest_of(good))
    assert sorted((r["path"], r["size"]) for r in store.read().collect()) == [("a", 0), ("b", 3), ("b/1", 1), ("b/2", 2)]


def test_reasons_of_refused_moves(spark):
    tree = spark.createDataFrame([("a/1", "s"), ("a/2", "s"), ("a/3", "s"), ("a/3", "s")], "path string, sha256 string")
    moves = spark.createDataFrame([("a/1", "b/1", "s"), ("a/2", "b/1", "s"), ("a/3", "b/3", "s"), ("a/4", None, "s")], "from_rel string, to_rel string, sha256 string")
    got = {r["from_rel"]: (r["gate"], r["detail"]) for r in versions.refused_moves(moves, tree).collect()}
    assert got == {"a/1": ("BATCH", "target_twice"), "a/2": ("BATCH", "target_twice"), "a/3": ("BATCH", "path_twice"), "a/4": ("PATH", "not_plain")}


def test_a_migration_puts_single_rows_back(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1), (3, None, 1)], "id int, t string, v int")
    up = lambda r: r.withColumns({"v": F.lit(2), "t": F.when(F.col("id") == 2, "changed").otherwise(F.col("t"))})
    got = sorted(((r["id"], r["t"], r["v"], r["violations"], r["upgraded"]) for r in versions.migrated(rows, up, ["t"], {"HAS_TEXT": lambda r: F.col("t") != ""}).collect()), key=str)
    assert got == [(1, "a", 2, [], True), (2, "b", 1, ["FACT:t"], False), (3, None, 1, ["HAS_TEXT"], False), (3, None, 1, ["HAS_TEXT"], False)]
    assert versions.migrated(rows.limit(0), up, ["t"], {}).count() == 0


# --- contained batches ---------------------------------------------------------------------------

UNIT = {"unit_id": "Q1", "unit_type": "standalone_question", "question_numbers": [1], "printed_number": ["1"], "stem": {"start": 2, "end": 2}, "answer": {"start": 3, "end": 3}}


def batch(spark, *manifests):
    (a, b), (c, d) = exam.ZONES["stem"], exam.ZONES["answer"]
    shown = f"{a}\n1. x\n{b}{c}\n1. A\n{d}"
    rows = [(str(i), "# t\n1. x\n1. A", shown, "p.md", 1, m) for i, m in enumerate(manifests)]
    df = spark.createDataFrame(rows, "doc_id string, text string, rendered string, source_file string, identity_version int, manifest string")
    return exam.annotated(isolation.parsed_units(df.withColumn("annotated", F.lit(None).cast("string")), "manifest"))


def test_one_bad_paper_among_a_thousand(spark):
    good = json.dumps([UNIT])
    wide = json.dumps([UNIT | {"stem": {"start": 1, "end": 2_000_000_000}}])
    df = batch(spark, *[wide if i == 500 else good for i in range(1000)])
    got = {r["doc_id"]: r for r in isolation.judged(df).collect()}
    assert len(got) == 1000 and {k for k, r in got.items() if r["verdict"] != "PASS"} == {"500"}
    assert [tuple(i) for i in got["500"]["issues"]] == [("QC_CONTAINED", "FAIL", "a span is too wide")]
    assert len(got["500"]["units"]) == 1  # it comes back as it was


def test_what_is_contained_and_why(spark):
    unit = lambda **c: json.dumps([UNIT | c])
    cases = {
        unit(): None, None: "units are missing", "": "units are missing", "[{": "units are missing", "{}": "units are missing", unit(question_numbers=["x"]): "units are missing",
        unit(question_numbers=[1 << 40]): "units are missing", json.dumps([UNIT])[:-4]: "units are missing", "[null]": "a unit is null",
        unit(stem={"start": 2, "end": None}): "a span has one end", unit(question_numbers=[1, None]): "a number is null", unit(question_numbers=[2_000_000_000]): "a number is too large",
        unit(answer={"start": -2_000_000_000, "end": 3}): "a span is too wide",
    }
    rows = {r["doc_id"]: r for r in isolation.judged(batch(spark, *cases)).collect()}
    for i, (manifest, error) in enumerate(cases.items()):
        found = [x["detail"] for x in rows[str(i)]["issues"] if x["code"] == isolation.CONTAINED]
        assert found == ([error] if error else []), manifest
        assert error is None or rows[str(i)]["verdict"] == "FAIL"
    assert isolation.judged(batch(spark, "[]").limit(0)).count() == 0


# --- the ledger ----------------------------------------------------------------------------------


def test_a_compacted_ledger_reads_the_same_and_less(spark, tmp_path):
    led, out = f"file://{tmp_path}/led", f"file://{tmp_path}/out"
    schema = "source_rel string, sha256 string, pages int"
    do = lambda rows, i: ingest.work_off(spark, spark.createDataFrame(rows, schema), f"{i:012d}", led, lambda d: d, out, f"d{i}", 10)
    for i in range(5):
        do([("same", f"s{i}", 1), (f"f{i}", "s", 2)], i)
    show = lambda before=None: sorted(map(tuple, ingest.read_ledger(spark, led, before).select("source_rel", "sha256", "pages", "day", "batch_id").collect()))
    whole, last = show(), show(f"{4:012d}")
    assert ingest.compact(spark, led) == f"{3:012d}"
    assert show() == whole and show(f"{4:012d}") == last
    assert ingest._batches(spark, led) == [f"{4:012d}"] and ingest.compact(spark, led) == f"{3:012d}"
    do([("same", "s4", 1), ("f4", "s", 2)], 4)  # the last batch runs again and finds what it found
    assert show() == whole
    do([("f0", "s", 2), ("f9", "s", 2)], 5)  # f0 was done before the compaction
    assert [r["source_rel"] for r in spark.read.parquet(f"{out}/batch_id={5:012d}").collect()] == ["f9"]
    assert ingest.compact(spark, led) == f"{4:012d}" and ingest._compactions(spark, led) == [f"{4:012d}"] and len(show()) == 7
