"""Fingerprints, whitening and the manifest against brute-force versions: nulls, empty and very long
texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import fingerprints, manifest, registry, whitening
from sheaf.llm.shared import range_ends, range_of

SF = "/root/testdata/sf0.001"
TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "One two",
    "one TWO",
    "the quick brown fox jumps over the lazy dog " * 12,
    "É日本 wide　blank words 😀 and more of them here to fill it up",
    " ".join(f"w{i}" for i in range(400)),
    " ".join(f"w{i}" for i in range(9000)) + "\n" + " ".join(f"v{i}\n" for i in range(300)),
    "a\nb\n\nc",
]
EXTRA = "doc_id long, text string, lang string, source string, n_chars int, key string, rank long, range int, guest boolean, w string, next string, hash string, path string, block long, x string, n long"


def table(spark, texts, ids=None, sources=None):
    ids = ids if ids is not None else range(len(texts))
    sources = sources if sources is not None else ["s"] * len(texts)
    rows = [(i, t, None if i == 3 else "en", s, len(t or ""), "k", 1, 2, True, "w", "n", "h", "p", 4, "x", 5) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


def test_ranges(spark):
    ids = [5, 5, None, -3, 2**62 + 1, 2**62 + 3, 7, 7, 7, 0]
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    for n in (1, 2, 5, 40):
        ends = range_ends(df, n)
        assert ends[-1] == 2**62 + 3 and ends == sorted(set(ends)) and set(ends) <= set(ids) and len(ends) <= n + 1
        for r in df.select("i", range_of(F.col("i"), ends).alias("at")).collect():
            assert r["at"] == sum(e < r["i"] for e in ends if r["i"] is not None)
    assert range_ends(df.where("i IS NULL"), 4) == []


# --- 11 --------------------------------------------------------------------------------------


def sketch(text):
    ws = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    found = [" ".join(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))] if ws else []
    hs = sorted({hashlib.md5(s.encode()).hexdigest()[:16] for s in found})
    return hs[: max(16, sum(h < "1" for h in hs))]


def likeness(a, b):
    if not a and not b:
        return 1.0
    top = min("g" if len(s) < 16 else max("1", s[-1]) for s in (a, b))
    x, y = {h for h in a if h <= top}, {h for h in b if h <= top}
    return len(x & y) / len(x) if x else 0.0


def prints(docs):
    """Brute force; of rows that share an id the order is taken from the texts' hashes, as given."""
    out = []
    for k, (i, t, _) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1] or ""
        t = t or ""
        cut = len(t) - len(t) // 3
        edited = t[:cut] + after[: len(t) // 3]
        a, b, c = sketch(t), sketch(edited), sketch(after)
        out.append((i, len(t), edited, a, b, likeness(a, b), likeness(a, c)))
    return out


@pytest.mark.parametrize("ids", [range(10), [4, 4, 4, None, None, 0, 9, 9, 2, 7], [None] * 10])
def test_fingerprints(spark, none, ids):
    docs = table(spark, TEXTS, ids).repartition(3)
    order = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = sorted(map(tuple, order), key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    got = fingerprints.fingerprints(docs).select("doc_id", "n_chars", "edited", "sketch", "edited_sketch", "near_edited", "near_next").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, prints(order)))
    assert fingerprints.fingerprints(none).count() == 0
    assert fingerprints.fingerprints(docs.limit(1)).count() == 1


def test_sketches_merge_and_contain(spark):
    parts = [" ".join(f"{p}{i}" for i in range(n)) for p, n in (("a", 20), ("b", 3000), ("c", 90))]
    whole = f"{parts[0]} | | | | | {parts[1]} | | | | | {parts[2]}"
    df = spark.createDataFrame([(*parts, whole)], "a string, b string, c string, t string")
    df = df.select(*[fingerprints.words(F.col(c)).alias(c) for c in df.columns]).withColumns({c: fingerprints.sketch(F.col(c)) for c in df.columns})
    r = df.select("*", fingerprints.merged(fingerprints.merged(F.col("a"), F.col("b")), F.col("c")).alias("m")).first()
    union = sorted({h for p in parts for h in sketch(p)})
    assert [sketch(p) for p in parts] == [r["a"], r["b"], r["c"]]
    assert r["m"] == union[: max(16, sum(h < "1" for h in union))]
    assert likeness(r["b"], r["t"]) > 0.99 and likeness(r["t"], r["b"]) > 0.9
    # a containment of a half is estimated from about 190 hashes: four deviations are 0.15
    x, y = " ".join(f"w{i}" for i in range(6000)), " ".join(f"w{i}" for i in range(3000))
    got = fingerprints.with_likeness(spark.createDataFrame([(sketch(x), sketch(y))], "p array<string>, q array<string>"), "p", "q", "z").first()
    assert abs(got["near_z"] - 0.5) < 0.15 and abs(got["alike_z"] - 0.5) < 0.15


def test_fingerprint_query_uses_no_python_and_one_text_shuffle(spark):
    plan = registry.queries()["op11_fingerprints"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


# --- 12 --------------------------------------------------------------------------------------


def whiten(xs, top=32):
    x = np.array([[int(np.floor(float(c) * 64)) + 1000000 for c in v] for v in xs], dtype=object)
    n, s = len(x), x.sum(0)
    dev = ((n * x - s) ** 2).sum(1)
    y = (n * x - s).astype(float) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(top, int((e > e[0] * len(e) * 2e-16).sum()))
    return dev, e, y @ u[:, :k] / np.sqrt(e[:k])


def embedded(spark, vs, kind="float"):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in enumerate(vs)], f"vec_id long, embedding array<{kind}>, label int, x string, n int")


@pytest.mark.parametrize("dims", [1, 2, 7, 40])
def test_whitening(spark, dims):
    rng = np.random.default_rng(dims)
    scale = 10.0 ** -np.linspace(0, 2, dims)
    good = [list(map(float, v)) for v in (rng.normal(size=(300, dims)) * scale * 30).astype(np.float32)]
    good += [good[0]] * 150  # a vector that repeats
    bad = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] * dims, [1.0] * (dims + 1)]
    got = whitening.whitened(embedded(spark, [*good, *bad]).repartition(5)).orderBy("vec_id").collect()
    dev, e, w = whiten(good)
    assert [r["vec_id"] for r in got] == list(range(450)) and {r["n"] for r in got} == {450}
    assert [r["deviation"] for r in got] == list(dev)
    mine = np.array([r["w"] for r in got])
    assert mine.shape == w.shape and np.abs(mine * np.sign((mine * w).sum(0)) - w).max() < 1e-8
    assert np.allclose(got[0]["explained"], e[: w.shape[1]] / e.sum(), rtol=1e-10)
    assert got[0]["identity_error"] < 1e-9


def test_whitening_without_variance_or_rows(spark):
    same = whitening.whitened(embedded(spark, [[1.0, 2.0]] * 5)).collect()
    assert [(r["w"], r["deviation"], r["identity_error"]) for r in same] == [([], 0, 0.0)] * 5
    flat = whitening.whitened(embedded(spark, [[float(i), 2.0 * i, 5.0] for i in range(9)], "double")).collect()
    assert {len(r["w"]) for r in flat} == {1}
    for vs in ([], [None, []]):
        assert whitening.whitened(embedded(spark, vs)).count() == 0


def test_jacobi():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 33):
        b = rng.normal(size=(d, d))
        a = b @ b.T
        e, v = whitening.jacobi(a)
        assert np.abs(a @ v - v * e).max() < 1e-11 * e[0] and np.abs(v.T @ v - np.eye(d)).max() < 1e-13 and (np.diff(e) <= 0).all()
    # small eigenvalues of a graded matrix are right to all digits, where a tridiagonal solver loses them
    s = 10.0 ** -np.arange(0, 12, 2)
    base = np.full((6, 6), 0.1) + 0.9 * np.eye(6)
    e, _ = whitening.jacobi(s[:, None] * base * s)
    exact = [1.0 / x for x in whitening.jacobi(np.linalg.inv(base) / (s[:, None] * s))[0][::-1]]
    assert np.allclose(e, exact, rtol=1e-12)
    for d in range(1, 9):
        pairs = [(p, q) for ps, qs in whitening.rounds(d) for p, q in zip(ps, qs, strict=True)]
        assert len(pairs) == len(set(pairs)) == d * (d - 1) // 2
        assert all(len({*ps, *qs}) == 2 * len(ps) for ps, qs in whitening.rounds(d))


# --- 13 --------------------------------------------------------------------------------------


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def levels(hs):
    out = [hs]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def beside(ls, k):
    out = []
    for nodes in ls[:-1]:
        g = k // 3 * 3
        out.append(("".join(nodes[g:k]), "".join(nodes[k + 1 : g + 3])))
        k //= 3
    return out


def proofs(rows, claim):
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))):
        by[r["source"]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([leaf(r, r["text"]) for r in by[s]]) for s in names]
    over = levels([t[-1][0] for t in trees])
    out = []
    for j, s in enumerate(names):
        for k, r in enumerate(by[s]):
            path = beside(trees[j], k) + beside(over, j)
            h = leaf(r, claim(r))
            for x, y in path:
                h = H(x + h + y)
            out.append((r["doc_id"], leaf(r, r["text"]), trees[j][-1][0], over[-1][0], H("".join(x + y for x, y in path)), h, h == over[-1][0]))
    return sorted(map(repr, out))


def claim(r):
    return r["text"].replace("\n", "") if r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 else r["text"]


def claimed():
    return F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def check(docs):
    out = manifest.verified(docs, claimed())
    got = out.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root", "verified").collect()
    assert sorted(map(repr, map(tuple, got))) == proofs(docs.collect(), claim)
    return got


def test_manifest(spark, none):
    n = len(TEXTS)
    check(table(spark, TEXTS, range(n), [None, "", "a", "a", "É", "b", "b", "b", "b", None]).repartition(3))
    check(table(spark, TEXTS + TEXTS, [1, 1, None, None, *range(4, n)] * 2, ["s"] * n + [None, "t"] * (n // 2)))
    assert {r["verified"] for r in check(table(spark, ["one"]))} == {True}
    assert manifest.verified(none, claimed()).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 9, 10, 81, 82, 300])
def test_manifest_sizes(spark, n):
    got = check(table(spark, [f"text\nof {i}" for i in range(n)], range(n), ["hot" if i % 7 else f"s{i}" for i in range(n)]))
    assert n < 5 or any(not r["verified"] for r in got)


def test_manifest_many_sources(spark):
    check(table(spark, ["x\ny"] * 100, range(100), [f"s{i}" for i in range(100)]))


def test_manifest_shuffles_no_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = manifest.verified(docs, claimed())._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan


# --- queries ---------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_fingerprints", "op13_manifest"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.execute(registry.oracles()[name]).df()[got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(x.item() if hasattr(x, "item") else x for x in r)) for r in want.itertuples(index=False))


def test_op12_query(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    dev, values, w = whiten([r["embedding"] for r in e])
    got = whitening.op12_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"]) for r in got] == [(r["vec_id"], k + 1) for r in e for k in range(w.shape[1])]
    mine = np.array([r["whitened"] for r in got]).reshape(w.shape)
    assert np.abs(mine * np.sign((mine * w).sum(0)) - w).max() < 1e-8
    assert [r["deviation"] for r in got[:: w.shape[1]]] == list(dev)
    assert np.allclose([r["explained"] for r in got[: w.shape[1]]], values[: w.shape[1]] / values.sum(), rtol=1e-9)
    assert {r["identity_error"] < 1e-9 for r in got} == {True}
