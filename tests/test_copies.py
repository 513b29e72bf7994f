"""Near copies inside documents against loops over all pairs."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from sheaf.operators import copies as C
from sheaf.operators import exam as E
from tests.test_exam import frame, paper, span, unit


def form(t):
    t = re.sub(r"\s+", "", t)
    for a, b in (C.SAME | C.SMALL).items():
        t = t.replace(a, b)
    t = t.replace(C.GONE, "")
    for w in C.WRAPPED:
        t = re.sub(w, r"\1", t)
    return re.sub(C.MARKUP, "", re.sub(C.SPACING, "", t))


def cover(a, b):
    if not a or not b:
        return 0.0
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks()) / min(len(a), len(b))


def copied(p):
    """All pairs, without any bound."""
    lines = p["text"].split("\n")
    units = [u | {r: u[r] and (u[r]["start"], u[r]["end"]) for r in E.ROLES} for u in p["units"]]
    asked, taken = [], set()
    for i, u in enumerate(units):
        for r in C.QUESTION:
            if u[r]:
                taken |= set(range(u[r][0], u[r][1] + 1))
                asked += [(i, lines[k - 1]) for k in range(u[r][0], u[r][1] + 1) if k <= len(lines)]
    out = []
    for i, u in enumerate(units):
        own = sorted({u[r] for r in C.ANSWER if u[r]})
        if not own:
            continue
        first = own[0][0]
        start = max([k for k in taken if k < first], default=0) + 1
        numbers = {str(n) for n in u["question_numbers"] or []}
        found = [k for k in range(start, first) if (m := re.match(r"^\s*(\d{1,3})\s*[.．、]", lines[k - 1])) and m[1] in numbers]
        window = set(range(found[0], first)) if found else set()
        for (_, e), (s, _) in zip(own, own[1:]):
            if not set(range(e + 1, s)) & taken:
                window |= set(range(e + 1, s))
        for k in sorted(window):
            x = lines[k - 1]
            if x.lstrip().startswith("<") or len(form(x)) < C.LEAST:
                continue
            best, at = 0.0, None
            for j, y in asked:
                c = 0.0 if y.lstrip().startswith("<") else cover(form(x), form(y))
                if c > best:
                    best, at = c, j
            if C.LOW <= best <= C.HIGH and at == i:
                out.append((i, k, x, best))
    return sorted(out)


def made(seed):
    """A paper whose answers are preceded by its questions' lines, changed more or less."""
    r = random.Random(seed)
    text = lambda: "".join(r.choice("甲乙丙丁abc，x²  $") for _ in range(r.randint(8, 40)))
    n = r.randint(1, 5)
    asked = [f"{k + 1}. {text()}" for k in range(n)]
    if r.random() < 0.3:
        asked[-1] = asked[0]
    lines, units = ["# t", *asked, "## 答案"], []
    for k in range(n):
        y = list(asked[k])
        for _ in range(r.randint(0, len(y) // 2)):
            y[r.randrange(3, len(y))] = r.choice("戊己庚YZ")
        lines += ["".join(y)] + (["<div>" + text()] if r.random() < 0.2 else []) + [f"{k + 1}. A"]
        a = len(lines)
        lines += [asked[k][:-3] + "尾巴"] * r.randint(0, 2)
        more = span(len(lines) + 1, len(lines) + 1) if r.random() < 0.5 else None
        lines += ["解析" + text()]
        units.append(unit(f"Q{k}", [k + 1], stem=span(k + 2, k + 2), answer=span(a, a), explanation=more))
    return paper() | {"doc_id": f"p{seed}", "text": "\n".join(lines), "units": units}


def test_copied_lines(spark):
    papers = [made(s) for s in range(60)]
    want = sorted((p["doc_id"], *row) for p in papers for row in copied(p))
    df = C.copied_lines(frame(spark, *papers))
    assert sorted(tuple(r) for r in df.collect()) == want and len(want) > 20
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    same = [papers[0] | {"doc_id": None}] * 2 + [papers[1] | {"doc_id": None, "text": None}, papers[1] | {"units": None}]
    assert len(C.copied_lines(frame(spark, *same)).collect()) == 2 * len(copied(papers[0]))
    assert C.copied_lines(frame(spark, *papers).limit(0)).count() == 0


def test_print_form_and_bound(spark):
    texts = ["（a）·，x₁²＋", r"\underline{ab} \mathrm{H}_{2}\quad\times $x^{n}$", r"\overset{a}{b}\text{ c}", "", "　全 角"]
    r = random.Random(1)
    pairs = [("".join(r.choice("abcd甲") for _ in range(r.randint(0, 12))), "".join(r.choice("abcd甲") for _ in range(r.randint(0, 12)))) for _ in range(200)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(C.print_form(F.col("t"))).collect()
    assert [x[0] for x in got] == [form(t) for t in texts]
    df = spark.createDataFrame(pairs, "x string, y string")
    for x, y, most in df.select("x", "y", C.most_in_common(C.counts(F.col("x")), F.col("y"))).collect():
        assert most == sum(min(x.count(c), y.count(c)) for c in set(x))
        assert most >= sum(m.size for m in difflib.SequenceMatcher(None, x, y).get_matching_blocks())


def scanned(text):
    lines = (text or "").splitlines()
    items = [(i, m[1], re.sub(r"[\s,。，、：:；;（）()]", "", m[2])) for i, x in enumerate(lines, 1) if (m := re.match(C.NUMBERED.removeprefix("(?U)"), x))]
    doubled = [(a, b, n) for k, (a, n, x) in enumerate(items) for b, m, y in items[k + 1 :] if b - a <= 4 and n == m and min(len(x), len(y)) >= 8 and difflib.SequenceMatcher(None, x, y).ratio() >= 0.7]
    bare = [i for i, x in enumerate(lines, 1) if "$" not in x and re.search(C.LATEX, x)]
    return doubled, [i for i in bare if not re.search(C.COMPLEX, lines[i - 1])], [i for i in bare if re.search(C.COMPLEX, lines[i - 1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_scan(spark, seed):
    r = random.Random(seed)
    body = lambda: r.choice(["甲乙丙丁戊己庚辛壬", "abcdefghij", "短", r"\frac{a}{b} text text", "x^{2} and more", "$x^{2}$ in math", "", "甲乙丙丁戊己庚辛癸", "甲乙丙，丁（戊）己庚辛壬"])
    texts = ["\n".join(f"{r.randint(1, 2)}{r.choice('.、 ．')} {body()}" if r.random() < 0.8 else body() for _ in range(r.randint(0, 14))) for _ in range(40)] + [None, ""]
    rows = spark.createDataFrame([(i % 30, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, lines string").repartition(3)
    got = sorted((r["doc_id"], [tuple(p) for p in r["doubled"]], r["bare_simple"], r["bare_complex"]) for r in C.line_scan(rows).collect())
    want = sorted((i % 30, *scanned(t)) for i, t in enumerate(texts))
    assert got == want and any(w[1] for w in want) and any(w[2] for w in want) and any(w[3] for w in want)
    assert C.line_scan(rows.limit(0)).count() == 0
