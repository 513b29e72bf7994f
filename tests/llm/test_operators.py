"""The ten operators against brute-force versions: nulls, empty and very long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import groupby

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from sheaf.llm import chat, decontaminate, exact_dedup, licenses, line_dedup, near_dedup, pieces, pii, quality, registry, warc
from sheaf.llm.shared import new_folder, text_hash, without_rows

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"
LINE = "This line is long enough to be a key."
TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "a",
    "short\nlines\n\nonly\n",
    f"{LINE}\nfirst own line here\n{LINE}",
    f"x\n  {LINE.upper()}\t\ny",
    f"{LINE}",
    f"É{LINE}\nÉ{LINE}\n{LINE}\n",
    "the quick brown fox jumps over the lazy dog " * 12,
    "the quick brown fox jumps over the lazy dog " * 12 + "again",
    "The Quick Brown Fox Jumps Over The Lazy Dog " * 12,
    "thequickbrownfoxjumps over the lazy dog " * 3,
    "the quick brown fox jumps over the lazy dog the end of it all my friend",
    "Mail a.b%c@x-y.example.org, +1 (017) 555-7713, 4111 1111 1111 1111, 10.0.0.255 and 10.0.0.256.",
    "token = abcdefghij0123456789abcdefghij0123456789 MIT License. the GNU General Public License version 3",
    "日本語のテキスト😀 ▁ with　wide blanks </s> [INST]",
    "word " * 30000,
]
EXTRA = "doc_id long, text string, lang string, sha string, kept boolean, size int, node string, runs string, rep long, th long, line string"


def table(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "x", None, 1, "n", "r", 7, 3, "l") for i, t in zip(ids, texts)], EXTRA)


@pytest.fixture(scope="module")
def docs(spark):
    ids = [*range(len(TEXTS)), 3, 9, None, 500, 501]
    return table(spark, [*TEXTS, "a", TEXTS[9], TEXTS[9], TEXTS[17], TEXTS[5]], ids).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


def sha(s):
    return hashlib.sha256((s or "").encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- 1 ---------------------------------------------------------------------------------------


def test_line_dedup(spark, docs, none):
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda x: x.strip(BLANK).translate(UP)
    found = defaultdict(set)
    for i, t in data:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                found[key(x)].add(i)
    top = {k: max(v, key=lambda i: (i is not None, i or 0)) for k, v in found.items() if len(v) >= 3}
    want = []
    for i, t in data:
        ls = (t or "").split("\n")
        left = [x for x in ls if key(x) not in top or top[key(x)] == i]
        want.append((i, len(ls), len(ls) - len(left), sha("\n".join(left))))
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_dedup(docs))
    assert rows(out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))) == sorted(want, key=str)
    assert any(w[2] for w in want)
    assert out.columns.count("kept") == 1 and "runs" in out.columns
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_hot_line(spark):
    hot = table(spark, [f"{LINE} hot\nown line number {i} of many" for i in range(400)] + ["other"] * 5)
    occ = line_dedup.occurrences(hot)
    assert len(line_dedup.hot_hashes(occ, 8)) == 1
    gone = line_dedup.dropped_lines(occ, 8)
    assert sorted(r["doc_id"] for r in gone.collect()) == list(range(399))


def test_bitmap_round_trip(spark):
    for gone, n in (([0], 1), ([0, 1, 2], 3), ([1, 3, 4], 6), ([5], 6)):
        df = spark.createDataFrame([(1, 2, p) for p in gone], "doc_id long, th long, pos int")
        bits = line_dedup.keep_bitmaps(df).select(line_dedup.bits_of(F.col("runs"), F.lit(n))).first()[0]
        assert bits == [i not in gone for i in range(n)]


# --- 5 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [exact_dedup.MOST_BITS, 1])
def test_exact_dedup(spark, docs, none, bits):
    data = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in data:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((i, t))
    want = []
    for n, g in groups.items():
        best = max(len(t) for _, t in g)
        ids = [i for i, t in g if len(t) == best and i is not None]
        keep = min(ids) if ids else None
        want += [(i, keep, len(g), i == keep, sha(n)) for i, _ in g]
    assert rows(exact_dedup.exact_dedup(docs, bits)) == sorted(want, key=str)
    assert exact_dedup.exact_dedup(none, bits).count() == 0
    left = exact_dedup.drop_copies(docs, bits)
    assert left.columns == docs.columns
    assert sorted((r["text"] or "").translate({ord(c): None for c in BLANK}) for r in left.collect()) == sorted(groups)
    kept = {(w[0], w[4]) for w in want if w[3]}
    assert {(r["doc_id"], sha((r["text"] or "").translate({ord(c): None for c in BLANK}))) for r in left.collect()} == kept


def test_rows_alike_in_id_are_told_apart(spark):
    df = table(spark, ["bad text", "good text", "same", "same", "bad text", None], [1, 1, 2, 2, None, None])
    gone = df.where("text = 'bad text'").select("doc_id", text_hash().alias("th"))
    for most in (100, 0):
        left = without_rows(df, gone, most)
        assert left.columns == df.columns
        assert rows(left.select("doc_id", "text")) == sorted([(1, "good text"), (2, "same"), (2, "same"), (None, None)], key=str)
    assert rows(exact_dedup.drop_copies(df).select("doc_id", "text")) == sorted([(1, "bad text"), (1, "good text"), (2, "same"), (None, None)], key=str)


def test_bloom_filter_is_safe_and_sharp(spark):
    df = spark.range(20_000).select(F.unhex(F.sha2((F.col("id") % 19_000).cast("string"), 256)).alias("sha"), "id")
    marked = exact_dedup.mark_possible(df, exact_dedup.repeat_filter(df))
    got = {r["id"] for r in marked.where("possible").collect()}
    assert got >= {i for i in range(20_000) if i < 1000 or i >= 19_000}
    assert len(got) < 2000 + 400


# --- 3 ---------------------------------------------------------------------------------------


def test_sentencepiece_equals_the_library(spark, docs, none):
    import public_tokenizers
    import sentencepiece

    f = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=f)
    got = {(r["doc_id"], r["text"]): r for r in pieces.encoded(docs, f, ids=True).collect()}
    for (_, t), r in got.items():
        ids = sp.encode(t or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids))) and r["decoded_sha256"] == sha(sp.decode(ids))
    assert pieces.encoded(none, f).count() == 0


def test_sentencepiece_fuzz():
    import random

    import public_tokenizers
    import sentencepiece

    f = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=f)
    with open(f, "rb") as x:
        m = pieces.Model(x.read())
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "th", "ing", "tion", "é", "▁", "\r", "中", "😀", ".", "..", '"', "(", "\x00", "_", "==", "1", "23", "A", "　"]
    for _ in range(3000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        assert m.encode(t) == sp.encode(t)
        assert m.decode(m.encode(t)) == sp.decode(sp.encode(t))
    for t in ("a" * 5000, " " * 3000, "ab" * 3000 + " " * 50):
        assert m.encode(t) == sp.encode(t)


# --- 8 ---------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = ["</s>", "\\", "[\\INST]", "<\\/s> </s>", "<<SYS>>\\\\</s>", "[INST", "INST]", "", None, "é😀\n"]
    data = [(1, k, ["user", "assistant", "system", "tool", None, "</s>[ROLE] x"][k % 6], t) for k, t in enumerate(nasty)]
    data += [(2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", "x"), (3, 0, "assistant", "x"), (None, None, "user", "n"), (4, 1, "user", "b"), (4, 1, "user", "b")]
    data += [(5, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(400)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1)).withColumn("chunk", F.lit(2))
    out = chat.format_chats(df).withColumn("turns", chat.parsed(F.col("formatted")))
    got = {r["conv_id"]: r for r in out.collect()}
    want = defaultdict(list)
    for c, k, role, t in data:
        want[c].append((-1 if k is None else k, role or "", t or ""))
    for c, turns in want.items():
        turns.sort()
        assert [(x["role"], x["text"]) for x in got[c]["turns"]] == [x[1:] for x in turns]
        lost = "".join(s["text"] for s in got[c]["segments"] if s["loss"])
        assert lost.count("t1") == "".join(x[2] for x in turns if x[1] == "assistant").count("t1")
    assert {c: r["valid"] for c, r in got.items()} == {1: False, 2: True, 3: False, None: False, 4: False, 5: True}
    assert chat.format_chats(df.limit(0)).count() == 0


# --- 9 ---------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def base_spans(t):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, t or "") if _holds(k, m[0])]


def test_personal_data(spark, docs, none):
    import random

    rng = random.Random(3)
    parts = ["1", "12", "255", "256", ".", ".", "@", "a", "b.c", "-", "+", " ", "(", ")", "%", "_", "4111111111111111", "\n", "é", "token = ", "0000", "user", "😀"]
    fuzz = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(1500)]
    fuzz += ["1" * 30000, "a" * 30000, "1 " * 9000, "1.2.3.4 " * 400, "a@b.c%d@e.f", "@" * 500]
    for df in (docs, table(spark, fuzz)):
        text = {(r["doc_id"], sha(r["text"])): r["text"] for r in df.collect()}
        got = pii.personal_data(df).collect()
        left = Counter(map(str, (i for i, _ in text)))
        assert len(got) == df.count() and set(map(str, (r["doc_id"] for r in got))) == set(left)
        by = defaultdict(list)
        for r in got:
            by[r["doc_id"]].append([(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]])
        for (i, _), t in text.items():
            assert base_spans(t) in by[i]
    assert pii.personal_data(none).count() == 0


def test_boosted_trees_separate_their_cells():
    counts = {b: ((0, 50) if b & 1 and b & 4 else (40, 2)) for b in range(16)}
    model = pii.boost(counts)
    good = [pii._score(b, model) for b in counts if b & 1 and b & 4]
    bad = [pii._score(b, model) for b in counts if not (b & 1 and b & 4)]
    assert min(good) > max(bad)


def loose_brute(texts):
    """Spans of each text by plain Python: base spans, and loose candidates by the fitted trees."""
    import math

    cells, found = Counter(), []
    for t in texts:
        base = base_spans(t)
        mine = []
        for kind, p in pii.LOOSE.items():
            for m in regex.finditer(p, t or ""):
                s, d = m[0], re.sub("[^0-9]", "", m[0])
                before = t[max(m.start() - 24, 0) : m.start()]
                luhn = 8 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
                has = [luhn, len(d) >= 8, len(d) >= 13, len(d) >= 16, len(d) > 19, re.fullmatch(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", s), s.startswith("+"), re.search(r"[\x20().-]", s), re.search("[A-Za-z]", s) and len(d) >= 3, re.fullmatch("[0-9a-f]+", s), len(s) >= 32, re.search("[\"'=:]\\s?$", before), re.search(r"(?i)(?:\.|dot\)\x20|dot\]\x20)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|[a-z]{2})$", s), re.search("[(-]", s)]
                bits = sum(1 << i for i, x in enumerate(has) if x)
                over = any(a < m.end() and m.start() < z for _, a, z in base)
                cue = {"number": pii.NUMBER_CUES, "secret": pii.SECRET_CUES, "handle": pii.MAIL_CUES}[kind]
                label = True if re.search(cue, before) or kind == "number" and over else False if re.search(pii.OTHER_CUES[kind], before) else None
                if label is not None:
                    cells[kind, bits, label] += 1
                mine.append((kind, m.start(), m.end(), bits, over))
        found.append((base, mine))
    out = []
    models = {}
    for kind, known in pii.KNOWN.items():
        counts = defaultdict(lambda: [0, 0])
        for names, no, yes in known:
            cell = counts[sum(1 << pii.FEATURES.index(f) for f in names.split())]
            cell[0] += no
            cell[1] += yes
        for (k, bits, label), n in sorted(cells.items()):
            if k == kind:
                counts[bits][label] += n
        model = pii.boost({b: tuple(c) for b, c in counts.items()})
        best, sums = math.inf, [0, 0]
        for score in sorted({pii._score(b, model) for b in counts}, reverse=True):
            sums = [sum(c[i] for b, c in counts.items() if pii._score(b, model) >= score) for i in (0, 1)]
            best = score if sums[1] >= 0.95 * sum(sums) else best
        models[kind] = (model, best)
    for base, mine in found:
        out.append(sorted([(*x, True) for x in base] + [(k, a, z, False) for k, a, z, bits, over in mine if not over and pii._score(bits, models[k][0]) >= models[k][1] - 1e-9], key=lambda x: (pii.KINDS.index(x[0]), x[1])))
    return out


def personal_texts():
    import random

    rng = random.Random(6)
    out = [f"word token = {hashlib.sha1(str(i).encode()).hexdigest()} more" for i in range(12)]
    out += [f"write to joe.{i} (at) site{i} (dot) org now" for i in range(6)] + ["phone 555-123-4567 or 0301 234 567 89", "at home (at) the.mill", "tel (030) 1234-5678."]
    out += ["plain words only", "order 20240611 of 1000000 pieces", "abcdefghijklmnopqrstuvwxyz", "x" * 40, None, "", "key: Zq8-" + "a1B2c3D4" * 5]
    return out + [" ".join(rng.choices(["4111 1111 1111 1111", "10.0.0.1", "+1 (017) 555-7713", "a@b.cd", "note", "card 4111-1111", "19990101", "é", "secret=" + "f00d" * 8], k=8)) for _ in range(25)]


def test_all_kinds_are_added_and_equal_brute_force(spark):
    texts = personal_texts()
    want = loose_brute(texts)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]] for r in pii.personal_data(table(spark, texts)).collect()}
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]
    assert {s[0] for w in want for s in w if not s[3]} == {"number", "secret", "handle"}
    assert all(any(s[0] == "secret" for s in got[i]) for i in range(12)) and all(any(s[0] == "handle" for s in got[i]) for i in range(12, 18))
    assert any(s[0] == "number" for s in got[18]) and not any(got[i] for i in (21, 22, 23, 24, 25, 26))


def test_a_text_alone_is_judged_like_one_among_many(spark):
    (r,) = pii.personal_data(table(spark, [personal_texts()[0]])).collect()
    assert [s["kind"] for s in r["spans"]] == ["secret"]


def test_planted_spans_are_held_out(spark):
    """Personal data without any cue word before it, among clean texts: recall and precision."""
    import random

    rng = random.Random(9)
    words = ["the", "of", "house", "river", "in 2024 it", "page 12 of", "chapter 7 on", "and", "1999 was", "a", "walk", "20240611 pieces"]
    make = [lambda: hashlib.sha256(str(rng.random()).encode()).hexdigest(), lambda: f"{rng.choice('abc')}.{rng.randrange(99)} (at) mail (dot) com", lambda: f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}", lambda: "".join(rng.choices("abcdefXYZ0123456789", k=40))]
    texts, planted = [], []
    for i in range(200):
        t = rng.choices(words, k=30)
        if i % 2:
            t.insert(15, make[i // 2 % 4]())
        texts.append(" ".join(t))
        planted.append(bool(i % 2))
    got = {r["doc_id"]: bool(r["spans"]) for r in pii.personal_data(table(spark, texts)).collect()}
    hit = sum(got[i] for i, p in enumerate(planted) if p) / 100
    wrong = sum(got[i] for i, p in enumerate(planted) if not p) / 100
    assert hit >= 0.9 and wrong <= 0.02, (hit, wrong)


def test_redacted(spark):
    texts = ["Mail a@b.cd, call +1 (017) 555-7713 or 4111 1111 1111 1111.", "nothing", None, "10.0.0.1" + " 10.0.0.2" * 200]
    got = {r["doc_id"]: r["redacted"] for r in pii.redacted(table(spark, texts)).collect()}
    assert got == {0: "Mail [EMAIL], call [PHONE] or [CARD].", 1: "nothing", 2: "", 3: "[IP]" + " [IP]" * 200}


# --- 7 ---------------------------------------------------------------------------------------


def test_license_scan(spark, docs, none):
    got = {}
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for r in licenses.scan_licenses(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in data:
        w = re.findall(licenses.WORD, (t or "").translate(UP))
        at, labels = [], set()
        for p, label in licenses.BASE:
            ps = p.split()
            hit = [k for k in range(len(w)) if w[k : k + len(ps)] == ps]
            at += hit
            labels |= {label} if hit else set()
        want = (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert any(want == (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got[i])
    assert licenses.scan_licenses(none).count() == 0


def test_license_templates_are_found_where_they_stand(spark):
    texts = [f"Some words before. {t} and words after" for _, t, _ in licenses.TEMPLATES] + ["license software permission granted public general version " * 3]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(table(spark, texts)).collect()}
    for k, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert label in got[k]["labels"].split(",") and got[k]["score"] > 0.5
    assert got[len(licenses.TEMPLATES)]["labels"] == ""


def test_license_notices_of_one_text_are_all_found(spark):
    by = {label: t for label, t, _ in licenses.TEMPLATES}
    groups = [("bsd", "isc"), ("lgpl", "bsd", "mpl", "isc", "cc-by", "unlicense"), tuple(sorted(by))]
    texts = [" and so on. ".join(by[x] for x in g) for g in groups]
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses.scan_licenses(table(spark, texts)).collect()}
    assert all(got[k] >= set(g) for k, g in enumerate(groups))


# --- 6 ---------------------------------------------------------------------------------------


def near_brute(data, width=3, least=85):
    sets = []
    for i, t in data:
        w = (t or "").translate(UP).split(" ")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(UP)) if x]
        n = min(width, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    up = list(range(len(data)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and (x == y or 100 * len(x & y) >= least * len(x | y)):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(data)]


@pytest.mark.parametrize("small", [4, 256])
def test_near_dedup(spark, docs, none, small):
    import random

    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for n in range(120):
        t = list(base if n % 3 else [f"v{n % 5}_{k}" for k in range(60)])
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    for df in (docs, table(spark, texts)):
        data = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = near_dedup.near_components(df, small=small)
        want = near_brute(data)
        assert rows(got.drop("kept", "th")) == sorted(want, key=str)
        kept = [r for r in got.collect() if r["kept"]]
        assert all(r["doc_id"] == r["component_id"] for r in kept)
        assert {r["component_id"] for r in kept if r["n_shingles"]} == {w[2] for w in want if w[1]}
    assert near_dedup.near_components(none).count() == 0


def test_near_dedup_keeps_pairs_of_large_nodes_together(spark):
    """Different documents with a common passage: each signature value is the passage's or one's own."""
    import random

    rng = random.Random(5)
    sigs = []
    for _ in range(150):
        x = [7 if rng.random() < 0.45 else rng.randrange(1 << 32) for _ in range(near_dedup.FUNCTIONS)]
        y = [v if rng.random() < 0.8 else rng.randrange(1 << 32) for v in x]
        sigs += [x, y]
    data = [(i, 1, b"".join(v.to_bytes(4, "little") for v in s)) for i, s in enumerate(sigs)]
    placed, _ = near_dedup.nodes(spark.createDataFrame(data, "rep long, size long, sig binary"), small=4)
    held = defaultdict(set)
    for r in placed.collect():
        held[r["rep"]].add((r["tree"], r["node"]))
    assert not [i for i in range(0, 300, 2) if not held[i] & held[i + 1]]


@pytest.mark.parametrize("most", [10**9, 700])
def test_sizes_of_intersections(monkeypatch, most):
    monkeypatch.setattr(near_dedup, "MOST_ITEMS", most)
    monkeypatch.setattr(near_dedup, "COLUMNS", 64)
    rng = np.random.default_rng(4)
    every = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
    own = [np.sort(rng.choice(every, int(rng.integers(0, 200)), replace=False)) for _ in range(40)]
    got = near_dedup._shared(own, np.ones((40, 40), bool))
    for i in range(40):
        for j in range(40):
            assert i == j or got[i, j] == len(np.intersect1d(own[i], own[j]))


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(300, 301), (301, 300)], "a long, b long")
    got = {r["rep"]: r["part"] for r in near_dedup.components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {301: 300}


# --- 10 --------------------------------------------------------------------------------------


def leaks_brute(texts, bench, least=0.5):
    """(document, item): coverage and whether reworded, by plain loops over the places."""
    codes = decontaminate.Codes()
    out = {}

    def told(text, n):
        w = decontaminate.Words(text or "", codes)
        a, b, slots = w.windows(n)
        return w, [(int(x), int(y), int(z)) for x, y, z in zip(a, b, slots)]

    for item, it in bench:
        size = min(decontaminate.WINDOW, len(decontaminate.Words(it or "", codes)))
        if not size:
            continue
        iw, own = told(it, size)
        for d, dt in enumerate(texts):
            dw, theirs = told(dt, size)
            best = None
            for occ in {2 * ((p - q) // 8) for p in range(len(theirs)) for q in range(len(own))} | {2 * ((p - q + 4) // 8) + 1 for p in range(len(theirs)) for q in range(len(own))}:
                pairs = [(p, q) for p in range(len(theirs)) for q in range(len(own)) if occ == (2 * ((p - q) // 8), 2 * ((p - q + 4) // 8) + 1)[occ % 2]]
                if size < decontaminate.LEAST_WORDS:
                    pairs = [(p, q) for p, q in pairs if dw.starts[p] and dw.ends[p + size - 1]]
                plain = {q for p, q in pairs if theirs[p][0] == own[q][0]}
                maps = []
                for p, q in {(tuple(dw.values(p, size)), q) for p, q in pairs if theirs[p][1] == own[q][1] != own[q][0]}:
                    maps.append((q, [(x.split("\t")[1], y.split("\t")[1]) for x, y in zip(iw.values(q, size), p)]))
                # the query counts a window of each place of the document
                votes = Counter()
                for p, q in pairs:
                    if theirs[p][1] == own[q][1] != own[q][0] and theirs[p][1] != theirs[p][0]:
                        votes.update((x.split("\t")[1], y.split("\t")[1]) for x, y in zip(iw.values(q, size), dw.values(p, size)))
                to = {x: max((n, y) for (a, y), n in votes.items() if a == x)[1] for x, _ in votes}
                back = {y: max((n, x) for (x, b), n in votes.items() if b == y)[1] for _, y in votes}
                fit = {q for q, m in maps if all(to.get(x) == y and back.get(y) == x for x, y in m)} | plain
                open_ = [q for q in range(len(own)) if not (own[q][2] and own[q][0] == own[q][1])]
                against = {q for q, _ in maps} - fit
                cover = max(len(plain) / len(own), min(1, (len(fit) - len(against)) / len(open_)) if open_ else 0)
                run = max((sum(1 for _ in g) for k, g in groupby(range(len(own)), lambda q: q in plain) if k), default=0)
                if cover >= least or run >= decontaminate.RUN:
                    got = (round(cover, 6), len(plain) / len(own) < least and run < decontaminate.RUN)
                    best = (max(best[0], got[0]), best[1] and got[1]) if best else got
            if best:
                out[d, item] = best
    return out


def test_decontamination(spark, docs, none):
    item = "Alice has 12 apples and then Bob gives 5 apples to Alice, so how many apples does Alice have in total after 3 days?"
    other = item.replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "40").replace("5", "7")
    third = item.replace("Alice", "Emma").replace("Bob", "Frank").replace("12", "61").replace("5", "8")
    mixed = "Alice has 12 apples and then Bob gives 5 apples to Carol, so how many apples does Peter have in total after 3 days?"
    same = item.replace("Alice", "Anna").replace("Bob", "Anna").replace("12", "9").replace("5", "9").replace("3", "9")
    long = "The quick river ran over old stones and past the mill where nobody had lived since the great flood took the bridge and half of the village with it into the sea"
    dense = "Ride 30 km in 2 hours, then 45 km in 3 hours, then 10 miles in 4 hours and tell me how many kilometres you rode in these 9 hours."
    texts = [f"Before it. {item} After it.", item.upper(), f"Intro. {other}", mixed.replace("12", "77"), "nothing of it", None, "", "tiny item", "a tiny item here", "Well. Tiny item! Yes."]
    texts += [f"We ask: what is the capital of France? Say so.", "The capital of France is known", f"{other} And also: {third}", same, f"so {' '.join(long.split()[:14])} and on", f"so {' '.join(long.split()[:9])} and on", dense.replace("30", "55").replace("45", "71").replace("10", "12").replace("9 h", "14 h").replace("in 4", "in 6"), f"{item} " * 3 + "word " * 3000]  # noqa: F541
    bench = [(1, item, "k"), (2, None, "k"), (3, "", "k"), (4, "tiny item", "k"), (1, item, "k"), (5, "What is the capital of France?", "k"), (6, long, "k"), (7, dense, "k")]
    items = spark.createDataFrame(bench, "item_id long, text string, hash string")
    got = {(r["doc_id"], r["item_id"]): (round(r["coverage"], 6), r["reworded"]) for r in decontaminate.contaminated(table(spark, texts), items).collect()}
    assert got.keys() == {(0, 1), (1, 1), (2, 1), (12, 1), (17, 1), (7, 4), (9, 4), (10, 5), (14, 6), (16, 7)}
    assert [got[k][1] for k in ((0, 1), (2, 1), (12, 1), (14, 6), (16, 7))] == [False, True, True, False, True]
    small = [t for t in texts if len(t or "") < 3000]
    assert leaks_brute(small, [b[:2] for b in bench if b[0] != 1] + [(1, item)]) == {k: v for k, v in got.items() if k[0] < len(small)}
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, texts[0]), (1, "clean words"), (None, texts[2]), (None, None), (3, texts[0]), (3, texts[0])], "doc_id long, text string").withColumns({"th": F.lit(1), "place": F.lit("x"), "item_id": F.lit(None)})
    left = decontaminate.decontaminated(odd, items)
    assert left.columns == odd.columns and rows(left.select("doc_id", "text")) == [(1, "clean words"), (None, None)]
    assert len(decontaminate.contaminated(odd, items).collect()) == 3


# --- 4 ---------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    long = "é" * 80
    data = [(5, "http://a/ ü\r\n", long, 1), (3, None, long, 1), (9, "u", long, 1), (3, "again", long, 1), (1, "u", "short", 1), (2, "u", "short", 1), (4, "u", None, 1), (None, "u", long, 1), (-7, "u", "x" * 3000, 1), (5000, "u", "y" * 200, 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, kind int")
    files = []
    for n in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        folder = new_folder(spark, "warc")
        man = warc.write_warc(pages, folder, width=100, most_bytes=600)
        got = warc.read_warc(man, folder, payloads=True).collect()
        files.append(rows(man))
        want = []
        for i, _, h, _ in data:
            b = (h or "").encode()
            first = min((j for j, _, g, _ in data if g == h and j is not None), default=None)
            revisit = i is not None and len(b) >= 100 and i != first
            want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
        assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
        assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got if r["record_type"] == "response")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert files[0] == files[1] and len(files[0]) >= 4
    folder = new_folder(spark, "warc")
    assert warc.read_warc(warc.write_warc(pages.limit(0), folder), folder).count() == 0


# --- 2 ---------------------------------------------------------------------------------------


def test_quality(spark, none):
    import random

    rng = random.Random(4)
    words = ["the", "cat", "sat", "on", "a", "mat", "and", "then", "it", "slept", "near", "warm", "old", "stove"]
    good = [" ".join(rng.choices(words, k=rng.randint(5, 60))).capitalize() + "." for _ in range(400)]
    bad = ["%%% $$ | ## " * 20, "THE CAT!! SAT!! ON!! " * 9, "Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat Cat " * 3]
    df = table(spark, [*good, *bad, None, ""]).withColumn("lang", F.when(F.col("doc_id") == 7, None).otherwise(F.col("lang")))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(5, 1, 0), (None, 1, 0), (9, None, None), (10, 1, None), (400, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality(df, labels).collect()}
    assert len(got) == 405
    assert sum(got[i]["kept"] for i in range(400)) >= 396 and not any(got[400 + i]["kept"] for i in range(3))
    assert got[403]["kept"] and got[404]["char"] is None and got[7]["lang"] is None
    assert quality.quality(none, labels).count() == 0
    unlabelled = quality.quality(df, labels.limit(0)).collect()
    assert len(unlabelled) == 405 and all(r["kept"] for r in unlabelled)


def kneser_ney(texts, order):
    """Plain interpolated modified Kneser-Ney: a function of context and symbol."""
    def grams(t, n):
        t = quality.EDGE * (order - 1) + t
        return [t[i : i + n] for i in range(order - n, len(t) - n + 1)]

    tables = [Counter(g for t in texts for g in grams(t, order))]
    while len(tables) < order:
        tables.insert(0, Counter(g[1:] for g in tables[0]))
    cuts = []
    for t in tables:
        n = Counter(t.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else None
        cuts.append([max(0.1, min(i - 0.1, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and y is not None else 0.5 for i in (1, 2, 3)])
    cut = lambda k, c: cuts[k][min(c, 3) - 1] if c else 0.0

    def p(g):
        if not g:
            return 1 / (len(tables[0]) + 1)
        k = len(g) - 1
        mine = {x: c for x, c in tables[k].items() if x[:-1] == g[:-1]}
        total = sum(mine.values())
        if not total:
            return p(g[1:])
        c = mine.get(g, 0)
        return (c - cut(k, c)) / total + sum(cut(k, x) for x in mine.values()) / total * p(g[1:])

    return p


def test_probabilities_equal_plain_kneser_ney(spark):
    import random

    rng = random.Random(8)
    texts = ["".join(rng.choices("abé 😀\x00", [5, 4, 2, 3, 1, 1], k=rng.randint(1, 40))) for _ in range(30)]
    rows = [(7, i, "x", 1 if i % 3 else 0, bool(i % 2), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "block long, doc_id long, lang string, fold int, trusted boolean, text string")
    got = quality.block_grams(df.repartition(2)).where("view = 'char'")
    order = quality.VIEWS["char"]
    model = quality.probabilities(quality.orders(got.groupBy("lang", "g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), order)).collect()
    clean = [t.replace("\x00", "\ufffd") for t in texts]
    want = [kneser_ney([t for r, t in zip(rows, clean) if r[4] and r[3] == f], order) for f in (0, 1)]
    assert len(model) == len({g[i : i + order] for t in clean for g in [quality.EDGE * (order - 1) + t] for i in range(len(t))})
    for r in model:
        assert abs(r["p0"] - want[0](r["g"])) < 1e-9 and abs(r["p1"] - want[1](r["g"])) < 1e-9


def quality_brute(data, labels, quantile):
    """Scores and decisions of documents (doc_id, lang, fold, text), one by one."""
    import math

    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    kinds = quality.classes()
    seen = [(i, lang or "", f, ["".join(map(chr, v.cp[v.order - 1 :])) for v in quality.text_views([t or ""], kinds)]) for i, lang, f, t in data]
    out = [[] for _ in data]
    limits = []
    for v, (view, order) in enumerate(quality.VIEWS.items()):
        models = {(x, f): kneser_ney(ts, order) for x in {s[1] for s in seen} for f in (0, 1) if (ts := [s[3][v] for s in seen if s[0] in trusted and s[1:3] == (x, f) and s[3][v]])}
        bits = []
        for i, lang, f, t in seen:
            g = quality.EDGE * (order - 1) + t[v]
            m = models.get((lang, 1 - f))
            bits.append(None if m is None or not t[v] else sum(-math.log2(m(g[k : k + order])) for k in range(len(t[v]))))
        mean = {}
        for x in {s[1] for s in seen}:
            mine = [(b, len(s[3][v])) for s, b in zip(seen, bits) if s[1] == x and s[0] in trusted]
            if any(b is not None for b, _ in mine):
                mean[x] = sum(b or 0 for b, _ in mine) / sum(n for _, n in mine)
        pp = [None if b is None or s[1] not in mean else 2 ** ((b + quality.PRIOR[view] * mean[s[1]]) / (len(s[3][v]) + quality.PRIOR[view])) for s, b in zip(seen, bits)]
        for x in mean:
            own = sorted(p for s, p in zip(seen, pp) if s[1] == x and s[0] in trusted and p is not None)
            limits.append((x, view, own[math.ceil(quantile * len(own)) - 1]))
        for k, p in enumerate(pp):
            out[k].append(p)
    return out, limits


def test_word_shapes_of_texts_together():
    kinds = quality.classes()
    texts = ["", "The cat, the CAT! sat", " a a a  b b\x00", "", "%% x1. \u3000é", "a"]
    both = quality.text_views(texts, kinds)
    for v, edges in zip(both, (4, 2)):
        alone = [quality.text_views([t], kinds)[0 if edges == 4 else 1] for t in texts]
        assert v.cp.tolist() == [c for a in alone for c in a.cp.tolist()]
        assert v.n.tolist() == [a.n[0] for a in alone]
        values = (v.hash % np.uint64(1000)).astype(np.int64) if not v.empty else None
        assert v.sums(values).tolist() == [int((a.hash % np.uint64(1000)).sum()) if a.n[0] else 0 for a in alone]
    assert both[0].n.tolist() == list(map(len, texts))
    shape = both[1].cp.tolist()
    words = [[w for w in shape[2 + both[1].begin[k] : 2 + both[1].begin[k] + both[1].n[k]]] for k in range(len(texts))]
    assert words[2][1:3] == [101, 102] and words[2][4] != 101 and words[4][0] >= 50 and [len(w) for w in words] == [0, 5, 5, 0, 3, 1]


def test_quality_equals_brute_force(spark):
    import random

    rng = random.Random(12)
    vocab = ["the", "cat", "Sat,", "on", "a", "mat.", "and", "cat", "x1", "%%", "\n", "é"]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 25))) for _ in range(50)] + [None, "", "same same", "same same", "cat " * 300]
    ids = [*range(50), 50, 51, 52, 53, None]
    langs = ["en", "de", None]
    rows = [(i, langs[k % 3], t, 1, "x") for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, block long, char string").repartition(3)
    labels = [(i, 1, 0) for i in range(30)] + [(5, 1, 0), (None, 1, 0), (31, None, None), (32, 1, None), (33, 0, 0), (34, 1, 1)]
    fold = {(r["doc_id"], r["text"]): r["f"] for r in df.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("f")).collect()}
    data = [(i, lang, fold[i, t], t) for i, lang, t, *_ in rows]
    want, limits = quality_brute(data, labels, 0.9)
    got = defaultdict(list)
    for r in quality.quality(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), 0.9).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    limit = {(x, v): p for x, v, p in limits}
    for (i, lang, *_), (char, word) in zip(rows, want):
        (r,) = got[i]
        assert r["lang"] == lang
        for v, p in (("char", char), ("word", word)):
            assert (r[v] is None) == (p is None) and (p is None or abs(r[v] - p) < 0.01 * p)
            assert (lang or "", v) not in limit or abs(r[f"{v}_limit"] - limit[lang or "", v]) < 0.01 * limit[lang or "", v]
        assert r["kept"] == all(r[v] is None or r[v] <= r[f"{v}_limit"] for v in ("char", "word"))


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    r = got.agg(F.avg(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.col("kept").cast("int"))).alias("good"), F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad")).first()
    assert r["good"] >= 0.95 and r["bad"] <= 0.2


# --- queries ---------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_equals_sql(spark, name):
    from pathlib import Path

    con = duckdb.connect()
    for p in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    con.execute(registry.oracles()[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in con.fetchall()), key=str)
    assert rows(df.select(*cols)) == want


@pytest.fixture(scope="module")
def documents():
    return {i: (t or "", lang) for i, t, lang in duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()}


def test_op3_query(spark, documents):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in pieces.op3_sentencepiece(spark, SF).collect()}
    assert got.keys() == documents.keys()
    for i, (t, _) in documents.items():
        ids = sp.encode(t)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_op9_query(spark, documents):
    got = {r["doc_id"]: r for r in pii.op9_personal_data(spark, SF).collect()}
    assert got.keys() == documents.keys()
    ids = sorted(documents)
    told = lambda spans: ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
    for i, spans in zip(ids, loose_brute([documents[i][0] for i in ids])):
        base = [s[:3] for s in spans if s[3]]
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        assert got[i]["base_sha256"] == sha(told(base)) and got[i]["spans"] == told(s[:3] for s in spans) and got[i]["n_spans"] == len(spans)


def test_op7_query(spark, documents):
    got = {r["doc_id"]: r for r in licenses.op7_license_scan(spark, SF).collect()}
    assert got.keys() == documents.keys()
    for i, (t, _) in documents.items():
        w = re.findall(licenses.WORD, t.translate(UP))
        stands = lambda p: [k for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]  # noqa: E731, B023
        at = sorted(k for p, _ in licenses.BASE for k in stands(p))
        base = {label for p, label in licenses.BASE if stands(p)}
        assert (got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"]) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)))
        # a label of the method needs all key phrases of a notice, and a notice that stands whole gives it
        labels = set(filter(None, got[i]["labels"].split(",")))
        keyed = {label for label, _, ps in licenses.TEMPLATES if all(stands(p) for p in ps)}
        whole = {label for label, text, _ in licenses.TEMPLATES if stands(text)}
        assert base | whole <= labels <= base | keyed and (got[i]["score"] > 0) == bool(labels - base or got[i]["score"])


def test_op10_and_op2_queries(spark, documents):
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    want = {(i, k) for i, (t, _) in documents.items() for k, b in bench if b and b in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op10_decontamination(spark, SF).collect()}
    assert got >= want and len(got) <= len(want) + 2
    rows_ = quality.op2_quality_classifier(spark, SF).collect()
    assert {r["doc_id"] for r in rows_} == documents.keys() and len(rows_) == len(documents)
    assert all(r["kept"] == all(r[v] is None or r[v] <= r[f"{v}_limit"] for v in ("char", "word")) for r in rows_)


def test_quality_counts_every_trusted_text(spark, tmp_path):
    import inspect

    assert list(inspect.signature(quality.quality).parameters) == ["docs", "labels", "quantile"]  # no bound of trusted texts
    n = 40
    spark.createDataFrame([(i, "en", "s", f"word {i} of a text") for i in range(n)] + [(None, "en", "s", "nobody's")], "doc_id long, lang string, source string, text string").write.parquet(str(tmp_path / "d"))
    docs = quality._in_blocks(spark.read.parquet(str(tmp_path / "d")))
    folder = "file://" + str(tmp_path / "marks")
    quality.write_blocks(docs.where("doc_id % 2 = 0").select("block", "doc_id"), ["doc_id"], [], folder)
    got = quality.block_grams(docs, folder).where("view = 'char'").agg(F.sum(F.col("c0") + F.col("c1"))).first()[0]
    assert got == sum(len(f"word {i} of a text") for i in range(0, n, 2))
