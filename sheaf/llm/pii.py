"""Personal data: overlapping candidates, boosted trees, calibrated thresholds.

All on SQL expressions: a pattern's places are the running lengths of the parts between its
matches. The trees are fitted on the driver to one table of counts (feature bits by silver
label, at most 2 ** len(FEATURES) rows a kind) that a partial sum over all candidates gives, so
the fit sees the whole corpus and its size is bounded.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import stored, text_of

#: A run's start, or where the last match ended: the same matches as without, in linear time.
_EMAIL_CHAR = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_EMAIL_CHAR})|\G){_EMAIL_CHAR}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of high recall; their spans may overlap those above.
LOOSE = {
    "number": r"(?<![A-Za-z0-9_.@-])(?:\+|\()?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+(?![A-Za-z0-9_@])",
    "secret": r"(?:(?<![A-Za-z0-9_-])|\G)[A-Za-z0-9_-]{20,}+",
    "handle": rf"(?:(?<!{_EMAIL_CHAR})|\G){_EMAIL_CHAR}++(?:\x20\(at\)\x20|\x20\[at\]\x20|\(at\)|\[at\])[A-Za-z0-9-]++(?:(?:\.|\x20\(dot\)\x20|\x20\[dot\]\x20)[A-Za-z0-9-]++)++",
}
#: What must be in a text for the pattern to match at all.
_NEEDS = {"email": "@", "phone": "+", "handle": "at"}
KINDS = ("email", "ip", "card", "phone", "number", "secret", "handle")
SECRET_CUES = r"(?i)(?:token|key|secret|password|pwd|auth|bearer)\W{0,4}$"
MAIL_CUES = r"(?i)(?:e-?mail|mail|contact|write to|reach (?:me|us)(?: at)?)\W{0,4}$"
NUMBER_CUES = r"(?i)(?:phone|tel|call|mobile|fax|card|visa|account|iban)\W{0,4}$"
#: Words before a span that tell what else it is.
OTHER_CUES = {
    "number": r"(?i)(?:page|chapter|volume|figure|table|section|order|item|version|year|isbn|issn|doi|[$€£#])\W{0,2}$",
    "secret": r"(?i)(?:sha-?1|sha-?256|md5|commit|hash|checksum|digest|uuid|doi|url|path|file)\W{0,4}$",
    "handle": r"(?i)(?:look|meet|stay|live|arrive|sit|wait)\W{0,4}$",
}
FEATURES = ("luhn", "d8", "d13", "d16", "over19", "quad", "plus", "parted", "letters", "hexed", "long", "quoted", "ending", "marked")
#: What is known before any table is seen: features that a candidate has, and how many of such count as
#: no personal data, and as some. They outweigh few candidates, and many outweigh them.
KNOWN = {
    "number": (("", 40, 0), ("d8", 30, 10), ("d8 parted", 25, 15), ("d8 parted marked", 1, 60), ("d8 plus", 1, 20), ("d8 plus parted", 1, 40), ("d8 plus parted marked", 1, 40), ("parted marked", 20, 20), ("d8 d13", 30, 5), ("d8 d13 d16", 30, 5), ("d8 d13 d16 luhn", 1, 40), ("d8 d13 d16 luhn parted", 1, 40), ("d8 d13 parted marked", 20, 10), ("d8 d13 d16 parted marked", 20, 10), ("d8 d13 d16 over19 parted marked", 20, 1), ("d8 d13 d16 over19", 40, 1), ("quad d8", 20, 20)),
    "secret": (("", 60, 0), ("long", 40, 0), ("hexed long", 20, 2), ("letters", 20, 10), ("letters hexed", 10, 10), ("letters long", 5, 40), ("letters long quoted", 1, 40), ("letters hexed long", 2, 60), ("letters hexed long quoted", 1, 60), ("letters quoted", 5, 30), ("letters hexed quoted", 2, 30)),
    "handle": (("", 20, 5), ("ending", 1, 60)),
}


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    r = F.reverse(d)

    def add(total: Column, i: Column) -> Column:
        v = F.substr(r, i, F.lit(1)).cast("int")
        v = F.when(i % 2 == 1, v).when(v > 4, 2 * v - 9).otherwise(2 * v)
        return total + v

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.char_length(d), F.lit(1))), F.lit(0), add)
    return (F.char_length(d) > 0) & (total % 10 == 0)


def _parts_at_most_255(c: Column) -> Column:
    def small(p: Column) -> Column:
        p = F.ltrim(p, F.lit("0"))
        return (F.char_length(p) <= 3) & (F.coalesce(F.substr(p, F.lit(1), F.lit(3)).try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(c, r"\."), small)


def holds(kind: str, m: Column) -> Column:
    """Whether a match of a base pattern is one."""
    n = F.char_length(digits(m))
    if kind == "ip":
        return _parts_at_most_255(m)
    if kind == "card":
        return n.between(16, 19) & luhn(digits(m))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _holding(kind: str):
    return lambda m: holds(kind, m["s"])


def _named(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["s"].alias("s"))


def matches(text: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches, array<struct<start, end, s>> (code points, end exclusive). Places are running
    sums of lengths, taken by stretches of 64, so that a text of many matches takes no time that
    grows with their square."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    parts = F.split(text, pattern, -1)
    empty = F.from_json(F.lit("[]"), "array<struct<start: int, end: int, s: string>>")
    both = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda g, s: F.struct(F.char_length(g).alias("gap"), F.char_length(s).alias("n"), s.alias("s")))
    stretches = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / 64).cast("int")), lambda c: F.slice(x, 64 * c + 1, 64))

    def placed(part: Column, at: Column) -> Column:
        def put(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + x["n"]
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["s"].alias("s")))).alias("out"))

        return F.aggregate(part, F.struct(at.alias("at"), empty.alias("out")), put, lambda a: a["out"])

    def far(groups: Column) -> Column:
        """Each stretch with the length of all before it."""
        sums = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda a, x: a + x["gap"] + x["n"]))
        ends = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.zip_with(groups, F.slice(ends, 1, F.size(groups)), lambda g, at: F.struct(g.alias("g"), at.alias("at")))

    few = placed(both, F.lit(0))
    many = F.flatten(F.transform(far(stretches(both)), lambda x: placed(x["g"], x["at"])))
    has = F.contains(text, F.lit(needs)) if needs else F.regexp_like(text, F.lit(pattern))
    return F.when(has, F.when(F.size(found) <= 64, few).otherwise(many)).otherwise(empty)


def candidates(docs: DataFrame, text: bool = False) -> DataFrame:
    """doc_id, with ``text`` the text, and ``c``, array<struct<kind, start, end, base, over, bits,
    silver>> of the whole text, one row per row of ``docs``. ``bits`` are FEATURES; ``silver`` is
    the label to learn, null without one; ``over`` says that a base span overlaps it."""
    t = F.col("t")
    rows = docs.select("doc_id", text_of().alias("t"))
    rows = rows.select("doc_id", "t", *[matches(t, p, _NEEDS.get(k)).alias(k) for k, p in (BASE | LOOSE).items()])
    rows = rows.withColumns({k: F.filter(k, _holding(k)) for k in BASE if k != "email"})
    flat = [F.transform(k, _named(k)) for k in KINDS]
    rows = rows.withColumn("spans", F.flatten(F.array(*flat)))

    def looked_at(m: Column) -> Column:
        s, d = m["s"], digits(m["s"])
        n = F.char_length(d)
        before = F.substr(t, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24)))
        has = {
            "luhn": F.when(n.between(8, 19), luhn(d)).otherwise(False),
            "d8": n >= 8,
            "d13": n >= 13,
            "d16": n >= 16,
            "over19": n > 19,
            "quad": F.regexp_like(s, F.lit(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$")),
            "plus": s.startswith("+"),
            "parted": F.regexp_like(s, F.lit(r"[\x20().-]")),
            "letters": F.regexp_like(s, F.lit("[A-Za-z]")) & (n >= 3),
            "hexed": F.regexp_like(s, F.lit("^[0-9a-f]+$")),
            "long": F.char_length(s) >= 32,
            "quoted": F.regexp_like(before, F.lit("[\"'=:]\\s?$")),
            "marked": F.regexp_like(s, F.lit("[(-]")),
            "ending": F.regexp_like(s, F.lit(r"(?i)(?:\.|dot\)\x20|dot\]\x20)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|[a-z]{2})$")),
        }
        bits = sum((has[f].cast("int") * (1 << i) for i, f in enumerate(FEATURES)), F.lit(0))
        base = F.exists(F.col("known"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        # labels come from what the features do not see: words before a span, and base spans that a
        # candidate overlaps, as if these were masked; without either there is none
        told = F.regexp_like(before, F.lit(SECRET_CUES)) & (m["kind"] == "secret") | F.regexp_like(before, F.lit(MAIL_CUES)) & (m["kind"] == "handle") | (base | F.regexp_like(before, F.lit(NUMBER_CUES))) & (m["kind"] == "number")
        silver = F.when(told | m["kind"].isin(*BASE), True)
        for kind, cue in OTHER_CUES.items():
            silver = silver.when((m["kind"] == kind) & F.regexp_like(before, F.lit(cue)), False)
        return F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["kind"].isin(*BASE).alias("base"), base.alias("over"), bits.alias("bits"), silver.alias("silver"))

    known = F.filter("spans", lambda m: m["kind"].isin(*BASE))
    rows = rows.withColumn("known", F.when(F.size(F.filter("spans", lambda m: ~m["kind"].isin(*BASE))) > 0, known).otherwise(F.slice(known, 1, 0)))
    return rows.select("doc_id", *([F.col("t").alias("text")] if text else []), F.transform("spans", looked_at).alias("c"))


def _side(cells: dict, f: int) -> tuple[float, float]:
    """Newton steps of a leaf's two halves."""
    out = []
    for on in (0, 1):
        g = sum(w[0] for b, w in cells.items() if b >> f & 1 == on)
        h = sum(w[1] for b, w in cells.items() if b >> f & 1 == on)
        out.append((g / (h + 1.0), g * g / (h + 1.0)))
    return out


def boost(counts: dict[int, tuple[int, int]], rounds: int = 20, rate: float = 0.3) -> tuple[float, list]:
    """Gradient-boosted trees of depth two for log-loss on (negatives, positives) by feature
    bits. Returns the bias and trees (f, (g, leaf, leaf), (g, leaf, leaf))."""
    neg, pos = (sum(c[i] for c in counts.values()) for i in (0, 1))
    bias = math.log((pos + 1) / (neg + 1))
    score, trees, n = dict.fromkeys(counts, bias), [], len(FEATURES)
    for _ in range(rounds):
        cells = {}
        for b, (a, c) in counts.items():
            p = 1 / (1 + math.exp(-score[b]))
            cells[b] = (c - (a + c) * p, (a + c) * p * (1 - p))
        f = max(range(n), key=lambda i: sum(x[1] for x in _side(cells, i)))
        halves = []
        for on in (0, 1):
            part = {b: w for b, w in cells.items() if b >> f & 1 == on}
            g = max(range(n), key=lambda i: sum(x[1] for x in _side(part, i)))
            halves.append((g, *(round(rate * x[0], 6) for x in _side(part, g))))
        trees.append((f, *halves))
        for b in score:
            g, no, yes = halves[b >> f & 1]
            score[b] += yes if b >> g & 1 else no
    return bias, trees


def scored(bits: Column, model: tuple[float, list]) -> Column:
    """The trees as one SQL expression: the log-odds."""
    on = lambda f: bits.bitwiseAND(F.lit(1 << f)) != 0
    leaf = lambda h: F.when(on(h[0]), F.lit(h[2])).otherwise(F.lit(h[1]))
    return sum((F.when(on(f), leaf(b)).otherwise(leaf(a)) for f, a, b in model[1]), F.lit(model[0]))


def fit(cands: DataFrame, precision: float = 0.95) -> dict[str, tuple[tuple, float]]:
    """Per loose kind, the trees and the lowest log-odds from which on labels are right with
    ``precision``. Labels are the silver ones of all candidates that have one, and KNOWN: every
    kind has a model on a table of any size."""
    rows = cands.select(F.explode("c").alias("c")).where("c.silver IS NOT NULL").groupBy("c.kind", "c.bits", "c.silver").agg(F.count("*").alias("n")).collect()
    tables: dict = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for kind, known in KNOWN.items():
        for names, no, yes in known:
            cell = tables[kind][sum(1 << FEATURES.index(f) for f in names.split())]
            cell[0] += no
            cell[1] += yes
    for r in sorted(rows, key=lambda r: (r["kind"], r["bits"], r["silver"])):
        tables[r["kind"]][r["bits"]][int(r["silver"])] += r["n"]
    out = {}
    for kind in LOOSE:
        counts = {b: tuple(c) for b, c in tables[kind].items()}
        model = boost(counts)
        by = sorted(((_score(b, model), c) for b, c in counts.items()), reverse=True)
        neg = pos = 0
        at = math.inf
        for i, (s, (a, c)) in enumerate(by):
            neg, pos = neg + a, pos + c
            if pos >= precision * (neg + pos) and (i + 1 == len(by) or by[i + 1][0] < s):
                at = s
        out[kind] = (model, at)
    return out


def _score(bits: int, model: tuple[float, list]) -> float:
    total = model[0]
    for f, a, b in model[1]:
        g, no, yes = b if bits >> f & 1 else a
        total += yes if bits >> g & 1 else no
    return total


def _kept(cands: DataFrame) -> Column:
    """The spans that stay, from the candidates of a whole table."""
    models = fit(cands)

    def stays(c: Column) -> Column:
        out = c["base"]
        for kind, (model, at) in models.items():
            if at < math.inf:
                out = out | ((c["kind"] == kind) & ~c["over"] & (scored(c["bits"], model) >= at - 1e-9))
        return out

    return F.transform(F.filter("c", stays), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, array<struct<kind, start, end, base>>,
    ordered by kind as in KINDS, then start. Base spans always stay; a loose candidate is added
    where its score reaches its kind's threshold (at the threshold it is added, so ties are) and
    no base span overlaps it.

    A null text counts as empty and gives no spans; a null doc_id is told as it comes. Texts are
    searched whole, however long. Repeated rows give repeated results, and count as often in the
    fit; other columns are not read; an empty table gives no rows.
    """
    cands = stored(candidates(docs), "candidates")
    return cands.select("doc_id", _kept(cands).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id and ``redacted``: the text with [KIND] in the place of each span; of spans that
    overlap, the first (of equal starts the longest) names what is cut, to the end of the last."""
    cands = stored(candidates(docs, text=True), "candidates")
    rows = cands.select("doc_id", "text", _kept(cands).alias("spans"))
    spans = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))

    def put(acc: Column, x: Column) -> Column:
        gap = F.substr("text", acc["at"] + 1, x["start"] - acc["at"])
        new = F.concat(acc["out"], F.array(F.concat(gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))))
        apart = x["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(apart, new).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.aggregate(spans, start, put, lambda a: F.concat(F.array_join(a["out"], ""), F.substr("text", a["at"] + 1)))
    return rows.select("doc_id", F.when(F.size("spans") > 0, text).otherwise(F.col("text")).alias("redacted"))


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["base"])
    return rows.select("doc_id", *[number(k) for k in BASE], F.sha2(_told(base), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
