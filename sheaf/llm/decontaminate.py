"""Benchmark decontamination: template windows, hash-joined, with consistent slots.

Texts become words; numbers, names and units become typed placeholders. Windows of WINDOW words
are hashed as they are and as templates, and those of the documents that hash like one of the
benchmark join it. Hits are judged by occurrence, that is by the distance of their places in
document and item: there, slot values must map one to one. An item is held if an occurrence
covers enough of its windows, or a long run of them as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import arrow_rows, held, stored, text_hash, without_rows

WINDOW = 8
#: Words of a template window that must not be slots.
LEAST_PLAIN = 5
#: Items of fewer words than a window are one window of their own length; those of fewer words
#: than this are looked for only as whole sentences, as they stand in any text.
LEAST_WORDS = 4
#: Windows in a row, as they are, that tell a leak of any item: 13 words.
RUN = 6
#: Places by which an occurrence may shift, as where a name has two words.
SHIFT = 4
#: Benchmark windows looked for in one pass over the documents (16 MB broadcast).
MOST_WINDOWS = 1_000_000
MOST_WORDS = 150_000
UNITS = frozenset("mm cm m km inch inches foot feet ft yard yards mile miles g kg mg lb lbs oz pound pounds ton tons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years l ml litre litres liter liters gallon gallons dollar dollars usd euro euros eur cent cents percent degree degrees kmh mph watt watts volt volts".split())
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]")
_END, _TITLE, _NUMBER, _UNIT = 1, 2, 4, 8
_SLOT = {"number": np.uint64(0x9E3779B97F4A7C15), "name": np.uint64(0xC2B2AE3D27D4EB4F), "unit": np.uint64(0x165667B19E3779F9)}
_POWERS = np.array([pow(0x2545F4914F6CDD1D, i, 1 << 64) for i in range(WINDOW)], np.uint64)
_LOW = np.uint64(15)


class Codes(dict):
    """Memo: a token's hash of 60 bits (of its lower case) and four flags."""

    def __missing__(self, w: str) -> int:
        low = w.lower()
        if w in ".!?:\n":
            out = _END
        else:
            flags = _NUMBER if w[0].isdigit() else _UNIT if low in UNITS else _TITLE if len(w) > 1 and w[0].isupper() and w[1:].islower() else 0
            out = (xxhash.xxh3_64_intdigest(low) >> 4 << 4) | flags
        if len(self) >= MOST_WORDS:
            self.clear()
        if len(w) < 100:
            self[w] = out
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


class Words:
    """A text's words, their hashes, as they are and in templates, and where sentences begin."""

    def __init__(self, text: str, codes: Codes):
        tokens = _TOKEN.findall(text)
        v = np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))
        end = (v & _LOW) == _END
        first = np.ones(len(v) + 1, bool)  # also where the text ends
        first[1:] = end
        at = np.flatnonzero(~end)
        self.tokens, self.at = tokens, at
        self.starts = first[at]
        # a word ends a sentence if an end or nothing follows it
        self.ends = np.concatenate([end, [True]])[at + 1] if len(at) else np.zeros(0, bool)
        v = v[at]
        flags = v & _LOW
        self.plain = v >> np.uint64(4)
        title = flags == _TITLE
        name = title & ~self.starts
        early = title & self.starts
        if early.any() and name.any():  # a name inside a sentence is one at a sentence's start too
            name |= early & np.isin(self.plain, self.plain[name]) & ~np.isin(self.plain, self.plain[flags == 0])
        self.slot = name | (flags >= _NUMBER)
        self.form = np.where(flags == _NUMBER, _SLOT["number"], np.where(flags == _UNIT, _SLOT["unit"], np.where(name, _SLOT["name"], self.plain)))

    def __len__(self) -> int:
        return len(self.at)

    def __getitem__(self, i: int) -> str:
        return self.tokens[self.at[i]]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the windows of ``n`` words as they are and as templates (equal where there is no
        slot, or more than WINDOW - LEAST_PLAIN slots or half of the words), and numbers of slots."""
        m = len(self) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, int)
        a, b = np.full(m, n, np.uint64), np.full(m, n, np.uint64)
        for j in range(n):
            a += self.plain[j : j + m] * _POWERS[j]
            b += self.form[j : j + m] * _POWERS[j]
        total = np.concatenate([[0], np.cumsum(self.slot)])
        slots = total[n:] - total[:-n]
        a = _mix(a)
        fits = (slots > 0) & (slots <= min(WINDOW - LEAST_PLAIN, n // 2)) & (n >= LEAST_WORDS)
        return a, np.where(fits, _mix(b ^ np.uint64(0x5851F42D4C957F2D)), a), slots

    def values(self, i: int, n: int) -> list[str]:
        """"place in the window, tab, value" of the slots in a window."""
        return [f"{j}\t{self[i + j].lower()}" for j in range(n) if self.slot[i + j]]


SHAPE = "place int, hash long, templated boolean, slots array<string>"


def _rows_of(words: Words, sizes: list[int], wanted=None) -> Iterator[tuple]:
    """(place, hash, templated, slot values) of the windows, or of the wanted ones, of ``sizes``."""
    for n in sizes:
        a, b, _ = words.windows(n)
        for hashes, templated in ((a, False), (b, True)):
            at = np.arange(len(hashes))
            if templated:
                at = at[b != a]
            if n < LEAST_WORDS:
                at = at[words.starts[at] & words.ends[at + n - 1]]
            if wanted is not None and len(at):
                at = at[wanted(hashes[at])]
            for i in at.tolist():
                yield i, int(hashes[i].view(np.int64)), templated, words.values(i, n) if templated else []


_ROWS = pa.schema([("place", pa.int32()), ("hash", pa.int64()), ("templated", pa.bool_()), ("slots", pa.list_(pa.string()))])


def _batch(rows: list[tuple], first: list[pa.Field]) -> pa.RecordBatch:
    fields = [*first, *_ROWS]
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, fields)], schema=pa.schema(fields))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, size (words of the item's windows), dense (the window has slots, but is no
    template), place, hash, templated, slots of all windows of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = Words(text or "", codes)
                n = min(WINDOW, len(words))
                if n:
                    a, b, slots = words.windows(n)
                    dense = (slots > 0) & (a == b)
                    # an item that is itself a sentence part still is looked for as a whole one
                    words.starts[0] = words.ends[-1] = True
                    out += [(item, n, bool(dense[x[0]]), *x) for x in _rows_of(words, [n])]
            yield _batch(out, [pa.field("item_id", pa.int64()), pa.field("size", pa.int32()), pa.field("dense", pa.bool_())])

    return arrow_rows(benchmark.select(F.col("item_id").cast("long"), "text"), run, f"item_id long, size int, dense boolean, {SHAPE}")


def document_windows(docs: DataFrame, hashes: np.ndarray, sizes: list[int]) -> DataFrame:
    """doc_id, th, place, hash, templated, slots of the windows of ``sizes`` words that hash like a
    given one."""
    hashes = np.unique(hashes.view(np.uint64))
    table = np.zeros(1 << 20, bool)
    table[hashes & np.uint64((1 << 20) - 1)] = True
    sent = docs.sparkSession.sparkContext.broadcast((hashes, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = held("decontaminate", Codes)
        known, maybe = sent.value

        def wanted(h: np.ndarray) -> np.ndarray:
            out = maybe[h & np.uint64((1 << 20) - 1)]
            some = h[out]
            out[out] = known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some
            return out

        for batch in batches:
            out = []
            for i, th, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text"))):
                out += [(i, th, *x) for x in _rows_of(Words(text or "", codes), sizes, wanted)]
            yield _batch(out, [pa.field("doc_id", pa.int64()), pa.field("th", pa.int64())])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), "text")
    return arrow_rows(rows, run, f"doc_id long, th long, {SHAPE}")


def _longest_run(places):
    """Length of the longest run of neighbours in a sorted array."""
    none = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(acc, x):
        now = F.when(x == acc["last"] + 1, acc["now"] + 1).otherwise(1)
        return F.struct(x.alias("last"), now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    return F.aggregate(places, none, step, lambda a: a["best"])


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, run: int = RUN) -> DataFrame:
    """A row per document (doc_id and th, the text_hash) and item that it holds: doc_id, th,
    item_id, n_windows (of the item), n_plain (of these, those in the best occurrence as they
    are), n_template (those there as they are or as templates), longest_run (of n_plain),
    coverage, reworded.

    Hits of one occurrence, whose places in document and item differ alike up to SHIFT, are
    judged together. There an item's slot value stands for the document's value of most windows
    and the other way round (of ties the largest string): the map is one to one, and each window
    against it undoes one that fits. Coverage is n_plain / n_windows or, if larger, n_template
    less the windows against it, by the windows that could be templates or have no slots, as
    those dense with slots cannot be found reworded. An item is held from coverage ``least`` or a run of ``run``; it is reworded if it
    is held by templates only.

    Null or empty texts hold nothing, and items without words are in nothing. An item of fewer
    words than WINDOW is a window of its own length; of fewer than LEAST_WORDS, it is held only
    as a whole sentence. Texts are searched whole, however long. Repeated rows are one document
    if they share doc_id and text; rows of one item_id are one item; null ids are told as they
    come; other columns are not read. An empty table gives no rows.
    """
    items = stored(item_windows(benchmark), "windows")
    sizes = [r["size"] for r in items.select("size").distinct().orderBy("size").collect()]  # WINDOW rows at most
    keys = items.select("hash").distinct()
    n = keys.count()
    hits = None
    for part in range(max(1, -(-n // MOST_WINDOWS))):  # one pass, unless the benchmark is huge
        mine = keys if n <= MOST_WINDOWS else keys.where(F.pmod(F.xxhash64("hash"), F.lit(-(-n // MOST_WINDOWS))) == part)
        found = document_windows(docs if n else docs.limit(0), mine.toArrow().column("hash").to_numpy(), sizes)
        hits = found if hits is None else hits.unionByName(found)
    hits = stored(hits.distinct().select("doc_id", "th", "hash", "templated", F.col("place").alias("at"), F.col("slots").alias("doc_slots")), "hits")
    pairs = hits.join(items.select("item_id", "place", "hash", "templated", "slots").distinct(), ["hash", "templated"])
    shift = F.col("at") - F.col("place")
    both = F.array(2 * F.floor(shift / (2 * SHIFT)), 2 * F.floor((shift + SHIFT) / (2 * SHIFT)) + 1)  # one of the two holds any shifts SHIFT apart
    by = ["doc_id", "th", "item_id", "occurrence"]
    pairs = pairs.select("doc_id", "th", "item_id", "place", "templated", F.arrays_zip(F.col("slots").alias("item"), F.col("doc_slots").alias("doc")).alias("maps"), F.explode(both).alias("occurrence"))
    value = lambda c: F.substring_index(c, "\t", -1)
    told = pairs.where("templated").select(*by, F.explode("maps").alias("m")).groupBy(*by, value(F.col("m.item")).alias("item"), value(F.col("m.doc")).alias("doc")).agg(F.count("*").alias("n"))

    def chosen(key: str, other: str, name: str) -> DataFrame:
        best = told.groupBy(*by, key).agg(F.max_by(other, F.struct("n", other)).alias(other))
        return best.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(key, other))).alias(name))  # values of one item

    maps = chosen("item", "doc", "stands").join(chosen("doc", "item", "back").withColumnsRenamed({c: f"{c}_" for c in by}), [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in by])
    maps = maps.select(*[F.col(c).alias(f"_{c}") for c in by], "stands", "back")
    pairs = pairs.join(maps, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left")
    fits = lambda m: (F.try_element_at("stands", value(m["item"])) == value(m["doc"])) & (F.try_element_at("back", value(m["doc"])) == value(m["item"]))
    pairs = pairs.withColumn("fits", ~F.col("templated") | F.forall("maps", lambda m: F.coalesce(fits(m), F.lit(False))))
    places = lambda on: F.collect_set(F.when(on, F.col("place")))  # noqa: E731  (places of one item)
    got = pairs.groupBy(*by).agg(F.array_sort(places(~F.col("templated"))).alias("plain"), places(F.col("fits")).alias("fit"), places(~F.col("fits")).alias("against"))
    got = got.withColumns({"n_template": F.size("fit"), "n_against": F.size(F.array_except("against", "fit"))})
    whole = items.where("NOT templated").groupBy("item_id").agg(F.countDistinct("place").alias("n_windows"), F.countDistinct(F.when(~F.col("dense"), F.col("place"))).alias("n_open"))
    got = got.select(*by, "n_template", "n_against", F.size("plain").alias("n_plain"), _longest_run(F.col("plain")).alias("longest_run"))
    got = got.join(whole.withColumnRenamed("item_id", "_item"), F.col("item_id").eqNullSafe(F.col("_item")))
    by_plain = F.col("n_plain") / F.col("n_windows")
    by_template = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("n_template") - F.col("n_against"), F.col("n_open")), F.lit(0.0)))
    got = got.withColumns({"coverage": F.greatest(by_plain, by_template), "reworded": (by_plain < least) & (F.col("longest_run") < run)})
    got = got.where((F.col("coverage") >= least) | (F.col("longest_run") >= run))
    best = F.max(F.struct("coverage", "n_plain", "n_template", "longest_run", "n_windows", (~F.col("reworded")).alias("plainly")))
    got = got.groupBy("doc_id", "th", "item_id").agg(best.alias("b"), F.bool_and("reworded").alias("reworded"))
    told = [F.col(f"b.{c}").cast("long").alias(c) for c in ("n_windows", "n_plain", "n_template", "longest_run")]
    return got.select("doc_id", "th", "item_id", *told, F.col("b.coverage").alias("coverage"), "reworded")


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that hold no item, with their columns."""
    return without_rows(docs, contaminated(docs, benchmark, least))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("th")
