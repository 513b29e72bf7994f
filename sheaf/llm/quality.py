"""Quality classifier: Kneser-Ney perplexity under the trusted text of a language.

The model is an interpolated modified Kneser-Ney model of character n-grams: real characters,
without buckets, so the tables grow with the text. A second view is the sequence of the words'
shapes (case, mark, length, run of repeats). All of it is DataFrame work on counts sharded by
n-gram: sums, continuation counts, discounts, and for each n-gram that any document has, its
probability from joins of the orders.

Documents are dealt into blocks: ROWS neighbouring rows of an input file. One pass over the
texts gives each block's distinct n-grams with their trusted counts, and these rows, not the
texts, are joined with the sharded probabilities. What comes back to a block is one table in the
shared folder, bounded by the block's text, and a second pass sums it up per document.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.shared import arrow_rows, discard, held, new_folder, partitions, stored, text_hash

#: Views of a text and the lengths of their n-grams.
VIEWS = {"char": 5, "word": 3}
EDGE = "\x02"  # stands before a text, once less than an n-gram is long
#: Rows of an input file that make a block.
ROWS = 16_384
#: Slots of a table of n-grams (4 MB); those of more than so many distinct ones leave the task.
SLOTS, MOST_GRAMS = 1 << 20, 1 << 19
#: Rows of a table of languages that are broadcast at most; more are joined by shuffle.
MOST_LANGS = 10_000
#: Symbols of average trusted text that are added to each text, so that short ones vary less.
PRIOR = {"char": 100, "word": 20}
#: Bits are told in thousandths, this for none.
UNIT, NONE = 1000, 65_535
_MIX, _STEP, _FAR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SPACE, _UPPER, _LOWER, _DIGIT, _SYMBOL, _COMMA, _STOP = (1 << i for i in range(7))


def classes() -> np.ndarray:
    """What each code point is, as bits."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        b = _SPACE if c.isspace() else _DIGIT if c.isdigit() else _UPPER if c.isupper() else _LOWER if c.islower() else 0
        out[i] = b or (0 if c.isalnum() or c in "_.,;:!?'\"()-" else _SYMBOL)
    out[[ord(c) for c in ",;:"]] |= _COMMA
    out[[ord(c) for c in ".!?"]] |= _STOP
    return out


def mixed(cp: np.ndarray) -> np.ndarray:
    """64-bit hashes of symbols."""
    x = cp.astype(np.uint64)
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


def hashes(x: np.ndarray, order: int) -> np.ndarray:
    """64-bit hashes of all n-grams of ``order`` (3 or 5) of hashed symbols; never 0."""
    h = x[:-1] * _STEP
    h += x[1:]
    if order == 5:
        far = h[:-2] * _FAR
        far += h[2:]
        h = far
    n = len(x) - order + 1
    h = h[:n] * _STEP
    h += x[order - 1 :]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    h |= np.uint64(1)
    return h


class View:
    """Some texts' symbols in one array, edges before each text, and hashes of the n-grams that
    begin at each place, 0 for those that end in an edge. A text has as many as symbols (``n``),
    and they begin where its edges do."""

    def __init__(self, cp: np.ndarray, x: np.ndarray, n: np.ndarray, order: int):
        self.cp, self.n, self.order = cp, n, order
        self.begin = np.cumsum(n + order - 1) - n - order + 1
        self.empty = not n.any()
        if not self.empty:
            self.hash = hashes(x, order)
            out = (self.begin[1:, None] - np.arange(1, order)).ravel()
            self.hash[out[(out >= 0) & (out < len(self.hash))]] = 0

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of an integer a place of ``hash``, the texts' sums."""
        out = np.zeros(len(self.n), np.int64)
        some = np.flatnonzero(self.n)
        out[some] = np.add.reduceat(values, self.begin[some], dtype=np.int64)
        return out


def text_views(texts: list[str], kinds: np.ndarray) -> tuple[View, View]:
    """The views of some texts. Characters are code points (a zero, which numpy strings cannot end
    in, is U+FFFD). Words, which white space parts, are known by their case, last mark, length,
    digits and symbols; one that repeats those before it, by the length of the run, 100 at most."""
    order = VIEWS["char"]
    n = np.array([len(t) for t in texts], np.int64)
    cp = np.frombuffer("".join([EDGE * (order - 1) + t for t in texts]).encode("utf-32-le", "replace"), np.uint32)
    if not cp.all():
        cp = np.where(cp == 0, np.uint32(0xFFFD), cp)
    x = mixed(cp)
    chars = View(cp, x, n, order)
    kind = kinds[cp]
    begin = chars.begin
    kind[(begin[:, None] + np.arange(order - 1)).ravel()] = _SPACE
    word = (kind & _SPACE) == 0
    edge = np.diff(word.view(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    doc = np.searchsorted(begin, first, "right") - 1
    count = np.bincount(doc, minlength=len(texts))
    shape = np.zeros(0, np.uint32)
    if len(first):
        end = kind[last]
        kind *= word
        has = np.bitwise_or.reduceat(kind, first)
        mark = np.where(end & _COMMA, 1, np.where(end & _STOP, 2, 0))
        size = last - first + 1 - (mark > 0)
        case = np.where(has & _UPPER, np.where((has & _LOWER) | (size < 2), 1, 2), 0)
        shape = 5 + (case * 3 + mark) * 5 + np.searchsorted([1, 3, 6, 10], size)
        shape = np.where(has & _DIGIT, 60 + mark, shape)
        shape = np.where(has & _SYMBOL, 50 + case * 3 + mark, shape)
        x *= word
        total = np.add.reduceat(x, first)
        x *= np.arange(len(x), dtype=np.uint64)
        moment = np.add.reduceat(x, first)
        moment -= total * first.astype(np.uint64)  # a sum weighted by the place in the word
        same = np.zeros(len(first), bool)
        same[1:] = (total[1:] == total[:-1]) & (moment[1:] == moment[:-1]) & (doc[1:] == doc[:-1])
        k = np.arange(len(first))
        run = k - np.maximum.accumulate(np.where(same, 0, k))
        shape = np.where(same, 100 + np.minimum(run, 100), shape).astype(np.uint32)
    edges = VIEWS["word"] - 1
    cp = np.full(len(shape) + edges * len(texts), ord(EDGE), np.uint32)
    cp[np.arange(len(shape)) + edges * (doc + 1)] = shape
    return chars, View(cp, mixed(cp), count, VIEWS["word"])


def strings(rows: np.ndarray) -> np.ndarray:
    """Rows of code points as strings."""
    return np.ascontiguousarray(rows, np.uint32).view(f"<U{rows.shape[1]}").ravel()


class Places:
    """Where hashes stand in a list that grows: two slots each, and a sorted rest."""

    def __init__(self):
        self.keys = np.zeros(1024, np.uint64)
        self.slot = np.zeros(SLOTS, np.int32)
        self.rest, self.rest_at = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.n = 1  # place 0 is none's

    def _slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = np.uint64(SLOTS - 1)
        return ((h >> np.uint64(8)) & m).astype(np.int64), ((h >> np.uint64(36)) & m).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places, 0 for what is not there."""
        i = h >> np.uint64(8)
        i &= np.uint64(SLOTS - 1)
        at = self.slot[i.view(np.int64)]
        bad = np.flatnonzero(self.keys[at] != h)
        if len(bad):
            other = h[bad]
            second = self.slot[((other >> np.uint64(36)) & np.uint64(SLOTS - 1)).astype(np.int64)]
            second[self.keys[second] != other] = 0
            if len(self.rest):
                lost = np.flatnonzero(second == 0)
                i = np.minimum(np.searchsorted(self.rest, other[lost]), len(self.rest) - 1)
                second[lost] = np.where(self.rest[i] == other[lost], self.rest_at[i], 0)
            at[bad] = second
        return at

    def put(self, u: np.ndarray) -> None:
        """Add distinct hashes that are not there, in their order."""
        new = np.arange(self.n, self.n + len(u), dtype=np.int32)
        if self.n + len(u) > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros(max(len(self.keys), len(u)), np.uint64)])
        self.keys[self.n : self.n + len(u)] = u
        self.n += len(u)
        left = np.arange(len(u))
        for s in self._slots(u):
            free = left[self.slot[s[left]] == 0]
            self.slot[s[free]] = new[free]  # of some that want one slot the last gets it
            left = left[self.slot[s[left]] != new[left]]
        if len(left):
            self.rest = np.concatenate([self.rest, u[left]])
            order = np.argsort(self.rest)
            self.rest, self.rest_at = self.rest[order], np.concatenate([self.rest_at, new[left]])[order]


class Grams:
    """Distinct n-grams of a view, language and block, with counts in the trusted texts by fold."""

    def __init__(self, order: int):
        self.places = Places()
        self.rows = [np.zeros((1, order), np.uint32)]
        self.counts = np.zeros((2, 1), np.int64)

    def add(self, view: View, fold: int) -> None:
        """``fold`` is that of trusted texts, else 2."""
        at = self.places.find(view.hash)
        new = np.flatnonzero((at == 0) & (view.hash != 0))
        if len(new):
            u, i = np.unique(view.hash[new], return_index=True)
            self.places.put(u)
            self.rows.append(view.cp[new[i][:, None] + np.arange(view.order)])
            self.counts = np.concatenate([self.counts, np.zeros((2, len(u)), np.int64)], axis=1)
            if fold < 2:
                at[new] = self.places.find(view.hash[new])
        if fold < 2:
            self.counts[fold] += np.bincount(at, minlength=self.counts.shape[1])

    def told(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted n-grams and their counts."""
        text = strings(np.concatenate(self.rows)[1:])
        order = np.argsort(text)
        return text[order], self.counts[:, 1:][:, order]


def grouped(batch: pa.RecordBatch, key, columns: tuple) -> Iterator[tuple[tuple, list[tuple[int, str]]]]:
    """Texts of a batch, with their places in it, by key; up to some 500,000 characters at once."""
    groups: dict[tuple, list] = {}
    for k, (text, *cells) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", *columns)))):
        groups.setdefault(key(*cells), []).append((k, text))
    for k in sorted(groups):
        size, part = 0, []
        for x in groups[k]:
            part.append(x)
            size += len(x[1])
            if size > 500_000:
                yield k, part
                size, part = 0, []
        if part:
            yield k, part


BLOCK_GRAMS = "block long, view string, lang string, g string, c0 long, c1 long"


class Trusted:
    """The trusted ids of one block at a time, from its file under ``folder``."""

    def __init__(self, folder: str):
        self.store, self.root = _folder(folder)
        self.block, self.ids = None, frozenset()

    def has(self, block: int, doc_id: int | None) -> bool:
        if block != self.block:
            path = f"{self.root}/{block}.parquet"
            some = self.store.get_file_info(path).is_file
            self.block, self.ids = block, frozenset(pq.read_table(path, filesystem=self.store)["doc_id"].to_pylist() if some else ())
        return doc_id in self.ids


def block_grams(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """BLOCK_GRAMS of ``docs`` (block, doc_id, lang, fold, text): distinct n-grams of each block, with
    their counts in its trusted texts by fold. A task may tell one twice, in parts. ``folder`` has the
    trusted ids of each block (see write_blocks): no text is shuffled for them, however many there are. Without it they are told by the column trusted."""
    told = "trusted" if folder is None else "doc_id"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = held("quality", Held).kinds
        has = Trusted(folder).has if folder else lambda block, trusted: trusted
        parts: dict[tuple[str, str], Grams] = {}
        at = None

        def out() -> Iterator[pa.RecordBatch]:
            for view, lang in sorted(parts):
                g, c = parts.pop((view, lang)).told()
                for i in range(0, len(g), 50_000):
                    n = len(g[i : i + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, at)), pa.array([view] * n), pa.array([lang] * n), pa.array(g[i : i + n].tolist()), pa.array(c[0, i : i + n]), pa.array(c[1, i : i + n])], ["block", "view", "lang", "g", "c0", "c1"])

        for batch in batches:
            for (block, lang, fold), texts in grouped(batch, lambda b, x, f, i: (b, x, f if has(b, i) else 2), ("block", "lang", "fold", told)):
                if block != at or len(parts) > 16 or sum(p.places.n for p in parts.values()) > MOST_GRAMS:
                    yield from out()
                    at = block
                for (view, order), v in zip(VIEWS.items(), text_views([t for _, t in texts], kinds)):
                    if not v.empty:
                        if (view, lang) not in parts:
                            parts[view, lang] = Grams(order)
                        parts[view, lang].add(v, fold)
        yield from out()

    return arrow_rows(docs.select("block", told, "lang", "fold", "text"), run, BLOCK_GRAMS)


def orders(counts: DataFrame, order: int) -> list[DataFrame]:
    """(lang, g, c0, c1) of the orders from 1 on: counts in trusted texts by fold for the highest,
    and for a lower one the number of different symbols that stand before it there. N-grams that
    only documents have are rows with zeros."""
    out = [counts]
    for _ in range(order - 1):
        longer = out[0]
        cut = longer.select("lang", F.substring("g", 2, order).alias("g"), "c0", "c1")
        out.insert(0, stored(cut.groupBy("lang", "g").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in ("c0", "c1")]), "order"))
    return out


def _near(df: DataFrame) -> DataFrame:
    """A stored table of languages, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= MOST_LANGS else df


def discounts(tables: list[DataFrame]) -> DataFrame:
    """Per language, order k and fold f the discounts d1_k_f to d3_k_f of modified Kneser-Ney, and
    v_f, the number of characters known and one more, null without trusted text."""
    out = None
    for k, t in enumerate(tables, 1):
        n = {(i, f): F.count_if(F.col(f"c{f}") == i) for i in (1, 2, 3, 4) for f in (0, 1)}
        seen = {f: F.count_if(F.col(f"c{f}") > 0) for f in (0, 1)}
        row = t.groupBy("lang").agg(*[n[i, f].alias(f"n{i}_{f}") for i, f in n], *[seen[f].alias(f"seen_{f}") for f in (0, 1)])
        cols = []
        for f in (0, 1):
            y = F.try_divide(F.col(f"n1_{f}"), F.col(f"n1_{f}") + 2 * F.col(f"n2_{f}"))
            for i in (1, 2, 3):
                d = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}_{f}"), F.col(f"n{i}_{f}"))
                cols.append(F.when(d.isNotNull(), F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), d))).otherwise(0.5).alias(f"d{i}_{k}_{f}"))
            if k == 1:
                cols.append(F.when(F.col(f"seen_{f}") > 0, F.col(f"seen_{f}") + 1).alias(f"v_{f}"))
        row = row.select("lang", *cols)
        out = row if out is None else out.join(row, "lang")
    return stored(out, "discounts")


def probabilities(tables: list[DataFrame]) -> DataFrame:
    """(lang, g, p0, p1): of each n-gram of the highest order the probability of its last symbol
    after the others, by the model of each fold; null without one."""
    known = _near(discounts(tables))
    low = None
    for k, t in enumerate(tables, 1):
        rows = t.join(known, "lang").withColumn("ctx", F.substring("g", 1, k - 1))
        off = {}
        for f in (0, 1):
            c = F.col(f"c{f}")
            off[f] = F.when(c == 0, 0.0).when(c == 1, F.col(f"d1_{k}_{f}")).when(c == 2, F.col(f"d2_{k}_{f}")).otherwise(F.col(f"d3_{k}_{f}"))
        rows = rows.withColumns({f"off{f}": off[f] for f in (0, 1)})
        w = Window.partitionBy("lang", "ctx")
        rows = rows.withColumns({f"total{f}": F.sum(f"c{f}").over(w) for f in (0, 1)} | {f"offs{f}": F.sum(f"off{f}").over(w) for f in (0, 1)})
        share = {f: F.coalesce(F.try_divide(F.col(f"c{f}") - F.col(f"off{f}"), F.col(f"total{f}")), F.lit(0.0)) for f in (0, 1)}
        left = {f: F.coalesce(F.try_divide(F.col(f"offs{f}"), F.col(f"total{f}")), F.lit(1.0)) for f in (0, 1)}
        if low is None:
            p = [(share[f] + left[f] / F.col(f"v_{f}")).alias(f"p{f}") for f in (0, 1)]
            out = rows.select("lang", "g", *p)
        else:
            rows = rows.select("lang", "g", F.substring("g", 2, k).alias("tail"), *[share[f].alias(f"share{f}") for f in (0, 1)], *[left[f].alias(f"left{f}") for f in (0, 1)])
            lower = low.select("lang", F.col("g").alias("tail"), F.col("p0").alias("low0"), F.col("p1").alias("low1"))
            out = rows.join(lower, ["lang", "tail"]).select("lang", "g", *[(F.col(f"share{f}") + F.col(f"left{f}") * F.col(f"low{f}")).alias(f"p{f}") for f in (0, 1)])
        low = stored(out, "probabilities")
    return low


def _folder(uri: str):
    """File system and path of a folder that all machines share."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def write_tables(grams: DataFrame, model: DataFrame, folder: str) -> None:
    """A file a block under ``folder``: its n-grams with their bits, from a join by n-gram with
    ``model`` (view, lang, g, p0, p1)."""
    bits = [F.coalesce(F.least(F.lit(NONE - 1), F.round(-F.log2(f"p{f}") * UNIT)), F.lit(NONE)).cast("int").alias(f"b{f}") for f in (0, 1)]
    rows = grams.select("block", "view", "lang", "g").join(model.select("view", "lang", "g", *bits), ["view", "lang", "g"])
    write_blocks(rows.select("block", "view", "lang", "g", "b0", "b1"), ["view", "lang", "g"], ["view", "lang"], folder)


def write_blocks(rows: DataFrame, order: list[str], words: list[str], folder: str) -> None:
    """A file a block under ``folder``: its ``rows``, sorted by ``order``, with ``words`` in dictionaries."""
    rows = rows.repartition(partitions(rows.sparkSession), "block").sortWithinPartitions("block", *order)
    store, root = _folder(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _folder(folder)
        at, waiting, done = None, [], []

        def write() -> None:
            if waiting:
                temp = f"{root}/.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(temp) as out:
                    pq.write_table(pa.Table.from_batches(waiting).drop_columns("block"), out, compression="zstd", use_dictionary=words or False)
                store.move(temp, f"{root}/{at}.parquet")  # an attempt that runs again writes the same rows
                done.append(at)

        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for a, z in zip(cuts, cuts[1:]):
                if a < z:
                    if block[a] != at:
                        write()
                        at, waiting = int(block[a]), []
                    waiting.append(batch.slice(a, z - a))
        write()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["block"])

    stored(arrow_rows(rows, run, "block long", slice_rows=0), "written")


class Table:
    """Bits of the n-grams of a view, language and block, by fold of the model."""

    def __init__(self, whole: pa.Table, view: str, lang: str):
        order = VIEWS[view]
        mine = whole.filter(pc.and_(pc.equal(whole.column("view"), view), pc.equal(whole.column("lang"), lang)))
        cp = np.array(mine.column("g").to_pylist(), f"<U{order}").view(np.uint32)
        h, first = np.unique(hashes(mixed(cp), order)[::order], return_index=True)
        self.places = Places()
        self.places.put(h)
        self.bits = [np.concatenate([[0], mine.column(c).to_numpy()[first]]).astype(np.int32) for c in ("b0", "b1")]

    def sums(self, view: View, fold: int) -> list[float | None]:
        """Of some texts, none without a model or symbols."""
        bits = self.bits[fold]
        if bits[-1] == NONE:  # then all are
            return [None] * len(view.n)
        sums = view.sums(bits[self.places.find(view.hash)])
        return [x / UNIT if n else None for x, n in zip(sums.tolist(), view.n.tolist())]


class Held:
    """What a Python worker keeps: the classes of code points, and the tables of the last block, as
    neighbouring tasks often have rows of one block."""

    def __init__(self):
        self.kinds, self.at, self.whole, self.tables = classes(), None, None, {}

    def table(self, store, root: str, block: int, view: str, lang: str) -> Table:
        if (root, block) != self.at:
            self.whole, self.tables = None, {}
            with store.open_input_file(f"{root}/{block}.parquet") as f:
                self.whole = pq.read_table(f)
            self.at = root, block
        if (view, lang) not in self.tables:
            if len(self.tables) >= 16:
                self.tables.clear()
            self.tables[view, lang] = Table(self.whole, view, lang)
        return self.tables[view, lang]


SCORES = "doc_id long, th long, lang string, " + ", ".join(f"{v}_n long, {v}_bits double" for v in VIEWS)


def perplexities(docs: DataFrame, folder: str) -> DataFrame:
    """SCORES of ``docs`` (block, doc_id, lang, fold, text): for each view the symbols and bits (null
    without a model or symbols), by the tables of their blocks and the model of the other fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _folder(folder)
        mine = held("quality", Held)
        for batch in batches:
            got: dict[str, list] = {f"{v}_{x}": [None] * batch.num_rows for v in VIEWS for x in ("n", "bits")}
            for (block, lang, fold), texts in grouped(batch, lambda *x: x, ("block", "lang", "fold")):
                for view, v in zip(VIEWS, text_views([t for _, t in texts], mine.kinds)):
                    bits = [None] * len(texts)
                    if not v.empty:
                        bits = mine.table(store, root, block, view, lang).sums(v, 1 - fold)
                    for (k, _), n, b in zip(texts, v.n.tolist(), bits):
                        got[f"{view}_n"][k], got[f"{view}_bits"][k] = n, b
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), batch.column("lang"), *[pa.array(x, pa.float64() if c.endswith("bits") else pa.int64()) for c, x in got.items()]], ["doc_id", "th", "lang", *got])

    return arrow_rows(docs.select("block", "doc_id", text_hash().alias("th"), "lang", "fold", "text"), run, SCORES)


def _in_blocks(docs: DataFrame) -> DataFrame:
    """block, doc_id, lang, fold, text. A block is a property of a row (its file and place there),
    so it is the same in both passes however they are dealt; a table that does not come from
    Parquet files is written to some first."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    rows = [F.col("doc_id").cast("long").alias("doc_id"), lang, F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2)).cast("int").alias("fold"), F.coalesce("text", F.lit("")).alias("text")]
    block = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / ROWS)).alias("block")
    try:
        return docs.select(block, *rows)
    except AnalysisException:
        return stored(docs.select("doc_id", "lang", "text"), "texts").select(block, *rows)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = 0.999) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (text_hash), lang, the perplexities char and word,
    their limits char_limit and word_limit, and kept.

    Trusted are all documents that ``labels`` calls of quality 1 and not toxic. Documents are in two folds, by hash of
    doc_id, and each is held to the model of the other fold's trusted texts: no text is judged
    by a model that has seen it, trusted ones neither, so limits do not come out too low where
    trusted text is scarce. A document goes if a perplexity is above its language's limit, the
    ``quantile`` over that language's trusted documents (at the limit it stays, so ties stay).

    One without text, or in a language without trusted text in the other fold, stays: there is
    nothing against it. A null language is a language of its own, told as null; a null doc_id is
    never trusted; labels that are null are not trusted, repeated ones count once. Repeated
    documents are scored alike, and count as often as they come. Texts are scored whole, however
    long. Other columns are not read; empty tables give no rows, or rows that are all kept.
    """
    rows = _in_blocks(docs)
    ids = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    ids = stored(ids, "trusted")
    marks = new_folder(docs.sparkSession, "marks")
    write_blocks(rows.select("block", "doc_id").join(ids, "doc_id").select("block", "doc_id"), ["doc_id"], [], marks)
    found = stored(block_grams(rows, marks), "grams")
    model = None
    for view, order in VIEWS.items():
        tables = orders(stored(found.where(F.col("view") == view).groupBy("lang", "g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "counts"), order)
        mine = probabilities(tables).withColumn("view", F.lit(view))
        discard(*tables)
        model = mine if model is None else model.unionByName(mine)
    folder = new_folder(docs.sparkSession, "tables")
    write_tables(found, model, folder)
    discard(found, model)
    scores = stored(perplexities(rows, folder), "perplexities")
    mean = scores.join(ids, "doc_id", "left_semi").groupBy("lang").agg(*[(F.sum(f"{v}_bits") / F.sum(f"{v}_n")).alias(f"{v}_mean") for v in VIEWS])
    scores = scores.join(_near(stored(mean, "means")), "lang", "left")
    smooth = {v: F.when(F.col(f"{v}_n") > 0, F.pow(F.lit(2.0), (F.col(f"{v}_bits") + PRIOR[v] * F.col(f"{v}_mean")) / (F.col(f"{v}_n") + PRIOR[v]))) for v in VIEWS}
    scores = scores.select("doc_id", "th", "lang", *[smooth[v].alias(v) for v in VIEWS])
    limit = scores.join(ids, "doc_id", "left_semi").groupBy("lang").agg(*[F.percentile_approx(v, quantile, 10_000).alias(f"{v}_limit") for v in VIEWS])
    kept = F.lit(True)
    for v in VIEWS:
        kept = kept & F.coalesce(F.col(v) <= F.col(f"{v}_limit"), F.lit(True))
    out = scores.join(_near(stored(limit, "limits")), "lang", "left")
    return out.select("doc_id", "th", F.when(F.col("lang") != "", F.col("lang")).alias("lang"), *VIEWS, *[f"{v}_limit" for v in VIEWS], kept.alias("kept"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("th")
