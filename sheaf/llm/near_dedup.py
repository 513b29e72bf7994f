"""Near dedup: chosen-path set similarity join over word shingles.

Equal shingle sets are one class first. Each of TREES trees deals the classes to nodes by a
minwise token; a node of at most SMALL classes is compared exhaustively, a larger one branches
twice by its next tokens, or is compared block by block where branching does not pay; its class
with the most documents is compared with all others before. Comparing means: signatures pick
what may be similar, then whole sets confirm each link. Only links that join parts leave a
comparison, so a group of any size gives a link a class and node, not all its pairs.

Two branches keep a pair of similarity s together in one leaf at least with probability p,
p = 1 - (1 - s * p) ** 2 at any depth: 0.969 for 0.85, 0.937 for 0.8. So were functions
independent, 12 trees would lose a pair with (1 - s * p) ** 12, 9e-10 and 6e-8, however large
the node; there are FUNCTIONS of them in all, so the true loss is larger where few agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import arrow_rows, held, partitions, stored, text_hash

FUNCTIONS, TREES, STEP, SMALL = 64, 12, 5, 2048
WIDTH, LEAST = 3, 85
MOST_WORDS = 150_000
#: Items of a cluster's sets that are looked at once, and columns of a membership matrix (8 MB).
MOST_ITEMS, COLUMNS = 500_000, 1024
#: Hubs that are broadcast at most (7 MB); more are joined by shuffle.
MOST_HUBS = 100_000
_R = np.random.default_rng(20_240_601)
_MULTIPLIERS = _R.integers(1, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _R.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Codes(dict):
    """Memo of word hashes."""

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) >= MOST_WORDS:
            self.clear()
        if len(w) < 100:
            self[w] = h
        return h


def codes() -> Codes:
    return held("near_dedup", Codes)


def shingles(text: str | None, memo: Codes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes (64 bits) of the text's shingles. bytes.lower() and bytes.split()
    know A-Z and the blanks of [\\x20\\x09-\\x0D] only."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    if not n:
        return h
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out += h[j : j + len(out)] * _PLACE[j]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """FUNCTIONS minwise values, 32 bits each."""
    low = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 4096):
        low = np.minimum(low, (s[i : i + 4096, None] * _MULTIPLIERS).min(axis=0))
    return (low >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, th, n_shingles, set_id (128 bits), sig, low (a byte of each value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = codes()
        for batch in batches:
            n, ids, sigs, lows = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, memo, width)
                g = signature(s)
                n.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()))
                sigs.append(g.tobytes())
                lows.append((g & np.uint32(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in (ids, sigs, lows)]], ["doc_id", "th", "n_shingles", "set_id", "sig", "low"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), "text")
    return arrow_rows(rows, run, "doc_id long, th long, n_shingles long, set_id binary, sig binary, low binary")


def least_alike(least: int) -> int:
    """Of FUNCTIONS signature bytes, so many must agree for a pair to be looked at: five standard
    deviations under what a pair of similarity ``least`` percent has."""
    p = least / 100
    return math.floor(FUNCTIONS * p - 5 * math.sqrt(FUNCTIONS * p * (1 - p)))


def _token(function):
    """A function's token, four bytes of the signature."""
    return F.substring(F.col("sig"), (4 * function + 1).cast("int"), F.lit(4))


def _blocks(large: DataFrame, small: int) -> DataFrame:
    """(node, tree, rep): all pairs of a large node's classes, as nodes of two blocks of about
    ``small`` / 2 classes each. The trees' numbers come after those of whole nodes."""
    b = F.ceil(2 * F.col("n") / small).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(7)), b).cast("int")
    rows = large.select("node", "tree", "rep", own.alias("i"), F.explode(F.sequence(F.lit(0), b - 1)).alias("j")).where("i <> j")
    return rows.select(F.xxhash64("node", F.least("i", "j"), F.greatest("i", "j")).alias("node"), (F.col("tree") + TREES).alias("tree"), "rep")


def _met(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """``rows`` with the figures of their nodes. Nodes of more than 1/4p of all rows, p the number
    of partitions, are 4p at most: their figures are broadcast, and their rows are not dealt."""
    p = partitions(rows.sparkSession)
    most = (sums.agg(F.sum("n")).first()[0] or 0) / (4 * p)
    hot = sums.where(F.col("n") > max(most, SMALL))
    names = [*rows.columns, "n", "hub"]
    near = rows.join(F.broadcast(hot), "node").select(*names)
    rest = rows.join(F.broadcast(hot.select("node")), "node", "left_anti").join(sums.where(F.col("n") <= max(most, SMALL)), "node")
    return near.unionByName(rest.select(*names))


def nodes(classes: DataFrame, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """(node, tree, rep) of nodes with 2 to about ``small`` classes, and (hub, rep) for those that had more.

    Level by level; a level takes only the classes of larger nodes. Each of these branches
    twice, by two functions that its path has not used. Where branching does not pay, as a node
    kept more than half of its parent's classes, or has 4 * ``small`` at most, all its pairs
    are compared, block by block. So a node of n classes gives n * n / ``small`` rows a tree at most,
    up to a factor of four.
    """
    rows = classes.select("rep", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig", "size")
    first = (F.col("tree") * STEP % FUNCTIONS).cast("int")
    rows = rows.select("rep", "size", "tree", F.array(first).alias("used"), F.lit(None).cast("long").alias("above"), F.xxhash64("tree", _token(first)).alias("node"))
    done, hubs = None, None
    while True:
        sums = rows.groupBy("node").agg(F.count("*").alias("n"), F.max(F.struct(F.col("size"), (-F.col("rep")).alias("neg"))).alias("top")).where("n > 1")
        sums = stored(sums.select("node", "n", (-F.col("top.neg")).alias("hub")), "sums")
        met = stored(_met(rows, sums), "nodes")
        here = met.where(F.col("n") <= small).select("node", "tree", "rep")
        done = here if done is None else done.unionByName(here)
        large = met.where(F.col("n") > small)
        if large.isEmpty():
            break
        star = large.where("rep <> hub").select("hub", "rep")
        hubs = star if hubs is None else hubs.unionByName(star)
        whole = (F.col("n") <= 4 * small) | F.coalesce(2 * F.col("n") > F.col("above"), F.lit(False)) | (F.size("used") == FUNCTIONS)
        done = done.unionByName(_blocks(large.where(whole), small))
        rows = large.where(~whole).select("rep", "size", "tree", "used", "node", F.col("n").alias("above"), F.explode(F.array(F.lit(0), F.lit(1))).alias("branch")).join(classes.select("rep", "sig"), "rep")
        left = F.array_except(F.sequence(F.lit(0), F.lit(FUNCTIONS - 1)), "used")
        rows = rows.withColumn("f", F.get(left, F.pmod(F.xxhash64("node") + F.col("branch"), F.size(left)).cast("int")))
        path = F.xxhash64("node", "branch", _token(F.col("f")))
        rows = rows.select("rep", "size", "tree", F.concat("used", F.array("f")).alias("used"), "above", path.alias("node"))
    if hubs is None:
        hubs = classes.limit(0).select(F.col("rep").alias("hub"), "rep")
    return done, hubs.distinct()


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of a stream sorted by ``key``, with the groups' bounds."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() == k[-1]:
            held.append(batch)
            continue
        cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
        if held or cut:
            yield _bounds(pa.Table.from_batches([*held, batch.slice(0, cut)] if cut or not held else held), key)
        held = [batch.slice(cut)]
    if held:
        yield _bounds(pa.Table.from_batches(held), key)


def _bounds(t: pa.Table, key: str) -> tuple[pa.Table, np.ndarray]:
    k = t.column(key).to_numpy()
    return t, np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])


def _parts(near: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """Connected parts of a symmetric matrix, each as (place, the place it was reached from)."""
    open_ = np.ones(len(near), bool)
    for seed in range(len(near)):
        if not open_[seed]:
            continue
        open_[seed] = False
        part = [(seed, seed)]
        for i, _ in part:  # grows while it is walked
            new = np.flatnonzero(near[i] & open_)
            open_[new] = False
            part += [(int(j), i) for j in new]
        yield part


def _alike(low: np.ndarray, least: int) -> np.ndarray:
    out = np.empty((len(low), len(low)), bool)
    for i in range(len(low)):
        out[i] = (low == low[i]).sum(axis=1) >= least
    return out


def _shared(own: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the sets' intersections, at least where ``pairs`` is true: by pair if these are
    few, else by products of membership matrices over the items that two sets or more have."""
    n = len(own)
    out = np.zeros((n, n), np.float32)
    at = np.argwhere(np.triu(pairs, 1))
    if len(at) <= 4 * n:
        for i, j in at:
            out[i, j] = out[j, i] = len(np.intersect1d(own[i], own[j], assume_unique=True))
        return out
    # sets are sorted hashes: they are cut into ranges of hashes, so that few items are held at once
    cuts = (np.arange(1, parts, dtype=object) * (1 << 64) // parts).astype(np.uint64) if (parts := -(-sum(map(len, own)) // MOST_ITEMS)) > 1 else np.zeros(0, np.uint64)
    ends = [np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]]) for x in own]
    for k in range(len(cuts) + 1):
        part = [x[e[k] : e[k + 1]] for x, e in zip(own, ends)]
        _, item, count = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        often = count > 1
        column = (np.cumsum(often, dtype=np.int32) - 1)[item]
        row = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in part])
        kept = often[item]
        row, column = row[kept], column[kept]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, int(often.sum()), COLUMNS):
            a, z = np.searchsorted(column, [first, first + COLUMNS])
            m = np.zeros((n, COLUMNS), np.float32)
            m[row[a:z], column[a:z] - first] = 1
            out += m @ m.T
    return out


def clusters(placed: DataFrame, least: int) -> DataFrame:
    """(cluster, rep, tree): of each node (node, tree, rep, low), the parts whose signatures may
    be similar. Like parts of different nodes have one name, and the number of the first tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in _runs(batches, "node"):
            reps, trees = t.column("rep").to_numpy(), t.column("tree").to_numpy()
            low = np.frombuffer(b"".join(t.column("low").to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
            names, members, told = [], [], []
            sizes = np.diff(at)
            two = at[:-1][sizes == 2]
            alike = two[(low[two] == low[two + 1]).sum(axis=1) >= least]
            parts = [(trees[i], reps[i : i + 2]) for i in alike.tolist()]
            for a, n in zip(at[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                for part in _parts(_alike(low[a : a + n], least)):
                    if len(part) > 1:
                        parts.append((trees[a], reps[a : a + n][[i for i, _ in part]]))
            for tree, p in parts:
                p = np.unique(p)
                told += [int(tree)] * len(p)
                names += [xxhash.xxh3_64_intdigest(p.tobytes()) - (1 << 63)] * len(p)
                members.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.concatenate(members) if members else [], pa.int64()), pa.array(told, pa.int32())], ["cluster", "rep", "tree"])

    n = partitions(placed.sparkSession)
    rows = placed.repartition(n, "node").sortWithinPartitions("node")
    return rows.mapInArrow(run, "cluster long, rep long, tree int").groupBy("cluster", "rep").agg(F.min("tree").alias("tree"))


def hub_pairs(hubs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(cluster, rep, tree -1): pairs of a hub and a class of its node that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, FUNCTIONS) for c in ("low", "hub_low"))
            on = (x == y).sum(axis=1) >= least
            reps, hub = (b.column(c).to_numpy()[on] for c in ("rep", "hub"))
            names = [xxhash.xxh3_64_intdigest(np.unique([i, j]).tobytes()) - (1 << 63) for i, j in zip(reps, hub)]
            both = np.stack([reps, hub], axis=1).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(names, np.int64), 2)), pa.array(both, pa.int64()), pa.array(np.full(len(both), -1), pa.int32())], ["cluster", "rep", "tree"])

    own = classes.select("rep", "low")
    top = stored(hubs.select("hub").distinct().join(classes.select(F.col("rep").alias("hub"), F.col("low").alias("hub_low")), "hub"), "hubs")
    rows = hubs.join(own, "rep").join(F.broadcast(top) if top.count() <= MOST_HUBS else top, "hub").select("rep", "hub", "low", "hub_low")
    return rows.mapInArrow(run, "cluster long, rep long, tree int")


def whole_sets(docs: DataFrame, reps: DataFrame, width: int = WIDTH) -> DataFrame:
    """rep, items (the sorted set, 8 bytes each) of the classes in ``reps`` (rep, set_id, and
    ``first`` and ``th``, a document that has the set and its text_hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = codes()
        for batch in batches:
            keep, items = [], []
            for rep, want, text in zip(*(batch.column(c).to_pylist() for c in ("rep", "set_id", "text"))):
                s = shingles(text, memo, width).tobytes()
                if xxhash.xxh3_128_digest(s) == want:
                    keep.append(rep)
                    items.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(items, pa.binary())], ["rep", "items"])

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text_hash().alias("_th"), "text")
    rows = rows.join(reps, F.col("_id").eqNullSafe(F.col("first")) & (F.col("_th") == F.col("th"))).select("rep", "set_id", "text")
    return arrow_rows(rows, run, "rep long, items binary").dropDuplicates(["rep"])


def confirmed(members: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """(a, b), a > b: links of the clusters (cluster, rep, low, part) with 100 * intersection >=
    ``least`` * union on whole sets, without those inside a part or that others imply."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in _runs(batches, "cluster"):
            reps, part = t.column("rep").to_numpy(), t.column("part").to_numpy()
            low = np.frombuffer(b"".join(t.column("low").to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
            items = t.column("items")
            out: list[tuple[int, int]] = []
            for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                own = [np.frombuffer(items[i].as_py(), np.uint64) for i in range(a, z)]
                size = np.array([len(x) for x in own], np.float64)
                same = part[a:z, None] == part[None, a:z]
                may = _alike(low[a:z], least_alike(least)) & ~same
                for i in range(z - a):  # row by row: no more matrices of the cluster's square
                    may[i] &= 100 * np.minimum(size[i], size) >= least * np.maximum(size[i], size)
                both = _shared(own, may)
                linked = np.zeros_like(may)
                for i in range(z - a):
                    s = both[i].astype(np.float64)
                    linked[i] = may[i] & (100 * s >= least * (size[i] + size - s))
                del may, both
                for found in _parts(linked | same):
                    out += [(int(max(reps[a + i], reps[a + j])), int(min(reps[a + i], reps[a + j]))) for i, j in found if linked[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    n = partitions(members.sparkSession)
    rows = members.join(sets, "rep").repartition(n, "cluster").sortWithinPartitions("cluster", "rep")
    return rows.select("cluster", "rep", "part", "low", "items").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(rep, part): each linked class and the class of the smallest name that it reaches, by alternating
    large and small stars. Rounds grow with the logarithm of the parts' size; each is written to
    the shared folder."""
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    told = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = stored(small.where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == told:
            return links.select(F.col("a").alias("rep"), F.col("b").alias("part"))
        told = now


def near_components(docs: DataFrame, width: int = WIDTH, least: int = LEAST, small: int = SMALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (text_hash), n_shingles, component_id, kept.

    Sets are of ``width``-word shingles of the A-Z lower-cased text, or of all words where there
    are fewer. Null or empty texts, and texts of blanks, have none and are linked with nothing.
    Equal sets are linked. Rows that share a doc_id are sets of their own; of those of a
    component one is kept, the one with the smallest th, and its like in doc_id and text. A
    null doc_id is linked as others, is never a component_id, unless nothing else is linked with
    it, and is kept only then. Whole texts count, however long. An empty table gives no rows;
    other columns are not read.
    """
    rows = stored(signatures(docs, width), "signatures")
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    classes = rows.where("n_shingles > 0").groupBy("set_id").agg(F.min(who).alias("who"), F.count("*").alias("size"), F.first("sig").alias("sig"), F.first("low").alias("low"))
    classes = stored(classes.withColumns({"rep": F.xxhash64("set_id"), "first": F.col("who.doc_id"), "th": F.col("who.th")}), "classes")
    placed, hubs = nodes(classes, small)
    found = clusters(placed.join(classes.select("rep", "low"), "rep"), least_alike(least))
    found = stored(found.unionByName(hub_pairs(hubs, classes, least_alike(least))).groupBy("cluster", "rep").agg(F.min("tree").alias("tree")), "clusters")
    need = found.select("rep").distinct().join(classes.select("rep", "set_id", "first", "th"), "rep")
    sets = stored(whole_sets(docs, need, width), "sets")
    lows = classes.select("rep", "low")
    # The hubs and two trees give most links; then only clusters that may join parts count.
    early = found.where("tree < 2").join(lows, "rep").withColumn("part", F.col("rep"))
    parts = components(confirmed(early, sets, least))
    named = found.where("tree >= 2").join(parts, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    open_ = named.groupBy("cluster").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("cluster")
    late = named.join(open_, "cluster").join(lows, "rep").select("cluster", "rep", "low", "part")
    links = parts.select(F.col("rep").alias("a"), F.col("part").alias("b")).unionByName(confirmed(late, sets, least))
    parts = components(links)
    ends = stored(classes.select("set_id", "rep", "who").join(parts, "rep", "left").select("set_id", "who", F.coalesce("part", "rep").alias("part")), "ends")
    best = ends.groupBy("part").agg(F.min("who").alias("best"))
    ends = ends.join(best, "part").select("set_id", "best")
    out = rows.where("n_shingles > 0").select("doc_id", "th", "n_shingles", "set_id").join(ends, "set_id")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    out = out.select("doc_id", "th", "n_shingles", F.col("best.doc_id").alias("component_id"), kept.alias("kept"))
    alone = rows.where("n_shingles = 0").select("doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("th")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""
