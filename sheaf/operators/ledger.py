"""Append-only ledgers: last write wins, skip decisions, quotas, log evidence, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.text import first_match


def last_wins(ledger: DataFrame, key: str, order: str, descending: bool = True) -> DataFrame:
    """One row a key. A partial maximum of (order, row): no sort of a key's rows."""
    rest = [c for c in ledger.columns if c != key]
    packed = F.struct(order, *[c for c in rest if c != order])
    pick = F.max(packed) if descending else F.min(packed)
    return ledger.groupBy(key).agg(pick.alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def skip_reason(output: Column, entry: Column, same_size: Column, same_sha: Column) -> Column:
    """Why an input is left out, or null: it is to be done. First match wins."""
    return first_match(
        [
            ("TODO", ~output),
            ("NO_MANIFEST_ENTRY", ~entry),
            ("SOURCE_CHANGED", ~same_size),
            ("SOURCE_UNVERIFIABLE", same_sha.isNull()),
            ("SOURCE_CHANGED", ~same_sha),
        ],
        "MANIFEST_DONE",
    )


def within_quota(rows: DataFrame, day: str, order: list[str], pages: str, quota: float) -> DataFrame:
    """Rows whose day had not reached the quota before them. A row that goes over it is still
    done. Days are few rows each; the running sum is a window within a day."""
    by = Window.partitionBy(day).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("used_before", F.coalesce(F.sum(pages).over(by), F.lit(0))).where(F.col("used_before") < quota)


def log_evidence(log: DataFrame, key: str, order: str, is_start: Column, is_ok: Column, value: str, ahead: int = 2) -> DataFrame:
    """Of each start line, the value of the first ok line among the next ``ahead``; the latest
    start with such evidence wins."""
    by = Window.partitionBy(key).orderBy(order)
    rows = log.withColumns({"_start": is_start, "_ok": F.when(is_ok, F.col(value))})
    rows = rows.withColumn("_got", F.coalesce(*[F.lead("_ok", i).over(by) for i in range(1, ahead + 1)]))
    rows = rows.where("_start AND _got IS NOT NULL")
    return rows.groupBy(key).agg(F.max_by("_got", order).alias(value), F.count("*").alias("n_evidence"))


def changes(before: DataFrame, after: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, before, after, change: added, removed, moved or same."""
    a = before.select(*key, F.col(value).alias("before"), F.lit(True).alias("_a"))
    b = after.select(*key, F.col(value).alias("after"), F.lit(True).alias("_b"))
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "moved").otherwise("same")
    return a.join(b, key, "full_outer").select(*key, "before", "after", kind.alias("change"))


def collisions(records: DataFrame, name: str, sha: str, path: str) -> DataFrame:
    """Names that two or more records share, and whether these are the same bytes. A null sha is
    a value of its own."""
    told = F.coalesce(F.col(sha), F.lit("?"))
    return records.groupBy(name).agg(F.count("*").alias("n"), F.countDistinct(told).alias("n_sha"), F.min(path).alias("first_path")).where("n > 1").withColumn("identical", F.col("n_sha") == 1)


def plan_buckets(entries: DataFrame, to: str, undecided: Column, unreadable: Column, existing: DataFrame) -> DataFrame:
    """Moves by bucket: read_error, needs_ruling, collision (the target exists), conflict (two
    entries have one target), move. First match wins."""
    shared = F.count("*").over(Window.partitionBy(to)) > 1
    there = existing.select(F.col(to).alias("_to")).distinct().withColumn("_there", F.lit(True))
    rows = entries.withColumn("_shared", shared).join(there, F.col(to) == F.col("_to"), "left")
    bucket = first_match([("read_error", unreadable), ("needs_ruling", undecided), ("collision", F.col("_there")), ("conflict", F.col("_shared"))], "move")
    return rows.withColumn("bucket", bucket).drop("_shared", "_to", "_there")


def near_in_time(events: DataFrame, log: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """Events with their evidence in the log: near, other_time or none, the near times, and the
    log's entries of the key. Time is dealt into buckets as wide as the window, and an event looks
    into its own and the two beside it: the log is grouped once by key and bucket, so no key's
    entries meet all of its events. Equal events stay apart."""
    second, width = F.unix_timestamp(at), F.lit(max(seconds, 1))
    bucket = F.floor(second / width)
    there = log.groupBy(F.col(key).alias("_key"), bucket.alias("_bucket")).agg(F.collect_list(at).alias("_times"))  # of one key in one window
    total = log.groupBy(F.col(key).alias("_key")).agg(F.count(at).alias("n_log"))
    rows = events.withColumn("_at", bucket)
    for i in (-1, 0, 1):
        side = there.select(F.col("_key").alias(f"_k{i + 1}"), F.col("_bucket").alias(f"_b{i + 1}"), F.col("_times").alias(f"_t{i + 1}"))
        rows = rows.join(side, (F.col(key) == F.col(f"_k{i + 1}")) & (F.col("_at") + i == F.col(f"_b{i + 1}")), "left")
    rows = rows.join(total, F.col(key) == F.col("_key"), "left")
    none = F.array().cast(there.schema["_times"].dataType)
    times = F.concat(*[F.coalesce(f"_t{i}", none) for i in range(3)])
    near = F.array_sort(F.filter(times, lambda t: F.abs(F.unix_timestamp(t) - second) <= seconds))
    n = F.coalesce("n_log", F.lit(0).cast("long"))
    kind = F.when(F.size("near_times") > 0, "near").when(F.col("n_log") > 0, "other_time").otherwise("none")
    return rows.select(*events.columns, near.alias("near_times"), n.alias("n_log")).withColumn("evidence", kind)


def semi_split(rows: DataFrame, others: DataFrame, key: str, marks: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each mark, the sorted names (``name``) of the ``others`` of their key that
    have it, and ``found``: whether there are any. The others are grouped before they meet."""
    lists = others.groupBy(F.col(key).alias("_key")).agg(*[F.array_sort(F.collect_set(F.when(c, F.col("name")))).alias(m) for m, c in marks.items()])
    out = rows.join(lists, F.col(key) == F.col("_key"), "left").drop("_key")
    none = F.array().cast("array<string>")
    out = out.withColumns({m: F.coalesce(m, none) for m in marks})
    return out.withColumn("found", sum((F.size(m) for m in marks), F.lit(0)) > 0)


def clean_path(path: Column) -> Column:
    """Whether a path is relative and plain: not absolute, no drive, no empty or dotted part."""
    parts = F.split(path, "/", -1)
    return F.coalesce((path != "") & ~path.rlike(r"^[/\\\\]|:") & ~F.exists(parts, lambda p: p.isin("", ".", "..")), F.lit(False))


def move_violations(moves: DataFrame, tree: DataFrame) -> DataFrame:
    """``moves`` (from_rel, to_rel, sha256) with ``gate`` and ``detail`` of what forbids them, null
    if nothing does. ``tree``: path, sha256 (null for folders) of all that is there.

    In order: a path is not plain; the source is missing; its bytes are not those planned; the
    target exists; a part above the target is a file; a part of the target differs from an entry
    only in case. Each rule is an equi-join; parts are exploded, so a deep path is a few rows."""
    files = tree.where("sha256 IS NOT NULL").select(F.col("path").alias("_from"), F.col("sha256").alias("_sha"))
    rows = moves.join(files, F.col("from_rel") == F.col("_from"), "left")
    rows = rows.join(tree.select(F.col("path").alias("_to")).distinct(), F.col("to_rel") == F.col("_to"), "left")
    ups = lambda p: F.transform(F.sequence(F.lit(1), F.size(F.split(p, "/", -1))), lambda i: F.array_join(F.slice(F.split(p, "/", -1), 1, i), "/"))
    each = moves.select("to_rel").distinct().select("to_rel", F.explode(ups(F.col("to_rel"))).alias("up"))
    over = each.where("up <> to_rel").join(files.select(F.col("_from").alias("up")), "up").select(F.col("to_rel").alias("_below")).distinct().withColumn("_blocked", F.lit(True))
    low = tree.select(F.col("path").alias("entry"), F.lower("path").alias("_low")).distinct()
    # the first part that differs: what is above it must be there in the same case
    other = each.withColumn("_low", F.lower("up")).join(low, "_low").where("entry <> up")
    above = lambda c: F.when(F.contains(c, F.lit("/")), F.regexp_replace(c, "/[^/]*$", "")).otherwise("")
    other = other.where(above(F.col("entry")) == above(F.col("up"))).groupBy(F.col("to_rel").alias("_like")).agg(F.min("entry").alias("_entry"))
    rows = rows.join(over, F.col("to_rel") == F.col("_below"), "left").join(other, F.col("to_rel") == F.col("_like"), "left")
    rules = [
        ("PATH", ~(clean_path(F.col("from_rel")) & clean_path(F.col("to_rel"))), F.lit("not_plain")),
        ("SOURCE", F.col("_from").isNull(), F.lit("source_missing")),
        ("SOURCE", ~F.col("_sha").eqNullSafe(F.col("sha256")), F.lit("sha256_drift")),
        ("TARGET", F.col("_to").isNotNull(), F.lit("destination_exists")),
        ("TARGET", F.col("_blocked").isNotNull(), F.lit("parent_is_file")),
        ("TARGET", F.col("_entry").isNotNull(), F.concat(F.lit("case_variant_exists:"), F.col("_entry"))),
    ]
    found = F.coalesce(*[F.when(c, F.struct(F.lit(g).alias("gate"), d.alias("detail"))) for g, c, d in rules])
    return rows.select(*moves.columns, found["gate"].alias("gate"), found["detail"].alias("detail"))


def digest(rows: DataFrame, group: list[str], line: Column, order: Column, chunk: Column) -> DataFrame:
    """``n`` and ``digest`` per group: SHA-256 of the lines by chunk, in order, then of these by
    chunk. A chunk's lines meet in one row, a group's do not."""
    part = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("x")))), lambda r: r["x"]), ""), 256)
    parts = rows.groupBy(*group, chunk.alias("_chunk")).agg(F.count("*").alias("_n"), part.alias("_part"))
    whole = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", "_part"))), lambda r: r["_part"]), ""), 256)
    return parts.groupBy(*group).agg(F.sum("_n").alias("n"), whole.alias("digest"))


def drift(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Inputs that are not what they were: key, and why: changed or missing. New ones are not."""
    rows = changes(before, after, [key], value).where(F.col("change").isin("moved", "removed"))
    return rows.select(key, F.when(F.col("change") == "removed", "missing").otherwise("changed").alias("why"))


def stages(base: DataFrame, key: str, named: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """``base`` keys with one column a stage: its status (an expression on the stage's columns), or
    NOT_BUILT where the stage has no row, and the first stage that is not OK."""
    rows = base.select(key).distinct()
    for name, (df, status) in named.items():
        one = df.select(F.col(key).alias("_key"), status.alias("_s")).groupBy("_key").agg(F.min("_s").alias(name))
        rows = rows.join(one, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(name, F.coalesce(name, F.lit("NOT_BUILT")))
    return rows.withColumn("stopped_at", F.coalesce(*[F.when(F.col(n) != "OK", F.lit(n)) for n in named]))
