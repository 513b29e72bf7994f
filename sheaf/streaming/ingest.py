"""Ledgered ingest: a stream of files that are done once, within a daily quota of pages.

Each micro-batch, with what earlier ones left over, is joined against the ledger (same content
done before: skipped; same path with other content: done again) and cut at the day's quota. What
is over the quota goes to a backlog that the next run begins with, so no file is lost though the
stream counts it as read.

All three tables are folders by batch, and a batch only looks at those before it: one that runs
again after a crash, at whatever point, finds what it found the first time and replaces its own
folders, so output and ledger hold each file once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.ledger import last_wins, within_quota

LEDGER = "source_rel string, sha256 string, pages int, day string, batch_id string"


def _batches(spark: SparkSession, path: str, before: str | None = None) -> list[str]:
    """Ids of the batches that are written under a path, in order."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    ids = sorted(n.partition("=")[2] for n in names if n.startswith("batch_id=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))
    return [i for i in ids if before is None or i < before]


def _compactions(spark: SparkSession, path: str, before: str | None = None) -> list[str]:
    """Ids of the batches up to which the ledger is compacted, in order."""
    return _batches(spark, f"{path}_compact", before)


def read_ledger(spark: SparkSession, path: str, before: str | None = None) -> DataFrame:
    """The last entry of each path, of the batches before one; no rows where there are none. Read are the
    last compaction before that batch and the batches after it."""
    upto = max(_compactions(spark, path, before), default=None)
    ids = [i for i in _batches(spark, path, before) if upto is None or i > upto]
    rows = spark.read.schema(LEDGER).option("basePath", path).parquet(*[f"{path}/batch_id={i}" for i in ids]) if ids else spark.createDataFrame([], LEDGER)
    if upto is not None:  # a compaction keeps the ids of its batches as a column
        rows = rows.unionByName(spark.read.schema(LEDGER.replace("batch_id", "done_in")).parquet(f"{path}_compact/batch_id={upto}").withColumnRenamed("done_in", "batch_id"))
    return last_wins(rows, "source_rel", "batch_id")


def compact(spark: SparkSession, path: str) -> str | None:
    """Writes the ledger up to the last batch but one as one folder and removes what it stands for: batches,
    older compactions and backlogs. Returns the id up to which the ledger is compacted.

    The last batch stays, as it may run again and must then find what it found. Call it while no stream
    runs. A crash in the middle leaves folders that the next call removes; readers skip them."""
    ids = _batches(spark, path)
    done = _compactions(spark, path)
    if len(ids) > 1 and (not done or ids[-2] > done[-1]):
        rows = read_ledger(spark, path, ids[-1]).withColumnRenamed("batch_id", "done_in")
        rows.write.mode("overwrite").parquet(f"{path}_compact/batch_id={ids[-2]}")
        done.append(ids[-2])
    if done:
        # the backlog that the last batch began with is the last one before it
        left = _batches(spark, f"{path}_backlog", ids[-1]) if ids else []
        old = [f"{path}/batch_id={i}" for i in ids[:-1] if i <= done[-1]] + [f"{path}_compact/batch_id={i}" for i in done[:-1]] + [f"{path}_backlog/batch_id={i}" for i in left[:-1]]
        for folder in old:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return done[-1] if done else None


def backlog(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """What the last batch left over; None before the first."""
    ids = _batches(spark, path, before)
    return spark.read.parquet(f"{path}/batch_id={ids[-1]}") if ids else None


def todo(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the batch (source_rel, sha256, pages, ...) that are not done, each content once."""
    done = ledger.select(F.col("source_rel").alias("_rel"), F.col("sha256").alias("_sha"))
    left = batch.join(done, (F.col("source_rel") == F.col("_rel")) & (F.col("sha256") == F.col("_sha")), "left_anti")
    return left.dropDuplicates(["source_rel", "sha256"])


def admitted(rows: DataFrame, ledger: DataFrame, day: str, quota: int) -> DataFrame:
    """Rows that are to be done today, by source_rel, then sha256."""
    used = ledger.where(F.col("day") == day).agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("used")).first()["used"]
    return within_quota(rows.withColumn("day", F.lit(day)), "day", ["source_rel", "sha256"], "pages", quota - used).drop("used_before")


def work_off(spark: SparkSession, fresh: DataFrame | None, batch_id: str, ledger_path: str, work: Callable[[DataFrame], DataFrame], out_path: str, day: str, quota: int) -> None:
    """Do what is new and what was left over, as far as the quota goes; the rest is left over."""
    known = read_ledger(spark, ledger_path, batch_id)
    old = backlog(spark, f"{ledger_path}_backlog", batch_id)
    rows = fresh if old is None else old if fresh is None else old.unionByName(fresh)
    if rows is None:
        return
    # done first, so that the day of the ledger is the same for a batch that runs again
    open_ = todo(rows, known).persist()
    now = admitted(open_, known, day, quota).persist()
    put = lambda df, path: df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    put(work(now.drop("day")), out_path)
    put(open_.join(now.select("source_rel", "sha256"), ["source_rel", "sha256"], "left_anti").select(*rows.columns), f"{ledger_path}_backlog")
    put(now.select("source_rel", "sha256", F.col("pages").cast("int").alias("pages"), "day"), ledger_path)
    open_.unpersist()
    now.unpersist()


def start(source: DataFrame, ledger_path: str, work: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str, day: Callable[[], str], quota: int = 20_000):
    """Work off the backlog, then start the query over ``source`` (source_rel, sha256, pages, ...);
    it ends when all files that are there now are seen. ``work`` maps rows to what is written."""
    spark = source.sparkSession
    compact(spark, ledger_path)
    last = max(_batches(spark, ledger_path), default=None)
    if last is not None:  # an id after the last batch's and before the next one's
        work_off(spark, None, f"{last.partition('_')[0]}_{day()}", ledger_path, work, out_path, day(), quota)

    def each(batch: DataFrame, batch_id: int) -> None:
        work_off(batch.sparkSession, batch, f"{batch_id:012d}", ledger_path, work, out_path, day(), quota)

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window, late rows dropped after ``late``; batch or stream."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
