"""What the operators of this subpackage share: text rules and written tables."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Where all bytes are ASCII, lower() does just that and is faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def without_blanks(c: Column) -> Column:
    """Delete every character of BLANKS."""
    for x in BLANKS:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def text_of(name: str = "text") -> Column:
    """The column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's spark.checkpoint.dir.
    Where none is set and all runs on one machine, as in tests, a temporary folder becomes it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext.getCheckpointDir()
        if not at and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = at or "file://" + tempfile.mkdtemp(prefix="sheaf-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage is cut, and a lost
    executor takes nothing with it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of stored rows that are not read again."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_HELD: dict = {}


def held(owner: str, make):
    """What a Python worker keeps between tasks. Workers are used again by other operators, so
    what the last owner held goes, and back to the system, when another comes."""
    if owner not in _HELD:
        _HELD.clear()
        trim()
        _HELD[owner] = make()
    return _HELD[owner]


def trim() -> None:
    """Give freed memory back to the system: Python's, Arrow's and the C library's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


#: Rows and bytes of an Arrow batch between the JVM and a Python worker, unless the session says
#: otherwise, and rows that a worker takes up as Python objects at a time.
BATCH_ROWS, BATCH_BYTES, SLICE_ROWS = 2000, 8 << 20, 200


def arrow_rows(df: DataFrame, run, schema: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """mapInArrow in batches of bounded size: ``run`` gets slices of them, or with 0 the batches."""
    conf = df.sparkSession.conf
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            conf.set(f"spark.sql.execution.arrow.{key}", str(value))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[pa.RecordBatch]:
            for b in batches:
                step = slice_rows or max(b.num_rows, 1)
                yield from (b.slice(i, step) for i in range(0, b.num_rows, step))

        yield from run(slices())
        trim()

    return df.mapInArrow(sliced, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Row keys that are broadcast at most (12 MB); beyond that the rows are joined by shuffle.
MOST_IDS = 500_000


def text_hash(name: str = "text") -> Column:
    """With doc_id, what a row is known by: rows that share both get the same decisions."""
    return F.xxhash64(text_of(name))


def without_rows(docs: DataFrame, gone: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """The rows of ``docs`` whose doc_id (null-safe) and text_hash are not among ``gone``
    (doc_id, th). Other rows that share the doc_id stay."""
    gone = stored(gone.select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct(), "gone")
    same = docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (text_hash() == F.col("_gone_th"))
    return docs.join(F.broadcast(gone) if gone.count() <= most else gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")


def range_ends(ids: DataFrame, n: int) -> list[int]:
    """The largest ids of about ``n`` even ranges of the one integer column, sorted; null ids
    aside. Quantiles cut the ranges; they may be a little off, so each range's own largest id is looked
    up; there are n + 1 at most."""
    (name,) = ids.columns
    cuts = ids.agg(F.percentile_approx(name, [i / n for i in range(1, n)] + [1.0], max(10_000, 20 * n))).first()[0]
    cuts = sorted(set(cuts or []))
    ends = ids.where(F.col(name).isNotNull()).groupBy(range_of(F.col(name), cuts)).agg(F.max(name).alias("end"))
    return sorted(r["end"] for r in ends.collect())


def range_of(c: Column, ends: list[int]) -> Column:
    """How many of the sorted ``ends`` are less than the value, by halving; of null, none."""
    at = longs(ends)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(ends).bit_length()))]) if ends else F.array().cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(at, n + step - 1) < c, n + step).otherwise(n))
