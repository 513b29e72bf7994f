"""WARC archives: a deterministic sharded writer, and a reader.

Rows are dealt by range of page_id in shards of fixed width, so a shard's rows, and with them
its files, do not depend on the cluster or the number of partitions. A task streams a shard in
order into gzip members, starts a new file when the compressed size passes a limit, and writes
under a temporary name that becomes the final one when the file is whole; a task that runs twice
writes the same bytes. The manifest (one row a file) is a table that Spark commits last, and the
reader opens only files that it names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import new_folder, partitions, stored

LEAST_REVISIT = 100
_END = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages have no date; a constant keeps archives reproducible


def planned(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Marks and pages in one relation, for one sort by page_id: for a revisit, a row
    (page_id, refers_to) stands before its page. Only digests and ids shuffle to find them; those
    of a payload with more than 1/4p of all rows, p the number of partitions, are not dealt at
    all: there are 4p such payloads at most, and their first pages are broadcast."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    ids = pages.select("page_id", F.octet_length(payload).alias("n"), F.unhex(F.sha2(payload, 256)).alias("d"))
    long = stored(ids.where((F.col("n") >= least) & F.col("page_id").isNotNull()).select("page_id", "d"), "digests")
    first = stored(long.groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("k")).where("k > 1"), "first")
    most = (first.agg(F.sum("k")).first()[0] or 0) / (4 * partitions(pages.sparkSession))
    hot = F.broadcast(first.where(F.col("k") > most).select("d", "first"))
    rest = long.join(hot.select("d"), "d", "left_anti").join(first.where(F.col("k") <= most).select("d", "first"), "d")
    marks = long.join(hot, "d").unionByName(rest).where("page_id <> first").select("page_id", F.col("first").alias("refers_to"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), F.lit(0).alias("kind")).distinct()
    rows = pages.select("page_id", F.lit(None).cast("long").alias("refers_to"), F.col("url").cast("string"), payload.alias("html"), F.lit(1).alias("kind"))
    return marks.unionByName(rows)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record with headers and digests made anew. A response has the payload, a
    revisit only the HTTP header; both state the full payload's digest and length."""
    name = "null" if page_id is None else str(page_id)
    digest = hashlib.sha256(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "about:blank")
    head = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"), f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member without time or name."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _store(uri: str):
    """File system and path of a folder that all machines share."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class _File:
    """A file under a temporary name, renamed when closed."""

    def __init__(self, store, root: str, name: str):
        self.store, self.root, self.name = store, root, name
        self.temp = f"{root}/.{name}.{uuid.uuid4().hex}.tmp"
        self.out = store.open_output_stream(self.temp)
        self.size = self.records = 0
        self.sum = hashlib.sha256()

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.records += 1
        self.sum.update(data)

    def close(self) -> tuple:
        self.out.close()
        try:
            self.store.move(self.temp, f"{self.root}/{self.name}")
        except OSError:  # stores that do not replace: another attempt has put the same bytes there
            if not self.store.get_file_info(f"{self.root}/{self.name}").size:
                raise
            self.store.delete_file(self.temp)
        return self.name, self.size, self.records, self.sum.hexdigest()


MANIFEST = "file string, bytes long, records long, sha256 string"
_MANIFEST = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()), ("sha256", pa.string())])


def write_warc(pages: DataFrame, folder: str, width: int = 4096, most_bytes: int = 64 << 20, level: int = 6) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``folder`` and return the
    manifest, read back from ``folder``/_manifest.

    A null html is an empty payload, a null url about:blank. Of records with equal payloads of
    LEAST_REVISIT bytes or more, the one with the smallest page_id is the response and the
    others revisit it; rows that repeat the smallest page_id are all responses, and rows with
    a null page_id are responses and in a shard of their own. Other columns are not read. An
    empty table gives an empty manifest. ``width`` is a shard's span of page_ids.
    """
    spark = pages.sparkSession
    rows = planned(pages).withColumn("shard", F.floor(F.col("page_id") / width))
    rows = rows.repartitionByRange(partitions(spark), "shard").sortWithinPartitions("shard", "page_id", "kind", "html", "url")
    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        done, at, seq, out, mark = [], ..., 0, None, (None, None)
        for batch in batches:
            cols = [batch.column(c) for c in ("shard", "page_id", "kind", "refers_to", "url", "html")]
            for k in range(batch.num_rows):
                shard, page, kind, to, url, html = (c[k].as_py() for c in cols)
                if kind == 0:
                    mark = (page, to)
                    continue
                if shard != at or out is None or out.size >= most_bytes:
                    if out:
                        done.append(out.close())
                    seq = 0 if shard != at else seq + 1
                    at = shard
                    name = "null" if shard is None else f"{'m' if shard < 0 else ''}{abs(shard):012d}"
                    out = _File(store, root, f"pages-{name}-{seq:05d}.warc.gz")
                out.add(member(record(page, url, html.encode(), mark[1] if page is not None and mark[0] == page else None), level))
        if out:
            done.append(out.close())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*done) if done else [[]] * 4, _MANIFEST)], schema=_MANIFEST)

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def records_of(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of each record of a gzip stream, member by member, in bounded memory."""
    z, buf, data = zlib.decompressobj(31), b"", b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                break
        buf += z.decompress(data)
        data = z.unused_data
        if z.eof:
            head, _, rest = buf.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            if len(rest) != n + 4 or hashlib.sha256(rest[:n]).hexdigest() != fields["WARC-Block-Digest"].partition(":")[2]:
                raise ValueError("a record's length or digest is wrong")
            yield fields, rest[:n]
            z, buf = zlib.decompressobj(31), b""
    if buf:
        raise ValueError("a record is cut off")


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def read_warc(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of the files that the manifest names; with ``payloads``, also the
    payload as ``payload binary`` (null for revisits). Lengths and digests are checked."""
    schema = _RECORDS.append(pa.field("payload", pa.binary())) if payloads else _RECORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        got: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*got) if got else [[]] * len(schema), schema)], schema=schema)

        for b in batches:
            for name in b.column("file").to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for h, block in records_of(f):
                        http, _, body = block.partition(b"\r\n\r\n")
                        ident = h["WARC-Record-ID"][len("<urn:page:") : -1]
                        digest = h["WARC-Payload-Digest"].partition(":")[2]
                        if h["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError("a payload's digest is wrong")
                        n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        to = h.get("WARC-Refers-To")
                        got.append((None if ident == "null" else int(ident), n, digest, h["WARC-Type"], to and int(to[len("<urn:page:") : -1]), h["WARC-Target-URI"], *([None if to else body] if payloads else [])))
                        size += len(body) if payloads else 200
                        if size > 4 << 20:
                            yield batch()
                            got, size = [], 0
        yield batch()

    files = manifest.select("file").repartition(max(partitions(manifest.sparkSession), 1), F.col("file"))
    return files.mapInArrow(run, RECORDS + (", payload binary" if payloads else ""))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = new_folder(spark, "warc")
    return read_warc(write_warc(pages, folder, width=1024), folder).drop("url")


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM r
"""
