"""Deterministic sharded WARC writer and reader.

Write. Records are range-sorted by ``page_id``; every task writes its sorted range into files that
roll when their compressed size passes ``roll_bytes``. Each record is a gzip member of its own with
headers and digests made anew from the payload. Of records with equal payloads of at least
``REVISIT_BYTES`` bytes the one with the largest ``page_id`` is the response, the others are revisits
that refer to it; only (page_id, digest) pairs are shuffled to find them.

Commit. A file is written under a temporary name of its own for every task attempt, then renamed to
a name made of its first record's key; the rows that the successful tasks return (name, records,
bytes, SHA-256) become the manifest, itself written by Spark's committer. A reader opens only
files that the manifest lists, and checks their bytes, so files of lost or repeated attempts are
never seen. Files are written to the folder of a ``pyarrow.fs`` URI, by default one in
``spark.checkpoint.dir``, which all executors share.

Defined cases: a null or empty html is an empty payload and a response; a null ``page_id`` is written as
``<urn:page:none>``, read back as null, and never referred to; rows that repeat a ``page_id``
are records of their own; a null url is written as an empty target; an empty table gives an
empty manifest and no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm.files import Checked, SealedFile, new_folder, open_fs
from tastemap.session import materialize

REVISIT_BYTES = 1000
ROLL_BYTES = 256 << 20
LEVEL = 6
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"
DATE = "1970-01-01T00:00:00Z"  # the table has no capture time


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{NO_ID if page_id is None else page_id}>"


def encode(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    body = b"" if refers_to is not None else payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(body).hexdigest()}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(text + body + b"\r\n\r\n") + z.flush()


def decode(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip member stream; bounded by one record."""
    rest = b""
    while True:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not rest:
                rest = stream.read(1 << 20)
                if not rest:
                    if out:
                        raise ValueError("truncated record")
                    return
            out.append(z.decompress(rest))
            rest = z.unused_data if z.eof else b""
        data = b"".join(out)
        head, _, rest_of = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        n = int(headers["Content-Length"])
        block = rest_of[:n]
        if len(block) != n or headers["WARC-Block-Digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
            raise ValueError("damaged record")
        yield headers, block


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the rows that repeat another's payload of ``least`` bytes or more."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    long_ = materialize(pages.filter(F.octet_length("html") >= least).select("page_id", F.sha1(payload).alias("digest")), "digests")
    first = long_.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return long_.join(first, "digest").filter("refers_to is not null and not page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES, partitions: int | None = None) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html); returns the folder and the committed manifest."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    again = revisits(rows)
    # the few revisit facts travel to their rows in the same range shuffle, ahead of them
    both = rows.select("page_id", F.lit(1).alias("is_row"), "url", "html", F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.select("page_id", F.lit(0).alias("is_row"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to")
    )
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = both.repartitionByRange(n, "page_id").sortWithinPartitions("page_id", "is_row")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, of, known = None, None, {}
        for batch in batches:
            for page_id, is_row, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if page_id != of:
                    of, known = page_id, {}
                if not is_row:
                    known[digest] = refers_to
                    continue
                payload = (html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                member = encode(page_id, url or "", payload, digest, known.get(digest))
                if out is None:
                    out = _File(folder, page_id)
                out.add(member)
                if out.out.size >= roll_bytes:
                    yield out.close()
                    out = None
        if out is not None:
            yield out.close()

    done = ranged.mapInArrow(task, "name string, records long, bytes long, sha256 string")
    manifest = f"{folder}/manifest"
    done.repartition(1).write.parquet(manifest)  # one small row per file
    return folder, spark.read.parquet(manifest)


class _File:
    def __init__(self, folder: str, first: int | None):
        self.first, self.out, self.records = first, SealedFile(folder), 0

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.records += 1

    def close(self) -> pa.RecordBatch:
        name, size, digest = self.out.seal(f"part-{NO_ID if self.first is None else format(self.first, '020d')}", ".warc.gz")
        return pa.record_batch({"name": [name], "records": pa.array([self.records], pa.int64()), "bytes": pa.array([size], pa.int64()), "sha256": [digest]})


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """All records of the manifest's files: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to (and the stored payload); a file whose bytes differ from the manifest is an error."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    files = manifest.repartition(max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))), "name")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]
    batch_rows = 200 if with_payload else 5000

    def number(urn: str | None) -> int | None:
        name = urn.rsplit(":", 1)[1].rstrip(">") if urn else NO_ID
        return None if name == NO_ID else int(name)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = open_fs(folder)
        rows: list[tuple] = []
        for batch in batches:
            for f in batch.to_pylist():
                with where.open_input_stream(f"{root}/{f['name']}", compression=None) as raw:
                    stream, n = Checked(raw), 0
                    for h, block in decode(stream):
                        n += 1
                        kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"payload digest in {f['name']}")
                        size = len(block) if kind == "response" else int(h["X-Payload-Length"])
                        row = (number(h["WARC-Record-ID"]), unquote(h["WARC-Target-URI"]), size, digest, kind, number(h.get("WARC-Refers-To")))
                        rows.append((*row, block) if with_payload else row)
                        if len(rows) >= batch_rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows = []
                    if (stream.size, n, stream.sha.hexdigest()) != (f["bytes"], f["records"], f["sha256"]):
                        raise ValueError(f"{f['name']} differs from the manifest")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return files.mapInArrow(task, schema)


def report(pages: DataFrame) -> DataFrame:
    """The query's columns, read back from the archives."""
    folder, _ = write(pages)
    return read(pages.sparkSession, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
