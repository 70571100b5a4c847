"""WARC archives with an index: written once, read by byte ranges.

Every record is a gzip member of its own, so a record can be read without the
rest of its archive. Writing yields the index first of all: archive, offset,
length, URL and digest per record. Reading takes index rows, sorts them by place,
merges neighbouring ranges into larger reads and unpacks the records in them.

Archives are written by tasks to the shared folder, each under a name of its own
attempt that then replaces the final name; a task that runs again writes the same
bytes. Files are reached through Arrow's file systems, so the folder may be any
store that these know.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import materialize

#: fixed values of the format
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"

INDEX = (
    "page_id long, url string, archive string, offset long, length long, payload_bytes long,"
    " payload_digest string, record_type string, refers_to long"
)


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there."""
    if ":" not in folder.split("/")[0]:
        return fs.LocalFileSystem(), folder
    scheme, rest = folder.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(folder)


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One compressed record: a response, or a revisit if it refers to a page."""
    block = HTTP if refers_to is not None else HTTP + payload
    head = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_name(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one compressed record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"no record starts here: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 32 << 20, smallest: int = 100) -> DataFrame:
    """Write ``page_id, url, html`` as archives below ``folder`` and return the index.

    A null html is an empty payload, and a null url leaves its field out. Of pages
    with equal payloads of at least ``smallest`` bytes that with the smallest
    page_id is the response and the others revisit it; a page without an id comes
    last, and rows that repeat an id and a payload are of the same kind. An empty
    table gives an empty index; other columns are left out.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    facts = materialize(rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("size")), "digests")
    total = facts.agg(F.sum("size")).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    copies = facts.filter(F.col("size") >= smallest).groupBy("digest").agg(F.min("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    repeated = copies.filter("n > 1 AND response IS NOT NULL").drop("n")
    revisits = facts.join(repeated, "digest").filter("page_id IS NULL OR page_id > response").select("page_id", "digest", "response").distinct()
    place = F.pmod(F.xxhash64("page_id"), F.lit(archives)).cast("int")
    # a revisit's note comes right before its page, without a join of the payloads
    notes = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "response")
    everything = notes.unionByName(rows.withColumn("response", F.lit(None).cast("long"))).withColumn("archive", place)
    laid = everything.repartition(archives, "archive").sortWithinPartitions(
        "archive", "page_id", "digest", F.col("payload").isNotNull(), "url"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        system.create_dir(root, recursive=True)
        name, sink, part, offset, note = None, None, "", 0, None
        try:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    if row["archive"] != name:
                        if sink is not None:
                            sink.close()
                            system.move(part, f"{root}/{_file(name)}")
                        name, offset = row["archive"], 0
                        part = f"{root}/{_file(name)}.{uuid.uuid4().hex}"
                        sink = system.open_output_stream(part, compression=None)
                    key = (row["page_id"], row["digest"])
                    if row["payload"] is None:
                        note = (*key, row["response"])
                        continue
                    refers_to = note[2] if note is not None and note[:2] == key else None
                    made = record(row["page_id"], row["url"], row["payload"], row["digest"], refers_to)
                    sink.write(made)
                    kind = "response" if refers_to is None else "revisit"
                    out.append((row["page_id"], row["url"], _file(name), offset, len(made), len(row["payload"]), row["digest"], kind, refers_to))
                    offset += len(made)
                yield _batch(out, index_schema)
            if sink is not None:
                sink.close()
                system.move(part, f"{root}/{_file(name)}")
                part = ""
        except BaseException:
            if part:
                with suppress(OSError):
                    system.delete_file(part)
            raise

    index_schema = _arrow(spark, INDEX)
    columns = ["page_id", "url", "payload", "digest", "response", "archive"]
    laid.select(*columns).mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _file(archive: int) -> str:
    return f"part-{archive:06d}.warc.gz"


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in ddl.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def read_plan(offset: np.ndarray, length: np.ndarray, gap: int, most: int) -> list[tuple[int, int]]:
    """Ranges of ascending records, as index bounds, that are read at once."""
    out, first = [], 0
    for k in range(1, len(offset) + 1):
        if k == len(offset) or offset[k] - (offset[k - 1] + length[k - 1]) > gap or offset[k] + length[k] - offset[first] > most:
            out.append((first, k))
            first = k
    return out


RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 8 << 20, payload: bool = True) -> DataFrame:
    """The records of the given index rows, read from the archives below ``folder``.

    Returns page_id, url, payload (null for revisits or if not asked for),
    payload_bytes, payload_digest, record_type, refers_to, all as the records
    say; digests of responses are taken from the bytes read and must agree with
    the record. Ranges at most ``gap`` bytes apart are one read of up to ``most``
    bytes or one record. Repeated index rows are read each.
    """
    spark = index.sparkSession
    parts = max(1, index.select("archive").distinct().count())
    laid = index.select("archive", "offset", "length").repartition(parts, "archive").sortWithinPartitions("archive", "offset")
    schema = _arrow(spark, RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        for batch in batches:
            names = np.array(batch.column("archive").to_pylist(), object)
            offset, length = batch.column("offset").to_numpy(), batch.column("length").to_numpy()
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                with system.open_input_file(f"{root}/{names[a]}") as source:
                    for lo, hi in read_plan(offset[a:b], length[a:b], gap, most):
                        lo, hi = lo + a, hi + a
                        span = source.read_at(int(offset[hi - 1] + length[hi - 1] - offset[lo]), int(offset[lo]))
                        at = offset[lo:hi] - offset[lo]
                        yield _batch([_row(span[o : o + n], payload) for o, n in zip(at.tolist(), length[lo:hi].tolist(), strict=True)], schema)

    return laid.mapInArrow(read, RECORDS)


def _row(member: bytes, payload: bool) -> tuple:
    fields, body = parse(member)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    page, refers_to = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
    size = int(fields["X-Payload-Length"])
    if kind == "response":
        found = hashlib.sha256(body).hexdigest()
        if (found, len(body)) != (digest, size):
            raise ValueError(f"record of page {page} does not hold what it says")
    return (
        int(page) if page is not None else None,
        fields.get("WARC-Target-URI"),
        body if payload and kind == "response" else None,
        size,
        digest,
        kind,
        int(refers_to) if refers_to is not None else None,
    )
