"""WARC archives: writing with an index, and coalesced byte-range reads of selected records.

``write_archives`` writes every page as a WARC/1.1 record, each record a gzip member of its own,
and returns the index: file, offset, length, URL and digest per record.  Every task writes the
archives of its own rows into the shared folder, rolling over at ``ARCHIVE_BYTES``; a file's
name is made up anew by each attempt, and only the rows of attempts that succeed reach the
index, so a repeated task leaves at worst a file that no index names.  ``read_records`` takes
any selection of index rows, spreads the files over as many tasks as their bytes call for, sorts
by file and offset, joins ranges that are less than ``GAP`` bytes apart, up to ``READ`` bytes, and
reads each joined range once.

Of pages with the same payload, that with the smallest id is a response record and the others
are revisit records that name it; they are told apart by SHA-256 of the payload, the digest in
the records is the customary SHA-1 in base32.

Defined results: a null payload counts as empty; empty payloads are equal to each other; rows
that repeat id and payload of the response are responses as well; pages with a null id are
responses if all pages of that payload have none; a null URL has no target line; control
characters and blanks in a URL are written percent-encoded; an empty table writes no archive; only
the three named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.columns import quoted
from ledgerline.session import scratch_folder, settled

ARCHIVE_BYTES = 64 << 20
GAP = 64 << 10
READ = 8 << 20  # bytes of one read, unless one record has more
TASK = 128 << 20  # bytes of the records that one task reads back
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
INDEX = "page_id long, record_type string, refers_to long, url string, digest string, file string, offset long, length long"
_SAFE_URL = "%/:=&?~#+!$,;'@()*[]|{}^`\"<>\\-_."


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record(page_id: int | None, kind: str, refers_to: int | None, url: str | None, payload: bytes) -> bytes:
    """One WARC record; a revisit has the HTTP header but no payload."""
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + (payload if kind == "response" else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {quote(url, safe=_SAFE_URL)}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The fields of a record and its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    number = lambda name: fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else ""
    return {
        "page_id": int(number("WARC-Record-ID")) if number("WARC-Record-ID") else None,
        "record_type": fields["WARC-Type"],
        "refers_to": int(number("WARC-Refers-To")) if number("WARC-Refers-To") else None,
        "digest": payload_digest(payload)
        if fields["WARC-Type"] == "response"
        else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": payload,
    }


def _typed(pages: DataFrame, id_column: str, url_column: str, payload_column: str, least_bytes: int) -> DataFrame:
    """Pages with their record type and, for revisits, the id of the response."""
    payload = F.encode(F.coalesce(quoted(payload_column), F.lit("")), "UTF-8")
    rows = pages.select(
        quoted(id_column).cast("long").alias("page_id"),
        quoted(url_column).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("same"),
    )
    # only payloads that repeat need looking up; a plain table on that side of the join lets
    # adaptive execution split it at a hot payload
    repeated = settled(
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("same", "first")
    )
    told = rows.join(repeated.hint("merge"), "same", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return told.select(
        "page_id", "url", "payload",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least_bytes: int = 0,
    folder: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write the archives into a shared folder; the index of their records, itself written down.

    Payloads of fewer than ``least_bytes`` bytes are always responses.
    """
    target = folder or scratch_folder(pages.sparkSession) + "/archives"
    typed = _typed(pages, id_column, url_column, payload_column, least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(target)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for r in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
                page_id, url, payload, kind, refers_to = (x.as_py() for x in r)
                if out is None or offset >= archive_bytes:
                    if out is not None:
                        out.close()
                    store.create_dir(base, recursive=True)
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                member = gzip.compress(record(page_id, kind, refers_to, url, payload), 6, mtime=0)
                out.write(member)
                rows.append(
                    (page_id, kind, refers_to, url, payload_digest(payload), f"{target}/{name}", offset, len(member))
                )
                offset += len(member)
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
        if out is not None:
            out.close()

    return settled(typed.mapInArrow(run, INDEX))


_NAMES = [part.split()[0] for part in INDEX.split(", ")]
_ARROW = [pa.int64() if part.split()[1] == "long" else pa.string() for part in INDEX.split(", ")]


def coalesced(spans: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> list[tuple[int, int]]:
    """(offset, end) of the reads that cover sorted (offset, length) spans."""
    out: list[tuple[int, int]] = []
    for offset, length in spans:
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(out[-1][1], offset + length))
        else:
            out.append((offset, offset + length))
    return out


def read_records(index: DataFrame, gap: int = GAP, task_bytes: int = TASK) -> DataFrame:
    """The records of the given index rows, read back: page_id, record_type, refers_to, digest,
    payload (of responses).  The digest of a response is that of the payload read, a revisit's that
    of its header.  A task holds one joined range and some ``READ`` bytes of its payloads."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for name, group in groupby(rows, key=itemgetter(0)):
                store, path = fs.FileSystem.from_uri(name)
                spans, at = [(offset, length) for _, offset, length in group], 0
                with store.open_input_file(path) as file:
                    for start, end in coalesced(spans, gap):
                        file.seek(start)
                        chunk, records, held = file.read(end - start), [], 0
                        while at < len(spans) and sum(spans[at]) <= end:
                            offset, length = spans[at]
                            record = parsed(zlib.decompress(chunk[offset - start : offset - start + length], 31))
                            records.append(record)
                            held += len(record["payload"])
                            at += 1
                            if held > READ:
                                yield pa.RecordBatch.from_pylist(records, schema=_RECORD)
                                records, held = [], 0
                        yield pa.RecordBatch.from_pylist(records, schema=_RECORD)

    spread = index.select("file", "offset", "length").repartition(tasks, "file")
    return spread.sortWithinPartitions("file", "offset").mapInArrow(
        run, "page_id long, record_type string, refers_to long, digest string, payload binary"
    )


_RECORD = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()), ("payload", pa.binary())]
)
