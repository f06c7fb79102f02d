"""WARC archives: writing with payload dedup, and sequential reading.

The writer makes one gzip member per record. The reader goes through a file once: it inflates step by step, frames blocks by
Content-Length, and checks digests of blocks and payloads. Both hold one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable, named, skew_join

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 16
_HEADER_MOST = 1 << 20


class WarcError(ValueError):
    """An archive that is cut short, badly framed or at odds with its digests."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(record_id: str, uri: str, payload: bytes, refers_to: str | None, date: str, level: int) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP header, whose Content-Length is the payload's, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(uri)}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        *([f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"] if refers_to else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of a binary stream, in order; digests of blocks are checked."""
    rest = stream.read(_CHUNK)
    while rest:
        inflate, buffer = zlib.decompressobj(31), bytearray()
        ended = False

        def more() -> bool:
            """Inflate another step; False at the member's end."""
            nonlocal rest, ended
            while not ended:
                if not rest:
                    rest = stream.read(_CHUNK)
                    if not rest:
                        raise WarcError("the file ends within a record")
                try:
                    got = inflate.decompress(rest, _CHUNK)
                except zlib.error as e:
                    raise WarcError(f"not a gzip member: {e}") from e
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                ended = inflate.eof
                if got:
                    buffer.extend(got)
                    return True
            return False

        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if len(buffer) > _HEADER_MOST or not more():
                raise WarcError("a record without an end of its header")
        first, *lines = buffer[:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise WarcError(f"not a WARC record: {first[:40]!r}")
        headers = {}
        for line in lines:
            name, colon, value = line.partition(":")
            if not colon:
                raise WarcError(f"not a header line: {line[:80]!r}")
            headers[name.strip().lower()] = value.strip()
        if not headers.get("content-length", "").isdigit():
            raise WarcError("a record without Content-Length")
        size = int(headers["content-length"])
        del buffer[: end + 4]
        while len(buffer) < size + 4:
            if not more():
                raise WarcError("a block shorter than its Content-Length")
        while more():
            if len(buffer) > size + 4:
                break
        if bytes(buffer[size:]) != b"\r\n\r\n":
            raise WarcError("a block longer than its Content-Length")
        block = bytes(buffer[:size])
        _check("block", headers.get("warc-block-digest"), block)
        yield headers, block
        if not rest:
            rest = stream.read(_CHUNK)


def _check(what: str, stated: str | None, data: bytes) -> None:
    if stated:
        method, _, value = stated.partition(":")
        if method.lower() == "sha1" and value.upper() != sha1_base32(data):
            raise WarcError(f"the {what} does not match its digest")


def payload_of(headers: dict[str, str], block: bytes) -> tuple[bytes | None, int]:
    """(payload, its length). A revisit has no payload here, but its HTTP header tells the length."""
    if not headers.get("content-type", "").startswith("application/http"):
        _check("payload", headers.get("warc-payload-digest"), block)
        return block, len(block)
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        raise WarcError("an HTTP block without an end of its header")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    if headers.get("warc-type") == "revisit":
        return None, int(stated[1]) if stated else 0
    if stated and int(stated[1]) != len(body):
        raise WarcError("a payload of another length than its HTTP header says")
    _check("payload", headers.get("warc-payload-digest"), body)
    return body, len(body)


# Schemes under which Spark knows a store, and those under which Arrow does.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def arrow_uri(uri: str) -> str:
    """A place as Spark names it, as Arrow's file systems name it: plain paths for local and mounted stores."""
    scheme, colon, rest = uri.partition(":")
    if not colon or uri.startswith("/"):
        return uri
    if scheme == "file":
        return "/" + rest.lstrip("/")
    if scheme == "dbfs":
        return "/dbfs/" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def _store(uri: str):
    """(file system, path) of a shared place, on any executor."""
    from pyarrow import fs

    uri = arrow_uri(uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 6, roll: int = 256 << 20, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in ``folder`` (shared by all executors); the manifest: (path, records, bytes), a row for each file.

    Of the pages with equal payloads of ``min_bytes`` or more, that with the smallest id is a response and the others are revisits
    of it. Null html is an empty payload, a null url ``about:blank``. Rows that repeat the smallest id are responses, too; rows with a null
    id are revisits if a page with an id has their payload, else responses. An empty table gives no files.

    Payloads are grouped by their digest and length without their bytes, aggregated on the map side first; pages are shuffled once,
    by id. A task writes files of its own attempt; only those in the manifest, which is checkpointed, count.
    """
    html = F.coalesce(named(html_col), F.lit(""))
    base = pages.select(named(id_col).cast("long").alias("id"), named(url_col).alias("url"), html.alias("html"), F.sha1(html).alias("sha"))
    narrow = base.select("id", "sha", F.octet_length("html").alias("size"))
    first = narrow.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL")
    revisits = skew_join(narrow, first, ["sha", "size"]).filter(~F.col("id").eqNullSafe(F.col("first"))).select(F.col("id").alias("r_id"), F.col("sha").alias("r_sha"), "first").distinct()
    rows = base.join(revisits.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("r_id")) & (F.col("sha") == F.col("r_sha")), "left").select("id", "url", "html", "first")

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        store, top = _store(folder)
        store.create_dir(top, recursive=True)
        place = folder.rstrip("/")
        files, out = [], None
        for batch in batches:
            for page, url, text, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or files[-1][2] >= roll:
                    if out is not None:
                        out.close()
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{len(files):04d}.warc.gz"
                    files.append([f"{place}/{name}", 0, 0])
                    out = store.open_output_stream(f"{top.rstrip('/')}/{name}", compression=None)
                data = record_bytes(f"urn:page:{'' if page is None else page}", url or "about:blank", text.encode(), None if refers is None else f"urn:page:{refers}", date, level)
                out.write(data)
                files[-1][1] += 1
                files[-1][2] += len(data)
        if out is not None:
            out.close()
        names, counts, sizes = zip(*files, strict=True) if files else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "records", "bytes"])

    return durable(rows.mapInArrow(write, "path string, records long, bytes long"))


def read_warc(files: DataFrame, payloads: bool = True) -> DataFrame:
    """(record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest[, payload]) of each record of the archives
    in ``files`` (column ``path``), a task for each file. No files: no rows. A damaged archive is an error."""

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = _store(path)
                with store.open_input_stream(at, compression=None) as stream:
                    for headers, block in read_records(stream):
                        payload, size = payload_of(headers, block)
                        digest = (headers.get("warc-payload-digest") or "sha1:" + sha1_base32(payload or b"")).partition(":")[2]
                        rows.append((headers.get("warc-record-id", "").strip("<>"), headers.get("warc-type"), headers.get("warc-target-uri"), headers.get("warc-refers-to", "").strip("<>") or None, size, digest, payload))
                        held += len(block)
                        if held > 8 << 20 or len(rows) >= 10_000:
                            yield pack(rows)
                            rows, held = [], 0
        yield pack(rows)

    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), *[pa.binary()] * payloads]
    names = ["record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", *["payload"] * payloads]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    schema = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string" + ", payload binary" * payloads
    n = max(1, files.count())
    # by range of a total order: each file has a task of its own, or nearly
    return files.select("path").repartitionByRange(n, "path").mapInArrow(read, schema)


def op7_warc(spark, sf_dir):
    """Writes the archives to the shared folder, reads them back, keeps what was read and removes the archives."""
    import uuid

    from ._common import remove_folder, shared_folder, table

    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    try:
        records = durable(read_warc(write_warc(table(spark, sf_dir, "pages"), folder), payloads=False))
    finally:
        remove_folder(spark, folder)
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


SQL = {
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT *, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS least FROM p),
        -- character i of the base-32 form is made of the bits from 5 * i on
        b AS (SELECT *, [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (CAST('0x' || substr(hex, 5 * i // 4 + 1, 2) AS INTEGER) >> (3 - 5 * i % 4)) % 32 + 1, 1) FOR i IN range(32)] AS digits FROM d)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(digits, '') AS payload_digest,
               CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to
        FROM b
    """,
}
