"""Revisit resolution over WARC archives.

Records are keyed by the digest of their payload. Headers alone are shuffled by digest; of equal
payloads the record with the smallest id is the response and the others are revisits of it. The
archives are then written anew: each record is one gzip member with fresh headers and the HTTP
headers of its page, responses with their payload, revisits without. A revisit names the id, URI
and date of the record it refers to, so that any reader of the format can follow it. A manifest
lists the files that finished tasks left, and reading goes by the manifest, so files of lost or
repeated tasks are never read.

Record ids derive from id, URL and digest, and all records have the date of the run, so a task
that runs again writes the same records.

Defined results: a null payload is the empty payload. Rows that are equal throughout give records
with the same record id. Where the response's id has several URLs, revisits name the smallest. Records whose payload is shorter than
``least`` bytes are all responses. Repeated rows (one id twice) are all written; a record with
the response's id is a response, and so is one without an id. An empty table makes no file.
Other columns do not matter.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.shared import ship, stored
from ledgerlake.session import scratch_path

#: A new file is begun when the current one has so many bytes.
FILE_BYTES = 64 << 20
GZIP_LEVEL = 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's for URLs
DATE = "%Y-%m-%dT%H:%M:%SZ"
HTTP_TYPE = "application/http; msgtype=response"

HEADERS = "page_id long, url string, payload_bytes long, payload_digest string"
MANIFEST = "file string, n_records long, file_bytes long"
RECORDS = (
    "page_id long, record_type string, url string, payload_bytes long, payload_digest string,"
    " refers_to long, payload binary"
)


def digest_of(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1 of a payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [html or b"" for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(map(len, payloads), pa.int64()),
                pa.array(map(digest_of, payloads), pa.string()),
            ],
            ["page_id", "url", "payload_bytes", "payload_digest"],
        )


def headers(pages: DataFrame) -> DataFrame:
    """The payload headers of ``pages`` (page_id, url, html)."""
    return pages.select(
        F.col("page_id").cast("long"), "url", F.col("html").cast("binary").alias("html")
    ).mapInArrow(_measured, HEADERS)


def resolve(found: DataFrame, least: int = 0) -> DataFrame:
    """The records of ``found`` headers that revisit another: id, digest, and the original's id
    (refers_to) and URL (refers_to_url).

    The first id per digest is aggregated before the shuffle, so a payload shared by a third of
    all records costs one row per task. Both sides of the join come from plain exchanges, which
    adaptive execution splits where one digest is hot.
    """
    first = (
        found.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1")
        .drop("n")
    )
    first = stored(first, "warc-first")
    key = ["payload_digest", "payload_bytes"]
    originals = (
        first.join(found, key)
        .filter("page_id = first_id")
        .groupBy(*key, "first_id")
        .agg(F.min(F.coalesce("url", F.lit(""))).alias("refers_to_url"))
    )
    return (
        found.select("page_id", *key)
        .join(originals, key)
        .filter("page_id <> first_id")
        .select(
            "page_id", "payload_digest", F.col("first_id").alias("refers_to"), "refers_to_url"
        )
        .distinct()  # an id may repeat with the same payload
    )


def record_id(page_id: int | None, url: str | None, payload_digest: str) -> str:
    own = "" if page_id is None else page_id
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{own} {payload_digest} {url or ""}')}>"


def record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    payload_digest: str,
    original: tuple[int, str] | None,
    now: str,
) -> bytes:
    """One record as a gzip member; ``original`` is the id and URL of the record it revisits."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http + payload if original is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, url, payload_digest)}",
        f"WARC-Date: {now}",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"Content-Type: {HTTP_TYPE}",
        f"Content-Length: {len(body)}",
    ]
    if original is not None:
        refers_to, refers_to_url = original
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, refers_to_url, payload_digest)}",
            f"WARC-Refers-To-Target-URI: {_header(refers_to_url)}",
            f"WARC-Refers-To-Date: {now}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + body + b"\r\n\r\n", GZIP_LEVEL, mtime=0)


def _header(value: str | None) -> str:
    """A value fit for one header line: percent-encoded where a line could end or begin."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n\t %" else c for c in value or "")


def _value(header: str) -> str:
    for code, char in (("%0D", "\r"), ("%0A", "\n"), ("%09", "\t"), ("%20", " "), ("%25", "%")):
        header = header.replace(code, char)
    return header


def _writer(folder: str, now: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, path, n, size = None, "", 0, 0

        def finished() -> pa.RecordBatch:
            out.close()
            row = [[path], [n], [size]]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.string()), *(pa.array(x, pa.int64()) for x in row[1:])],
                ["file", "n_records", "file_bytes"],
            )

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for page_id, url, html, refers_to, other, digest in zip(*columns, strict=True):
                if out is None:
                    # The name is new for every attempt; only the manifest makes a file count.
                    path, n, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                payload = html or b""
                original = None if refers_to is None else (refers_to, other)
                member = record(page_id, url, payload, digest, original, now)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= FILE_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return write


def write_archives(pages: DataFrame, revisits: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; the manifest of files.

    ``revisits`` has page_id, payload_digest, refers_to and refers_to_url of the records that
    become revisits.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.col("html").cast("binary").alias("html")
    ).mapInArrow(
        _with_digest, "page_id long, url string, html binary, payload_digest string"
    )
    named = rows.join(revisits, ["page_id", "payload_digest"], "left").select(
        "page_id", "url", "html", "refers_to", "refers_to_url", "payload_digest"
    )
    now = datetime.now(timezone.utc).strftime(DATE)
    return stored(named.mapInArrow(_writer(folder, now), MANIFEST), "warc-manifest")


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [digest_of(html or b"") for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(digests, pa.string())],
            [*batch.schema.names, "payload_digest"],
        )


def records_in(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and body of every record of an archive."""
    with gzip.GzipFile(fileobj=stream) as archive:
        reader = io.BufferedReader(archive, 1 << 20)
        while line := reader.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"a record begins with {line[:40]!r}")
            found = _named(iter(reader.readline, b"\r\n"))
            body = reader.read(int(found["content-length"]))
            if reader.read(4) != b"\r\n\r\n":
                raise ValueError("a record's length is not that of its header")
            yield found, body


def _named(lines: Iterable[bytes]) -> dict[str, str]:
    parts = (line.decode().rstrip("\r\n").partition(": ") for line in lines)
    return {name.lower(): value for name, _, value in parts}


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """The HTTP headers (lower-case names) of a record's block, and what follows them."""
    head, _, body = block.partition(b"\r\n\r\n")
    return _named(head.split(b"\r\n")[1:]), body


def _reader(folder: str, payloads: bool):
    def number(value: str | None) -> int | None:
        return int(value) if value else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["page_id", "record_type", "url", "payload_bytes", "payload_digest"]
        names += ["refers_to", "payload"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [*types, pa.binary()], strict=True)],
                names,
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for found, body in records_in(stream):
                        response = found["warc-type"] == "response"
                        http, body = http_parts(body)
                        if response and digest_of(body) != found["warc-payload-digest"][5:]:
                            raise ValueError(f"a payload in {path} is not what was written")
                        rows.append(
                            (
                                number(found["x-page-id"]),
                                found["warc-type"],
                                _value(found["warc-target-uri"]),
                                int(http["content-length"]),
                                found["warc-payload-digest"].removeprefix("sha1:"),
                                number(found.get("x-refers-to-page-id")),
                                body if payloads and response else None,
                            )
                        )
                        held += len(body) if payloads else 0
                        if len(rows) >= 5_000 or held >= FILE_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return read


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a manifest's archives; ``payload`` is null for revisits."""
    tasks = manifest.sparkSession.sparkContext.defaultParallelism
    spread = manifest.select("file").repartition(max(tasks, manifest.count()))
    return spread.mapInArrow(_reader(folder, payloads), RECORDS)


def deduplicate(
    pages: DataFrame, folder: str | None = None, least: int = 0
) -> tuple[DataFrame, str]:
    """Write deduplicated archives of ``pages`` (page_id, url, html); manifest and folder.

    Without a ``folder`` they go to the shared one, until the application ends.
    """
    spark: SparkSession = pages.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    revisits = resolve(stored(headers(pages), "warc-headers"), least)
    return write_archives(pages, revisits, folder), folder
