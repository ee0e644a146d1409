"""WARC derivatives: from each response record a metadata record and a plain-text conversion record.

Both refer to the response by ``WARC-Refers-To`` (with its URI and date) and keep its payload
digest; the metadata record lists the headers of the source. Record ids are derived from the id of
the source, so that building them again gives the same records. A record is a row; rows never
leave their partition.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from alertlake.llm.common import slices

VERSION = "WARC/1.1"
#: Date of records built from tables without one.
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6f1c1c0e-3c0b-5d2f-9a60-7d3f0a6d2b11")

HEADERS = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
RECORD = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("block_digest", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("headers", HEADERS),
        T.StructField("block", T.BinaryType()),
    ]
)

# Elements whose content is no text, and those that end a line.
_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|title)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|td|th|table|h[1-6]|article|section|header|footer|nav|aside|main|blockquote|pre|form|body)\b[^<>]*>",
    re.I,
)
_TAG = re.compile(r"""<[a-zA-Z/!?](?:[^<>"']|"[^"]*"|'[^']*')*>|<[a-zA-Z/!?][^<>]*>""")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"<a\b[^>]*\bhref\s*=", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest_of(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def id_of(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(map(str, parts)))}>"


def text_of(markup: str) -> str:
    """Lines of visible text: elements without text dropped, blocks on lines of their own."""
    plain = _TAG.sub("", _BREAK.sub("\n", _UNSEEN.sub(" ", markup)))
    lines = (" ".join(line.split()) for line in html.unescape(plain).split("\n"))
    return "\n".join(line for line in lines if line)


def http_parts(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers and body of an HTTP response, transfer and content codings undone.

    Without a status line all is body. A coding that can't be undone leaves the body as it is.
    """
    if not block.startswith(b"HTTP/"):
        return None, [], block
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    status = first.split(" ")[1] if first.count(" ") else ""
    headers = [(n.strip(), v.strip()) for n, sep, v in (x.partition(":") for x in lines) if sep]
    values = {n.lower(): v.lower() for n, v in headers}
    if "chunked" in values.get("transfer-encoding", ""):
        body = _unchunked(body)
    try:
        if values.get("content-encoding") in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif values.get("content-encoding") == "deflate":
            body = _inflated(body)
    except (OSError, EOFError, zlib.error):
        pass
    return int(status) if status.isascii() and status.isdigit() else None, headers, body


def _inflated(body: bytes) -> bytes:
    """Deflate with its header, or raw, as some servers send it."""
    try:
        return zlib.decompress(body)
    except zlib.error:
        return zlib.decompress(body, -15)


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            return body
        if not int(size, 16):
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + int(size, 16)])
        at = end + 4 + int(size, 16)
    return body  # cut short


def _decoded(body: bytes, content_type: str) -> tuple[str, str]:
    found = _CHARSET.search(content_type) or _CHARSET.search(body[:1024].decode("latin-1"))
    charset = found[1].lower() if found else "utf-8"
    try:
        return body.decode(charset, "replace"), charset
    except LookupError:
        return body.decode("utf-8", "replace"), "utf-8"


def _record(kind, record_id, refers_to, uri, date, content_type, payload_digest, headers, block) -> dict:
    return {
        "record_type": kind,
        "record_id": record_id,
        "refers_to": refers_to,
        "target_uri": uri,
        "date": date,
        "content_type": content_type,
        "block_digest": digest_of(block),
        "payload_digest": payload_digest,
        "headers": [{"name": n, "value": v} for n, v in headers],
        "block": block,
    }


def response(source: object, uri: str | None, body: str | None, date: str = DATE) -> dict:
    """A response record for a page; a null body is empty, a null URI is named after its source."""
    payload = (body or "").encode()
    uri = uri or f"urn:x-page:{source}"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    return _record(
        "response", id_of("response", source, uri, digest_of(payload)), None, uri, date,
        "application/http;msgtype=response", digest_of(payload), [], block,
    )


def derivatives(source: dict) -> list[dict]:
    """The metadata and the conversion record of a response; none of any other record.

    A response whose content is no text gets a metadata record only.
    """
    if source["record_type"] != "response":
        return []
    status, headers, body = http_parts(source["block"] or b"")
    content_type = next((v for n, v in headers if n.lower() == "content-type"), "text/html")
    markup, charset = _decoded(body, content_type)
    is_text = content_type.lower().startswith("text/") or "xhtml" in content_type.lower()
    is_html = is_text and "plain" not in content_type.lower()
    text = (text_of(markup) if is_html else markup) if is_text else ""
    title = _TITLE.search(markup) if is_html else None
    block = text.encode()
    links = [
        ("WARC-Refers-To-Target-URI", source["target_uri"] or ""),
        ("WARC-Refers-To-Date", source["date"] or ""),
    ]
    own = id_of("metadata", source["record_id"])
    converted = id_of("conversion", source["record_id"])
    digest = source["payload_digest"] or digest_of(body)
    fields = [
        ("source-record", source["record_id"]),
        ("source-payload-digest", digest),
        ("http-status", "" if status is None else str(status)),
        *((f"source-header-{n.lower()}", v) for n, v in headers),
        ("charset", charset),
        ("title", " ".join(html.unescape(title[1]).split()) if title else ""),
        ("links", str(len(_LINK.findall(markup))) if is_html else "0"),
        *([("conversion-record", converted), ("text-bytes", str(len(block)))] if is_text else []),
    ]
    listed = "".join(f"{n}: {v}\r\n" for n, v in fields).encode()
    made = [
        _record(
            "metadata", own, source["record_id"], source["target_uri"], source["date"],
            "application/warc-fields", digest, links, listed,
        )
    ]
    if is_text:
        made.append(
            _record(
                "conversion", converted, source["record_id"], source["target_uri"], source["date"],
                "text/plain; charset=utf-8", digest, [*links, ("WARC-Concurrent-To", own)], block,
            )
        )
    return made


def _line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def serialised(record: dict) -> bytes:
    """The record as bytes of a WARC file."""
    head = [
        ("WARC-Type", record["record_type"]),
        ("WARC-Record-ID", record["record_id"]),
        ("WARC-Date", record["date"]),
        ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Refers-To", record["refers_to"]),
        *((h["name"], h["value"]) for h in record["headers"] or []),
        ("WARC-Block-Digest", record["block_digest"]),
        ("WARC-Payload-Digest", record["payload_digest"]),
        ("Content-Type", record["content_type"]),
        ("Content-Length", len(record["block"] or b"")),
    ]
    lines = "".join(f"{n}: {_line(v)}\r\n" for n, v in head if v is not None)
    return f"{VERSION}\r\n{lines}\r\n".encode() + (record["block"] or b"") + b"\r\n\r\n"


_NAMED = {
    "warc-type": "record_type",
    "warc-record-id": "record_id",
    "warc-date": "date",
    "warc-target-uri": "target_uri",
    "warc-refers-to": "refers_to",
    "warc-block-digest": "block_digest",
    "warc-payload-digest": "payload_digest",
    "content-type": "content_type",
}


#: Record type of bytes that are no record; the reason is in their only header.
UNPARSED = "unparsed"
_MEMBER, _PADDING = b"\x1f\x8b\x08", b"\0\r\n\t "
_NEXT = re.compile(rb"(?:^|(?<=\n))WARC/\d")


def _unparsed(raw: bytes, reason: str) -> Iterator[dict]:
    if raw.strip(_PADDING):
        headers = [{"name": "Reason", "value": reason}]
        yield dict.fromkeys(RECORD.names) | {"record_type": UNPARSED, "headers": headers, "block": raw}


def parsed(raw: bytes) -> Iterator[dict]:
    """The records of a WARC file, plain or compressed by record.

    Padding between records or members is skipped. What is no record, or a broken one, comes out
    as a row of type UNPARSED with its bytes, and reading goes on at the next record or member.
    """
    if raw[:2] != _MEMBER[:2]:
        yield from _plain_records(raw)
        return
    at = 0
    while at < len(raw):
        member = zlib.decompressobj(31)
        try:
            plain = member.decompress(raw[at:] if at else raw)
        except zlib.error:
            end = raw.find(_MEMBER, at + 1)
            end = len(raw) if end < 0 else end
            yield from _unparsed(raw[at:end], "no gzip member")
            at = end
            continue
        yield from _plain_records(plain)
        if not member.eof:
            yield from _unparsed(raw[at:], "gzip member cut short")
            return
        at = len(raw) - len(member.unused_data.lstrip(_PADDING))


def _plain_records(raw: bytes) -> Iterator[dict]:
    at = 0
    while at < len(raw):
        begin = _NEXT.search(raw, at)
        if not begin:
            yield from _unparsed(raw[at:], "no record")
            return
        yield from _unparsed(raw[at : begin.start()], "no record")
        at = begin.start()
        end = raw.find(b"\r\n\r\n", at)
        following = _NEXT.search(raw, at + 5)
        if end < 0 or following and following.start() < end:
            stop = following.start() if following else len(raw)
            yield from _unparsed(raw[at:stop], "header without its end")
            at = stop
            continue
        record, size = _header(raw[at:end])
        if size is None or end + 4 + size > len(raw):
            stop = following.start() if following else len(raw)
            yield from _unparsed(raw[at:stop], "no length" if size is None else "block cut short")
            at = stop
            continue
        record["block"] = raw[end + 4 : end + 4 + size]
        yield record
        at = end + 4 + size


def _header(raw: bytes) -> tuple[dict, int | None]:
    """A record without its block, and the length of that; None if it is missing or no number."""
    record = dict.fromkeys(RECORD.names) | {"headers": []}
    size = None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        name, value = name.strip(), value.strip()
        if name.lower() == "content-length":
            size = int(value) if value.isascii() and value.isdigit() else None
        elif name.lower() in _NAMED:
            record[_NAMED[name.lower()]] = value
        else:
            record["headers"].append({"name": name, "value": value})
    return record, size


def _batch(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def from_pages(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, the columns of RECORD): a response record for each row of (page_id, url, html)."""
    given = pages.select("page_id", "url", "html")
    schema = T.StructType([given.schema["page_id"], *RECORD.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield _batch(
                [{"page_id": r["page_id"]} | response(r["page_id"], r["url"], r["html"], date) for r in part.to_pylist()],
                schema,
            )

    return given.mapInArrow(run, schema)


def derive(records: DataFrame) -> DataFrame:
    """The derivatives of the response records of ``records``; columns besides RECORD's are kept."""
    schema = records.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [row | made for row in part.to_pylist() for made in derivatives(row)]
            if rows:
                yield _batch(rows, schema)

    return records.mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files (plain or .gz), with rows of type UNPARSED for what is none.

    A file is read by one task, which holds it: up to some hundred megabytes, or the 2 GB that Spark reads.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            held: list[dict] = []
            for record in parsed(part.column(0)[0].as_py()):
                held.append(record)
                if len(held) == 256:
                    yield _batch(held, RECORD)
                    held = []
            if held:
                yield _batch(held, RECORD)

    return files.mapInArrow(run, RECORD)


def write(records: DataFrame, uri: str) -> DataFrame:
    """Writes a file compressed by record for each partition below ``uri``; (file, records, bytes).

    The folder has to be one that every executor reaches. A file appears under its name when it
    is whole; a task that runs again replaces it by the same content.
    """
    schema = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
        system.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.warc.gz"
        part = f"{root}/.{name}.{uuid.uuid4().hex}"
        n = size = 0
        with system.open_output_stream(part, compression=None) as out:
            for rows in slices(batches):
                for record in rows.to_pylist():
                    member = gzip.compress(serialised(record), mtime=0)
                    out.write(member)
                    n, size = n + 1, size + len(member)
        if n:
            system.move(part, f"{root}/{name}")
            yield _batch([{"file": name, "records": n, "bytes": size}], schema)
        else:
            system.delete_file(part)

    return records.select(*RECORD.names).mapInArrow(run, schema)


def report(pages: DataFrame) -> DataFrame:
    """Two rows for each page: its metadata and its conversion record, with the text of either."""
    made = derive(from_pages(pages))
    return made.select(
        "page_id",
        "record_type",
        "record_id",
        "refers_to",
        "target_uri",
        "content_type",
        "block_digest",
        "payload_digest",
        F.octet_length("block").cast("long").alias("n_bytes"),
        F.decode("block", "UTF-8").alias("text"),
    )
