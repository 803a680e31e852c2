"""WARC derivatives: each response record becomes a metadata and a plain-text conversion record.

Both derivatives name the response in WARC-Refers-To, with its target URI and date, and each
other's partner is found through it. The metadata record's block is JSON: the response's WARC
headers, HTTP status and headers, title, links, the response's own digests and whether they
match its bytes, and the id of the conversion record. The conversion record's block is the
page's text. Ids are made from the response's id, so a task that runs again makes the same records.

Every record is handled where it is read; nothing is shuffled.

A null page is an empty one; a null url leaves the target URI out; repeated rows give repeated
records with equal ids; what is no complete response record gives one row of type `unreadable`,
with its sha-256 and no other value; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.text import table

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"  # of the records made from a table without dates
Headers = list[tuple[str, str]]

DROPPED = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I
)
BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|caption|center|dd|div|dl|dt|fieldset|figcaption|"
    r"figure|footer|form|h[1-6]|head|header|hr|li|main|nav|ol|option|p|pre|section|table|tbody|td|"
    r"tfoot|th|thead|title|tr|ul)\b[^>]*(?:>|\Z)",
    re.I,
)
TAG = re.compile(r"<[/!?a-zA-Z][^>]*(?:>|\Z)")
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.S | re.I)
LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
CHARSET = re.compile(rb"""charset\s*=\s*["']?([\w.:-]+)""", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line, its control characters escaped as in a URI."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build(headers: Headers, block: bytes) -> bytes:
    lines = [VERSION, *[f"{k}: {_line(v)}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[str]) -> Headers:
    made: Headers = []
    for line in lines:
        if line[:1] in " \t" and made:
            made[-1] = (made[-1][0], f"{made[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            made.append((name.strip(), value.strip()))
    return made


def parse(record: bytes) -> tuple[Headers, bytes] | None:
    """Headers and block of a record; None if it is cut off or no record."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        return None
    headers = _headers(lines[1:])
    size = get(headers, "Content-Length")
    if not size.isdigit() or len(rest) < int(size):
        return None
    return headers, rest[: int(size)]


def get(headers: Headers, name: str) -> str:
    return next((v for k, v in headers if k.lower() == name.lower()), "")


def _unchunked(body: bytes) -> bytes:
    made, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]+", size) or not int(size, 16):
            return b"".join(made) or body
        made.append(body[end + 2 : end + 2 + int(size, 16)])
        at = end + 4 + int(size, 16)


def http(block: bytes) -> tuple[str, Headers, bytes, bytes]:
    """Status line, headers, payload as sent, and payload without chunks and compression."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    headers, body = _headers(lines[1:]), payload
    if get(headers, "Transfer-Encoding").lower() == "chunked":
        body = _unchunked(body)
    if get(headers, "Content-Encoding").lower() in ("gzip", "deflate"):
        try:
            body = zlib.decompressobj(47).decompress(body)
        except zlib.error:
            pass  # kept as it was sent
    return lines[0], headers, payload, body


def page_text(headers: Headers, body: bytes) -> str:
    named = CHARSET.search(get(headers, "Content-Type").encode()) or CHARSET.search(body[:2048])
    try:
        return body.decode(named[1].decode() if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain(source: str) -> str:
    """Visible text: a line for each block, white space inside it collapsed."""
    bare = TAG.sub("", BREAK.sub("\n", DROPPED.sub("", source.replace("\n", " "))))
    lines = (" ".join(html.unescape(x).split()) for x in bare.split("\n"))
    return "\n".join(x for x in lines if x)


def response(page_id, url: str | None, source: str | None, date: str = DATE) -> bytes:
    """A response record for a stored page."""
    body = (source or "").encode("utf-8")
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(body)}\r\n\r\n".encode()
        + body
    )
    payload = digest(body)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {payload}")
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", url)] if url is not None else []),
        ("WARC-Payload-Digest", payload),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return build(headers, block)


def derive(record: bytes) -> list[tuple[str, bytes, str]]:
    """(type, record, text) of the two derivatives; none if it is no response."""
    read = parse(record)
    if read is None or get(read[0], "WARC-Type").lower() != "response":
        return []
    headers, block = read
    status, sent, payload, body = http(block)
    source = page_text(sent, body)
    about, uri = get(headers, "WARC-Record-ID"), get(headers, "WARC-Target-URI")
    ids = {
        k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{about} {k}')}>"
        for k in ("metadata", "conversion")
    }

    def matches(name: str, data: bytes) -> bool | None:
        claimed = get(headers, name)
        return claimed.upper() == digest(data).upper() if claimed.startswith("sha1:") else None

    def made(kind: str, content_type: str, own: bytes) -> bytes:
        date = get(headers, "WARC-Date")
        return build(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", ids[kind]),
                ("WARC-Date", date),
                *([("WARC-Target-URI", uri)] if uri else []),
                ("WARC-Refers-To", about),
                *([("WARC-Refers-To-Target-URI", uri)] if uri else []),
                ("WARC-Refers-To-Date", date),
                ("WARC-Block-Digest", digest(own)),
                ("Content-Type", content_type),
            ],
            own,
        )

    title = TITLE.search(source)
    links = [html.unescape(x.strip("\"'")) for x in LINK.findall(source)]
    described = {
        "source": headers,
        "http": {"status": status, "headers": sent},
        "payload_digest": get(headers, "WARC-Payload-Digest") or digest(payload),
        "payload_digest_matches": matches("WARC-Payload-Digest", payload),
        "block_digest_matches": matches("WARC-Block-Digest", block),
        "title": " ".join(html.unescape(title[1]).split()) if title else None,
        "links": [{"href": x, "url": _joined(uri, x)} for x in links],
        "conversion": ids["conversion"],
    }
    text = plain(source)
    return [
        ("metadata", made("metadata", "application/json", json.dumps(described).encode()), ""),
        ("conversion", made("conversion", "text/plain; charset=utf-8", text.encode()), text),
    ]


def _joined(base: str, link: str) -> str:
    try:
        return urljoin(base, link)
    except ValueError:
        return link


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """page_id and a response record for every row of (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))
            made = [response(*row, date) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(made, pa.binary())], ["page_id", "record"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, record binary")


def records_of_files(spark: SparkSession, path: str) -> DataFrame:
    """file, place and bytes of the records of .warc and .warc.gz files, a file to a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(*(batch.column(c).to_pylist() for c in ("path", "content"))):
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                for place, (at, end) in enumerate(_spans(data)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([place], pa.int64()), pa.array([data[at:end]])],
                        ["file", "place", "record"],
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, place long, record binary")


def _spans(data: bytes) -> Iterator[tuple[int, int]]:
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        head = data.find(b"\r\n\r\n", at)
        size = get(_headers(data[at:head].decode("utf-8", "replace").split("\r\n")), "Content-Length")
        end = head + 4 + int(size) + 4 if head >= 0 and size.isdigit() else len(data)
        yield at, min(end, len(data))
        at = end


OUT = (
    "record_type string, record_id string, refers_to string, target_uri string, "
    "source_digest string, block_digest string, n_chars long, record binary"
)


def derivatives(records: DataFrame, *keys: str) -> DataFrame:
    """The derivatives of (keys, record), with the headers that link them read back from them."""
    kinds = dict(records.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in OUT.split(", ")]
        for batch in batches:
            rows, made = [], []
            for i, record in enumerate(batch.column("record").to_pylist()):
                found = derive(record or b"")
                payload = get((parse(record) or ([], b""))[0], "WARC-Payload-Digest") if found else ""
                for kind, own, text in found:
                    head = parse(own)[0]
                    about = ("WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI")
                    values = [get(head, k) or None for k in about]
                    made.append(
                        (kind, *values, payload or None, get(head, "WARC-Block-Digest"), len(text), own)
                    )
                if not found:
                    made.append(("unreadable", None, None, None, None, None, None, record or b""))
                rows += [i] * max(1, len(found))
            kinds_ = [pa.string()] * 6 + [pa.int64(), pa.binary()]
            columns = list(zip(*made)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k).take(pa.array(rows, pa.int64())) for k in keys],
                    *[pa.array(c, t) for c, t in zip(columns, kinds_)],
                ],
                [*keys, *names],
            )

    own = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    return records.select(*keys, "record").mapInArrow(run, own + OUT)


def op9_warc_derive(spark: SparkSession, folder: str) -> DataFrame:
    made = derivatives(responses(table(spark, folder, "pages", "page_id", "url", "html")), "page_id")
    return made.select(
        "page_id",
        "record_type",
        "record_id",
        "refers_to",
        "target_uri",
        "source_digest",
        "block_digest",
        "n_chars",
        F.length("record").cast("long").alias("n_bytes"),
        F.sha2("record", 256).alias("record_sha256"),
    )
