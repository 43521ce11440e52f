"""WARC derivatives: metadata and plain-text conversion records for archived responses.

Each response gives one metadata record (application/warc-fields: source headers, title, language, links) and one conversion
record (text/plain). Both refer to the response's record id, keep its target URI and date, and carry block digests; the
metadata record also keeps the digests and the HTTP headers of the source. Record ids follow from the response's id, so a
rerun gives the same records. All work is row by row.

Defined results: null or empty payloads give an empty text and still both records; a null URI leaves the header out; a
response without record id gets one made of its key, URI and payload, one without date UNDATED; repeated rows give repeated
records; markup that is never closed is read up to the end, scripts and the like in a head up to the head's end; text that
stands in a head by mistake is visible, as in browsers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col, sliced
from .markup import RAW, RAW_TAGS, START, TEXT, attributes, events

RECORDS = T.StructType([
    T.StructField("warc_type", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("warc_date", T.StringType()), T.StructField("content_type", T.StringType()),
    T.StructField("block_digest", T.StringType()), T.StructField("source_digest", T.StringType()), T.StructField("content_length", T.LongType()), T.StructField("block", T.BinaryType()),
])

# Elements that end a line, and attributes that link to other resources (fixed values).
BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd br hr table tr td th section article aside nav header footer main form blockquote pre figure figcaption title body html option address".split())
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src", "video": "src", "audio": "src", "embed": "src"}
_SPACES = re.compile(r"[ \t\r\f\v\xa0]+")
_LINES = re.compile(r" ?\n[\n ]*")

_BREAKS = re.compile(r"[\r\n]+[ \t]*")

#: The capture time that records get whose source has none: WARC-Date is mandatory.
UNDATED = "1970-01-01T00:00:00Z"


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def urn(*parts: str) -> str:
    h = hashlib.sha256("\0".join(parts).encode("utf-8", "surrogatepass")).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def read(page: str) -> tuple[str, list[tuple[str, str]]]:
    """All visible text, one line per block, and the fields title, lang and outlink; one pass over the page's events."""
    out: list[str] = []
    title = lang = None
    links: list[tuple[str, str]] = []
    for kind, tag, attrs, raw in events(page, _RAW):
        if kind is TEXT:
            out.append(html.unescape(raw.replace("\n", " ")))
        elif kind is RAW and tag == "textarea":
            out.append(html.unescape(raw.replace("\n", " ")))
        elif kind is RAW and tag == "title" and title is None:
            title = " ".join(html.unescape(raw).split())
        if kind is not TEXT and tag in BLOCKS:
            out.append("\n")
        if kind in (START, RAW) and attrs:
            if tag in LINKS and (to := attributes(attrs).get(LINKS[tag])):
                links.append(("outlink", f"{html.unescape(to).strip()} {tag}/@{LINKS[tag]}"))
            elif tag == "html" and lang is None:
                lang = attributes(attrs).get("lang")
    fields = [("title", title)] if title is not None else []
    fields += [("lang", lang.lower())] if lang else []
    return _LINES.sub("\n", _SPACES.sub(" ", "".join(out))).strip(), fields + links


_RAW = RAW_TAGS - {"svg"}


def text_of(page: str) -> str:
    return read(page)[0]


def headers_of(text: str | None) -> list[tuple[str, str]]:
    """Status line and headers of a response, values as they are but for folded lines, which are joined."""
    out: list[tuple[str, str]] = []
    for line in (text or "").replace("\r\n", "\n").split("\n"):
        if line[:1] in " \t" and line.strip() and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif line.startswith("HTTP/"):
            out.append(("http-status-line", line.strip()))
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append(("http-header-" + name.strip().lower(), value.strip()))
    return out


def derived(record_id: str, uri: str | None, date: str | None, headers: str | None, payload: str) -> Iterator[tuple]:
    """The metadata and the conversion record of one response."""
    raw = payload.encode("utf-8", "surrogatepass")
    source = digest(raw)
    text, fields = read(payload)
    lines = [("refers-to-payload-digest", source), *headers_of(headers), *fields]
    meta = "".join(f"{a}: {_BREAKS.sub(' ', b)}\r\n" for a, b in lines).encode("utf-8", "surrogatepass")
    text = text.encode("utf-8", "surrogatepass")
    for kind, mime, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        yield kind, urn(record_id, kind), record_id, uri, date or UNDATED, mime, digest(block), source, len(block), block


def responses(pages: DataFrame, key_col: str, html_col: str, uri_col: str, date: str = UNDATED) -> DataFrame:
    """Pages as response records: key, record_id, target_uri, warc_date, headers, payload. The id follows from key, URI and payload; null html is empty."""
    payload = F.coalesce(col(html_col), F.lit(""))
    h = F.sha2(F.concat_ws("\n", F.coalesce(col(key_col).cast("string"), F.lit("")), F.coalesce(col(uri_col), F.lit("")), payload), 256)
    cut = lambda a, n: F.substring(h, a, n)
    rid = F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-8"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n"))
    return pages.select(col(key_col).alias("key"), rid.alias("record_id"), col(uri_col).alias("target_uri"), F.lit(date).alias("warc_date"), head.alias("headers"), payload.alias("payload"))


def derive(responses: DataFrame, key_col: str, payload_col: str, uri_col: str | None = None, id_col: str | None = None, date_col: str | None = None, headers_col: str | None = None) -> DataFrame:
    """Two records per response: the key, then the columns of RECORDS."""
    none = F.lit(None).cast("string")
    pick = lambda c: col(c).cast("string") if c else none
    fed = responses.select(col(key_col).alias("key"), *(pick(c).alias(n) for c, n in ((id_col, "id"), (uri_col, "uri"), (date_col, "date"), (headers_col, "headers"), (payload_col, "payload"))))
    schema = T.StructType([T.StructField("key", fed.schema["key"].dataType), *RECORDS.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for key, rid, uri, date, headers, payload in zip(*[c.to_pylist() for c in batch.columns]):
                payload = payload or ""
                rows += [(key, *r) for r in derived(rid or urn("response", str(key), uri or "", payload), uri, date, headers, payload)]
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return fed.mapInArrow(run, schema)


def serialise(warc_type: str, record_id: str, block: bytes, headers: dict[str, str | None], compress: bool = True) -> bytes:
    """One record of an archive; compressed records are gzip members, so a file is their plain concatenation."""
    lines = ["WARC/1.1", f"WARC-Type: {warc_type}", f"WARC-Record-ID: {record_id}", *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}"]
    record = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(record, 6, mtime=0) if compress else record


def members(records: DataFrame, compress: bool = True) -> DataFrame:
    """records with one more column: each record's bytes in an archive file."""
    schema = T.StructType([*records.schema.fields, T.StructField("member", T.BinaryType())])

    def run(batches):
        for b in batches:
            made = []
            for r in b.to_pylist():
                head = {"WARC-Refers-To": r["refers_to"], "WARC-Target-URI": r["target_uri"], "WARC-Date": r["warc_date"], "Content-Type": r["content_type"], "WARC-Block-Digest": r["block_digest"], "WARC-Refers-To-Payload-Digest": r["source_digest"]}
                made.append(serialise(r["warc_type"], r["record_id"], r["block"], head, compress))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary())], names=[*b.schema.names, "member"])

    return records.mapInArrow(run, schema)


def inflated(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file one after another, or the file itself if it isn't compressed. Of a damaged member what can be read is given; reading goes on at the next member."""
    while data[:2] == _GZIP[:2]:
        d, out, pos = zlib.decompressobj(31), [], 0
        try:
            while pos < len(data) and not d.eof:
                out.append(d.decompress(data[pos : pos + 65536]))
                pos += 65536
            rest = d.unused_data + data[pos:]
        except zlib.error:
            at = data.find(_GZIP, 3)
            rest = data[at:] if at >= 0 else b""
        yield b"".join(out)
        data = rest.lstrip(b"\0")
    if data:
        yield data


_GZIP = b"\x1f\x8b\x08"


_LENGTH = re.compile(r"[0-9]{1,18}", re.ASCII).fullmatch


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; a truncated last record gives what is there. A record whose length isn't plain digits is damaged: reading goes on at the next one that begins after its headers."""
    for part in inflated(data):
        pos = 0
        while (start := part.find(b"WARC/", pos)) >= 0:
            end = part.find(b"\r\n\r\n", start)
            if end < 0:
                return
            head = {}
            for line in part[start:end].decode("utf-8", "replace").split("\r\n")[1:]:
                name, _, value = line.partition(":")
                head[name.strip().lower()] = value.strip()
            pos = end + 4
            if _LENGTH(head.get("content-length", "")):
                block = part[pos : pos + int(head["content-length"])]
                yield head, block
                pos += len(block)


def payload_of(block: bytes) -> tuple[str, str]:
    """HTTP headers and decoded body of a response block; chunked and gzip bodies are undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    text = head.decode("latin-1")
    if re.search(r"(?mi)^transfer-encoding:.*chunked", text):
        out, pos = [], 0
        while (eol := body.find(b"\r\n", pos)) >= 0 and (m := re.match(rb"[0-9A-Fa-f]+", body[pos:eol])) and (n := int(m[0], 16)):
            out.append(body[eol + 2 : eol + 2 + n])
            pos = eol + 2 + n + 2
        body = b"".join(out)
    if re.search(r"(?mi)^content-encoding:.*gzip", text) and body[:2] == b"\x1f\x8b":
        body = b"".join(inflated(body))
    charset = re.search(r"(?mi)^content-type:.*charset=[\"']?([\w-]+)", text)
    try:
        return text, body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return text, body.decode("utf-8", "replace")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of archive files: record_id, target_uri, warc_date, headers, payload. Files are read whole, one per task at a time."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("record_id", "target_uri", "warc_date", "headers", "payload")])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            for data in b.column(0):
                rows = []
                for head, block in parse(data.as_py()):
                    if head.get("warc-type") == "response":
                        rows.append((head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-date"), *payload_of(block)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
