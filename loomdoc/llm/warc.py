"""WARC derivative builder: metadata and plain-text conversion records of response records.

Every response gives a ``metadata`` record (fields: digests and headers of the source, charset, title,
links) and a ``conversion`` record (text/plain, UTF-8).  Both point to the response by WARC-Refers-To with
its URI and date, keep its target URI and date, and carry digests of their own block; their ids
derive from the response's, so reruns agree.

Scale.  One pass over the records, no shuffle.  Every step is linear in a record's bytes whatever they hold: markup
is read left to right once, a search that found nothing is not made again.  A task holds one file (a row, of 2 GB at
most), one of its records at a time, and results of 8 MB.

Cases: null url or html is empty; a record that cannot be parsed gives no derivative and is reported
with its error, and reading goes on at the next line that starts with WARC/ or the next gzip member; a tag ends at the
first >; a comment, script, style, template or noscript that does not end is ordinary text; a response that is not text gives metadata only; unknown charsets are read as UTF-8,
bytes that do not decode become U+FFFD; repeated rows give repeated records; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as html_entities
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
CRLF = b"\r\n"


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(text: str) -> str:
    """A header value: no line breaks or other control characters."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", text).strip()


def build(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record; Content-Length is set here."""
    lines = [VERSION, *(f"{k}: {_line(v)}" for k, v in headers if k.lower() != "content-length"), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + CRLF * 2 + block + CRLF * 2


def response(page_id, url: str | None, html: str | None) -> bytes:
    """A response record for a page of the table pages."""
    url, payload = url or "", (html or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    return build(
        [("WARC-Type", "response"), ("WARC-Record-ID", record_id(f"{page_id} {url}")), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("Content-Type", "application/http;msgtype=response"),
         ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block))],
        block,
    )


def _headers(lines: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in lines.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and out:  # folded
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return out


def first(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


_BLANK = re.compile(rb"\r?\n\r?\n")


def _head_end(data: bytes, at: int) -> tuple[int, int]:
    """End of a header block and start of what follows."""
    found = _BLANK.search(data, at)
    return found.span() if found else (-1, -1)


def parse(data: bytes, broken: list[str] | None = None) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, block) of the records in uncompressed WARC data.  A broken record is told in broken, and the next line that
    starts with WARC/ is read; without broken it is a ValueError."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end, body = _head_end(data, at) if data.startswith(b"WARC/", at) else (0, 0)
        if end > 0:
            headers = _headers(data[data.index(b"\n", at) + 1 : end + 1])
            length = first(headers, "Content-Length") or ""
            if length.isdecimal() and body + int(length) <= len(data):
                at = body + int(length)
                yield headers, data[body:at]
                continue
        error = f"no WARC record at byte {at}" if not end else f"headers at byte {at} do not end" if end < 0 else f"bad Content-Length {length[:20]!r} at byte {at}"
        if broken is None:
            raise ValueError(error)
        broken.append(error)
        at = len(data) if end < 0 else data.find(b"\nWARC/", at) + 1 or len(data)  # where no blank line follows, no record does


def _members(data: bytes, broken: list[str] | None = None) -> Iterator[bytes]:
    """The gzip members of data one by one, or data itself where it is plain."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at, view = 0, memoryview(data)
    while at < len(data):
        d, start, out = zlib.decompressobj(31), at, []
        try:
            while at < len(data) and not d.eof:
                out.append(d.decompress(view[at : at + (1 << 16)]))
                at += 1 << 16
            if not d.eof:
                raise zlib.error("member does not end")
            at = min(at, len(data)) - len(d.unused_data)
        except zlib.error as e:
            if broken is None:
                raise
            broken.append(f"gzip member at byte {start}: {e}"[:200])
            at = data.find(b"\x1f\x8b\x08", start + 1)
            at = len(data) if at < 0 else at
            continue
        yield b"".join(out)


def decompressed(data: bytes) -> bytes:
    """WARC data, of any number of gzip members or plain."""
    return b"".join(_members(data))


def all_records(data: bytes, broken: list[str] | None = None) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """parse() of data, plain or of gzip members; those after one that starts a record and before the next such belong to it."""
    held: list[bytes] = []
    for piece in _members(data, broken):
        if held and piece.startswith(b"WARC/"):
            yield from parse(b"".join(held), broken)
            held = []
        held.append(piece)
    yield from parse(b"".join(held), broken)


def compressed(records: list[bytes]) -> bytes:
    """A .warc.gz file: one gzip member per record."""
    return b"".join(gzip.compress(r, mtime=0) for r in records)


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while (end := data.find(b"\n", at)) >= 0:
        try:
            size = int(data[at:end].split(b";")[0].strip() or b"0", 16)
        except ValueError:
            break
        if not size:
            break
        out.append(data[end + 1 : end + 1 + size])
        at = end + 1 + size + (2 if data[end + 1 + size : end + 3 + size] == CRLF else 1)
    return b"".join(out)


def http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload (transfer and content codings removed) of an HTTP response."""
    end, body = _head_end(block, 0)
    if end < 0:
        end = body = len(block)
    status, _, rest = block[:end].partition(b"\n")
    headers = _headers(rest)
    payload = block[body:]
    if (first(headers, "Transfer-Encoding") or "").lower().strip() == "chunked":
        payload = _unchunked(payload)
    coding = (first(headers, "Content-Encoding") or "").lower().strip()
    try:
        if coding in ("gzip", "x-gzip"):
            payload = decompressed(payload)
        elif coding == "deflate":
            payload = zlib.decompress(payload, 15 if payload[:1] == b"\x78" else -15)
    except zlib.error:
        pass  # as it is
    return status.decode("utf-8", "replace").strip(), headers, payload


_CHARSET = re.compile(rb"""<meta[^>]{0,200}?charset\s*=\s*["']?\s*([\w-]+)""", re.I)
_MARKUP = re.compile(r"<(?:!--|!doctype[^>]*>|(/?)([a-z][^\s/>]*)([^>]*)>)", re.I)
_BLOCKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section select table tbody td tfoot th thead title tr ul".split())
_SILENT = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "template", "noscript")}
_HREF = re.compile(r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_GAP = re.compile(r"[ \t\r\f\v\xa0]+")


def _plain(source: str) -> str:
    text = html_entities.unescape(source)
    return "\n".join(x for line in text.split("\n") if (x := _GAP.sub(" ", line).strip()))


def read_html(source: str) -> tuple[str, str | None, list[str]]:
    """Plain text (a line per block, no scripts or styles), title and links of an HTML document, in one pass."""
    source = source.replace("\n", " ")
    last = source.rfind(">") + 1  # markup ends here, so any tag that starts before does end
    out, links, missing = [], [], set()
    title = title_from = None
    at, found = 0, _MARKUP.search(source, 0, last)
    while found:
        start, end = found.span()
        out.append(source[at:start])
        at = end
        close, name, rest = found.groups()
        if name is None:
            if end - start == 4:  # a comment
                to = source.find("-->", end) if "--" not in missing else -1
                if to < 0:
                    missing.add("--")
                    out.append("<!--")
                else:
                    at = to + 3
        else:
            name = name.lower()
            if name in _BLOCKS:
                if name == "title" and title is None:
                    if not close:
                        title_from = len(out)
                    elif title_from is not None:
                        title = "".join(x for x in out[title_from:] if x != "\n")
                out.append("\n")
            elif name == "a" and not close:
                if href := _HREF.search(rest):
                    links.append(html_entities.unescape(next(x for x in href.groups() if x is not None)))
            elif name in _SILENT and not close and name not in missing:
                if to := _SILENT[name].search(source, end):
                    at = to.end()
                else:
                    missing.add(name)
        found = _MARKUP.search(source, at, last)
    out.append(source[at:])
    return _plain("".join(out)), None if title is None else _plain(title), links


def text_of(source: str) -> str:
    return read_html(source)[0]


def derive(headers: list[tuple[str, str]], block: bytes) -> list[tuple[str, list[tuple[str, str]], bytes]]:
    """(type, headers, block) of the metadata and the conversion record of a response record."""
    own, uri = first(headers, "WARC-Record-ID") or "", first(headers, "WARC-Target-URI") or ""
    date = first(headers, "WARC-Date") or DATE
    status, answered, payload = http(block)
    kind = (first(answered, "Content-Type") or "").lower()
    declared = re.search(r"charset\s*=\s*\"?([\w-]+)", kind)
    found = _CHARSET.search(payload[:4096])
    charset = declared[1] if declared else found[1].decode() if found else "utf-8"
    try:
        text = payload.decode(charset, "replace")
    except LookupError:
        charset, text = "utf-8", payload.decode("utf-8", "replace")
    is_html = "html" in kind or (not kind and b"<html" in payload[:1024].lower())
    is_text = is_html or kind.startswith("text/")
    fields = [("source-block-digest", digest(block)), ("source-payload-digest", digest(payload)), ("http-status", status)]
    for name in ("WARC-Block-Digest", "WARC-Payload-Digest"):
        if told := first(headers, name):
            fields.append((f"source-{name.lower()}", told))
    fields += [("source-header", f"{k}: {v}") for k, v in headers]
    fields += [("http-header", f"{k}: {v}") for k, v in answered]
    if is_text:
        fields.append(("charset", charset))
    if is_html:
        text, title, links = read_html(text)
        if title is not None:
            fields.append(("title", title))
        fields += [("outlink", x) for x in links]
    link = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", own), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date)]
    out = []
    made = "".join(f"{k}: {_line(v)}\r\n" for k, v in fields).encode("utf-8", "replace")
    parts = [("metadata", "application/warc-fields", made)]
    if is_text:
        parts.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    for type_, content, data in parts:
        out.append((type_, [("WARC-Type", type_), ("WARC-Record-ID", record_id(f"{type_} {own}")), *link, ("Content-Type", content), ("WARC-Block-Digest", digest(data))], data))
    return out


def responses(pages: DataFrame) -> DataFrame:
    """(name, record) of the pages: one response record each."""

    def run(batches):
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            made = [(p, response(p, u, h)) for p, u, h in rows]
            yield pa.RecordBatch.from_arrays([pa.array([str(p) for p, _ in made], pa.string()), pa.array([r for _, r in made], pa.binary())], names=["name", "record"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "name string, record binary")


def files(spark: SparkSession, path: str) -> DataFrame:
    """(name, record) of .warc and .warc.gz files, a row per file; Arrow batches are of one row then, not of 1024 files."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz}").load(path)
    return found.select(F.col("path").alias("name"), F.col("content").alias("record"))


_DERIVED = "name string, type string, record_id string, refers_to string, target_uri string, date string, content_type string, block_digest string, source_block_digest string, content_length long, content string, record binary, error string"


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all responses in records (name, record: WARC data, plain or gzip),
    and a row of type error for what cannot be parsed."""
    small_batches(records.sparkSession)
    names = [x.split()[0] for x in _DERIVED.split(", ")]
    kinds = [pa.int64() if " long" in x else pa.binary() if " binary" in x else pa.string() for x in _DERIVED.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                broken: list[str] = []
                for headers, block in all_records(data or b"", broken):
                    if (first(headers, "WARC-Type") or "").lower() != "response":
                        continue
                    for type_, made, content in derive(headers, block):
                        told = (first(made, x) for x in ("WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "Content-Type", "WARC-Block-Digest"))
                        rows.append((name, type_, *told, digest(block), len(content), content.decode(), build(made, content), None))
                        size += 3 * len(content)
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                rows += [(name, "error", *[None] * 10, e) for e in broken]
            if rows:
                yield batch_of(rows)

    return records.select("name", "record").mapInArrow(run, _DERIVED)


def report(pages: DataFrame) -> DataFrame:
    """Derivatives of all pages, with a digest of each whole record."""
    found = derivatives(responses(pages))
    return found.select(F.expr("try_cast(name AS BIGINT)").alias("page_id"), "type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "source_block_digest", "content_length", "content", F.sha2("record", 256).alias("record_sha256"))
