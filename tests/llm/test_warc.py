import base64
import gzip
import hashlib
import time
import uuid
from html.parser import HTMLParser

import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from loomdoc.llm import queries, warc


def test_records_round_trip():
    rows = [(1, "http://a/b", "<p>x</p>"), (2, None, None), (3, "http://é/\r\nInjected: yes", "WARC/1.1\r\n\r\n€"), (4, "u", "a\r\n\r\n" * 50)]
    made = [warc.response(*r) for r in rows]
    for data in (b"".join(made), warc.decompressed(warc.compressed(made))):
        found = list(warc.parse(data))
        assert len(found) == len(rows)
        for (headers, block), (_, url, html) in zip(found, rows, strict=True):
            assert warc.first(headers, "warc-block-digest") == warc.digest(block)
            assert warc.first(headers, "Injected") is None
            status, answered, payload = warc.http(block)
            assert status == "HTTP/1.1 200 OK" and payload.decode() == (html or "")
            assert warc.first(headers, "WARC-Payload-Digest") == warc.digest(payload)
            assert int(warc.first(answered, "content-length")) == len(payload)


def test_derivatives_are_linked_and_whole():
    html = "<!DOCTYPE html><html><head><title>A &amp; B</title><style>x{}</style><script>if (a<b) 'p'</script></head><body><!-- no --><h1>Head</h1><p>one <b>two</b>\nthree<br>four&nbsp;&eacute;<a href='/x?a=1&amp;b=2'>link</a><a class=q href=/y>z</a></p></body></html>"
    (headers, block), = warc.parse(warc.response(5, "http://h/p", html))
    (kind, meta, fields), (kind2, conv, text) = warc.derive(headers, block)
    assert (kind, kind2) == ("metadata", "conversion")
    for h, data in ((meta, fields), (conv, text)):
        assert warc.first(h, "WARC-Refers-To") == warc.first(headers, "WARC-Record-ID") != warc.first(h, "WARC-Record-ID")
        assert warc.first(h, "WARC-Target-URI") == warc.first(h, "WARC-Refers-To-Target-URI") == "http://h/p"
        assert warc.first(h, "WARC-Block-Digest") == warc.digest(data)
        (again, same), = warc.parse(warc.build(h, data))
        assert same == data and warc.first(again, "WARC-Refers-To") == warc.first(h, "WARC-Refers-To")
    assert text.decode() == "A & B\nHead\none two three\nfour élinkz"
    told = warc._headers(fields)
    assert ("title", "A & B") in told and ("outlink", "/x?a=1&b=2") in told and ("outlink", "/y") in told
    assert ("source-warc-payload-digest", warc.first(headers, "WARC-Payload-Digest")) in told and ("source-payload-digest", warc.digest(html.encode())) in told
    assert ("http-header", "Content-Type: text/html; charset=utf-8") in told


def response(head, payload):
    return head.replace("\n", "\r\n").encode() + b"\r\n\r\n" + payload


def test_codings_and_charsets():
    chunked = b"5\r\nhello\r\n6;x=1\r\n world\r\n0\r\n\r\n"
    assert warc.http(response("HTTP/1.1 200 OK\nTransfer-Encoding: chunked", chunked))[2] == b"hello world"
    assert warc.http(response("HTTP/1.1 200 OK\nContent-Encoding: gzip", gzip.compress(b"zipped")))[2] == b"zipped"
    assert warc.http(response("HTTP/1.1 200 OK\nContent-Encoding: gzip", b"not zipped"))[2] == b"not zipped"
    head = [("WARC-Record-ID", "<x>"), ("WARC-Type", "response")]
    latin = warc.derive(head, response("HTTP/1.1 200 OK\nContent-Type: text/plain; charset=latin-1", "é".encode("latin-1")))
    assert latin[1][2].decode() == "é"
    meta = warc.derive(head, response("HTTP/1.1 200 OK\nContent-Type: text/html", b"<html><meta charset=nonsense>\xff"))
    assert meta[1][2].decode() == "\ufffd"
    assert [x[0] for x in warc.derive(head, response("HTTP/1.1 200 OK\nContent-Type: image/png", b"\x89PNG"))] == ["metadata"]


def test_spark(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = queries.QUERIES["op7_warc"](spark, data).collect()
    assert len(got) == 2 * pages.count() and {r["type"] for r in got} == {"metadata", "conversion"}
    assert {r["page_id"] for r in got} == {r["page_id"] for r in pages.collect()}
    made = [warc.response(i, f"http://x/{i}", f"<p>text {i}") for i in range(5)]
    (tmp_path / "a.warc.gz").write_bytes(warc.compressed(made))
    (tmp_path / "b.warc").write_bytes(made[0] + b"garbage")
    found = warc.derivatives(warc.files(spark, str(tmp_path))).collect()
    assert sorted(r["type"] for r in found) == ["conversion"] * 6 + ["error"] + ["metadata"] * 6
    assert {r["content"] for r in found if r["type"] == "conversion"} == {f"text {i}" for i in range(5)}


def test_edge_cases(spark):
    rows = [(1, None, None), (None, "u", "<p>x"), (2, "u", "<p>x"), (2, "u", "<p>x"), (3, "u", "<" * 2000 + "p>" * 2000)]
    t = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.report(t.withColumns({c: F.lit(0) for c in ("name", "record", "type", "content")})).collect()
    assert len(got) == 10 and sum(r["page_id"] is None for r in got) == 2
    assert warc.report(t.limit(0)).count() == 0
    broken = spark.createDataFrame([("a", bytearray(b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort")), ("b", None), ("c", bytearray(b"\x1f\x8bxx"))], "name string, record binary")
    assert sorted(r["name"] for r in warc.derivatives(broken).where("type = 'error'").collect()) == ["a", "c"]


class Reader(HTMLParser):
    """Text, title and links by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.title, self.links, self.silent, self.inside = [""], None, [], 0, False

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "template", "noscript"):
            self.silent += 1
        if tag == "title" and self.title is None:
            self.title, self.inside = "", True
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])
        if tag not in ("a", "b", "i", "span", "em", "strong"):
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "template", "noscript"):
            self.silent -= 1
        self.inside = self.inside and tag != "title"
        if tag not in ("a", "b", "i", "span", "em", "strong"):
            self.lines.append("")

    def handle_data(self, data):
        if self.inside:
            self.title += data
        if not self.silent:
            self.lines[-1] += data


def plain_derivatives(page_id, url, html):
    """Every column of the query for one page, without the module."""
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    name = lambda x: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, x)}>"
    url, payload = url or "", (html or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    own, date = name(f"{page_id} {url}"), "2024-01-01T00:00:00Z"
    source = [("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", url), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", sha(payload)), ("WARC-Block-Digest", sha(block)), ("Content-Length", str(len(block)))]
    r = Reader()
    r.feed(html or "")
    r.close()
    text = "\n".join(x for line in r.lines if (x := " ".join(line.split())))
    fields = [("source-block-digest", sha(block)), ("source-payload-digest", sha(payload)), ("http-status", "HTTP/1.1 200 OK"), ("source-warc-block-digest", sha(block)), ("source-warc-payload-digest", sha(payload))]
    fields += [("source-header", f"{k}: {v}".strip()) for k, v in source] + [("http-header", "Content-Type: text/html; charset=utf-8"), ("http-header", f"Content-Length: {len(payload)}"), ("charset", "utf-8")]
    fields += ([("title", " ".join(r.title.split()))] if r.title is not None else []) + [("outlink", x) for x in r.links]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields)
    for kind, content, body in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        data = body.encode()
        head = [("WARC-Type", kind), ("WARC-Record-ID", name(f"{kind} {own}")), ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Refers-To", own), ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", date), ("Content-Type", content), ("WARC-Block-Digest", sha(data)), ("Content-Length", str(len(data)))]
        record = "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in head)]).encode() + b"\r\n\r\n" + data + b"\r\n\r\n"
        yield {"page_id": page_id, "type": kind, "record_id": name(f"{kind} {own}"), "refers_to": own, "target_uri": url, "date": date, "content_type": content, "block_digest": sha(data), "source_block_digest": sha(block), "content_length": len(data), "content": body, "record_sha256": hashlib.sha256(record).hexdigest()}


def test_query_against_the_standard_library(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()
    want = [x for p in pages for x in plain_derivatives(*p)]
    got = [r.asDict() for r in queries.QUERIES["op7_warc"](spark, data).collect()]
    key = lambda x: (x["page_id"], x["type"])
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("unit", ["<!--", "<script>", "<a ", "<a href=", '<a href="', "<title>", "</", "<!doctype ", "<style ", "&", "<template>x</templat"])
def test_hostile_html_is_linear(unit):
    began = time.process_time()
    text, _, _ = warc.read_html(unit * (3_000_000 // len(unit)) + "<p>end")
    assert time.process_time() - began < 20 and isinstance(text, str)


def test_unclosed_parts_are_text():
    assert warc.read_html("a<!-- b <p>c") == ("a<!-- b\nc", None, [])
    assert warc.read_html("<script>a <p>b") == ("a\nb", None, [])
    assert warc.read_html("x < y <1 <") == ("x < y <1 <", None, [])


def test_reading_goes_on_after_a_broken_record(spark, tmp_path):
    made = [warc.response(i, f"http://x/{i}", f"<p>text {i}") for i in range(3)]
    cut = made[1].replace(b"Content-Length: ", b"Content-Length: 99999", 1)
    for name, data in (("plain", made[0] + made[1].replace(b"Content-Length", b"Content-Lengt", 1) + made[2]), ("far", made[0] + cut + made[2]), ("noise", made[0] + b"noise\r\n" + made[2])):
        broken = []
        assert [warc.first(h, "WARC-Target-URI") for h, _ in warc.all_records(data, broken)] == ["http://x/0", "http://x/2"], name
        assert broken
    z = [gzip.compress(r) for r in made]
    z[1] = z[1][:30] + b"????" + z[1][34:]
    broken = []
    assert [warc.first(h, "WARC-Target-URI") for h, _ in warc.all_records(b"".join(z), broken)] == ["http://x/0", "http://x/2"] and broken
    whole = b"".join(made)
    parts = b"".join(gzip.compress(whole[i : i + 100]) for i in range(0, len(whole), 100))  # members that do not end with records
    for data in (gzip.compress(whole), parts):
        assert len(list(warc.all_records(data))) == 3
    (tmp_path / "x.warc.gz").write_bytes(b"".join(z))
    found = warc.derivatives(warc.files(spark, str(tmp_path))).collect()
    assert sorted(r["type"] for r in found) == ["conversion"] * 2 + ["error"] + ["metadata"] * 2
