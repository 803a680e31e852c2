from __future__ import annotations

import gzip
import json
import zlib

from tillmetrics.llm import warc_derive as X

PAGES = "page_id long, url string, html string"
HTML = "<title>T &amp; u</title><script>x</script><p>Hé <b>y</b><a href='/z?a=1&amp;b'>z</a><!-- c --><p>q"


def test_round_trip():
    record = X.response(1, "http://a.example/\r\nx", HTML)
    headers, block = X.parse(record)
    assert X.get(headers, "warc-target-uri") == "http://a.example/%0D%0Ax"
    assert X.get(headers, "WARC-Block-Digest") == X.digest(block)
    assert X.http(block)[3].decode() == HTML
    assert X.build([h for h in headers if h[0] != "Content-Length"], block) == record


def test_derivatives_are_linked():
    record = X.response(1, "http://a.example/d/", HTML)
    source, _ = X.parse(record)
    (kind, meta, _), (other, conversion, text) = X.derive(record)
    assert (kind, other, text) == ("metadata", "conversion", "T & u\nHé yz\nq")
    (meta_head, meta_block), (head, block) = X.parse(meta), X.parse(conversion)
    assert block.decode() == text and X.get(head, "WARC-Block-Digest") == X.digest(block)
    for h in (meta_head, head):
        assert X.get(h, "WARC-Refers-To") == X.get(source, "WARC-Record-ID")
        assert X.get(h, "WARC-Refers-To-Target-URI") == "http://a.example/d/"
        assert X.get(h, "WARC-Date") == X.get(h, "WARC-Refers-To-Date") == X.DATE
    said = json.loads(meta_block)
    assert [tuple(x) for x in said["source"]] == source
    assert said["payload_digest"] == X.get(source, "WARC-Payload-Digest")
    assert said["payload_digest_matches"] and said["block_digest_matches"]
    assert said["conversion"] == X.get(head, "WARC-Record-ID")
    assert said["links"] == [{"href": "/z?a=1&b", "url": "http://a.example/z?a=1&b"}]
    assert said["title"] == "T & u"


def test_encoded_payloads():
    body = "<p>é".encode("latin-1")
    packed = gzip.compress(body)
    chunks = b"5\r\n" + packed[:5] + b"\r\n" + f"{len(packed) - 5:x};x=1\r\n".encode() + packed[5:] + b"\r\n0\r\n\r\n"
    block = (
        b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n"
        b"Content-Type: text/html; charset=ISO-8859-1\r\n\r\n" + chunks
    )
    record = X.build([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x:1>")], block)
    (_, meta, _), (_, _, text) = X.derive(record)
    said = json.loads(X.parse(meta)[1])
    assert text == "é" and said["payload_digest"] == X.digest(chunks)
    assert said["payload_digest_matches"] is None
    odd = block.replace(b"gzip", b"deflate").replace(chunks, zlib.compress(b"<p>ok"))
    assert X.derive(X.build([("WARC-Type", "response")], odd.replace(b"chunked", b"none")))[1][2] == "ok"


def test_every_row_is_accounted_for(spark, folder):
    rows = [(1, "http://a.example/", HTML), (2, None, None), (None, "", ""), (3, "u", "x " * 300_000)]
    rows.append(rows[0])
    extra = spark.createDataFrame([(*r, b"r", 5) for r in rows], PAGES + ", record binary, n_chars int")
    path = folder(pages=extra)
    found = X.op9_warc_derive(spark, path).collect()
    assert len(found) == 2 * len(rows)
    assert {r.record_type for r in found} == {"metadata", "conversion"}
    assert len({r.record_id for r in found}) == 8
    assert {r.n_chars for r in found if r.record_type == "conversion"} == {13, 0, 599_999}
    again = X.op9_warc_derive(spark, path).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert X.op9_warc_derive(spark, folder(pages=extra.limit(0))).count() == 0


def test_what_is_no_response(spark):
    whole = X.response(1, "u", HTML)
    bad = [None, b"", b"junk", whole[:-30], X.build([("WARC-Type", "request")], b"")]
    records = spark.createDataFrame([(i, b) for i, b in enumerate(bad)] + [(9, whole)], "id int, record binary")
    found = X.derivatives(records, "id").collect()
    assert [(r.id, r.record_type) for r in found if r.id < 9] == [(i, "unreadable") for i in range(len(bad))]
    assert len(found) == len(bad) + 2


def test_files(spark, tmp_path):
    records = [X.response(i, f"http://a.example/{i}", HTML * i) for i in range(4)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    found = X.records_of_files(spark, str(tmp_path)).collect()
    assert sorted((r.place, bytes(r.record)) for r in found) == sorted(2 * list(enumerate(records)))
