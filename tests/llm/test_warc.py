"""The archive converter: foreign archives of both versions, broken ones, and the round trip of pages."""

import base64
import gzip
import hashlib
import io

import brute
import pytest

from cohortmill.llm import warc

PAGES = "page_id long, url string, html string"


def arc(line, block):
    return f"{line} {len(block)}\n".encode() + block + b"\n"


V1 = (arc("filedesc://old.arc 0.0.0.0 19970101000000 text/plain",
          b"1 0 Some Crawler\nURL IP-address Archive-date Content-type Archive-length\n")
      + arc("http://a.org/x y 1.2.3.4 19970101123456 text/html", b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\nhi") + b"\n"
      + arc("dns:a.org 1.2.3.4 199701011234 text/dns", b"1.2.3\n")
      + arc("http://a.org/raw 1.2.3.4 19970102 image/gif", b"\x00\xff\n"))
V2 = (arc("filedesc://new.arc 0.0.0.0 19990101000000 text/plain 200 - - 0 new.arc",
          b"2 0 Some Crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
          b" Archive-length\n")
      + arc("http://b.org/ 4.3.2.1 19990101123456 text/html 200 abc - 190 new.arc", b"HTTP/1.1 200 OK\n\nhi ho"))


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(table):
    best = {}
    for page_id, _, html in table:
        data = (html or "").encode()
        best[data] = max(best.get(data, (-1,)), (-1 if page_id is None else page_id,))
    seen, out = set(), []
    for page_id, _, html in table:
        data = (html or "").encode()
        number = -1 if page_id is None else page_id
        first = (number,) == best[data] and data not in seen
        if first:
            seen.add(data)
        refers = None if first or best[data][0] < 0 else best[data][0]
        out.append((page_id, len(data), b32(data), "response" if first else "revisit", refers))
    return out


def result(spark, table, **options):
    pages = spark.createDataFrame(table, PAGES).selectExpr("*", "'k' as key", "'p' as path", "1 as offset", "2 as digest")
    return brute.collected(warc.archive_pages(pages, **options), "page_id", "payload_bytes", "payload_digest", "record_type",
                           "refers_to")


def test_pages_through_both_formats(spark):
    table = [(1, "http://a.org/", "<p>one</p>"), (2, "http://a.org/ x\n", "<p>one</p>"), (3, None, None), (4, "", ""),
             (5, "u", "\r\n\r\nWARC/1.0\r\n\r\n"), (6, "u", "HTTP/1.1 200 OK\r\n\r\nx"), (7, "u", "é汉\U0001F600" * 3000),
             (7, "u", "<p>twice</p>"), (7, "u", "<p>twice</p>"), (None, "u", "nobody's"), (None, "u", "<p>one</p>"),
             (8, "u", "a long page " * 100_000), (9, "u", "\n")] + [(100 + i, f"h{i}", "copy") for i in range(300)]
    assert result(spark, table) == sorted(expected(table), key=repr)
    assert result(spark, []) == []


def test_small_payloads_are_never_revisits(spark):
    table = [(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "large enough"), (4, "u", "large enough")]
    got = {row[0]: row[3:] for row in result(spark, table, min_bytes=5)}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_archives_are_closed_at_their_size_and_follow_both_versions(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * 1000) for i in range(50)], PAGES).coalesce(2)
    warc.write_arc(pages, str(tmp_path / "arc"), archive_bytes=5000)
    files = sorted((tmp_path / "arc").glob("part-*"))
    contents = [gzip.decompress(f.read_bytes()) for f in files]
    assert len(files) > 10 and max(map(len, contents)) < 7000
    records = [list(warc.read_arc_records(io.BytesIO(c))) for c in contents]
    assert {r[0].version for r in records} == {1, 2} and sum(len(r) - 1 for r in records) == 50
    for content, found in zip(contents, records):
        for r in found[1:]:
            line = content[r.offset:content.index(b"\n", r.offset)].split(b" ")
            assert line[0].decode() == r.url and len(line) == (5, 10)[r.version - 1]
            if r.version == 2:
                assert int(line[7]) == r.offset and line[5].decode() == b32(r.block)


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_foreign_archives(spark, tmp_path, pack):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "old.arc").write_bytes(pack(V1))
    (tmp_path / "in" / "new.arc").write_bytes(pack(V2))
    warc.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    records = [r for f in (tmp_path / "out").glob("part-*")
               for r in warc.read_warc_records(io.BytesIO(gzip.decompress(f.read_bytes())))]
    by_uri = {head.get("warc-target-uri", head.get("warc-filename")): (head, block) for head, block in records}
    assert set(by_uri) == {"old.arc", "new.arc", "http://a.org/x y", "dns:a.org", "http://a.org/raw", "http://b.org/"}
    assert {head["warc-type"] for head, _ in records} == {"warcinfo", "response", "resource"}
    head, _ = by_uri["http://a.org/x y"]
    assert head["warc-date"] == "1997-01-01T12:34:56Z" and head["warc-ip-address"] == "1.2.3.4"
    assert head["warc-payload-digest"] == f"sha1:{b32(b'hi')}"
    assert by_uri["dns:a.org"][0]["warc-date"] == "1997-01-01T12:34:00Z"
    assert by_uri["dns:a.org"][0]["content-type"] == "text/dns"
    assert by_uri["http://a.org/raw"][0]["warc-date"] == "1997-01-02T00:00:00Z" and by_uri["http://a.org/raw"][1] == b"\x00\xff\n"
    assert by_uri["http://b.org/"][1].endswith(b"hi ho")
    assert len({head["warc-record-id"] for head, _ in records}) == 6
    info = by_uri["old.arc"][0]["warc-record-id"]
    assert by_uri["dns:a.org"][0]["warc-warcinfo-id"] == info
    assert brute.count(warc.read_warc(spark, str(tmp_path / "out"))) == 4


def test_broken_archives_stop_or_are_read_on(spark):
    def read(data, **options):
        return list(warc.read_arc_records(io.BytesIO(data), **options))

    cut = V1[:-2]
    with pytest.raises(warc.BrokenArchive):
        read(cut)
    assert read(cut, strict=False)[-1].truncated
    noisy = V2[:V2.index(b"http://b.org/")] + b"what is this\n" + V2[V2.index(b"http://b.org/"):]
    with pytest.raises(warc.BrokenArchive):
        read(noisy)
    assert [r.url for r in read(noisy, strict=False)] == ["filedesc://new.arc", "http://b.org/"]
    with pytest.raises(warc.BrokenArchive):
        read(b"http://x 1.1.1.1 19970101000000 text/html 1\nx\n")
    assert read(b"") == []


def test_a_wrong_digest_is_not_read(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Payload-Digest: sha1:ABC\r\n"
        b"Content-Length: 19\r\n\r\nHTTP/1.0 200 OK\r\n\r\n\r\n\r\n")
    with pytest.raises(Exception, match="declared ABC"):
        warc.read_warc(spark, str(tmp_path / "w")).collect()
