import pytest

from stayline.llm import archive
from stayline.llm.common import Staged

PAGES = "page_id long, url string, html string, record_type string"


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "k") for r in rows], PAGES)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    rows = [
        (1, "http://a.example/x y", "same"), (4, "http://a.example/2", "same"), (3, None, "same"), (2, "http://b.example", None), (6, "http://b.example", ""),
        (7, "http://c.example", "WARC/1.0\r\n\r\nhttp://x 0.0.0.0 20200101000000 text/html 3\nabc\n"), (8, "http://d.example", "é😀\r\n\n" * 50_000),
    ]
    found = {r.page_id: r for r in archive.round_trip(pages(spark, *rows), version).collect()}
    assert len(found) == len(rows)
    for page_id, url, html in rows:
        body = (html or "").encode()
        r = found[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), archive.payload_digest(body))
        assert r.url == (url or "about:blank").replace(" ", "%20") and r.warc_date == "2024-01-01T00:00:00Z"
    assert {p: (r.record_type, r.refers_to) for p, r in found.items()} == {
        1: ("revisit", 4), 4: ("response", None), 3: ("revisit", 4), 2: ("revisit", 6), 6: ("response", None), 7: ("response", None), 8: ("response", None)
    }


def test_smaller_payloads_are_all_responses(spark):
    found = archive.round_trip(pages(spark, (1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (5, "u", "abcdef")), minimum=3).collect()
    assert {r.page_id: r.refers_to for r in found} == {1: None, 2: None, 3: 5, 5: None}


def test_repeated_rows_null_ids_and_empty_table(spark):
    found = archive.round_trip(pages(spark, (1, "u", "a"), (1, "u", "a"), (None, "u", "b"))).collect()
    assert sorted((r.page_id is None, r.page_id, r.record_type) for r in found) == [(False, 1, "response"), (False, 1, "response"), (True, None, "response")]
    assert archive.round_trip(pages(spark)).count() == 0


def test_arc_header_lines_follow_the_version_block():
    for version in (1, 2):
        content = archive.arc_head(version) + archive.arc_record(version, 5, "http://a", "x\ny", "19990203")
        (head, _), (fields, block) = archive.arc_records(content)
        assert head["URL"].startswith("filedesc://") and fields["Archive-date"] == "19990203"
        assert list(fields) == archive.ARC_FIELDS[version].split() and int(fields["Archive-length"]) == len(block)
        assert archive.split_http(block)[1] == b"x\ny"
    with pytest.raises(ValueError):
        list(archive.arc_records(archive.arc_head(2) + b"http://a 0.0.0.0 1999 text/html 3\nabc\n"))
    assert archive.warc_date("19990203") == "1999-02-03T00:00:00Z" and archive.warc_date("1999") == "1999-01-01T00:00:00Z"


def test_record_headers(spark):
    staged = Staged(spark, "test")
    arc, warc = staged.path("arc"), staged.path("warc")
    archive.write_arc(pages(spark, (1, "http://a", "x"), (2, "http://b", "x")), arc, 1)
    archive.convert(spark, arc, warc)
    records = [r for f in spark.read.format("binaryFile").load(warc).collect() for r in archive.warc_records(archive._unzipped(bytes(f.content)))]
    by_type = {}
    for fields, block in records:
        assert fields["warc-record-id"].startswith("<urn:uuid:") and int(fields["content-length"]) == len(block)
        by_type.setdefault(fields["warc-type"], []).append(fields)
    (response,), (revisit,) = by_type["response"], by_type["revisit"]
    assert by_type["warcinfo"] and revisit["warc-refers-to"] == response["warc-record-id"]
    assert revisit["warc-payload-digest"] == response["warc-payload-digest"] and revisit["warc-profile"].endswith("identical-payload-digest")


def test_archives_are_written_at_the_given_level(spark, monkeypatch):
    html = " ".join(str(i * i % 977) for i in range(40_000))
    sizes = []
    for level in ("BEST_SPEED", archive.GZIP_LEVEL, "BEST_COMPRESSION"):
        monkeypatch.setattr(archive, "GZIP_LEVEL", level)
        staged = Staged(spark, "test")
        arc, warc = staged.path("arc"), staged.path("warc")
        archive.write_arc(pages(spark, (1, "http://a", html)), arc)
        archive.convert(spark, arc, warc)
        sizes.append([sum(f.length for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).collect()) for folder in (arc, warc)])
        assert archive.read_warc(spark, warc).first().payload_bytes == len(html)
    for fast, used, small in zip(*sizes, strict=True):
        assert fast > used > small
