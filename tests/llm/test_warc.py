from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from adlake.llm import warc
from adlake.llm.warc import arc_record, arc_records, iso_date, page_of, pages_to_warc, record_id, version_block, warc_records

ROWS = [(1, "http://a/", "<p>x</p>"), (5, "http://b/ c", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "u", None), (2, "u", ""),
        (9, "u", "é\r\n\r\nWARC/1.1\r\n\r\n"), (10, "u", "http://x 0.0.0.0 20240101000000 text/html 3\nabc\n"), (None, "n", "<p>x</p>"),
        (None, "n", "alone"), (11, "u", "long " * 200_000), (-7, "u", "neg"), (12, "r", "rep"), (12, "r", "rep"), (2 ** 62 + 5, "u", "rep2")]


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        last = max(ids, default=None)
        again = last is not None and (page_id is None or page_id < last) and len(data) >= least
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                    last if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "archive_bytes"), [(0, 1 << 24), (4, 500)])
def test_pages_survive_the_round_trip(spark, least, archive_bytes):
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in ROWS], "page_id long, url string, html string, digest string")
    got = pages_to_warc(pages.repartition(3), least, archive_bytes).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == brute(ROWS, least)
    assert {r.date for r in got} == {"2024-01-01T00:00:00Z"}


def test_empty_table(spark):
    assert pages_to_warc(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def arc(version, *records):
    return gzip.compress(version_block(version, "f.arc", "20010203040506") + b"".join(records))


@pytest.mark.parametrize("version", [1, 2])
def test_declared_lengths_and_header_lines(version):
    blocks = [b"HTTP/1.1 200 OK\r\n\r\nabc\n\nx", b"", b"no http\n" * 50_000]
    data = arc(version, *(arc_record(version, "http://a/%d" % k, "2001", b, 0, "f.arc") for k, b in enumerate(blocks)))
    (head, _), *rest = arc_records(data, "f")
    assert head["URL"] == "filedesc://f.arc" and [b for _, b in rest] == blocks
    assert [f["URL"] for f, _ in rest] == ["http://a/0", "http://a/1", "http://a/2"]
    assert ("Checksum" in rest[0][0]) == (version == 2)


def test_legacy_url_with_spaces():
    data = arc(1, b"http://a/b c d 1.2.3.4 20010101 text/html 2\nhi\n")
    assert list(arc_records(data, "f"))[1][0]["URL"] == "http://a/b c d"


@pytest.mark.parametrize("record", [b"http://a 1.2.3.4 2001 text/html 99\nshort\n", b"http://a text/html x\nhi\n", b"nonsense\n"])
def test_broken_archives_raise(record):
    with pytest.raises(ValueError):
        list(arc_records(arc(1, record), "f"))


def test_unknown_version():
    with pytest.raises(ValueError):
        list(arc_records(gzip.compress(b"filedesc://x 0.0.0.0 2001 text/plain 4\n9 0\n\n"), "f"))


def test_synthesised_values():
    for page_id in (0, 1, -1, 2 ** 63 - 1, -2 ** 63, 2 ** 62, None):
        urn = record_id(page_id, "D")
        assert page_of(urn) == page_id and urn == record_id(page_id, "D") and urn[23] == "8"
    assert record_id(1, "D") != record_id(1, "E")
    assert iso_date("2001") == "2001-01-01T00:00:00Z" and iso_date("20010203040506") == "2001-02-03T04:05:06Z"


def test_wrong_block_digest():
    good = warc.warc_record("response", record_id(1, "D"), iso_date("2001"), "text/plain", b"abc", [])
    assert [b for _, b in warc_records(gzip.compress(good), "f")] == [b"abc"]
    with pytest.raises(ValueError):
        list(warc_records(gzip.compress(good.replace(b"abc", b"abd")), "f"))


def test_pages_whose_url_looks_like_a_version_block(spark):
    rows = [(1, "filedesc://part-00000.arc", "<p>a</p>"), (2, "filedesc:", "b"), (3, "http://a", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted([tuple(r)[:5] for r in pages_to_warc(pages).collect()], key=repr) == brute(rows)


def test_every_record_has_its_own_id(spark):
    """Repeated rows, and null ids with equal payloads, are different records; revisits refer to one that is there."""
    rows = ROWS + [(12, "r", "rep")] * 3 + [(None, "n", "<p>x</p>")] * 4 + [(None, None, None)] * 3 + [(5, "http://b/ c", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = pages_to_warc(pages, archive_bytes=600).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == brute(rows)
    ids = {r.record_id: r for r in got}
    assert len(ids) == len(rows)
    for r in got:
        assert (r.refers_to_id is None) == (r.record_type == "response")
        if r.refers_to_id:
            first = ids[r.refers_to_id]
            assert (first.record_type, first.page_id, first.payload_digest) == ("response", r.refers_to, r.payload_digest)


def test_equal_sha1_is_not_enough(spark):
    """Records whose SHA-1 agrees but whose payloads differ don't revisit each other."""
    from adlake.llm.warc import ARC_ROW, repeated_payloads, to_warc
    rows = [(k, "u", "2001", "response", b"HTTP/1.1 200 OK\r\n\r\n", p, "SAME", hashlib.sha256(p).hexdigest(), len(p), "a", k)
            for k, p in enumerate([b"one", b"two", b"one", b"three"])]
    records = spark.createDataFrame(rows, ARC_ROW)
    got = {r.page_id: (r.revisits, r.copy) for r in to_warc(records, repeated_payloads(records), 0).collect()}
    assert got == {0: (2, None), 1: (None, None), 2: (None, None), 3: (None, None)}
