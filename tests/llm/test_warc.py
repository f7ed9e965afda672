import base64
import gzip
import hashlib
import io

from ledgerlake.llm import warc as W


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "x") for r in rows], "page_id long, url string, html string, refers_to string"
    ).repartition(3)


ROWS = [
    (5, "http://a.org/ b%20c\r\nX: y", "<p>é</p>"), (3, "http://b.org", "<p>é</p>"),
    (9, None, "<p>é</p>"), (1, "http://c.org", None), (2, "http://d.org", ""),
    (4, "http://e.org", "own\r\n\r\nWARC/1.1"), (7, "http://f.org", "x" * 300_000),
    (8, "http://f.org", "x" * 300_000),
]


def read(spark, rows, least=0, payloads=True):
    manifest, folder = W.deduplicate(pages(spark, rows), least=least)
    return manifest, W.read_archives(manifest, folder, payloads)


def test_round_trip(spark):
    manifest, records = read(spark, ROWS)
    got = {r.page_id: r for r in records.collect()}
    first = {3: 3, 5: 3, 9: 3, 1: 1, 2: 1, 4: 4, 7: 7, 8: 7}
    assert set(got) == set(first)
    for page_id, url, html in ROWS:
        payload, r = (html or "").encode(), got[page_id]
        assert r.url == (url or "")
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if first[page_id] == page_id:
            assert (r.record_type, r.refers_to, r.payload) == ("response", None, payload)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", first[page_id], None)
    assert sum(r.n_records for r in manifest.collect()) == len(ROWS)


def test_short_payloads_are_all_responses(spark):
    _, records = read(spark, ROWS, least=5, payloads=False)
    got = {r.page_id: r.record_type for r in records.collect()}
    assert [got[i] for i in (1, 2, 3, 5)] == ["response", "response", "response", "revisit"]


def test_repeated_and_missing_ids(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (1, "u", "other"), (2, "u", "other"),
            (None, "u", "same"), (3, "u", "same"), (3, "u", "same")]
    _, records = read(spark, rows)
    got = sorted((str(r.page_id), r.record_type, r.payload or b"") for r in records.collect())
    assert got == [
        ("1", "response", b"other"), ("1", "response", b"same"), ("1", "response", b"same"),
        ("2", "revisit", b""), ("3", "revisit", b""), ("3", "revisit", b""),
        ("None", "response", b"same"),
    ]


def test_empty_table(spark):
    manifest, records = read(spark, [])
    assert manifest.count() == records.count() == 0


def test_records_are_gzip_members():
    one = W.record(1, "u", b"abc", W.digest_of(b"abc"), None, "2024-01-01T00:00:00Z")
    two = W.record(2, "v", b"abc", W.digest_of(b"abc"), (1, "u"), "2024-01-01T00:00:00Z")
    assert one == W.record(1, "u", b"abc", W.digest_of(b"abc"), None, "2024-01-01T00:00:00Z")
    assert gzip.decompress(two).startswith(b"WARC/1.1\r\nWARC-Type: revisit\r\n")
    (first, body), (second, none) = W.records_in(io.BytesIO(one + two))
    assert (first["x-page-id"], W.http_parts(body)[1], W.http_parts(none)[1]) == ("1", b"abc", b"")
    assert second["x-refers-to-page-id"] == "1"
    assert second["warc-refers-to"] == first["warc-record-id"] != second["warc-record-id"]


def plain_records(data):
    """The records of an archive by the format's text alone: headers and block."""
    data, out = gzip.decompress(data), []
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        named = dict(line.split(": ", 1) if ": " in line else (line[:-1], "") for line in lines)
        size = int(named["Content-Length"])
        out.append((named, rest[:size]))
        assert rest[size : size + 4] == b"\r\n\r\n"
        data = rest[size + 4 :]
    return out


def test_another_reader_can_follow_revisits(spark):
    manifest, _ = W.deduplicate(pages(spark, ROWS))
    records = []
    for row in manifest.collect():
        with open(row.file, "rb") as f:
            records += plain_records(f.read())
    assert len(records) == len(ROWS)
    by_id = {named["WARC-Record-ID"]: (named, block) for named, block in records}
    assert len(by_id) == len(ROWS)
    html = {page_id: (text or "").encode() for page_id, _, text in ROWS}
    for named, block in records:
        assert named["Content-Type"].startswith("application/http")
        own = named
        if named["WARC-Type"] == "revisit":
            own, block = by_id[named["WARC-Refers-To"]]
            assert own["WARC-Type"] == "response"
            assert own["WARC-Target-URI"] == named["WARC-Refers-To-Target-URI"]
            assert own["WARC-Date"] == named["WARC-Refers-To-Date"]
            assert own["WARC-Payload-Digest"] == named["WARC-Payload-Digest"]
        status, payload = block.split(b"\r\n\r\n", 1)
        assert status.startswith(b"HTTP/1.1 200 OK") and payload == html[int(named["X-Page-ID"])]
