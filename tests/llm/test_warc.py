import base64
import gzip
import hashlib

from stayline.llm import warc
from stayline.sources.store import work_path

SCHEMA = "page_id bigint, url string, html string"


def archives(spark, pages):
    raw, resolved = work_path(spark, "archives"), work_path(spark, "archives")
    warc.write_pages(spark.createDataFrame(pages, SCHEMA), raw)
    warc.resolve(spark, raw, resolved)
    return raw, resolved


PAGES = [
    (4, "http://a/4", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "u\r\nX: y", "own\r\n\r\nWARC/1.1\r\n"),
    (3, "http://a/3", None), (5, "http://a/5", ""), (6, "http://a/6", "é🙂" * 4000), (7, "http://a/7", "\r\n\r\n"), (None, "n", "<p>same</p>"),
    (8, "http://a/8", "twice"), (8, "http://a/8", "twice"),
]


def test_round_trip_and_revisits(spark):
    _, resolved = archives(spark, PAGES)
    records = warc.read_records(spark, resolved, payloads=True)
    rows = warc.with_payload_sizes(records).collect()
    assert len(rows) == len(PAGES)
    html = {page: (text or "").encode() for page, _, text in PAGES}
    for row in rows:
        payload = html[row.page_id]
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert bytes(row.payload) == (payload if row.record_type == "response" else b"")
    same = {r.page_id: (r.record_type, r.refers_to) for r in rows if r.page_id != 8}
    assert same == {
        2: ("response", None), 4: ("revisit", 2), 9: ("revisit", 2), None: ("revisit", 2), 1: ("response", None),
        3: ("response", None), 5: ("revisit", 3), 6: ("response", None), 7: ("response", None),
    }
    assert sorted((r.record_type, r.refers_to) for r in rows if r.page_id == 8) == [("response", None), ("revisit", 8)]


def test_small_payloads_and_former_revisits_stay(spark):
    raw, resolved = archives(spark, PAGES)
    again, third = work_path(spark, "archives"), work_path(spark, "archives")
    warc.resolve(spark, resolved, again)
    key = ("page_id", "record_type", "refers_to", "payload_digest")
    before, after = (sorted(map(repr, warc.read_records(spark, at).select(*key).collect())) for at in (resolved, again))
    assert before == after
    warc.resolve(spark, raw, third, min_payload=6)
    kinds = [(r.page_id, r.record_type) for r in warc.read_records(spark, third).collect()]
    assert (8, "revisit") not in kinds and (5, "response") in kinds and (4, "revisit") in kinds


def test_archives_are_plain_warc(spark):
    raw, _ = archives(spark, PAGES[:2])
    content = b"".join(gzip.decompress(bytes(r.content)) for r in warc._files(spark, raw).collect())
    assert content.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and content.endswith(b"</p>\r\n\r\n")
    assert [headers["Content-Length"] for _, headers, _ in warc.parse(content)] == ["11", "11"]


def test_no_pages(spark):
    _, resolved = archives(spark, [])
    assert warc.read_records(spark, resolved).count() == 0
