import base64
import hashlib
import uuid
from html.parser import HTMLParser

import pytest

from flowguard.llm import warc as W

PAGES = [
    (1, "https://a.example/1", "<html><head><title>T &amp; t</title><script>var t='</p>';</script></head><body><p>one<br>two &#233;</p><!-- no --><div>x<b>y</b></div></body></html>", "x"),
    (2, None, None, "x"), (3, "http://b.example/\r\nX-Bad: 1", "", "x"), (4, "http://c.example", "plain < text & more &amp;lt; <3", "x"),
    (5, "http://d.example", "<p>open <script>never closed <p>gone", "x"), (5, "http://d.example", "<p>open <script>never closed <p>gone", "x"),
    (6, "http://e.example", "<!-- never closed <p>gone", "x"), (None, "http://f.example", "<td>a</td><td>b</td>" * 5000, "x"), (7, "http://g", "a < b <", "x"),
]
SCHEMA = "page_id long, url string, html string, refers_to string"


class Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in W.HIDDEN
        if tag in W.BREAKING:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in W.HIDDEN
        if tag in W.BREAKING:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def label(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data.encode()).digest()).decode()


def test_text_equals_a_full_parser_on_real_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for page in pages:
        reader = Reader()
        reader.feed(page["html"])
        reader.close()
        want = "\n".join(x for x in (" ".join(line.split()) for line in "".join(reader.out).split("\n")) if x)
        assert W.page_text(page["html"]) == want


@pytest.mark.parametrize("page, text", [
    (PAGES[0][2], "T & t\none\ntwo é\nxy"), (None, ""), ("", ""), (PAGES[3][2], "plain < text & more &lt; <3"), (PAGES[4][2], "open"),
    (PAGES[6][2], ""), ("<" * 10_000, "<" * 10_000), ("<a" * 10_000, ""), ("a < b <", "a < b <"),
])
def test_odd_pages(page, text):
    assert W.page_text(page) == text


def test_records_are_linked_and_keep_the_source(spark):
    responses = W.response_records(spark.createDataFrame(PAGES, SCHEMA))
    sources = {r["record_id"]: r for r in responses.collect()}
    records = W.derive(responses).collect()
    assert len(records) == 2 * len(PAGES) and len(sources) == len(PAGES) - 1  # equal rows, equal ids
    for r in records:
        source = sources[r["refers_to"]]
        payload, http = source["payload"], source["http"]
        assert (r["key"], r["target_uri"], r["date"]) == (source["key"], source["target_uri"], W.DATE)
        assert r["source_payload_digest"] == source["payload_digest"] == label(payload)
        assert r["source_block_digest"] == source["block_digest"] == label(http + payload)
        assert r["block_digest"] == label(r["block"]) and r["content_length"] == len(r["block"].encode())
        assert uuid.UUID(r["record_id"][10:-1]).version == 5 and r["record_id"] != r["refers_to"]
        if r["record_type"] == "conversion":
            assert r["block"] == W.page_text(payload)
        else:
            lines = r["block"].split("\r\n")
            assert f"source-record: {r['refers_to']}" in lines and "http-status: 200" in lines
            assert f"http-header-Content-Length: {len(payload.encode())}" in lines and f"source-payload-digest: {label(payload)}" in lines
    assert "\n" not in sources[[r["refers_to"] for r in records if r["key"] == 3][0]]["target_uri"]


def test_files_are_warc_and_read_back(spark, tmp_path):
    records = W.derive(W.response_records(spark.createDataFrame(PAGES, SCHEMA))).repartition(3)
    W.write_warc(records, str(tmp_path / "out"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")
    back = W.read_warc(spark, str(tmp_path / "out")).collect()
    want = sorted((r["record_id"], r["refers_to"], r["block"]) for r in records.collect())
    assert sorted((r["headers"]["WARC-Record-ID"], r["headers"]["WARC-Refers-To"], r["block"]) for r in back) == want
    assert all(("WARC-Target-URI" in r["headers"]) or r["block"] in ("",) or "http-status" in r["block"] for r in back)


def test_empty_table_and_query(spark):
    assert W.derive(W.response_records(spark.createDataFrame([], SCHEMA))).count() == 0
    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = W.op3_warc_derivatives(spark, folder).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        assert r["source_payload_digest"] == label(pages[r["page_id"]]["html"]) and r["target_uri"] == pages[r["page_id"]]["url"]
        assert r["record_type"] == "metadata" or r["block"] == W.page_text(pages[r["page_id"]]["html"])
