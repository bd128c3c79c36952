"""Archives after repeated attempts, stale files, hot payloads and many small archives."""

import hashlib

import pyarrow as pa
import pytest

from stallwatch.llm import warc
from stallwatch.llm.scratch import Scratch


class Attempt:
    def __init__(self, partition, number):
        self.partition, self.number = partition, number

    def partitionId(self):
        return self.partition

    def taskAttemptId(self):
        return self.number


@pytest.fixture
def pages(spark):
    hot = "h" * 300
    rows = [(i, f"http://x/{i}", hot if i % 3 == 0 else "" if i % 3 == 1 else f"page {i} " * 20) for i in range(60)]
    return spark.createDataFrame(rows + [(5, None, None), (None, "u", hot), (12, "u", hot)], "page_id long, url string, html string")


def told(rows):
    return sorted((tuple(r) for r in rows), key=str)


def brute(rows):
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None] if len(data) >= 100 else []
        first = min(same, default=None)
        again = first is not None and page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_many_archives_equal_brute_force(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [tuple(r) for r in pages.collect()]
    assert told(warc.round_trip(pages).drop("url").collect()) == brute(rows)


def test_a_second_attempt_in_another_order_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1500)
    folder = Scratch(spark, "warc-test").path("files")
    rows = [(i, "u", f"page {i} " * (i % 7 * 10 + 1), hashlib.sha256(f"page {i} ".encode() * (i % 7 * 10 + 1)).hexdigest(), None) for i in range(40)]
    made = []
    for number, order in ((7, rows), (8, rows[::-1]), (9, rows[20:] + rows[:20])):
        monkeypatch.setattr(warc.TaskContext, "get", lambda n=number: Attempt(3, n))
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*order), types)], names=["page_id", "url", "html", "digest", "first"])
        made.append([x for b in warc._writer(folder)(iter([batch])) for x in b.column(0).to_pylist()])
    assert len({x for m in made for x in m}) == sum(map(len, made)) and min(map(len, made)) > 2
    for names in made:
        got = warc.read_archives(spark.createDataFrame([(x,) for x in names], "archive string")).collect()
        assert sorted((r.page_id, r.payload_digest) for r in got) == sorted((r[0], r[3]) for r in rows)


def test_stale_archives_are_not_read(spark, pages):
    scratch = Scratch(spark, "warc-test")
    made = warc.write_archives(pages, scratch.path("files"), scratch)
    warc.write_file(scratch.path("files") + "/part-000000-99-0000.warc.gz", warc.record("response", "urn:page:777", "u", b"HTTP/1.1 200 OK\r\n\r\n", {"WARC-Payload-Digest": "sha256:" + hashlib.sha256(b"").hexdigest()}))
    assert told(warc.read_archives(made).drop("url").collect()) == brute([tuple(r) for r in pages.collect()])
    assert 777 in {r.page_id for r in warc.read_archives(warc.list_archives(spark, scratch.path("files"))).collect()}
