import base64
import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from granero.llm import warc


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows):
    first, out = {}, []
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        payload = (html or "").encode()
        digest = sha(payload)
        kind, refers = ("revisit", first[digest]) if digest in first else ("response", None)
        first.setdefault(digest, i)
        out.append((i, len(payload), digest, kind, refers))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(3)
    rows = [(i, f"http://a.example/{i}?q=ü x", f"<p>{rnd.randrange(40)}</p>" * rnd.randrange(1, 400)) for i in range(200)]
    rows += [(500, None, None), (501, "u\r\nv", ""), (502, "u", "é 你好 🙂 \r\n\r\nWARC/1.1\r\n\r\n"), (503, "u", "same"), (504, "u", "same"),
             (505, "b", "same"), (505, "a", "same"), (None, "u", "same"), (None, "n", "only null"), (506, "u", "x" * 3_000_000)]
    return rows, spark.createDataFrame([(*r, "clash", 1, "d") for r in rows], "page_id long, url string, html string, digest string, size int, path string")


def test_archives_read_back(pages, monkeypatch):
    rows, frame = pages
    archives = warc.write_archives(frame)
    for size in (1000, 1 << 24):
        got = warc.read_archives(archives, size=size).collect()
        keys = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str)
        assert keys == brute(rows)
    texts = {(r["page_id"], r["payload_digest"]): r["payload"] for r in got if r["record_type"] == "response"}
    for i, _, html in rows:
        payload = (html or "").encode()
        key = (i, sha(payload))
        assert key not in texts or bytes(texts[key]) == payload
    assert {r["url"] for r in got if r["page_id"] == 501} == {"u%0D%0Av"}


def test_smaller_payloads_are_all_responses_and_empty_table(pages):
    rows, frame = pages
    got = warc.read_archives(warc.write_archives(frame.where("html = 'same'"), least=5), payloads=False).collect()
    assert len(got) == 6 - 1 and {r["record_type"] for r in got} == {"response"}
    assert warc.read_archives(warc.write_archives(frame.limit(0))).count() == 0


@pytest.mark.parametrize("step", [37, 700, 10**7])
def test_ranges_own_each_record_once(step):
    inner = gzip.compress(b"WARC/1.1\r\nWARC-Type: fake\r\n\r\n")
    payloads = [b"", b"x" * 5000, warc.MAGIC * 50, random.Random(0).randbytes(3000), b"tail" + warc.MAGIC, inner]
    data = b"".join(warc.record(i, "u", sha(p), len(p), p, None, 1) for i, p in enumerate(payloads))
    damaged = data[:-40] + b"\x00" * 40
    for archive, n in ((data, len(payloads)), (damaged, len(payloads) - 1)):
        found = [warc.parsed(r)["page_id"] for low in range(0, len(archive), step) for r in warc.records_in(io.BytesIO(archive), len(archive), low, low + step)]
        assert found == list(range(n))


def test_records_are_gzip_members():
    raw = gzip.decompress(warc.record(7, "http://x/", sha(b"hi"), 2, None, 3, 1))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: revisit") and raw.endswith(b"\r\n\r\n")
    assert warc.parsed(raw)["refers_to"] == 3 and warc.parsed(raw)["payload_bytes"] == 2
    with pytest.raises(ValueError):
        warc.parsed(gzip.decompress(warc.record(7, None, sha(b"hi"), 2, b"ho", None, 1)))


def test_long_urls_are_read_back(spark):
    urls = ["data:text/html," + "a" * 100_000, "http://a.example/" + "ü" * 25_000]
    frame = spark.createDataFrame([(1, urls[0], "one"), (2, urls[1], "two"), (3, "u", "one")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.read_archives(warc.write_archives(frame)).collect()}
    assert set(got) == {1, 2, 3} and got[1]["url"] == urls[0] and got[2]["url"] == urls[1].replace("ü", "%C3%BC")
    assert got[3]["refers_to"] == 1 and bytes(got[1]["payload"]) == b"one"


def test_magic_number_across_two_chunks(monkeypatch):
    first = warc.record(0, "u", sha(b"x"), 1, random.Random(1).randbytes(300), None, 1)
    data = first + warc.record(1, "u", sha(b"two"), 3, b"two", None, 1)
    for size in range(3, len(data)):
        monkeypatch.setattr(warc, "CHUNK", size)
        found = [warc.parsed(r)["page_id"] for r in warc.records_in(io.BytesIO(data), len(data), 1, len(data))]
        assert found == [1], size


def test_ranges_are_read_by_more_than_one_task(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("page "), F.col("id")).alias("html"))
    archives = warc.write_archives(pages.repartition(4))
    read = warc.read_archives(archives, payloads=False, size=4096)
    n_ranges = archives.agg(F.sum(F.ceil(F.col("bytes") / 4096))).first()[0]
    assert n_ranges > 100 and read.rdd.getNumPartitions() > 50
    assert read.select("page_id").distinct().count() == read.count() == 3000
    assert warc.qualified(spark, "/tmp/x").startswith("file:/")
