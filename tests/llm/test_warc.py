"""Archives written and read back, with records inside payloads."""

import base64
import hashlib

import pytest

from lexweave.llm import warc

FAKE = "x WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:lexweave:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n tail é"
DDL = "page_id long, url string, html string"


def expected(rows, least=0):
    pay = {}
    for i, _, h in rows:
        pay.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        top = max((x for x in pay[b] if x is not None), default=None)
        alone = len(b) < least or i is None or i == top
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if alone else "revisit", None if alone else top))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


ROWS = [
    (1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (3, None, None), (4, "u\r\n4", ""), (5, "u5", FAKE), (6, "u6", "WARC/1.1\r\n"), (7, "u7", FAKE + FAKE),
    (8, "u", "dup"), (8, "u", "dup"), (None, "n", "nul"), (9, "u9", "end\r\n\r\n"), (10, "u", "WARC/1.1\r\nWARC/1.1\r\n"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], DDL + ", record string")
    assert got(warc.round_trip(pages, least)) == expected(ROWS, least)


def test_small_splits_and_long_chains(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 40)
    rows = [(i, f"http://x/{i}", (FAKE if i % 7 == 0 else "") + "b" * (i * 37 % 900)) for i in range(150)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert got(warc.round_trip(spark.createDataFrame(rows, DDL))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_archives_are_plain_records(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(ROWS[:2], DDL).coalesce(1), path)
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: re") and data.count(b"WARC/1.1\r\n") == 2
    assert b"WARC-Type: revisit\r\n" in data and b"WARC-Refers-To: <urn:lexweave:page:2>" in data
    at = 0
    while at < len(data):  # lengths lead from record to record, to the end
        head = data[at : data.index(b"\r\n\r\n", at)]
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b":")[1])
        at += len(head) + 4 + length + 4
    assert at == len(data)


def test_foreign_records(spark, tmp_path):
    """Records of other types and of blocks that are no HTTP message."""
    own = "WARC/1.1\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:uuid:{}>\r\nContent-Type: text/plain\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    block = "a WARC/1.1\r\nb"
    text = own.format("warcinfo", 1, 3, "abc") + own.format("resource", 2, len(block), block) + own.format("metadata", 3, 0, "")
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes(text.encode())
    rows = {r["type"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.read(spark, str(tmp_path / "f")).collect()}
    digest = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    assert rows == {"warcinfo": (3, digest("abc")), "resource": (len(block), digest(block)), "metadata": (0, digest(""))}


def test_base32(spark):
    rows = [("",), ("abc",), ("é" * 100,)]
    df = spark.createDataFrame(rows, "t string").select("t", warc.base32_sha1("t").alias("d"))
    assert all(r["d"] == base64.b32encode(hashlib.sha1(r["t"].encode()).digest()).decode() for r in df.collect())


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], DDL)).collect() == []


def test_driver_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    assert got(warc.round_trip(pages)) == expected(rows)
