"""WARC archives, written by Spark and read back by boundary-chain verification.

Writing: a record a page. Of pages with equal payloads (their UTF-8 html) of at least
``least`` bytes the one with the largest id is a response record, the others are revisit
records without a body that refer to it; smaller payloads are all responses. Files hold
at most ``RECORDS`` records and lie in the folder that the cluster shares.

Reading: the text source parts the files at every record magic, so that the parts of one
file can be read by many tasks. Each part becomes a candidate: its offset and, from its
header, the offset of its successor. Magic inside a payload makes candidates too. Pointer
jumping from the start of every file, in doubling steps, keeps the candidates that the
chain of records reaches and no others. A payload that held magic was parted; its parts,
known by their offsets, are put together again.

Edge cases: a null html is an empty payload; a null url is an empty one, and comes back
so; line breaks in a url are escaped. Rows that tie on the largest id of a payload (repeated
rows, or no id at all) are all responses. A very long page is one record, whole. An empty table gives no files
and no rows. The other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.llm.common import batch_of, cut, fresh_dir, lean

MAGIC, RECORDS, DATE = "WARC/1.1\r\n", 1000, "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_URN = "urn:lexweave:page:"


def base32_sha1(column: Column | str) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits are five hex digits and four base-32 digits."""
    digest = F.sha1(column)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Archives the pages in files under path."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    digests = cut(rows.select("page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("size")))
    equal = digests.where((F.col("size") >= least) & F.col("page_id").isNotNull())
    # of each payload the largest id; a payload that stands once needs no second look
    groups = equal.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    revisits = equal.join(groups, "sha").where("page_id <> first").select(F.col("page_id").alias("revisit"), "first").distinct()
    notes = f"{path.rstrip('/')}-revisits"
    revisits.write.parquet(notes)  # its size decides whether it is sent to the pages or they are dealt out
    typed = rows.join(spark.read.parquet(notes), F.col("page_id") == F.col("revisit"), "left")
    is_revisit = F.col("first").isNotNull()
    own = F.concat(F.lit(f"WARC-Record-ID: <{_URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">\r\n"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    common = F.concat(own, F.lit(f"WARC-Date: {DATE}\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1("html"), F.lit("\r\n"))
    response = F.concat(
        F.lit(f"{MAGIC}WARC-Type: response\r\n"), common, F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length("html") + F.lit(len(_HTTP))).cast("string"), F.lit(_END + _HTTP), F.col("html"),
    )
    revisit = F.concat(
        F.lit(f"{MAGIC}WARC-Type: revisit\r\n"), common, F.lit(f"WARC-Refers-To: <{_URN}"), F.col("first").cast("string"),
        F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nContent-Length: 0" + _END),
    )
    typed.select(F.when(is_revisit, revisit).otherwise(response).alias("value")).write.option("lineSep", _END).option("maxRecordsPerFile", RECORDS).text(path)


_FIELD = re.compile(rb"^([A-Za-z0-9-]+):[ \t]*(.*?)\r?$", re.M)
_PARTS = pa.schema([
    ("file", pa.string()), ("split", pa.int64()), ("local", pa.int64()), ("size", pa.int64()), ("first", pa.bool_()), ("span", pa.int64()),
    ("type", pa.string()), ("record", pa.string()), ("url", pa.string()), ("refers", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])
_PARTS_DDL = "file string, split long, local long, size long, first boolean, span long, type string, record string, url string, refers string, payload_bytes long, payload_digest string"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def _header(data: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, header length and content length of what follows a magic; None if that is no record header."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(data[:end])}
    length = fields.get("content-length", "")
    return (fields, end + 4, int(length)) if length.isascii() and length.isdigit() and "warc-type" in fields and "warc-record-id" in fields else None


def _body(fields: dict[str, str], block: bytes) -> bytes:
    """The payload of a record's block: without the HTTP head where the block is an HTTP message."""
    return block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """What stands between the magics of the files, in the order of each split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of a task. local: where the part begins, counted from the split's first part; span: of the whole record with its magic."""
    at, local = None, 0
    for batch in batches:
        rows = []
        for file, split, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, split) != at:
                at, local = (file, split), 0
            head = _header(value)
            row = [None] * 7
            if head:
                fields, begin, length = head
                whole = begin + length <= len(value)
                body = _body(fields, value[begin : begin + length]) if whole else b""
                row = [len(MAGIC) + begin + length + len(_END), fields["warc-type"], fields["warc-record-id"], fields.get("warc-target-uri"), fields.get("warc-refers-to"), len(body) if whole else None, _digest(body) if whole else None]
            rows.append((file, split, local, len(value), local == 0, *row))
            local += len(value) + len(MAGIC)
        if rows:
            yield batch_of(_PARTS, *zip(*rows, strict=True))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every part of every file with its offset ``start`` (that of its magic) and the ``next`` record's offset."""
    parts = cut(_scan(spark, path).mapInArrow(lean(_parts), _PARTS_DDL))
    # a part is followed by a magic, so a split's bytes are those of its parts and as many magics
    splits = parts.groupBy("file", "split").agg(F.sum(F.col("size") + F.lit(len(MAGIC))).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = splits.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))  # a row a split
    start = F.col("base") + F.col("local") - F.lit(len(MAGIC))
    return parts.join(base, ["file", "split"]).select("file", start.alias("start"), (start + F.col("span")).alias("next"), "size", "type", "record", "url", "refers", "payload_bytes", "payload_digest")


def reachable(found: DataFrame) -> DataFrame:
    """(file, start) of the candidates on the chain from the start of each file, by pointer jumping."""
    jump = cut(found.where("next is not null").select("file", "start", "next"))
    reached = cut(jump.where("start = 0").select("file", "start"))
    n = reached.count()
    known = jump.select(F.col("file").alias("f"), F.col("start").alias("s"))
    while n:
        ahead = reached.join(jump, ["file", "start"]).select("file", F.col("next").alias("start"))
        real = ahead.join(known, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left_semi")
        reached = cut(reached.unionByName(real).distinct())
        n, before = reached.count(), n
        if n == before:
            break
        second = jump.select(F.col("file").alias("f"), F.col("start").alias("s"), F.col("next").alias("then"))
        jump = cut(jump.join(second, (F.col("file") == F.col("f")) & (F.col("next") == F.col("s"))).select("file", "start", F.col("then").alias("next")))
    return reached


_WHOLE = pa.schema([("file", pa.string()), ("start", pa.int64()), ("whole_bytes", pa.int64()), ("whole_digest", pa.string())])


def _rejoined(spark: SparkSession, path: str, parted: DataFrame, found: DataFrame) -> DataFrame:
    """Payload size and digest of the records whose payload held magic, from all their parts in order."""
    spans = parted.select(F.col("file").alias("f"), F.col("start").alias("owner"), F.col("next").alias("stop"))
    own = found.join(spans, (F.col("file") == F.col("f")) & (F.col("start") >= F.col("owner")) & (F.col("start") < F.col("stop"))).select("file", "start", "owner")
    notes = fresh_dir(spark, "warc-parts")
    own.write.parquet(notes)
    own = spark.read.parquet(notes).select(F.col("file").alias("f"), F.col("start").alias("s"), "owner")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, local = None, 0
        for batch in batches:
            out = []
            for file, split, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, split) != at:
                    at, local = (file, split), 0
                out.append(local)
                local += len(value) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=["file", "split", "value", "local"])

    pieces = _scan(spark, path).mapInArrow(lean(place), "file string, split long, value binary, local long")
    sizes = pieces.groupBy("file", "split").agg(F.sum(F.octet_length("value") + F.lit(len(MAGIC))).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = pieces.join(base, ["file", "split"]).select("file", (F.col("base") + F.col("local") - F.lit(len(MAGIC))).alias("start"), "value")
    mine = placed.join(own, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s"))).select("file", "owner", "start", "value")

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        for (file, owner), group in itertools.groupby(rows, key=lambda r: r[:2]):
            data = MAGIC.encode().join(r[3] for r in group)
            fields, begin, length = _header(data)
            body = _body(fields, data[begin : begin + length])
            yield batch_of(_WHOLE, [file], [owner], [len(body)], [_digest(body)])

    return mine.repartition("file", "owner").sortWithinPartitions("file", "owner", "start").mapInArrow(lean(join_up), "file string, start long, whole_bytes long, whole_digest string")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under path: type, record id, url, refers-to, payload size and digest.

    Size and digest are those of the bytes read; a revisit has none of its own.
    """
    found = cut(candidates(spark, path))
    chain = reachable(found)
    records = cut(found.join(chain, ["file", "start"], "left_semi"))
    parted = records.where("payload_bytes is null")
    if parted.limit(1).count():
        whole = _rejoined(spark, path, parted, found)
        records = records.join(whole, ["file", "start"], "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "whole_bytes")).withColumn("payload_digest", F.coalesce("payload_digest", "whole_digest"))
    return records.select("type", "record", "url", "refers", "payload_bytes", "payload_digest")


def round_trip(pages: DataFrame, least: int = 0, path: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, from archives written and read back."""
    spark = pages.sparkSession
    path = path or fresh_dir(spark, "warc")
    write(pages, path, least)
    number = lambda c: F.regexp_extract(c, f"^<{_URN}(-?[0-9]+)>$", 1).try_cast("long")
    records = cut(read(spark, path).select(number("record").alias("page_id"), "type", number("refers").alias("refers_to"), "payload_bytes", "payload_digest"))
    responses = records.where("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    target = responses.select(F.col("page_id").alias("target"), "payload_bytes", "payload_digest").distinct()
    revisits = records.where("type = 'revisit'").select("page_id", "refers_to").join(target, F.col("refers_to") == F.col("target"), "left")
    return responses.unionByName(revisits.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to"))
