"""WARC archives: writing pages with segmented, chunked records, and reading them back by segment reassembly.

Writing: one ``response`` record per different payload, ``revisit`` records for its repetitions. The HTTP message of a
response uses chunked transfer coding. A block longer than ``segment_bytes`` is split: the first part is the response
with ``WARC-Segment-Number: 1``, the rest are ``continuation`` records that name it in ``WARC-Segment-Origin-ID``; the last
one holds ``WARC-Segment-Total-Length``. Records are rows of bytes, and Spark's text writer puts the two line ends that
close each record between them, so archives are committed like any other table.

Reading: each archive is parsed by its ``Content-Length`` fields. Records of one part are complete; parts of segmented
ones are grouped by origin, ordered by number, checked against the total length and joined. Then the chunked framing is
decoded and the payload's digest compared with the record's. A revisit's size is that of the record it refers to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.llm.common import cut, shared_folder

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
SEGMENT_BYTES = 128 * 1024
#: Records in a file: with SEGMENT_BYTES this bounds an archive (before compression) at 64 MB.
RECORDS_PER_FILE = 512
CHUNK_BYTES = 16 * 1024
EPOCH = "1970-01-01T00:00:00Z"  # the pages don't say when they were fetched
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight times 20 bits, of four digits each."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def to_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def from_chunks(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped, a broken frame is an error."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        part = body[end + 2:end + 2 + size]
        if len(part) != size or body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        parts.append(part)
        at = end + 4 + size


def record(kind: str, record_id: str, block: bytes, **fields: object) -> bytes:
    """A record without the two line ends that close it."""
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": EPOCH,
             **{k.replace("_", "-"): v for k, v in fields.items() if v is not None}, "Content-Length": len(block)}
    lines = [f"{k}: {' '.join(str(v).split())}" for k, v in named.items()]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + block


def page_records(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None,
                 segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    name = "" if page_id is None else page_id
    own = f"urn:uuid:{uuid.uuid4()}"  # all parts are made at once, so a task that runs again stays consistent
    common = {"WARC_Target_URI": url, "WARC_Payload_Digest": f"sha1:{digest}", "Page_ID": name}
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END
    kind = {"Content_Type": "application/http; msgtype=response"}
    if refers_to is not None:
        yield record("revisit", own, http, **common, **kind, WARC_Profile=PROFILE, Refers_To_Page_ID=refers_to)
        return
    block = http + to_chunks(html)
    if len(block) <= segment_bytes:
        yield record("response", own, block, **common, **kind)
        return
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield record("response", own, parts[0], **common, **kind, WARC_Segment_Number=1)
    for number, part in enumerate(parts[1:], 2):
        yield record("continuation", f"urn:uuid:{uuid.uuid4()}", part, WARC_Segment_Number=number,
                     WARC_Segment_Origin_ID=f"<{own}>", WARC_Segment_Total_Length=len(block) if number == len(parts) else None)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the pages (page_id, url, html) as gzip-compressed archives.

    A null html is an empty payload. Of equal payloads the row with the largest page_id is the response (null is the
    smallest; rows that share the largest id are all responses), the others are revisits of it.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"), base32_sha1(html).alias("digest"))
    # Counted before it is joined: a payload with a third of all pages is one row here. Single payloads need no partner.
    newest = (rows.groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    lean = rows.join(newest, "digest", "left").withColumn(
        "refers_to", F.when(F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest")))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["refers_to"] = batch["refers_to"].astype(object)
            made: list[bytes] = []
            for page_id, url, body, digest, refers in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "refers_to"))):
                made += page_records(None if pd.isna(page_id) else int(page_id), url, body, digest,
                                     None if pd.isna(refers) else int(refers), segment_bytes)
                if len(made) >= 1000:
                    yield pd.DataFrame({"record": made})
                    made = []
            yield pd.DataFrame({"record": made})

    # Ids travel as text: pandas would turn a column with nulls into doubles.
    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")]
    (lean.select(*ids, "url", "html", "digest").mapInPandas(write, "record binary")
     .select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def inflated(content: bytes) -> Iterator[bytes]:
    """Pieces of a file, decompressed if it is gzip, also of several members."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = content
    while rest:
        stream = zlib.decompressobj(31)
        data = rest
        while data and not stream.eof:
            yield stream.decompress(data, 1 << 20)
            data = stream.unconsumed_tail
        rest = stream.unused_data


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields (names in lower case) and the block of each record of an archive."""
    held, pieces = bytearray(), inflated(content)

    def fill(enough) -> bool:
        while not enough():
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while fill(lambda: len(held) >= 2) and held[:2] == b"\r\n":
            del held[:2]
        if not fill(lambda: END in held):
            if held.strip():
                raise ValueError("a record header is cut short")
            return
        at = held.index(END)
        lines = bytes(held[:at]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = int(fields["content-length"])
        if not fill(lambda: len(held) >= at + 4 + size):
            raise ValueError("a record block is cut short")
        yield fields, bytes(held[at + 4:at + 4 + size])
        del held[:at + 4 + size]


PARTS = ("kind string, origin string, number int, total long, page_id string, url string, digest string, "
         "refers_to string, payload binary, n long, block binary")
#: Bytes of payloads and blocks that a task holds before it passes them on.
HELD_BYTES = 1 << 22


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP message, transfer coding undone."""
    head, _, body = block.partition(END)
    return from_chunks(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head) else body


def checked(block: bytes, digest: str, page_id: str | None) -> tuple[bytes, str]:
    """The payload and its digest, which must be the record's, if the record has one."""
    payload = payload_of(block)
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest and digest != own:
        raise ValueError(f"wrong digest of page {page_id or 'null'}")
    return payload, own


def read_parts(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record. An archive is read by one task; the writer bounds its size, as crawlers do.

    Records of one part are decoded, measured and compared with their digest on the spot, and have their payload if
    ``payloads``; only parts of segmented records carry blocks.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for f, block in parse(content):
                    kind, number = f["warc-type"], int(f.get("warc-segment-number", 0))
                    page_id, digest = f.get("page-id") or None, re.sub("^sha1:", "", f.get("warc-payload-digest", ""))
                    payload = n = None
                    if not number and kind == "response":
                        payload, digest = checked(block, digest, page_id)
                        n = len(payload)
                    if not payloads:
                        payload = None
                    rows.append((kind, f.get("warc-segment-origin-id") or f["warc-record-id"], number,
                                 int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                                 page_id, f.get("warc-target-uri"), digest, f.get("refers-to-page-id"), payload, n,
                                 block if number else None))
                    size += len(payload or b"") + (len(block) if number else 0)
                    if size > HELD_BYTES or len(rows) >= 1000:
                        yield frame(rows)
                        rows, size = [], 0
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")], dtype=object)
        return made.astype({"number": "int32"}).assign(
            total=pd.Series([x[3] for x in rows], dtype="Int64"), n=pd.Series([x[9] for x in rows], dtype="Int64"))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path).select("content")
    return files.mapInPandas(read, PARTS)


@F.pandas_udf(T.StructType([
    T.StructField("payload", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("digest", T.StringType())]))
def reassembled(parts: pd.Series, digests: pd.Series, page_ids: pd.Series) -> pd.DataFrame:
    """Payload, size and digest of segmented records from their blocks in order."""
    rows = []
    for blocks, digest, page_id in zip(parts, digests, page_ids):
        payload, own = checked(b"".join(blocks), digest, page_id)
        rows.append((payload, len(payload), own))
    return pd.DataFrame(rows, columns=["payload", "n", "digest"])


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, payload and payload_bytes (both null for revisits), payload_digest, refers_to.

    A segmented record that lacks a part, whose length differs from the declared total, or any record whose payload differs
    from its digest raises an error; a record without a digest gets that of its payload. No archives: no rows. Page ids are
    the texts of the archive, as 64-bit numbers. The archives are read once; without ``payloads`` the payloads are null and
    the records, cut in the shared folder, are small rows.
    """
    parts = read_parts(spark, path, payloads)
    if not payloads:
        parts = cut(parts, "warc-parts")
    whole = parts.filter("number = 0 and kind in ('response', 'revisit')").select(
        "kind", "page_id", "url", "digest", "refers_to", "payload", "n")
    # Only records that were split travel; a group is one record's parts.
    split = (parts.filter("number > 0").groupBy("origin")
             .agg(F.sort_array(F.collect_list(F.struct("number", "block"))).alias("s"), F.max("total").alias("total"),
                  *(F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("kind", "page_id", "url", "digest"))))
    complete = (F.col("s")[F.size("s") - 1]["number"] == F.size("s")) & (
        F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + F.length(x["block"])) == F.col("total"))
    blocks = F.when(F.coalesce(complete, F.lit(False)), F.col("s.block")).otherwise(
        F.raise_error(F.concat(F.lit("segments missing of "), "origin")).cast("array<binary>"))
    rebuilt = split.select(
        F.lit("response").alias("kind"), "page_id", "url", F.lit(None).cast("string").alias("refers_to"),
        reassembled(blocks, "digest", "page_id").alias("p")).select(
        "kind", "page_id", "url", F.col("p.digest").alias("digest"), "refers_to",
        (F.col("p.payload") if payloads else F.lit(None).cast("binary")).alias("payload"), F.col("p.n").alias("n"))
    return whole.unionByName(rebuilt).select(
        F.col("page_id").cast("long"), "url", F.col("kind").alias("record_type"), "payload", F.col("n").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("refers_to").cast("long"))


def sized(records: DataFrame) -> DataFrame:
    """Revisits get the size of the response with their payload's digest."""
    responses = records.filter("record_type = 'response'")
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes")
    sizes = responses.select("payload_digest", "payload_bytes").dropDuplicates(["payload_digest"])
    return responses.unionByName(revisits.join(sizes, "payload_digest", "left"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records with their payloads; a revisit's size is that of the response it repeats."""
    return sized(read_records(spark, path))


def op8_archives(pages: DataFrame) -> DataFrame:
    """Write and read the whole table; only small rows without payloads are joined."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    lean = cut(read_records(spark, path, payloads=False).drop("payload", "url"), "warc-records")
    return sized(lean).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
coded AS (
    SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, list_reduce(list_prepend('', list_transform(range(32),
        lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1))),
        lambda a, b: a || b) AS payload_digest
    FROM hashed),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS m FROM coded)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM m THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM newest
"""
