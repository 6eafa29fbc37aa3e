"""WARC archives without repeated payloads: revisit resolution by payload digest.

Headers (id and digest, never payloads) are shuffled by digest; the smallest id of a digest is the
original, all others become revisit records that refer to it. Archives are written by Spark's own
text writer, whose commit protocol survives lost tasks and which reaches any store: a record ends
with two line ends, which serve as the writer's separator. Records of similar size share archives, so
that many small ones or few large ones make one, and none outgrows what a task can read.

The reader takes archives of other writers as well: a member of the compressed file per record or for
many, records of any type (only responses and revisits are returned), field names in any case. It
holds one record at a time beside the archive's bytes; what is cut off or follows the end is refused.

Defined results: null payload = empty; empty table = no records; rows that repeat id and payload
are all originals if their id is the smallest (a record cannot refer to itself); a page without id
is a response; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits as four numbers of 40 bits, eight digits each."""
    hexed = F.sha1(payload.cast("binary"))
    parts = [
        F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty) with payload_bytes and payload_digest."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        base32_sha1(html).alias("payload_digest"),
    )


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_digest, original of each page that repeats an earlier page's payload.

    Originals are pre-aggregated per digest, so a payload that a third of all pages share sends one
    row per task; the join back is a shuffle join whose hot side Spark splits.
    """
    sized = headers.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest")
    first = sized.groupBy("payload_digest").agg(F.min("page_id").alias("original"))
    return (
        sized.join(first, "payload_digest")
        .where(F.col("page_id") > F.col("original"))
        .dropDuplicates(["page_id", "payload_digest"])
    )


def record_id(page_id: Column) -> Column:
    """A UUID made from the page id, so a repeated run writes the same archive."""
    h = F.sha1(F.concat(F.lit("warc-page-"), F.coalesce(page_id.cast("string"), F.lit(""))))
    parts = [
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(F.lit("8"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    ]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("")), F.lit(EOL))


def records(rows: DataFrame, date: str) -> DataFrame:
    """One WARC record per row as text, without the two line ends that close it."""
    repeats = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}"),
        _field("Content-Type", "text/html; charset=utf-8"),
        _field("Content-Length", F.col("payload_bytes")),
        F.lit(EOL),
    )
    block = F.concat(http, F.when(repeats, "").otherwise(F.col("html")))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20]", "+")
    refers = F.concat(
        _field("WARC-Refers-To", record_id(F.col("original"))),
        _field("WARC-Profile", PROFILE),
        _field("Refers-To-Page-Id", F.col("original")),
    )
    return rows.select(
        F.concat(
            F.lit(f"WARC/1.0{EOL}"),
            _field("WARC-Type", F.when(repeats, "revisit").otherwise("response")),
            _field("WARC-Record-ID", record_id(F.col("page_id"))),
            _field("WARC-Date", date),
            _field("WARC-Target-URI", url),
            _field("Content-Type", "application/http; msgtype=response"),
            _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            F.when(repeats, refers).otherwise(""),
            _field("Page-Id", F.col("page_id")),
            _field("Payload-Length", F.col("payload_bytes")),
            _field("Content-Length", F.octet_length(block)),
            F.lit(EOL),
            block,
        ).alias("value")
    )


# Payloads below so many bytes, and how many records of that size share an archive: about 300 MB.
SIZES = ((1 << 16, 5_000), (1 << 20, 300), (1 << 24, 20), (1 << 31, 1))


def write_archives(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = SIZES[0][1],
) -> None:
    """Writes gzipped archives under ``path``: a record per page, payloads of at least ``min_bytes``
    only once. Page-Id, Payload-Length and Refers-To-Page-Id are extension fields."""
    rows = payloads(pages)
    size = F.lit(len(SIZES) - 1)
    for i, (limit, _) in reversed(list(enumerate(SIZES))):
        size = F.when(F.col("payload_bytes") < limit, i).otherwise(size)
    rows = rows.withColumn("size", size)
    present = sorted(r[0] for r in rows.select("size").distinct().collect())  # at most len(SIZES)
    later = revisits(rows.select("page_id", "payload_bytes", "payload_digest"), min_bytes)
    for i in present:
        resolved = rows.where(F.col("size") == i).join(later, ["page_id", "payload_digest"], "left")
        writer = records(resolved, date).write.option("maxRecordsPerFile", min(records_per_file, SIZES[i][1]))
        writer.text(f"{path}/size={i}", compression="gzip", lineSep=EOL + EOL)


def _parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of one archive; holds a record at a
    time."""
    held = bytearray()

    def fill(upto: int) -> bool:
        while len(held) < upto:
            piece = next(chunks, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        end = -1
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                raise ValueError("a WARC record is cut off in its header")
        lines = held[:end].decode().split(EOL)
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record: {lines[0][:40]}")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        upto = end + 4 + int(fields["content-length"])
        if not fill(upto + 4) or held[upto : upto + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record is cut off in its block")
        yield fields, bytes(held[end + 4 : upto])
        del held[: upto + 4]


def _inflate(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed bytes of all members of a compressed file, at most ``step`` at a time."""
    data, at = memoryview(content), 0
    while at < len(data):
        engine, waiting = zlib.decompressobj(wbits=31), b""
        while not engine.eof:
            ended = not waiting and at >= len(data)
            if not waiting:
                waiting = bytes(data[at : at + step])
                at += len(waiting)
            found = engine.decompress(waiting, step)
            waiting = engine.unconsumed_tail
            if ended and not found and not engine.eof:
                raise ValueError("a compressed archive is cut off")
            if found:
                yield found
        at -= len(engine.unused_data)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    number = lambda text: int(text) if text else None
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for fields, block in _parse(_inflate(content.as_py())):
                kind = fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                payload = block.partition(b"\r\n\r\n")[2]
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                if kind == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if digest and found != digest:
                        raise ValueError(f"{fields.get('warc-record-id')}: payload and digest differ")
                    digest = found
                length = number(fields.get("payload-length", ""))
                row = (
                    number(fields.get("page-id", "")),
                    fields.get("warc-target-uri"),
                    len(payload) if length is None and kind == "response" else length,
                    digest or None,
                    kind,
                    number(fields.get("refers-to-page-id", "")),
                    payload if kind == "response" else None,
                )
                rows.append(row)
                held += len(payload)
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)],
                        schema=schema,
                    )
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)],
                    schema=schema,
                )


def _any_archive(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits of all archives under ``path``, in folders below it too; every
    response's payload is held against its digest. An archive is one task's input: Spark reads files of
    up to 2 GB whole."""
    if not _any_archive(spark, path):
        return spark.createDataFrame([], RECORDS)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
    files = reader.option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(_read, RECORDS)
