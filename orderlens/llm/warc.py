"""WARC archives without repeated payloads.

Headers (id, digest, size) are shuffled by payload digest, every record with a payload seen
under a smaller id becomes a revisit of that one, and only then are payloads written, once
each. Archives are ordinary WARC/1.1 files of response and revisit records, one gzip stream per
file, written through Spark's own committed text output, so that any file system that Spark
reaches will do and a lost executor leaves no half archive behind.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.workspace import stored

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
_READ = 1 << 16


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hex digest of whole 20-bit groups, as SHA-1 has: four digits for five."""
    groups = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def headers(pages: DataFrame) -> DataFrame:
    """page_id, payload size and digest of each row; a missing html is an empty payload."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return pages.select(
        "page_id",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1(payload)).alias("payload_digest"),
    )


def revisits(heads: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id and refers_to of the rows whose payload a smaller page_id has as well.

    Payloads under ``least_bytes`` are never revisits. Rows without page_id cannot be referred
    to and refer to nothing; repeated rows of the smallest id are all responses. A digest that
    many rows share is combined before the shuffle to one row per task.
    """
    large = heads.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    first = (
        large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where(F.col("refers_to") < F.col("last")).select("payload_digest", "refers_to")
    )
    return (
        large.join(first, "payload_digest").where(F.col("page_id") > F.col("refers_to"))
        .select("page_id", "payload_digest", "refers_to")
    )


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """One WARC record per row of pages (page_id, url, html), as text without the closing blank lines."""
    html = F.coalesce("html", F.lit("")).alias("html")
    payload = F.col("html").cast("binary")
    rows = pages.select("page_id", "url", html).withColumn("payload_digest", base32_of_hex(F.sha1(payload)))
    repeated = revisits(stored(headers(pages), "warc-headers"), least_bytes).distinct()
    decided = rows.join(repeated, ["page_id", "payload_digest"], "left")
    again = F.col("refers_to").isNotNull()
    block = F.when(again, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), "html"))
    uri = F.regexp_replace("url", r"[\s<>]+", "%20")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    nothing = F.lit("")
    return decided.select(F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.when(uri.isNull(), nothing).otherwise(line("WARC-Target-URI", uri)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(again, F.concat(
            line("WARC-Refers-To", record_id(F.col("refers_to"))), line("WARC-Profile", F.lit(PROFILE))
        )).otherwise(nothing),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block,
    ).alias("record"))


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the archives, one for each partition that the records come in.

    Each record ends in two line ends, which is the output's separator.
    """
    archives = records(pages, least_bytes).write
    archives.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


def _inflated(content: bytes) -> Iterator[bytes]:
    """The plain bytes of gzip members, a piece at a time."""
    view, at, stream = memoryview(content), 0, zlib.decompressobj(31)
    while at < len(view):
        piece = view[at : at + _READ]
        yield stream.decompress(piece)
        at += len(piece) - len(stream.unused_data)
        if stream.eof:
            stream = zlib.decompressobj(31)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a gzipped archive."""
    held, pieces = bytearray(), _inflated(content)

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends within a record header")
                return
        first, *lines = held[:end].decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        size = end + 4 + int(fields["content-length"])
        while len(held) < size + 4:
            if not more():
                raise ValueError("an archive ends within a record")
        yield fields, bytes(held[end + 4 : size])
        del held[: size + 4]


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives, with the payload's size and the digest found on reading."""
    schema = (
        "record_id string, record_type string, payload_digest string, refers_to_id string,"
        " read_bytes long, read_digest string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse(content.as_py()):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    rows.append((
                        fields["warc-record-id"], fields["warc-type"],
                        fields["warc-payload-digest"].removeprefix("sha1:"), fields.get("warc-refers-to"),
                        len(payload), digest,
                    ))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in zip(*rows)] if rows else [[]] * 6, schema=_READ_SCHEMA
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)


_READ_SCHEMA = pa.schema([
    (name, pa.int64() if name == "read_bytes" else pa.string())
    for name in ("record_id", "record_type", "payload_digest", "refers_to_id", "read_bytes", "read_digest")
])


def resolve(found: DataFrame) -> DataFrame:
    """What each record stands for: a revisit takes its size from the response it refers to.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to and intact (whether
    the payload read has the digest of the header). A revisit whose response is missing has no
    size and is not intact.
    """
    original = (
        found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id"), "payload_digest")
        .agg(F.max("read_bytes").alias("original_bytes"), F.min(F.expr("read_digest = payload_digest")).alias("sound"))
    )
    referred = found.where("record_type = 'revisit'").select("refers_to_id", "payload_digest").distinct()
    used = original.join(referred, ["refers_to_id", "payload_digest"])
    revisit = F.col("record_type") == "revisit"

    def page(column: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({column}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")

    return found.join(used, ["refers_to_id", "payload_digest"], "left").select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("original_bytes")).otherwise(F.col("read_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to_id").alias("refers_to"),
        F.when(revisit, F.coalesce("sound", F.lit(False)))
        .otherwise(F.expr("read_digest = payload_digest")).alias("intact"),
    )


def archive(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write archives of the pages below ``path``, read them back and resolve them."""
    write(pages, path, least_bytes)
    return resolve(read(pages.sparkSession, path))
