"""A content-addressed archive of WARC records.

Method: payload bytes are stored once, under a verified strong digest (SHA-256);
the exact header block of every record is stored separately; the original records
come back by joining the two. A record whose payload another one holds already is
a revisit: its header names the response, its block is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import text_bytes
from tickloom.session import work_folder

BASE32_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: The date all records carry unless the caller gives one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: Column) -> Column:
    """SHA-1 in upper-case base32: each five hex digits are four of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), BASE32_DIGITS, BASE32)


def _header(fields: list[tuple[str, Column]]) -> Column:
    """A WARC header block: version line, fields with a value, empty line; CRLF everywhere."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)) for name, value in fields]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit("\r\n\r\n"))


def record_id(page: Column) -> Column:
    """A URN made of the page's number; pages without one are told apart by their digest only."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Archive ``pages`` (page_id, url, html) under ``path``: tables ``headers`` and ``payloads``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the
    smallest page_id is the response and the others revisit it; smaller payloads are
    all responses. Rows that repeat the response's page_id and payload are responses
    too, as they name the same record. A null html is an empty payload; a null url
    leaves the target out; a null page_id comes after all others. Line breaks in a
    url are percent-encoded, so that they cannot end the header. Two payloads of one
    SHA-256 but different length or SHA-1 are an error.
    """
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
        F.coalesce(text_bytes("html"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("address"), sha1_base32(F.col("payload")).alias("sha1"),
                       F.octet_length("payload").cast("long").alias("bytes"))
    # One copy of each payload: combined in every task before the exchange.
    store = rows.groupBy("address").agg(
        F.any_value("payload").alias("payload"), F.min("bytes").alias("bytes"), F.max("bytes").alias("most"),
        F.min("sha1").alias("sha1"), F.max("sha1").alias("other"))
    store = store.withColumn("payload", F.when(
        (F.col("bytes") == F.col("most")) & (F.col("sha1") == F.col("other")), F.col("payload")
    ).otherwise(F.raise_error(F.concat(F.lit("different payloads of digest "), "address")).cast("binary")))
    store.select("address", "payload", "bytes", "sha1").write.parquet(f"{path}/payloads")

    narrow = rows.select("page_id", "url", "address", "sha1", "bytes")
    least = narrow.filter(F.col("bytes") >= min_bytes).groupBy("address").agg(F.min("page_id").alias("first"))
    known = narrow.join(least, "address", "left")
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    header = _header([
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", record_id(F.col("page_id"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        ("WARC-Refers-To", F.when(revisit, record_id(F.col("first")))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("X-Payload-Length", F.col("bytes").cast("string")),
        ("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
    ])
    known.select("page_id", revisit.alias("is_revisit"), "address", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, byte for byte: header, block, and both with the closing line breaks.

    Columns page_id, header, block, record. A payload is checked against its address
    as it is read. A revisit needs no payload and takes no part in the join.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    verified = payloads.select("address", F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), "address")).cast("binary")).alias("block"))
    full = headers.filter("NOT is_revisit").join(verified, "address").select("page_id", "header", "block")
    empty = headers.filter("is_revisit").select("page_id", "header", F.lit(b"").alias("block"))
    return full.unionByName(empty).withColumn("record", F.concat("header", "block", F.lit(b"\r\n\r\n")))


def parsed(records: DataFrame) -> DataFrame:
    """The fields of each record's header, read from its text; the digest of a response from its block."""
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        value = F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(value != "", value)

    kind = field("WARC-Type")
    stated = F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "")
    found = F.when(kind == "response", sha1_base32(F.col("block"))).otherwise(stated)
    return records.select(
        "page_id", kind.alias("record_type"), field("WARC-Target-URI").alias("url"),
        field("X-Payload-Length").cast("long").alias("payload_bytes"),
        F.when(found == stated, found).otherwise(F.raise_error(F.lit("a payload differs from its header"))).alias("payload_digest"),
        F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), "<urn:page:(-?[0-9]+)>", 1).try_cast("long").alias("refers_to"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every archived page with its full html, that of revisits too; a hot payload is split by the join."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    return headers.join(payloads, "address").select("page_id", F.decode("payload", "UTF-8").alias("html"))


def export(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write the records as plain WARC files. Payloads here are UTF-8, so a record is a line that ends in two CRLF."""
    line = F.concat(F.decode("header", "UTF-8"), F.decode("block", "UTF-8"))
    records.select(line.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive the pages in a new shared folder, read the records back and return their fields."""
    path = work_folder(pages.sparkSession, "warc")
    write_archive(pages, path, min_bytes)
    return parsed(read_records(pages.sparkSession, path))
