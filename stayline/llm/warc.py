"""WARC archives: writing, reading, and resolving revisits.

Archives are written and read by Spark's own file readers, so they lie wherever Spark reaches. A record is a block of
named headers, a payload and two line ends; as pages are text, the text writer lays records down byte for byte, with the
two line ends as its separator and gzip around each file. Reading goes by Content-Length, so payloads may hold anything.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayline.llm.tables import read, stored, work_path

VERSION = "WARC/1.1"
#: Payloads of at least so many bytes are deduplicated.
MIN_PAYLOAD = 0
#: Records per archive file, which bounds what a task reads at once.
FILE_RECORDS = 2_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"

RECORDS = (
    "file string, place bigint, record_id string, target_uri string, date string, record_type string, page_id bigint, "
    "payload_digest string, payload_bytes bigint, refers_to_id string, refers_to bigint, payload binary"
)
HEADERS = RECORDS.removesuffix(", payload binary")
_HEADER_NAMES = {
    "WARC-Record-ID": "record_id",
    "WARC-Target-URI": "target_uri",
    "WARC-Date": "date",
    "WARC-Type": "record_type",
    "WARC-Refers-To": "refers_to_id",
}
_PAGE = re.compile(r"^<urn:page:(-?\d+)(?::\d+)?>$")


def base32_of_hex(digest: Column) -> Column:
    """Base 32 (RFC 4648) of the 40 hexadecimal digits of a SHA-1: four letters for every five digits."""
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(name: str, value: Column) -> Column:
    """One header line, left out where the value is null; line ends inside a value would break the record."""
    clean = F.regexp_replace(value, r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _write(records: DataFrame, path: str) -> None:
    """Lay down records (record_id, record_type, target_uri, date, payload_digest, payload, and for revisits refers_to_id,
    refers_to_uri, refers_to_date); a revisit has no payload."""
    body = F.coalesce(F.col("payload"), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    text = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.col("date")),
        _header("WARC-Target-URI", F.col("target_uri")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", F.col("refers_to_id")),
        _header("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        _header("WARC-Refers-To-Date", F.col("refers_to_date")),
        _header("Content-Type", F.lit("text/html")),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    writer = records.select(text.alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("lineSep", _END).option("compression", "gzip").text(path)


def write_pages(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """A response record per page (page_id, url, html). A null html is an empty payload, a null url has no header.

    Record ids name the page and the row, as pages may repeat.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    page = F.coalesce(F.concat(F.lit("page:"), F.col("page_id").cast("string")), F.lit("unknown"))
    _write(
        rows.select(
            F.concat(F.lit("<urn:"), page, F.lit(":"), F.monotonically_increasing_id().cast("string"), F.lit(">")).alias("record_id"),
            F.lit("response").alias("record_type"),
            F.col("url").alias("target_uri"),
            F.lit(date).alias("date"),
            base32_of_hex(F.sha1(F.col("payload").cast("binary"))).alias("payload_digest"),
            "payload",
            *[F.lit(None).cast("string").alias(name) for name in ("refers_to_id", "refers_to_uri", "refers_to_date")],
        ),
        path,
    )


def parse(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, headers and payload of each record of an uncompressed archive."""
    at = 0
    while at < len(content):
        stop = content.index(b"\r\n\r\n", at)
        lines = content[at:stop].decode("utf-8").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        end = begin + int(headers["Content-Length"])
        yield at, headers, content[begin:end]
        at = end + 4


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def _page_of(record_id: str | None) -> int | None:
    found = _PAGE.match(record_id or "")
    return int(found[1]) if found else None


def _record(file: str, place: int, headers: dict[str, str], payload: bytes) -> dict:
    row = {field: headers.get(name) for name, field in _HEADER_NAMES.items()}
    own = row["record_type"] != "revisit"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if own else headers["WARC-Payload-Digest"].removeprefix("sha1:")
    return row | {
        "file": file,
        "place": place,
        "page_id": _page_of(row["record_id"]),
        "payload_digest": digest,
        "payload_bytes": len(payload) if own else None,
        "refers_to": _page_of(row["refers_to_id"]),
        "payload": payload,
    }


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of all archives below `path`; digests and sizes of responses are taken from their payloads."""
    schema = RECORDS if payloads else HEADERS
    target = to_arrow_schema(StructType.fromDDL(schema))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for record in parse(zlib.decompress(content.as_py(), wbits=31)):
                    rows.append(_record(file.as_py(), *record))
                    if not payloads:
                        del rows[-1]["payload"]
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    return _files(spark, path).mapInArrow(records, schema)


def resolve(spark: SparkSession, source: str, target: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Read archives and write them again with every payload of at least `min_payload` bytes once.

    Only headers are shuffled. Among equal payloads the record with the smallest page id (nulls last, then by file and
    place) is the response; the others, and revisits that were there before, refer to it. Smaller payloads, and revisits
    whose response is nowhere, stay as they are.
    """
    headers = stored(read_records(spark, source), "headers")
    response = F.col("record_type") == "response"
    order = F.struct(
        F.col("page_id").isNull().alias("unknown"), "page_id", "file", "place", "record_id", "target_uri", "date", "payload_bytes"
    )
    # a map-side minimum, so a payload that a third of all pages share costs one row per task
    originals = (
        headers.where(response & (F.col("payload_bytes") >= min_payload))
        .groupBy("payload_digest")
        .agg(F.min(order).alias("first"))
    )
    decided = headers.join(originals, "payload_digest", "left").select(
        "file",
        "place",
        (F.col("first").isNotNull() & ((F.col("first.file") != F.col("file")) | (F.col("first.place") != F.col("place")))
         & (~response | (F.col("payload_bytes") >= min_payload))).alias("is_copy"),
        F.col("first.record_id").alias("to_id"),
        F.col("first.target_uri").alias("to_uri"),
        F.col("first.date").alias("to_date"),
    )
    copies = decided.where("is_copy")
    # a file holds a bounded number of records, so its decisions are a bounded list
    by_file = copies.groupBy("file").agg(F.collect_list(F.struct("place", "to_id", "to_uri", "to_date")).alias("copies"))
    joined = _files(spark, source).join(by_file, "file", "left")
    schema = (
        "record_id string, record_type string, target_uri string, date string, payload_digest string, payload string, "
        "refers_to_id string, refers_to_uri string, refers_to_date string"
    )
    target_schema = to_arrow_schema(StructType.fromDDL(schema))

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                row = batch.slice(number, 1).to_pylist()[0]
                places = {copy["place"]: copy for copy in row["copies"] or ()}
                out = []
                for place, old, payload in parse(zlib.decompress(row["content"], wbits=31)):
                    record = _record(row["file"], place, old, payload)
                    fresh = {name: record[name] for name in ("record_id", "record_type", "target_uri", "date", "payload_digest")}
                    if copy := places.get(place):
                        fresh |= {
                            "record_type": "revisit", "refers_to_id": copy["to_id"], "refers_to_uri": copy["to_uri"],
                            "refers_to_date": copy["to_date"],
                        }
                    elif record["record_type"] == "revisit":
                        fresh |= {
                            "refers_to_id": record["refers_to_id"], "refers_to_uri": old.get("WARC-Refers-To-Target-URI"),
                            "refers_to_date": old.get("WARC-Refers-To-Date"),
                        }
                    else:
                        fresh["payload"] = payload.decode("utf-8")
                    out.append(fresh)
                yield pa.RecordBatch.from_pylist(out, schema=target_schema)

    _write(joined.mapInArrow(rewritten, schema), target)


def with_payload_sizes(records: DataFrame) -> DataFrame:
    """Give revisits the payload size of the response that they refer to."""
    sizes = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("original_bytes")
    )
    joined = records.join(sizes, "refers_to_id", "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "original_bytes")).drop("original_bytes")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, its revisits resolved, and read back from the deduplicated archives."""
    raw, resolved = work_path(spark, "archives"), work_path(spark, "archives")
    write_pages(read(spark, sf_dir, "pages"), raw)
    resolve(spark, raw, resolved)
    found = with_payload_sizes(stored(read_records(spark, resolved), "records"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest
  FROM digests),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM coded GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM coded JOIN firsts USING (payload_digest)
"""
