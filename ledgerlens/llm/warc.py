"""WARC archives with revisit records.

Writing: headers (id, payload digest, payload size) are shuffled by digest; of equal payloads of at
least ``least_bytes`` the one with the largest id stays a response, the others become revisit
records that refer to it. Records are written by Spark's text writer with the record separator
CR LF CR LF, so that each file is a plain sequence of WARC/1.1 records; ``per_file`` bounds the
records of a file. Reading: whole files are read by Spark and cut by their Content-Length fields, so
payloads may hold anything. ``resolve`` joins revisit records, by digest, to the responses they
refer to; ``rewrite`` brings archives with repeated payloads to deduplicated ones with fresh headers.
It decides on headers; a payload is fetched for an earlier revisit only if that becomes a response.

Cases: a null payload is empty; a null id is written as an empty id and read as null; rows that
repeat the largest id with the same payload all stay responses; payloads below ``least_bytes`` stay
responses; a revisit whose response (id and digest) is not in the archives is rewritten as it is; line breaks in URLs are percent-encoded; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned

HEADER_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
                 "payload_bytes long, payload string")
#: pairs of id and digest (some 60 bytes each) that are broadcast at most
BROADCAST_PAIRS = 100_000
WRITTEN = "2000-01-01T00:00:00Z"


def with_digest(pages: DataFrame, doc_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    body = F.coalesce(F.col(html), F.lit(""))
    return pages.select(F.col(doc_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"),
                        F.sha1(body.cast("binary")).alias("payload_digest"), F.octet_length(body).cast("long").alias("payload_bytes"))


def mark_revisits(records: DataFrame, least_bytes: int = 1000, headers: DataFrame | None = None) -> DataFrame:
    """Adds record_type and refers_to. Only headers (those of ``records`` if none are given) are
    grouped; the aggregate combines on the map side, and the join back is one that AQE can split
    where one payload is frequent."""
    headers = records if headers is None else headers
    originals = (headers.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
                 .groupBy(F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes"))
                 .agg(F.max("page_id").alias("original")))
    same = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("bytes"))
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return (records.join(originals, same, "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("original")))
            .drop("digest", "bytes", "original"))


def record_text(crlf: str = "\r\n") -> Column:
    """Header block, empty line and payload (none for a revisit); the writer adds the end."""
    is_revisit = F.col("record_type") == "revisit"
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    clean_url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(crlf))

    return F.concat(
        F.lit("WARC/1.1" + crlf), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), ident, F.lit(">"))),
        line("WARC-Date", F.lit(WRITTEN)), line("WARC-Target-URI", clean_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(is_revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                    line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(">")))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(is_revisit, F.lit("0")).otherwise(F.octet_length("payload").cast("string"))),
        F.lit(crlf), F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))


def write_archives(records: DataFrame, path: str, per_file: int = 2000) -> None:
    """records: page_id, url, payload, payload_digest, record_type, refers_to."""
    (records.select(record_text().alias("value")).write.option("lineSep", HEADER_END).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def _ident(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_archive(data: bytes) -> Iterator[tuple]:
    """Records of one archive file, cut by their Content-Length."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        field = dict(x.split(": ", 1) for x in lines)
        size = int(field["Content-Length"])
        body = data[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4
        revisit = field["WARC-Type"] == "revisit"
        digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
        if not revisit and hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload of {field['WARC-Record-ID']} doesn't match its digest")
        yield (_ident(field["WARC-Record-ID"]), field["WARC-Target-URI"], field["WARC-Type"],
               _ident(field["WARC-Refers-To"]) if revisit else None, digest,
               None if revisit else size, None if revisit else body.decode())


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record (RECORD_SCHEMA); payload_bytes and payload are null for revisits."""
    import gzip

    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    if not payload:
        names, kinds = names[:-1], kinds[:-1]

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = list(parse_archive(gzip.decompress(content.as_buffer().to_pybytes())))
                for lo in range(0, len(rows), 500):
                    columns = list(zip(*rows[lo:lo + 500], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[i], k) for i, k in enumerate(kinds)], names=names)

    schema = RECORD_SCHEMA if payload else RECORD_SCHEMA.replace(", payload string", "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(read, schema)


def resolve(records: DataFrame) -> DataFrame:
    """Headers with the payload size of revisits filled in from the response they refer to."""
    responses = (records.where("record_type = 'response' and page_id is not null")
                 .groupBy(F.col("page_id").alias("original"), F.col("payload_digest").alias("digest"))
                 .agg(F.max("payload_bytes").alias("full_bytes")))
    revisits = records.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("original")) & (F.col("payload_digest") == F.col("digest")), "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (records.where("record_type = 'response'").select(*out)
            .unionByName(revisits.withColumn("payload_bytes", F.col("full_bytes")).select(*out)))


def rewrite(spark: SparkSession, source: str, target: str, least_bytes: int = 1000, per_file: int = 2000) -> None:
    """Archives in, deduplicated archives out: earlier revisits get back the payload of the response
    they refer to, equal payloads are found anew, and all headers are written afresh."""
    responses = read_archives(spark, source).where("record_type = 'response'").drop("record_type", "refers_to")
    sized = pinned(read_archives(spark, source, payload=False).select("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes"))
    held = (sized.where("record_type = 'response' and page_id is not null")
            .groupBy(F.col("page_id").alias("held_id"), F.col("payload_digest").alias("held_digest")).agg(F.max("payload_bytes").alias("held_bytes")))
    earlier = (sized.where("record_type = 'revisit'")
               .join(held, (F.col("refers_to") == F.col("held_id")) & (F.col("payload_digest") == F.col("held_digest")), "left"))
    known = pinned(earlier.where("held_bytes is not null").select(
        "page_id", "url", "payload_digest", F.col("held_bytes").alias("payload_bytes"), F.col("refers_to").alias("earlier")))
    lost = earlier.where("held_bytes is null").select("page_id", "url", "payload_digest", "record_type", "refers_to")
    headers = (sized.where("record_type = 'response'").select("page_id", "payload_digest", "payload_bytes")
               .unionByName(known.select("page_id", "payload_digest", "payload_bytes")))
    marked = mark_revisits(known, least_bytes, headers)
    promoted = marked.where("record_type = 'response'")
    wanted = pinned(promoted.select(F.col("earlier").alias("page_id"), "payload_digest").distinct())
    if wanted.count() <= BROADCAST_PAIRS:  # few texts are fetched: the others need not move
        wanted = F.broadcast(wanted)
    texts = (responses.join(wanted, ["page_id", "payload_digest"], "left_semi")
             .groupBy(F.col("page_id").alias("earlier"), "payload_digest").agg(F.first("payload").alias("payload")))
    out = ["page_id", "url", "payload", "payload_digest", "record_type", "refers_to"]
    without = F.lit(None).cast("string").alias("payload")
    write_archives(mark_revisits(responses, least_bytes, headers).select(*out)
                   .unionByName(marked.where("record_type = 'revisit'").select(*out[:2], without, *out[3:]))
                   .unionByName(promoted.join(texts, ["earlier", "payload_digest"]).select(*out))
                   .unionByName(lost.select(*out[:2], without, *out[3:])), target, per_file)
