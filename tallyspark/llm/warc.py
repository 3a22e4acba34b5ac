"""WARC archives with revisit resolution.

Writing: only headers (row identity, page_id, payload digest and length) are
shuffled by payload digest, to find the first page of each payload; the
resolved headers then join their pages by row identity, which is uniform, and
every record gets fresh headers.  Repeated payloads become ``revisit`` records
without a body.  Archives are written by Spark's text writer with the WARC
record end as line separator, so any file system and a lost executor's retry
are covered by its commit protocol.  Archives are gzip files.

Reading: each archive is parsed record by record by Content-Length, response
payloads are digested again, and revisits join the response they refer to.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import common
from tallyspark.session import scratch_path

RECORD_END = "\r\n\r\n"
#: Shorter payloads are always stored whole.
MIN_REVISIT_BYTES = 100
#: Records of one archive at most; files also end with their partition.
RECORDS_PER_ARCHIVE = 4000
#: Records that a reading task hands on at a time.
RECORDS_PER_BATCH = 256
#: Fixed date: the same pages give the same archives.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(f: Column, r: Column) -> Column:
    h = F.md5(F.concat_ws(":", f.cast("string"), r.cast("string")))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``headers`` (__f, __r, page_id, digest, bytes) plus ``first``: the
    struct (page_id, __f, __r) of the response each row revisits, null for a
    response.  The smallest page_id of a digest is the response, null ids last
    and repeated rows in input order, so exactly one row of a digest is."""
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "__f", "__r")
    first = (headers.where(F.col("bytes") >= min_bytes).groupBy("digest")
             .agg(F.min(order).alias("first")).withColumnRenamed("digest", "d"))
    joined = headers.join(first.hint("merge"), F.col("digest") == F.col("d"), "left")
    own = (F.col("first.__f") == F.col("__f")) & (F.col("first.__r") == F.col("__r"))
    return joined.withColumn("first", F.when((F.col("bytes") >= min_bytes) & ~own, F.col("first"))).drop("d")


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One WARC record per row of ``pages`` (page_id, url, html).

    Null html is an empty payload, a null url or page_id leaves its header
    out, line breaks in a url are percent-encoded, other columns are ignored."""
    common.ready(pages.sparkSession)
    rows = common.with_identity(
        pages, F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        common.text_or_empty(F.col("html").cast("string")).alias("html"))
    headers = rows.select("__f", "__r", "page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"),
                          F.octet_length("html").alias("bytes"))
    resolved = resolve(headers, min_bytes).drop("page_id")
    joined = rows.join(resolved.hint("merge"), ["__f", "__r"])

    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = [F.lit("WARC/1.1"),
             F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("__f"), F.col("__r"))),
             F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Target-URI: "), url),
             F.concat(F.lit("WARC-Page-ID: "), F.col("page_id").cast("string")),
             F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first.__f"), F.col("first.__r")))),
             F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    (joined.select(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body).alias("value"))
     .write.option("lineSep", RECORD_END).option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
     .option("compression", "gzip").text(path))


RECORD = ("record_id string, record_type string, page_id long, url string, refers_id string, digest string, "
          "bytes long, payload binary")


def parse(archive: BinaryIO):
    """(headers, payload) of each record of one archive, by Content-Length;
    one record at a time is held."""
    while version := archive.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record starts with {version[:40]!r}")
        head = {}
        while (line := archive.readline()) not in (b"\r\n", b""):
            name, value = line.decode().removesuffix("\r\n").split(": ", 1)
            head[name] = value
        body = archive.read(int(head["Content-Length"]))
        if archive.read(len(RECORD_END)) != RECORD_END.encode():
            raise ValueError(f"record {head['WARC-Record-ID']} has another length than it states")
        yield head, body.split(b"\r\n\r\n", 1)[1]


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``, as stored (revisits have no
    payload; digest and length are computed anew from each response)."""
    names = [x.split(" ")[0] for x in RECORD.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def row(head, payload):
        full = head["WARC-Type"] == "response"
        digest = hashlib.sha256(payload).hexdigest()
        if full and head["WARC-Payload-Digest"] != f"sha256:{digest}":
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
        page = head.get("WARC-Page-ID")
        return (head["WARC-Record-ID"], head["WARC-Type"], page and int(page), head.get("WARC-Target-URI"),
                head.get("WARC-Refers-To"), digest if full else None, len(payload) if full else None,
                payload if full and with_payload else None)

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                records = parse(gzip.open(io.BytesIO(data.as_buffer())))
                while rows := [row(*r) for r in itertools.islice(records, RECORDS_PER_BATCH)]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def resolved_records(records: DataFrame) -> DataFrame:
    """Every record with digest and length of its full payload: revisits take
    them from the response they refer to (one row per record id)."""
    own = records.select("record_id", "record_type", "page_id", "refers_id", "digest", "bytes")
    target = own.where("record_type = 'response'").select(
        F.col("record_id").alias("t_id"), F.col("page_id").alias("t_page"),
        F.col("digest").alias("t_digest"), F.col("bytes").alias("t_bytes"))
    return own.join(target.hint("merge"), F.col("refers_id") == F.col("t_id"), "left").select(
        "page_id", F.coalesce("bytes", "t_bytes").alias("payload_bytes"),
        F.coalesce("digest", "t_digest").alias("payload_digest"), "record_type",
        F.col("t_page").alias("refers_to"))


def archive_digest(pages: DataFrame) -> DataFrame:
    """The contract's row per page, from archives written and read back."""
    spark = common.ready(pages.sparkSession)
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return resolved_records(common.stored(read_archives(spark, path, with_payload=False), "warc-records"))
