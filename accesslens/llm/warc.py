"""WARC archives without repeated payloads: revisit resolution.

Headers (id, url, payload digest, length) are shuffled by digest; of the records
with one payload of ``SMALLEST`` bytes or more the one with the largest id stays a
response and the others become revisit records that refer to it by record id, target
and date. Every archive has headers of its own: record ids are new and the date is that of
writing. Archives are written by Spark's text writer: a record is one value, the record end
(CR LF CR LF) is the line separator, so files are plain WARC 1.1, written and
committed as any Spark output, in whatever store the path names. Records of one class
of sizes fill files together, as many as make up ``ARCHIVE`` bytes of the largest of them; a
longer record is an archive by itself. Reading unpacks a file as a stream and frames
records by Content-Length, so a task holds one packed file and one record.
Payload bytes only move once, with the join that tells a record its kind.

Equal payloads are told by SHA-1 and length.

Defined cases: a null html is an empty payload, a null url an empty target; line
breaks in a url are percent-encoded; a null id loses against any other; rows
alike in id and payload are written with the same kind, so a repeated
largest id gives several responses, which share the record id that is referred to; an
empty table gives no record; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens import session
from accesslens.llm.common import CLEANUP, setting, stored

SMALLEST = 1000
ARCHIVE = 128 << 20
CLASSES = (64 << 10, 2 << 20)  # bytes of the largest payload of each class but the last
PAGE = "X-Page-ID"  # header of our own: the id that the row had
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payloads(pages: DataFrame) -> DataFrame:
    """``id``, ``url``, ``body``, ``bytes``, ``digest``."""
    body = F.coalesce(pages["html"], F.lit("")).cast("binary")
    return pages.select(
        pages["page_id"].cast("long").alias("id"),
        F.coalesce(pages["url"], F.lit("")).alias("url"),
        body.alias("body"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.sha1(body).alias("digest"),
    )


def originals(headers: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """The record that stays a response, per payload that repeats: ``digest``, ``bytes``, ``original``, ``original_url``."""
    large = headers.filter(F.col("bytes") >= smallest)
    groups = large.groupBy("digest", "bytes").agg(F.max(F.struct("id", "url")).alias("first"), F.count(F.lit(1)).alias("n"))
    return groups.filter("n > 1").select("digest", "bytes", F.col("first.id").alias("original"), F.col("first.url").alias("original_url"))


def header_lines(*pairs: tuple[str, Column]) -> Column:
    return F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in pairs])


def target_uri(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_id(archive: str, id_: Column, digest: Column) -> Column:
    """The id of a record that others refer to: a UUID made from the archive's, the page and the payload."""
    name = F.md5(F.concat_ws(" ", F.lit(archive), id_.cast("string"), digest).cast("binary"))
    return F.regexp_replace(name, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-3$3-8$4-$5")


def records(found: DataFrame, archive: str) -> Column:
    """The record of each row as bytes in a string column, without the record end."""
    id_, revisit, original = found["id"], found["revisit"], found["original"]
    date = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    referred = record_id(archive, original, found["digest"])
    own = F.when(original.isNotNull() & ~revisit, referred).otherwise(F.uuid())
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        found["bytes"].cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(found["bytes"])
    lines = F.concat(
        F.lit("WARC/1.1\r\n"),
        header_lines(
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), own, F.lit(">"))),
            ("WARC-Date", date),
            ("WARC-Target-URI", target_uri(found["url"])),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), found["digest"])),
        ),
        F.when(id_.isNotNull(), header_lines((PAGE, id_.cast("string")))).otherwise(""),
        F.when(
            revisit,
            header_lines(
                ("WARC-Profile", F.lit(PROFILE)),
                ("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), referred, F.lit(">"))),
                ("WARC-Refers-To-Target-URI", target_uri(found["original_url"])),
                ("WARC-Refers-To-Date", date),
            ),
        ).otherwise(""),
        header_lines(
            ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", block.cast("string"))
        ),
        F.lit("\r\n"),
        http,
    )
    body = F.when(~revisit, found["body"].cast("string")).otherwise("")
    return F.concat(lines, body)


def write_archives(pages: DataFrame, path: str, smallest: int = SMALLEST) -> None:
    """Archives below ``path``, one record per row of ``pages`` (page_id, url, html)."""
    spark, archive = pages.sparkSession, str(uuid.uuid4())
    rows = payloads(pages)
    headers = stored(rows.select("id", "url", "digest", "bytes"), "page-headers")
    stay = stored(originals(headers, smallest), "originals")
    stay = stay.withColumnsRenamed({"digest": "d", "bytes": "b"})
    edges = (0, *CLASSES, None)
    some = [F.count_if(within(F.col("bytes"), a, b)).alias(f"c{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    counted = headers.select(*some).first()
    with setting(spark, CLEANUP, "true"):
        for i, (low, high) in enumerate(zip(edges, edges[1:])):
            if i and not counted[f"c{i}"]:
                continue
            found = rows.filter(within(F.col("bytes"), low, high))
            found = found.join(stay, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left")
            # Rows with a null id lose against any other id, and stay responses where there is no other.
            revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
            found = found.withColumn("revisit", revisit)
            found.select(records(found, archive).alias("value")).write.mode("append").option("lineSep", RECORD_END).option(
                "maxRecordsPerFile", max(1, ARCHIVE // high) if high else 1
            ).option("compression", "gzip").text(path)


def within(size: Column, low: int, high: int | None) -> Column:
    """Whether a payload is of the class of sizes above ``low``, to ``high``; the first class has the empty ones."""
    above = size > low if low else size >= 0
    return above & (size <= high) if high else above


class Reader:
    """Records of one archive file, framed by Content-Length, unpacked as they are read."""

    def __init__(self, content: bytes):
        packed = io.BytesIO(content)
        self.file = io.BufferedReader(gzip.GzipFile(fileobj=packed)) if content[:2] == b"\x1f\x8b" else packed

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while first := self.file.readline():
            if first != b"WARC/1.1\r\n":
                raise ValueError(f"no record begins with {first[:40]!r}")
            headers = {}
            while (line := self.file.readline()) != b"\r\n":
                if not line:
                    raise ValueError("an archive ends within the headers of a record")
                name, value = line[:-2].decode("utf-8", "replace").split(": ", 1)
                headers[name] = value
            block = self.file.read(int(headers["Content-Length"]))
            if len(block) < int(headers["Content-Length"]) or self.file.read(len(RECORD_END)) != RECORD_END.encode():
                raise ValueError(f"record {headers['WARC-Record-ID']} does not end where its length says")
            yield headers, block


def read_archives(spark, path: str) -> DataFrame:
    """Headers of all records: ``id`` (of the page), ``record``, ``record_type``, ``digest``, ``refers_to`` (a
    record), ``bytes`` and ``payload_sha1`` of the payload in the record (null for revisits)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(
            [
                ("id", pa.int64()),
                ("record", pa.string()),
                ("record_type", pa.string()),
                ("digest", pa.string()),
                ("refers_to", pa.string()),
                ("bytes", pa.int64()),
                ("payload_sha1", pa.string()),
            ]
        )
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in Reader(content.as_py()):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    whole = headers["WARC-Type"] == "response"
                    rows.append(
                        {
                            "id": int(headers[PAGE]) if PAGE in headers else None,
                            "record": headers["WARC-Record-ID"],
                            "record_type": headers["WARC-Type"],
                            "digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "refers_to": headers.get("WARC-Refers-To"),
                            "bytes": len(payload) if whole else None,
                            "payload_sha1": hashlib.sha1(payload).hexdigest() if whole else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, kind)

    schema = "id long, record string, record_type string, digest string, refers_to string, bytes long, payload_sha1 string"
    # An archive is one row: one at a time goes to Python.
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):
        return stored(files.mapInArrow(parse, schema), "headers")


def resolved(headers: DataFrame) -> DataFrame:
    """Revisits joined to their responses by record id and payload digest: one row per record with the full
    payload's length and digest and the page whose response a revisit refers to."""
    responses = headers.filter("record_type = 'response'").select("id", "record", "bytes", F.col("payload_sha1").alias("digest"))
    whole = responses.select("id", "bytes", "digest", F.lit("response").alias("kind"), F.lit(None).cast("long").alias("refers_to"))
    revisits = headers.filter("record_type = 'revisit'").select("id", "digest", F.col("refers_to").alias("record"))
    wanted = stored(revisits.select("digest", "record").distinct(), "wanted")
    # Responses that share a record id are rows alike.
    sources = wanted.join(responses.withColumnRenamed("id", "of"), ["digest", "record"]).distinct()
    back = revisits.join(stored(sources, "sources"), ["digest", "record"])
    return whole.unionByName(back.select("id", "bytes", "digest", F.lit("revisit").alias("kind"), F.col("of").alias("refers_to")))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives, reads them back: one row per page."""
    spark = pages.sparkSession
    path = session.scratch(spark, "archives")
    write_archives(pages, path)
    return resolved(read_archives(spark, path)).select(
        F.col("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )
