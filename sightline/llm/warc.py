"""WARC archives of pages: segmented records are written, read back, put together again and decoded.

A page's payload travels in an HTTP response with chunked framing.  A block longer than a segment is cut into a first
record and continuation records, which name the first (``WARC-Segment-Origin-ID``) and carry their number; the last
one carries the total length.  A page whose payload another page has already is written as a revisit without payload.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sightline.llm.common import settle, work_folder

VERSION, EOL = b"WARC/1.1", b"\r\n"
#: Bytes of a block in one record, of a chunk, and records in one archive: an archive has at most 40 MB.
SEGMENT_BYTES, CHUNK_BYTES, ARCHIVE_RECORDS = 8192, 3000, 4000
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD = ("record_id string, kind string, page_id long, refers_to long, uri string, payload_digest string, "
          "segment int, origin_id string, total_length long, block binary")


def sha1_32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = [payload[k:k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes | None:
    """What chunked framing holds; None where it is broken or cut short."""
    parts, at = [], 0
    while True:
        end = body.find(EOL, at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size:at + size + 2] != EOL:
            return None
        parts.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response, its framing undone."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    chunked = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(EOL)[1:])
    return unframed(body) if chunked else body


def header(fields: dict[str, object]) -> bytes:
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A").encode() for k, v in fields.items() if v is not None]
    return EOL.join([VERSION, *lines, b"", b""])


def records_of(row: dict, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page, without the two line ends that close each."""
    first = f"<urn:uuid:{row['uid']}>"
    fields = {"WARC-Target-URI": row["url"], "WARC-Date": "2000-01-01T00:00:00Z", "Page-ID": row["page_id"]}
    if row["is_revisit"]:
        block = HTTP
        yield header({"WARC-Type": "revisit", "WARC-Record-ID": first, **fields, "WARC-Payload-Digest": f"sha1:{row['digest']}",
                      "Refers-To-Page-ID": row["leader"], "Content-Length": len(block)}) + block
        return
    block = HTTP + framed(row["payload"])
    parts = [block[k:k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    for k, part in enumerate(parts, 1):
        more = {} if len(parts) == 1 else {"WARC-Segment-Number": k}
        if k == 1:
            more |= {"WARC-Payload-Digest": f"sha1:{row['digest']}"}
        else:
            more |= {"WARC-Segment-Origin-ID": first, "WARC-Segment-Total-Length": len(block) if k == len(parts) else None}
        name = first if k == 1 else f"<urn:uuid:{row['uid']}-{k}>"
        yield header({"WARC-Type": "response" if k == 1 else "continuation", "WARC-Record-ID": name, **fields, **more, "Content-Length": len(part)}) + part


def with_leaders(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, payload) with its payload's ``digest``, and ``leader``, the largest ``page_id`` that has that payload."""
    rows = pages.withColumn("sha", F.unhex(F.sha1("payload")))
    leaders = rows.groupBy("sha", F.octet_length("payload").alias("_bytes")).agg(F.max("page_id").alias("leader")).drop("_bytes")
    return rows.join(leaders, "sha", "left")


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``, in gzip archives of bounded size.

    Null html is an empty payload.  Of equal payloads the largest ``page_id`` is the response; rows that repeat it are
    responses too, and so are all rows of a payload that no row with an id has.  Other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = with_leaders(rows).withColumn("uid", F.uuid()).withColumn("is_revisit", ~F.col("page_id").eqNullSafe(F.col("leader")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(start, 64).to_pylist():
                    row["digest"] = base64.b32encode(row["sha"]).decode()
                    out.extend(records_of(row, segment_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = rows.select("page_id", "url", "payload", "sha", "leader", "uid", "is_revisit").mapInArrow(run, "record binary")
    # a text writer puts bytes out as they are; a record ends with two line ends
    (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", archive_records).text(folder))


def parsed(archive: bytes) -> Iterator[dict]:
    """The records of an archive, plain or gzip (of one member or many), by their content lengths."""
    if archive[:2] == b"\x1f\x8b":
        parts = []
        while archive:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(archive))
            archive = member.unused_data
        archive = b"".join(parts)
    at = 0
    while archive.startswith(b"WARC/", at):
        end = archive.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in archive[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        start = end + 4
        at = start + int(head["Content-Length"])
        number = lambda name: int(head[name]) if name in head else None
        yield {"record_id": head["WARC-Record-ID"], "kind": head["WARC-Type"], "page_id": number("Page-ID"), "refers_to": number("Refers-To-Page-ID"),
               "uri": head.get("WARC-Target-URI"), "payload_digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
               "segment": number("WARC-Segment-Number"), "origin_id": head.get("WARC-Segment-Origin-ID"),
               "total_length": number("WARC-Segment-Total-Length"), "block": archive[start:at]}
        at += 4


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records below ``folder``, one row each, continuation records included.  An empty folder has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for record in parsed(content.as_py()):
                    rows.append(record)
                    if len(rows) == 256:
                        yield to_batch(rows)
                        rows = []
                if rows:
                    yield to_batch(rows)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in RECORD.split(", ")]

    def to_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)

    return files.mapInArrow(run, RECORD)


def whole(parts: Column) -> Column:
    """Whether ordered segments are numbered 1, 2, ... and the last one's total is the length of all."""
    return ((F.element_at(parts, -1)["segment"] == F.size(parts)) & (parts[0]["segment"] == 1)
            & (F.size(F.array_distinct(F.transform(parts, lambda p: p["segment"]))) == F.size(parts))
            & (F.element_at(parts, -1)["total_length"] == F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))))


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record that is no continuation: its fields, ``complete``, ``payload`` and ``actual_digest``.

    Continuation records are gathered with the record that they continue and put in order of their numbers.  Where a
    number is missing or doubled, or the total length differs, ``complete`` is false and the payload null; so it is
    where the chunked framing is broken.  Continuations of a record that is not there give no row.
    """
    fields = ["record_id", "kind", "page_id", "refers_to", "uri", "payload_digest"]
    single = records.where("segment IS NULL").select(*fields, F.lit(True).alias("in_order"), F.array("block").alias("blocks"))
    part = F.struct("segment", "total_length", "block")
    joined = (records.where("segment IS NOT NULL").groupBy(F.coalesce("origin_id", "record_id").alias("origin"))
              .agg(F.array_sort(F.collect_list(part)).alias("parts"), *(F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in fields))
              .where("record_id IS NOT NULL")
              .select(*fields, F.coalesce(whole(F.col("parts")), F.lit(False)).alias("in_order"), F.col("parts.block").alias("blocks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                payloads = [payload_of(b"".join(blocks)) if good else None
                            for blocks, good in zip(part.column("blocks").to_pylist(), part.column("in_order").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in fields), pa.array([p is not None for p in payloads]), pa.array(payloads, pa.binary()),
                     pa.array([None if p is None else sha1_32(p) for p in payloads], pa.string())],
                    [*fields, "complete", "payload", "actual_digest"])

    schema = "record_id string, kind string, page_id long, refers_to long, uri string, payload_digest string, complete boolean, payload binary, actual_digest string"
    revisits = records.where("kind = 'revisit'").select(*fields, F.lit(True).alias("complete"), F.lit(None).cast("binary").alias("payload"),
                                                        F.lit(None).cast("string").alias("actual_digest"))
    return single.where("kind <> 'revisit'").unionByName(joined).mapInArrow(run, schema).unionByName(revisits)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and give each page's record: ``page_id``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``complete``.  A revisit has the length of
    the response to which its digest leads."""
    spark = pages.sparkSession
    folder = work_folder(spark)
    write_archives(pages, folder)
    found = reassemble(read_archives(spark, folder)).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.coalesce("actual_digest", "payload_digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to", "complete")
    found = settle(found)
    responses = (found.where("record_type = 'response'").groupBy("payload_digest", F.col("complete").alias("_c"))
                 .agg(F.max("payload_bytes").alias("_bytes")).drop("_c"))
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes").join(responses, "payload_digest", "left").withColumnRenamed("_bytes", "payload_bytes")
    return found.where("record_type = 'response'").unionByName(revisits)
