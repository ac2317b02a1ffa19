"""WARC archives of pages through a chunked record table.

A payload is never copied as a whole: it is cut into chunks, and a record that
is longer than one chunk becomes a row of segments (WARC's own segmentation:
a first record and ``continuation`` records).  Every segment carries the
record's identifier, its chunk number and the digest of the payload up to its
end, so that a reader verifies chunk after chunk.  Segments are gathered into
blocks of bounded size; Spark's text writer puts a bounded number of blocks
into a file, whose record separator is the one of WARC.

Copies are found before writing: payloads are grouped by SHA-256, and only
groups of two or more rows are joined back to the pages.

Reading takes whole files, which the writer bounds.  Records that lie in one
file are verified as they stream by; the chunks of a record that runs over the
end of a file are shuffled by record, sorted by chunk number and verified with
one running digest, so no task ever holds a whole oversized record.

Defined results: null html is an empty payload; a row without page_id is a
response only if no row with one has its payload, and is never referred to;
rows that repeat a page_id and its payload are all what that page is; two
payloads under one page_id are two records; a null URL gives no target line,
other characters than printable ASCII in a URL are percent-encoded; an empty
table gives empty archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlake.llm.common import attach_groups, ship_package, stage, text_bytes

CHUNK = 1 << 16             # payload bytes of a segment, at most
BLOCK = 1 << 20             # bytes after which a block is closed
BLOCKS_PER_FILE = 32
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"     # fixed value
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))

CHUNKS = T.StructType([
    T.StructField("source_row", T.StringType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("last", T.BooleanType()), T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("so_far", T.StringType()),
    T.StructField("body", T.BinaryType()),
])


def base32(digest) -> str:
    return base64.b32encode(digest.digest()).decode("ascii")


def cuts(payload: memoryview, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of chunks of at most ``size`` bytes that end between characters."""
    start = 0
    while len(payload) - start > size:
        end = start + size
        while end > start + 1 and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield start, end
        start = end
    yield start, len(payload)


def _head(fields: list[tuple[str, str]], size: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {size}"]
    return "\r\n".join(lines).encode("ascii") + END


def segments(page_id, url, payload: memoryview, first, source_row: str, chunk: int = CHUNK) -> Iterator[bytes]:
    """The segments of one record, each a whole WARC record without its end mark."""
    whole = hashlib.sha1()
    for a, b in cuts(payload, chunk):
        whole.update(payload[a:b])
    digest = base32(whole)
    name = lambda i: f"<urn:page:{'-' if i is None else i}:{digest}>"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}").encode("ascii") + END
    common = [("WARC-Date", DATE), ("X-Source-Row", source_row)]
    if url is not None:
        common.append(("WARC-Target-URI", quote(url, safe=PRINTABLE)))
    about = common + [("WARC-Payload-Digest", f"sha1:{digest}")]
    kind = ("Content-Type", "application/http; msgtype=response")
    if first is not None:
        yield _head([("WARC-Type", "revisit"), ("WARC-Record-ID", name(page_id)), *about, ("WARC-Profile", PROFILE),
                     ("WARC-Refers-To", name(first)), kind], len(http)) + http
        return
    running = hashlib.sha1()
    for k, (a, b) in enumerate(cuts(payload, chunk), 1):
        running.update(payload[a:b])
        fields = [("X-Payload-So-Far", f"sha1:{base32(running)}")]
        if k > 1 or b < len(payload):
            fields.append(("WARC-Segment-Number", str(k)))
        if k > 1:
            fields += [("WARC-Segment-Origin-ID", name(page_id))]
            if b == len(payload):
                fields.append(("WARC-Segment-Total-Length", str(len(http) + len(payload))))
            yield _head([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name(page_id)[:-1]}:{k}>"),
                         *about, *fields], b - a) + payload[a:b]
        else:
            yield _head([("WARC-Type", "response"), ("WARC-Record-ID", name(page_id)), *about, *fields, kind],
                        len(http) + b) + http + payload[:b]


def first_of_copies(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(payload_key, first, n) of payloads of at least ``min_bytes`` that stand in several rows."""
    body = pages.select(F.col("page_id").cast("long").alias("page_id"), text_bytes("html").alias("body"))
    return body.where(F.octet_length("body") >= min_bytes).groupBy(F.sha2("body", 256).alias("payload_key")) \
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, chunk: int = CHUNK, block: int = BLOCK,
               blocks_per_file: int = BLOCKS_PER_FILE) -> None:
    """Archive every page under ``path``.

    Of rows with equal payloads of at least ``min_bytes`` the smallest page_id
    is the response that the others revisit.
    """
    ship_package(pages.sparkSession)
    copies = stage(first_of_copies(pages, min_bytes), "warc-copies")
    body = text_bytes("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("body"),
                        F.when(F.octet_length(body) >= min_bytes, F.sha2(body, 256)).alias("payload_key"))
    known = attach_groups(rows, copies, "payload_key", "n")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    todo = known.select("page_id", "url", "body", F.when(revisits, F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], names=["value"])

        for batch in batches:
            ids, urls, firsts = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i in range(batch.num_rows):
                payload = memoryview(batch.column(2)[i].as_buffer())
                for s in segments(ids[i], urls[i], payload, firsts[i], f"{part}-{at}", chunk):
                    held.append(s)
                    size += len(s)
                    if size >= block:
                        yield close()
                        held, size = [], 0
                at += 1
        if held:
            yield close()

    todo.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", END.decode("ascii")).option("maxRecordsPerFile", blocks_per_file).text(path)


def parse(data: memoryview | bytes) -> Iterator[tuple[dict, dict, memoryview]]:
    """(WARC header, HTTP header, payload part) of every record in a file."""
    whole, view, at = bytes(data) if not isinstance(data, bytes) else data, memoryview(data), 0

    def fields(start: int, end: int) -> dict:
        lines = whole[start:end].decode("utf-8").split("\r\n")[1:]
        return dict(x.split(": ", 1) for x in lines)

    while at < len(whole):
        stop = whole.find(END, at)
        if stop < 0 or whole[at:at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        head = fields(at, stop)
        start = stop + len(END)
        end = start + int(head["Content-Length"])
        if whole[end:end + len(END)] != END:
            raise ValueError(f"record at byte {at} is cut short")
        http: dict = {}
        if head["WARC-Type"] != "continuation":
            stop = whole.index(END, start, end)
            http = fields(start, stop)
            start = stop + len(END)
        yield head, http, view[start:end]
        at = end + len(END)


def _page(name: str) -> int | None:
    """page_id of a record's name."""
    text = name.split(":")[2]
    return None if text == "-" else int(text)


def _sha1(value: str) -> str:
    return value.removeprefix("sha1:")


def read_chunks(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """The chunk table of the archives under ``path`` (CHUNKS).

    Without ``bodies``, a record that lies in one file comes as a single row
    whose chunks were verified; only records that run over the end of a file
    still come chunk by chunk with their bytes.
    """
    ship_package(spark)
    names = CHUNKS.fieldNames()

    def rows_of_file(data: bytes) -> Iterator[tuple]:
        group: list[tuple] = []         # chunks so far of a record of several
        running = None                  # its digest, if its first chunk is in this file
        for head, http, part in parse(data):
            kind, k = head["WARC-Type"], int(head.get("WARC-Segment-Number", 1))
            origin = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
            more = "WARC-Segment-Number" in head and "WARC-Segment-Total-Length" not in head
            if k == 1:
                yield from group
                group, running = [], hashlib.sha1()
            if running is not None:
                running.update(part)
                if "X-Payload-So-Far" in head and base32(running) != _sha1(head["X-Payload-So-Far"]):
                    raise ValueError(f"chunk {k} of {origin} does not match its digest")
            row = (head["X-Source-Row"], k, not more, _page(origin), head.get("WARC-Target-URI"),
                   "revisit" if kind == "revisit" else "response",
                   _page(head["WARC-Refers-To"]) if kind == "revisit" else None,
                   int(http["Content-Length"]) if http else None, _sha1(head["WARC-Payload-Digest"]),
                   _sha1(head.get("X-Payload-So-Far", "")) or None, bytes(part))
            if running is not None and not more and kind != "revisit" \
                    and base32(running) != _sha1(head["WARC-Payload-Digest"]):
                raise ValueError(f"payload of {origin} does not match its digest")
            if bodies or running is None:
                yield row
            elif more:
                group.append(row)
            else:
                first = group[0] if group else row
                yield (first[0], None, True, *first[3:9], None, None)
                group = []
        yield from group

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(),
                 pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out, size = [], 0
                for row in rows_of_file(batch.column(0)[i].as_py()):
                    out.append(row)
                    size += 256 + len(row[-1] or b"")
                    if size >= BLOCK:
                        yield batch_of(out)
                        out, size = [], 0
                if out:
                    yield batch_of(out)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, CHUNKS)


def join_chunks(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table, its payload verified chunk by chunk."""
    ship_package(chunks.sparkSession)
    schema = T.StructType(CHUNKS.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, running, after = None, None, 0
        for batch in batches:
            out = []
            for i, row in enumerate(batch.drop_columns(["body"]).to_pylist()):
                if row["chunk"] == 1:
                    held, running, after = row, hashlib.sha1(), 0
                if held is None or row["chunk"] != after + 1 or row["source_row"] != held["source_row"]:
                    raise ValueError(f"chunk {row['chunk']} of row {row['source_row']} has no chunk before it")
                running.update(memoryview(batch.column("body")[i].as_buffer()))
                after += 1
                if base32(running) != row["so_far"]:
                    raise ValueError(f"chunk {after} of row {row['source_row']} does not match its digest")
                if row["last"]:
                    if base32(running) != held["payload_digest"]:
                        raise ValueError(f"payload of row {row['source_row']} does not match its digest")
                    out.append({**held, "chunk": None, "last": True, "so_far": None})
                    held = None
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [pa.field(f.name, {"string": pa.string(), "integer": pa.int32(), "boolean": pa.bool_(),
                                   "long": pa.int64()}[f.dataType.typeName()]) for f in schema.fields]))
        if held is not None:
            raise ValueError(f"row {held['source_row']} lacks its last chunk")

    return chunks.repartition("source_row").sortWithinPartitions("source_row", "chunk").mapInArrow(run, schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page, digests verified."""
    read = stage(read_chunks(spark, path, bodies=False), "warc-read")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return read.where("chunk IS NULL").select(*columns).unionByName(
        join_chunks(read.where("chunk IS NOT NULL")).select(*columns))
