"""WARC archives as seekable Zstandard bundles.

`archive` writes one WARC record per page. Records are put together into frames of about
`frame_bytes`, each compressed on its own; a bundle is a file of such frames with the seek table of
the seekable Zstandard format as its footer, so any Zstandard reader can decompress it and a reader
that knows the footer can jump to a frame. The index maps each record to its bundle, the frame's
offset in the file, and the record's offset within the decompressed frame. `records` reads whole
archives back by their footers; `fetch` gets single records, decompressing only their frames.

Of records with equal payloads of at least `least` bytes, that with the smallest page_id is a
response; the others are revisits, which hold its id and the digest but no payload. Only
(digest, page_id) pairs are shuffled to find it, added up within each task first, so a payload that
a third of all pages share costs one row per task. Pages stay where they are read.

Losses: each attempt of a task writes files of its own name, and the index, which Spark commits
once per task, names those that count. Files of lost attempts stay unread in the folder.

Odd input: a null html is an empty payload, a null url leaves the target out, and characters that
must not stand in a header are percent-encoded there. A null page_id is never the smallest; if all
ids of equal payloads are null, all are responses. Rows that share the smallest page_id of a payload
are all responses. No pages make an archive without bundles. Extra columns are not looked at.
A page, its record and its frame are held in memory at a time, so a payload may have 2 GB.
"""

from __future__ import annotations

import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirefunnel.llm.common import only

LEAST = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 128 << 20
# Repeated payloads (digest and id, about 100 bytes each) that are sent to every task.
BROADCAST_ROWS = 300_000
# Largest number of tasks that read bundles.
READ_TASKS = 10_000

# Fixed values of the seekable Zstandard format: the marks of a skippable frame and of its end.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

DATE = "2024-01-01T00:00:00Z"
_ADDRESS = "bundle string, frame long, frame_size long, start long, length long"
INDEX = f"page_id long, record_type string, refers_to long, payload_digest string, {_ADDRESS}"
META = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(f.name, kinds[f.dataType.typeName()]) for f in StructType.fromDDL(ddl)])


def payload(pages: DataFrame) -> DataFrame:
    """page_id, url, the payload as bytes, its size and digest."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return only(pages, "page_id", "url", "html").select(
        "page_id",
        F.col("url").cast("binary").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"),
    )


def first_pages(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """The smallest page_id of each payload that several pages have."""
    keyed = payload(pages).where(F.col("payload_bytes") >= least)
    found = keyed.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_page"), F.count("*").alias("n")
    )
    return found.where("n > 1 AND first_page IS NOT NULL").drop("n")


# --- writing -------------------------------------------------------------------------

def _uri(url: bytes) -> str:
    return urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~-._|^`{}\"\\<>")


def record(row: dict, date: str = DATE) -> bytes:
    """One WARC record: its header, and an HTTP response with the payload unless it is a revisit."""
    revisit = row["refers_to"] is not None
    body = b"" if revisit else row["payload"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{row['page_id']}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_uri(row['url'])}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:x-page:{row['refers_to']}>")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(http) + len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer: compressed and decompressed size of each frame, in a frame that readers skip."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    end = struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(end)) + entries + end


class _Bundle:
    """A file of frames that is being written."""

    def __init__(self, folder: str):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        files, path = pyarrow.fs.FileSystem.from_uri(folder)
        self.out = files.open_output_stream(f"{path}/{self.name}", compression=None)
        self.pack = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.size = 0

    def add(self, raw: bytes) -> tuple[int, int]:
        """Write one frame; its offset and compressed size."""
        packed = self.pack.compress(raw)
        self.out.write(packed)
        at, self.size = self.size, self.size + len(packed)
        self.frames.append((len(packed), len(raw)))
        return at, len(packed)

    def close(self) -> None:
        self.out.write(seek_table(self.frames))
        self.out.close()


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_bytes: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    bundle: _Bundle | None = None
    raw, held, size = [], [], 0

    def flushed() -> pa.RecordBatch:
        nonlocal bundle, raw, held, size
        bundle = bundle or _Bundle(folder)
        at, packed = bundle.add(b"".join(raw))
        for entry in held:
            entry.update(bundle=bundle.name, frame=at, frame_size=packed)
        done = pa.RecordBatch.from_pylist(held, schema)
        raw, held, size = [], [], 0
        if bundle.size >= bundle_bytes:
            bundle.close()
            bundle = None
        return done

    for batch in batches:
        # One row at a time, so that the batch is not held twice.
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            data = record(row)
            kind = "response" if row["refers_to"] is None else "revisit"
            held.append(
                {n: row[n] for n in ("page_id", "refers_to", "payload_digest")}
                | {"record_type": kind, "start": size, "length": len(data)}
            )
            raw.append(data)
            size += len(data)
            if size >= frame_bytes:
                yield flushed()
    if held:
        yield flushed()
    if bundle:
        bundle.close()


def archive(
    pages: DataFrame,
    folder: str,
    least: int = LEAST,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Write bundles and their index below a new folder that all executors share; the index."""
    spark = pages.sparkSession
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    first_pages(pages, least).write.parquet(f"{folder}/first")
    firsts = spark.read.schema("payload_digest string, first_page long").parquet(f"{folder}/first")
    if firsts.count() <= broadcast_rows:
        firsts = F.broadcast(firsts)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page"))
    rows = payload(pages).join(firsts, "payload_digest", "left")
    rows = rows.withColumn("refers_to", refers).drop("first_page")
    schema = _arrow(INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write(batches, folder, frame_bytes, bundle_bytes, schema)

    rows.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return index(spark, folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


# --- reading -------------------------------------------------------------------------

def frames_of(file) -> list[tuple[int, int]]:
    """Offset and compressed size of each frame, by the footer of an open bundle."""
    size = file.size()
    n, _, mark = struct.unpack("<IBI", file.read_at(9, size - 9))
    if mark != SEEKABLE:
        raise ValueError("not a seekable bundle")
    at, found = 0, []
    table = file.read_at(8 * n, size - 9 - 8 * n)
    for packed, _ in struct.iter_unpack("<II", table):
        found.append((at, packed))
        at += packed
    return found


def parsed(raw: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """Header fields, payload and end of the record that begins at an offset of a frame."""
    body = raw.index(b"\r\n\r\n", at) + 4
    lines = raw[at : body - 4].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    end = body + int(fields["Content-Length"])
    http = raw.index(b"\r\n\r\n", body) + 4
    fields["payload_bytes"] = raw[body : http - 4].rsplit(b": ", 1)[1].decode()
    return fields, raw[http:end], end + 4


def _number(urn: str | None) -> int | None:
    text = urn[len("<urn:x-page:") : -1] if urn else "None"
    return None if text == "None" else int(text)


def _row(fields: dict, data: bytes) -> dict:
    """A record's columns; the digest of a payload that is here is computed anew and compared."""
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(fields["payload_bytes"])
    if kind == "response" and (hashlib.sha256(data).hexdigest() != digest or len(data) != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": _number(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _number(fields.get("WARC-Refers-To")),
    }


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive, read from its bundles frame by frame, payloads checked."""
    bundles = index(spark, folder).select("bundle").distinct()
    tasks = max(1, min(READ_TASKS, bundles.count()))
    schema = _arrow(META)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.open_input_file(f"{path}/{name}") as file:
                    for at, size in frames_of(file):
                        raw, rows, begin = unpack.decompress(file.read_at(size, at)), [], 0
                        while begin < len(raw):
                            fields, data, begin = parsed(raw, begin)
                            rows.append(_row(fields, data))
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return bundles.repartition(tasks).mapInArrow(read, META)


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """page_id and payload of the records with these ids (`page_id`), each frame read once.

    A revisit is answered with the payload of the response it refers to. An id without a record
    has no row; an id of several records has one row for each.
    """
    entries = index(spark, folder)
    address = F.struct("bundle", "frame", "frame_size", "start", "length")
    kept = entries.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("holder"), "payload_digest"
    )
    places = kept.agg(F.min(address).alias("place"))
    found = entries.join(wanted.select("page_id").distinct(), "page_id", "left_semi").select(
        "page_id", "payload_digest", _holder().alias("holder")
    )
    asked = found.join(places, ["holder", "payload_digest"]).select("page_id", "place.*")
    # One task per bundle at most reads a frame, once for all its records.
    asked = asked.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        last, raw = None, b""
        for batch in batches:
            ids, data = [], []
            for row in batch.to_pylist():
                here = row["bundle"], row["frame"]
                if here != last:
                    with files.open_input_file(f"{path}/{row['bundle']}") as file:
                        raw, last = unpack.decompress(file.read_at(row["frame_size"], row["frame"])), here
                ids.append(row["page_id"])
                data.append(parsed(raw, row["start"])[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(data, pa.binary())], ["page_id", "payload"]
            )

    return asked.mapInArrow(read, "page_id long, payload binary")


def _holder() -> Column:
    return F.when(F.col("record_type") == "revisit", F.col("refers_to")).otherwise(F.col("page_id"))
