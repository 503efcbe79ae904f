"""WARC archives as seekable Zstandard bundles (operator 4).

Every task writes one bundle into the shared folder: records are grouped into independent Zstandard frames of about
``frame_bytes``, and the file ends with the seek table of the public seekable format (a skippable frame that lists
the sizes of all frames), so any frame can be read and decompressed alone.  The manifest, a table, maps each record
identifier to file, frame number and offset within the decompressed frame.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is a response and the
others are revisits of it, without payload.  The repeated payloads are found by digest with a map-side combined
aggregate; pages are read again to be written and joined with the repeated digests only (broadcast if counted small,
else a shuffle join that the adaptive skew join can split).

File names carry the task attempt and the manifest is committed by Spark, so files of failed or repeated attempts are
never read.  Files are opened through ``pyarrow.fs`` by the folder's URI.

Cases: a null html is an empty payload; a null url has no target header; a null page_id is kept as such and never
the response of a group; of repeated rows with the largest page_id one is the response; every row is one record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C

FRAME_BYTES = 256 << 10
MIN_BYTES = 1000
LEVEL = 3
#: Magic numbers of the seekable Zstandard format (fixed values).
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
CRLF = b"\r\n"
MANIFEST = ("page_id long, record_id string, file string, frame int, record_offset long, record_bytes long")
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def filesystem(uri: str):
    """(filesystem, path) of a folder or file URI, or of a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# -- records ---------------------------------------------------------------------------------------------------------

def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record: an HTTP response, or a revisit with the HTTP header only."""
    digest = b"sha1:" + base64.b32encode(hashlib.sha1(payload).digest())
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            b"WARC-Record-ID: <" + record_id(page_id).encode() + b">", b"WARC-Date: " + date.encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    head.append(b"WARC-Payload-Digest: " + digest)
    if revisit:
        head += [b"WARC-Refers-To: <" + record_id(refers_to).encode() + b">",
                 b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return CRLF.join(head) + CRLF + CRLF + block + CRLF + CRLF


def record_id(page_id) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _page(header: bytes):
    last = header.strip(b"<>").rpartition(b":")[2]
    return None if last == b"null" else int(last)


def _headers(data: bytes, at: int) -> tuple[dict[bytes, bytes], int]:
    end = data.index(CRLF + CRLF, at)
    lines = data[at:end].split(CRLF)
    return {k.lower(): v for k, _, v in (x.partition(b": ") for x in lines[1:])}, end + 4


def parse(data: bytes, at: int = 0) -> tuple[tuple, bytes, int]:
    """The record at ``at``: (page_id, payload bytes, digest, type, refers_to), payload, end of the record."""
    head, at = _headers(data, at)
    end = at + int(head[b"content-length"])
    http, body = _headers(data, at)
    payload = data[body:end]
    digest = base64.b32decode(head[b"warc-payload-digest"].partition(b":")[2]).hex()
    kind = head[b"warc-type"].decode()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload digest differs: {head[b'warc-record-id']!r}")
    refers = _page(head[b"warc-refers-to"]) if b"warc-refers-to" in head else None
    return ((_page(head[b"warc-record-id"]), int(http[b"content-length"]), digest, kind, refers), payload, end + 4)


# -- bundles ---------------------------------------------------------------------------------------------------------

class Bundle:
    """Writer of one seekable bundle: at most one frame is held in memory, besides eight bytes per frame."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.buffer, self.frames = io.BytesIO(), []

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset within the frame) of the record."""
        if self.buffer.tell() and self.buffer.tell() + len(data) > self.frame_bytes:
            self.flush()
        at = self.buffer.tell()
        self.buffer.write(data)
        return len(self.frames), at

    def flush(self) -> None:
        data = self.buffer.getvalue()
        if data:
            packed = self.zstd.compress(data)
            self.out.write(packed)
            self.frames.append((len(packed), len(data)))
        self.buffer = io.BytesIO()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + 9) + table
                       + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC))


def seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, bytes) of every frame, from the footer."""
    f.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * count)
    table, at = [], 0
    for packed, plain in struct.iter_unpack("<II", f.read(8 * count)):
        table.append((at, packed, plain))
        at += packed
    return table


def read_frame(f, offset: int, packed: int, plain: int) -> bytes:
    import zstandard

    f.seek(offset)
    return zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)


# -- jobs ------------------------------------------------------------------------------------------------------------

def typed(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html (binary), refers_to and revisit of every row."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    ids = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    repeated = C.small(C.written(
        ids.groupBy("digest").agg(F.max("page_id").alias("keep"), F.max_by("n", F.coalesce("page_id", F.lit(-1 << 63)))
                                  .alias("keep_rows"), F.sum("n").alias("n")).where("n > 1"), "warc-repeated"))
    out = rows.join(repeated, "digest", "left").withColumn(
        "revisit", F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep")))
    tied = F.coalesce(F.col("keep_rows"), F.lit(0)) > 1
    if not repeated.where(tied).isEmpty():  # rows that repeat the largest page_id: one of them stays
        pick = F.row_number().over(W.partitionBy("digest").orderBy("url")) > 1
        ties = tied & ~F.col("revisit")
        out = out.where(~ties).unionByName(out.where(ties).withColumn("revisit", pick))
    return out.select("page_id", "url", "html", F.when(F.col("revisit"), F.col("keep")).alias("refers_to"), "revisit")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES,
                   frame_bytes: int = FRAME_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all pages below ``folder`` (default: a new one in the shared folder); returns the written manifest."""
    folder = folder or C.scratch_path(pages.sparkSession, "warc")

    def write(batches):
        from pyspark import TaskContext

        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.warc.zst"
        out = bundle = None
        for batch in batches:
            rows = []
            for page_id, url, html, refers, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle is None:
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    bundle = Bundle(out, frame_bytes)
                data = record(page_id, url, html, refers, revisit, date)
                frame, at = bundle.add(data)
                rows.append((page_id, record_id(page_id), f"{folder}/{name}", frame, at, len(data)))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             [x.split()[0] for x in MANIFEST.split(", ")])
        if bundle is not None:
            bundle.close()
            out.close()

    return C.written(typed(pages, min_bytes).mapInArrow(write, MANIFEST), "warc-manifest")


def _frames(files: DataFrame) -> DataFrame:
    """(file, frame, offset, packed, plain) of every frame, from the files' seek tables."""
    def read(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = filesystem(file)
                with fs.open_input_file(path) as f:
                    table = seek_table(f, f.size())
                cols = list(zip(*table)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(table), pa.string()), pa.array(range(len(table)), pa.int32()),
                     *(pa.array(c, pa.int64()) for c in cols)], ["file", "frame", "offset", "packed", "plain"])

    return files.select("file").mapInArrow(read, "file string, frame int, offset long, packed long, plain long")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's files, frame by frame in parallel."""
    def read(batches):
        for batch in batches:
            for file, offset, packed, plain in zip(*(batch.column(k).to_pylist() for k in ("file", "offset", "packed", "plain"))):
                fs, path = filesystem(file)
                with fs.open_input_file(path) as f:
                    data = read_frame(f, offset, packed, plain)
                rows, at = [], 0
                while at < len(data):
                    row, _, at = parse(data, at)
                    rows.append(row)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 [x.split()[0] for x in RECORD.split(", ")])

    frames = _frames(manifest.select("file").distinct())
    return frames.repartition("file", "frame").mapInArrow(read, RECORD)


def fetch(manifest: DataFrame, page_ids: DataFrame) -> DataFrame:
    """Payloads of the wanted pages (page_id, record_type, refers_to, payload), reading only the frames that hold them."""
    wanted = manifest.join(page_ids.select("page_id").distinct(), "page_id").alias("m")
    frames = _frames(wanted.select("file").distinct()).alias("f")
    at = wanted.join(frames, (F.col("m.file") == F.col("f.file")) & (F.col("m.frame") == F.col("f.frame"))).groupBy(
        F.col("f.file").alias("file"), "offset", "packed", "plain").agg(F.collect_list("record_offset").alias("ats"))

    def read(batches):  # records of one frame: bounded by the frame's size
        for batch in batches:
            for file, offset, packed, plain, ats in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = filesystem(file)
                with fs.open_input_file(path) as f:
                    data = read_frame(f, offset, packed, plain)
                got = [parse(data, a) for a in ats]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0][0] for r in got], pa.int64()), pa.array([r[0][3] for r in got]),
                     pa.array([r[0][4] for r in got], pa.int64()), pa.array([r[1] for r in got], pa.binary())],
                    ["page_id", "record_type", "refers_to", "payload"])

    return at.mapInArrow(read, "page_id long, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return read_archives(write_archives(pages))
