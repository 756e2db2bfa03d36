"""WARC archives as seekable Zstandard bundles.

Records are written in groups, each an independent Zstandard frame, one bundle per task. A footer
frame, which ordinary decoders skip, holds a seek table: the compressed and the decompressed size
of each frame. An index maps record ids to bundle, frame and the offset within the frame, so one
record is read by decompressing one frame.

Payloads of at least REVISIT_BYTES that occur in several records are stored once, in the response
with the largest page id; the others are revisits that refer to it.

Cases: null html is an empty payload; a null url is empty, line breaks in it are dropped. Rows with
a null id get a record without one, are always responses and refer to nothing; of repeated rows of
an id each gets a record. Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips.llm.common import shared_path, slices, stored

REVISIT_BYTES = 1000
#: A frame is closed when it holds this many bytes, a bundle when it has this many compressed.
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 64 << 20, 3
#: Fixed values of the seekable format: magic numbers of skippable frames and of the footer.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
WHEN = "2024-01-01T00:00:00Z"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer: (compressed, decompressed) size of each frame."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, FOOTER)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int]]:
    """(offset in the file, compressed size) of each frame, from the footer alone."""
    size = file.size()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != FOOTER:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * width)
    body, out, at = file.read(count * width), [], 0
    for k in range(count):
        (length,) = struct.unpack_from("<I", body, k * width)
        out.append((at, length))
        at += length
    return out


def record(page_id: int | None, url: str | None, kind: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has no payload, but the digest and size of the one it refers to."""
    name = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {WHEN}",
             f"WARC-Target-URI: {(url or '').translate({13: None, 10: None})}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers in lower case, payload, where the next record starts) of the record at a place."""
    end = data.index(b"\r\n\r\n", at)
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in data[at:end].decode().split("\r\n")[1:])
    headers = {k.lower(): v for k, v in headers.items()}
    start = end + 4
    stop = start + int(headers["content-length"])
    return headers, data[start:stop], stop + 4


def page_of(name: str | None) -> int | None:
    """The page id in a record id."""
    return int(name[10:-1]) if name and name.startswith("<urn:page:") else None


def open_file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of an address in the shared folder."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, size, refers_to (null for responses)."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("size", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # ids and digests move, not pages; equal payloads are combined in the map tasks
    large = own.where((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    groups = large.groupBy("digest").agg(F.max("page_id").alias("target"), F.min("page_id").alias("least")).where("target <> least")
    revisits = large.join(groups, "digest").where("page_id <> target").select("page_id", "digest", F.col("target").alias("refers_to")).distinct()
    return own.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "size", "refers_to")


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns their index: page_id, bundle, frame, offset (within the
    frame), length. Bundles of attempts that failed are in no index."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_file_system(folder)
        fs.create_dir(base, recursive=True)
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        out, name = None, ""
        frames: list[tuple[int, int]] = []
        held: list[bytes] = []
        size = written = 0
        index: list[tuple] = []

        def flush() -> None:
            nonlocal out, name, frames, held, size, written
            if out is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            packed = compressor.compress(b"".join(held))
            out.write(packed)
            frames.append((len(packed), size))
            written += len(packed)
            held, size = [], 0

        def finish() -> None:
            nonlocal out, frames, written
            if out is not None:
                out.write(seek_table(frames))
                out.close()
            out, frames, written = None, [], 0

        def indexed() -> pa.RecordBatch:
            columns = list(zip(*index, strict=True)) if index else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "bundle", "frame", "offset", "length"])

        for batch in slices(batches, text=2):
            for page_id, url, html, digest, length, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(page_id, url, "response" if refers_to is None else "revisit", html.encode() if refers_to is None else b"", digest, length, refers_to)
                held.append(data)
                index.append((page_id, None, len(frames), size, len(data)))
                size += len(data)
                if size >= FRAME_BYTES:
                    flush()
                    if written >= BUNDLE_BYTES:
                        index = [(p, b or name, *rest) for p, b, *rest in index]
                        finish()
                        yield indexed()
                        index = []
        if held:
            flush()
        if out is not None:
            index = [(p, b or name, *rest) for p, b, *rest in index]
            finish()
            yield indexed()

    return stored(_planned(pages).mapInArrow(work, "page_id bigint, bundle string, frame int, offset bigint, length bigint"), "warc-index")


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """All records of the bundles named in the index, read frame by frame: page_id, url,
    payload_bytes, payload_digest, record_type, refers_to, stored (the digest of the payload as
    read agrees; null for revisits)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_file_system(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "stored"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                with fs.open_input_file(f"{base}/{bundle}") as file:
                    for offset, length in read_seek_table(file):
                        file.seek(offset)
                        data = zstandard.ZstdDecompressor().decompress(file.read(length))
                        rows, at = [], 0
                        while at < len(data):
                            headers, payload, at = parse(data, at)
                            digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                            whole = kind == "response"
                            rows.append((page_of(headers["warc-record-id"]), headers["warc-target-uri"],
                                         len(payload) if whole else int(headers["warc-payload-length"]), hashlib.sha1(payload).hexdigest() if whole else digest,
                                         kind, page_of(headers.get("warc-refers-to")), hashlib.sha1(payload).hexdigest() == digest if whole else None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    bundles = index.select("bundle").distinct().repartition("bundle")
    return bundles.mapInArrow(work, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, stored boolean")


def read_record(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record, by its place in the index: decompresses one frame."""
    fs, base = open_file_system(folder)
    with fs.open_input_file(f"{base}/{bundle}") as file:
        at, length = read_seek_table(file)[frame]
        file.seek(at)
        headers, payload, _ = parse(zstandard.ZstdDecompressor().decompress(file.read(length)), offset)
    return headers, payload


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives of the pages into the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    return read_bundles(spark, folder, write_bundles(pages, folder))
