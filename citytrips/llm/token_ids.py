"""Raw token ids in shards, with a minimal perfect hash index over the document keys.

A shard holds the ids of documents in ascending key order as little-endian unsigned integers, of
16 bits if all its ids fit and else of 32, followed by the bounds of its documents. The index is dealt into buckets by a hash of
the key. A bucket's minimal perfect hash gives every key of the bucket a slot of its own: a level
of bits keeps the keys that hash to a place alone and passes the others on to the next level, and
the number of bits before a key's bit is its slot. A slot holds a fingerprint of the key, which
turns foreign keys away, and where the key's documents lie: shard, first document, documents. A
lookup reads a few bits and one slot, whatever the number of documents.

Cases: null text is empty and has its end mark alone. Rows with a null key come first and are found
under the key null. Repeated rows of a key are documents of their own, ordered by a hash of their text; a key
with very many rows spreads over shards and has one entry a shard. Further columns are ignored;
an empty table makes no shard and no row.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citytrips.llm.common import HASH, mix, shared_path, slices, stored
from citytrips.llm.packing import encode, load_encoding
from citytrips.llm.warc import open_file_system

END = 2
MAGIC = b"TOKENID1"
#: A shard is closed when it holds this many ids; a bucket of the index has about this many entries.
SHARD_IDS, BUCKET_KEYS = 8 << 20, 1 << 20
#: Bits for each key that a level still has to place.
GAMMA = 2
#: Ids that are read from a shard at once, about.
READ_IDS = 1 << 20
_SLOT_SEED, _FINGERPRINT_SEED = 100, 99


class PerfectHash(NamedTuple):
    """Bits of the levels one after the other, where each level starts (in words), and the number
    of bits set before each word."""

    words: np.ndarray
    starts: np.ndarray
    before: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For different keys (unsigned, 64 bits)."""
        levels: list[np.ndarray] = []
        left = keys
        while len(left):
            size = -(-GAMMA * len(left) // 64) * 64
            at = (mix(left, _SLOT_SEED + len(levels)) % HASH(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = left[~alone]
        words = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        starts = np.cumsum([0, *map(len, levels)])
        count = np.bitwise_count(words).astype(np.int64)
        return cls(words, starts, np.cumsum(count) - count)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for a key that was not there at building."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (a, b) in enumerate(zip(self.starts[:-1], self.starts[1:], strict=True)):
            if not len(left):
                break
            at = (mix(keys[left], _SLOT_SEED + level) % HASH((b - a) * 64)).astype(np.int64)
            word, bit = a + (at >> 6), (at & 63).astype(HASH)
            found = (self.words[word] >> bit & HASH(1)).astype(bool)
            word, bit = word[found], bit[found]
            out[left[found]] = self.before[word] + np.bitwise_count(self.words[word] & ((HASH(1) << bit) - HASH(1)))
            left = left[~found]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key that are independent of its places."""
    return (mix(keys, _FINGERPRINT_SEED) >> HASH(32)).astype("<u4")


_ARRAYS = (("words", "<u8"), ("starts", "<i8"), ("before", "<i8"), ("marks", "<u4"), ("first", "<i8"), ("shard", "<i4"), ("document", "<i8"), ("documents", "<i8"))


class Bucket:
    """The index of some keys: entries (shard, first document, documents) by key."""

    def __init__(self, arrays: dict[str, np.ndarray], names: list[str]):
        self.arrays, self.names = arrays, names
        self.hash = PerfectHash(arrays["words"], arrays["starts"], arrays["before"])

    @classmethod
    def build(cls, keys: list[int | None], shards: list[str], document: list[int], documents: list[int]) -> Bucket:
        missing = np.array([k is None for k in keys], bool)
        key = np.array([0 if k is None else k for k in keys], np.int64).view(HASH)
        names, shard = np.unique(np.array(shards, object).astype(str), return_inverse=True) if shards else (np.zeros(0, str), np.zeros(0, np.int64))
        own = np.unique(key[~missing])
        index = PerfectHash.build(own)
        slot = np.where(missing, len(own), 0)  # the entries of the null key follow those of all slots
        slot[~missing] = index.slots(key[~missing])
        marks = np.zeros(len(own), "<u4")
        marks[index.slots(own)] = fingerprints(own)
        order = np.lexsort((np.array(document, np.int64), shard, slot))
        first = np.searchsorted(slot[order], np.arange(len(own) + 2))
        return cls({"words": index.words, "starts": index.starts, "before": index.before, "marks": marks, "first": first, "shard": shard[order],
                    "document": np.array(document, np.int64)[order], "documents": np.array(documents, np.int64)[order]}, names.tolist())

    def find(self, keys: list[int | None]) -> Iterator[tuple[int | None, str, int, int]]:
        """(key, shard, first document, documents) of every entry of the keys that are known."""
        a = self.arrays
        missing = np.array([k is None for k in keys], bool)
        key = np.array([0 if k is None else k for k in keys], np.int64).view(HASH)
        slot = np.where(missing, len(a["marks"]), self.hash.slots(key))
        known = missing | (slot >= 0)
        at = np.flatnonzero(known & ~missing)
        known[at] = a["marks"][slot[at]] == fingerprints(key[at])
        for k in np.flatnonzero(known):
            for e in range(a["first"][slot[k]], a["first"][slot[k] + 1]):
                yield keys[k], self.names[a["shard"][e]], int(a["document"][e]), int(a["documents"][e])

    def dump(self) -> bytes:
        out = io.BytesIO()
        names = "\n".join(self.names).encode()
        out.write(MAGIC + struct.pack("<9Q", len(names), *(len(self.arrays[n]) for n, _ in _ARRAYS)) + names)
        for name, kind in _ARRAYS:
            out.write(self.arrays[name].astype(kind).tobytes())
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Bucket:
        if data[:8] != MAGIC:
            raise ValueError("not an index of token ids")
        length, *sizes = struct.unpack_from("<9Q", data, 8)
        at = 8 + 72 + length
        names = data[80:at].decode()
        arrays = {}
        for (name, kind), size in zip(_ARRAYS, sizes, strict=True):
            arrays[name] = np.frombuffer(data, kind, size, at)
            at += arrays[name].nbytes
        return cls(arrays, names.split("\n") if names else [])


class Shard:
    """A file of ids, opened for reading: bounds are read at once, ids as they are asked for."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        self.count, self.width, magic = struct.unpack("<QQ8s", file.read_at(24, size - 24))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.bounds = np.frombuffer(file.read_at(8 * (self.count + 1), size - 24 - 8 * (self.count + 1)), "<i8")

    def documents(self, first: int, count: int) -> Iterator[tuple[int, np.ndarray]]:
        """(ids before it in the shard, ids) of documents that follow each other."""
        at, last = first, first + count
        while at < last:
            stop = max(at + 1, min(last, int(np.searchsorted(self.bounds, self.bounds[at] + READ_IDS, "right")) - 1))
            a, b = int(self.bounds[at]), int(self.bounds[stop])
            block = np.frombuffer(self.file.read_at(self.width * (b - a), 8 + self.width * a), f"<u{self.width}").astype("<u4")
            for k in range(at, stop):
                yield int(self.bounds[k]), block[self.bounds[k] - a:self.bounds[k + 1] - a]
            at = stop


_ENTRIES = "part int, seq int, shard string, key bigint, document bigint, documents bigint, ids bigint"


def write_shards(docs: DataFrame, folder: str, ids_of: Callable[[str], np.ndarray], end: int = END) -> DataFrame:
    """Writes the ids of all documents, with the end mark, in ascending order of keys. Returns the
    entries: part, seq (shards in order of these two), shard (file), key, document (the first one of
    the key in the shard), documents, ids (of them). Shards of attempts that failed have no entry."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, base = open_file_system(folder)
        fs.create_dir(base, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0
        bounds, width = [0], 2
        held: list[np.ndarray] = []
        entries: list[list] = []

        def finish() -> pa.RecordBatch:
            nonlocal bounds, width, entries, seq
            name = f"{uuid.uuid4().hex}.ids"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(MAGIC)
                for ids in held:
                    out.write(ids.astype(f"<u{width}").tobytes())
                out.write(np.array(bounds, "<i8").tobytes() + struct.pack("<QQ8s", len(bounds) - 1, width, MAGIC))
            kinds = [pa.int64()] * 4
            n = len(entries)
            columns = [pa.array(c, k) for c, k in zip(zip(*entries, strict=True), kinds, strict=True)]
            batch = pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array([name] * n), *columns],
                                               names=["part", "seq", "shard", "key", "document", "documents", "ids"])
            held.clear()
            bounds, width, entries = [0], 2, []
            seq += 1
            return batch

        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(ids_of(text), np.array([end], "<u4")).astype("<u4")
                if ids.max() >= 1 << 16:
                    width = 4
                held.append(ids.astype(f"<u{width}"))
                if entries and entries[-1][0] == key:
                    entries[-1][2] += 1
                    entries[-1][3] += len(ids)
                else:
                    entries.append([key, len(bounds) - 1, 1, len(ids)])
                bounds.append(bounds[-1] + len(ids))
                if bounds[-1] >= SHARD_IDS:
                    yield finish()
        if held:
            yield finish()

    own = docs.select(F.col("doc_id").cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    # ranges of (key, hash, row): a key with very many rows is split, whatever their texts are
    own = own.select("key", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("key").asc_nulls_first(), F.col("h"), F.col("row")]
    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.select("key", "text").mapInArrow(work, _ENTRIES), "ids-entries")


def write_index(entries: DataFrame, folder: str) -> DataFrame:
    """Writes the index over the entries; returns bucket, buckets (of the whole index), file."""
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_file_system(folder)
        last, held = None, []

        def finish() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.mph"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(Bucket.build(*map(list, zip(*held, strict=True))).dump())
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([buckets], pa.int64()), pa.array([name])], names=["bucket", "buckets", "file"])

        for batch in batches:
            for bucket, *entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and bucket != last:
                    yield finish()
                    held = []
                last = bucket
                held.append(entry)
        if held:
            yield finish()

    dealt = entries.select(_bucket(buckets), "key", "shard", "document", "documents").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(work, "bucket bigint, buckets bigint, file string"), "ids-index")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")


def lookup(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """key, shard, document, documents of the different values of ``key``; unknown keys give no row."""
    buckets = index.select(F.max("buckets")).first()[0] or 1
    wanted = keys.select(F.col("key").cast("long").alias("key")).distinct()
    # empty buckets have no file, their keys are unknown; a file is loaded once by the task that has its keys
    dealt = wanted.select("key", _bucket(buckets)).join(index.drop("buckets"), "bucket").select("bucket", "file", "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_file_system(folder)
        name, bucket = None, None
        for batch in batches:
            files = np.array(batch.column(0).to_pylist(), object)
            cuts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)]
            found = batch.column(1).to_pylist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if files[a] != name:
                    name = files[a]
                    with fs.open_input_file(f"{base}/{name}") as file:
                        bucket = Bucket.load(file.read())
                rows = list(bucket.find(found[a:b]))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
                columns = zip(*rows, strict=True) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "shard", "document", "documents"])

    return dealt.repartition("bucket").sortWithinPartitions("bucket", "file").select("file", "key").mapInArrow(
        work, "key bigint, shard string, document bigint, documents bigint")


def read_documents(places: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """key, shard, at (ids before it in its shard), ids (little-endian unsigned 32-bit) of the
    documents at places found by ``lookup``. Every shard is opened by one of ``tasks`` tasks, which
    are not merged by the size of the places: the ids are what they read."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_file_system(folder)
        name, shard = None, None
        for batch in batches:
            for file, key, document, documents in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if shard is not None:
                        shard.file.close()
                    name, shard = file, Shard(fs.open_input_file(f"{base}/{file}"))
                held, size = [], 0
                for at, ids in shard.documents(document, documents):
                    held.append((key, file, at, ids.tobytes()))
                    size += len(ids)
                    if size >= READ_IDS:
                        yield _documents(held)
                        held, size = [], 0
                if held:
                    yield _documents(held)
        if shard is not None:
            shard.file.close()

    tasks = tasks or int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(tasks, "shard").sortWithinPartitions("shard", "document").select("shard", "key", "document", "documents").mapInArrow(
        work, "key bigint, shard string, at bigint, ids binary")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "shard", "at", "ids"])


def shard_starts(entries: DataFrame) -> DataFrame:
    """shard, first: the ids of all shards before it. One row a shard passes the window."""
    sizes = entries.groupBy("part", "seq", "shard").agg(F.sum("ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("shard", F.coalesce(before, F.lit(0)).alias("first"))


def archive(docs: DataFrame, folder: str, ids_of: Callable[[str], np.ndarray], end: int = END) -> tuple[DataFrame, DataFrame]:
    """Writes shards and index; returns the entries and the index's files."""
    entries = write_shards(docs, folder, ids_of, end)
    return entries, write_index(entries, folder)


def vocabulary(path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Ids of a text by a byte-level vocabulary, loaded once by each worker."""
    return lambda text: encode(load_encoding(path, pattern), text)


def round_trip(docs: DataFrame, ids_of: Callable[[str], np.ndarray], end: int = END) -> DataFrame:
    """Archives the documents, looks all their keys up and reads them back: doc_id, start (ids of all
    documents before), n_tokens, ids_crc32, shard."""
    spark: SparkSession = docs.sparkSession
    folder = shared_path(spark, "token-ids")
    entries, index = archive(docs, folder, ids_of, end)
    ids = entries.agg(F.sum("ids")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ids // (2 * SHARD_IDS))
    found = read_documents(lookup(docs.select(F.col("doc_id").alias("key")), index, folder), folder, tasks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                names=["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    read = found.mapInArrow(work, "doc_id bigint, shard string, at bigint, n_tokens bigint, ids_crc32 bigint")
    return read.join(shard_starts(entries), "shard").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard")
