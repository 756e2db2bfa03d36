"""Document fingerprints from prefix polynomial hashes.

The code points of a text are the digits of a number in base b modulo a prime. With the hashes of
all prefixes at hand, the hash of any span is a difference, so two spans are compared in constant
time and the longest common extension of two positions is found by binary search. Two bases give
62 bits.

A fingerprint holds the length and hash of the whole text, a ladder of prefix and of suffix hashes
at lengths that are the same for all texts, and the smallest hashes of its spans of GRAM code
points. The likeness of two fingerprints is the larger of two shares: what their ladders, searched
binarily, show as common beginning and end, and what their smallest hashes show as common spans.

Cases: null and empty texts have the fingerprint of the empty text; two empty texts have likeness
1, an empty and another one 0. Equal texts have equal fingerprints. The next document follows by
id, nulls first, rows of one id by a hash of their text; the last is followed by the first.
Repeated rows are fingerprinted each; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import HASH, mix, slices, stored

PRIME = (1 << 31) - 1
BASES = (1_000_003, 776_531_401)
GRAM = 12
SMALLEST = 32
#: Lengths of the ladders: growing by a quarter, up to 2^30.
LADDER = np.unique(np.floor(1.25 ** np.arange(94)).astype(np.int64))
_P = HASH(PRIME)


def _reduce(x: np.ndarray) -> np.ndarray:
    """Modulo 2^31 - 1, for values below 2^62."""
    x = (x & _P) + (x >> HASH(31))
    return np.where(x >= _P, x - _P, x)


class _Powers:
    """Powers of a base and of its inverse, grown as texts need them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up, self.down = np.ones(1, HASH), np.ones(1, HASH)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, _reduce(self.up * HASH(pow(self.base, size, PRIME)))])
            self.down = np.concatenate([self.down, _reduce(self.down * HASH(pow(self.inverse, size, PRIME)))])
        return self.up[:n], self.down[:n]


_POWERS = tuple(_Powers(b) for b in BASES)


class PrefixHash:
    """Prefix hashes of a text, in code points."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(HASH) + HASH(1)
        self.size = len(points)
        self.sums = []
        for powers in _POWERS:
            up, _ = powers.upto(self.size + 1)
            total = np.zeros(self.size + 1, HASH)
            np.cumsum(_reduce(points * up[:-1]), out=total[1:])  # below 2^33 texts of 2^31 each
            self.sums.append(_reduce(total))

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """62-bit hashes of many spans; equal spans have equal hashes wherever they lie."""
        parts = []
        for powers, total in zip(_POWERS, self.sums, strict=True):
            _, down = powers.upto(self.size + 1)
            parts.append(_reduce(_reduce(total[stop] + _P - total[start]) * down[start]))
        return (parts[0] << HASH(31)) | parts[1]

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of a width."""
        count = self.size - width + 1
        if count <= 0:
            return np.zeros(0, HASH)
        parts = []
        for powers, total in zip(_POWERS, self.sums, strict=True):
            _, down = powers.upto(self.size + 1)
            parts.append(_reduce(_reduce(total[width:] + _P - total[:count]) * down[:count]))
        return (parts[0] << HASH(31)) | parts[1]

    def span(self, start: int, stop: int) -> int:
        return int(self.spans(np.array([start]), np.array([stop]))[0])


def equal_spans(a: PrefixHash, i: int, b: PrefixHash, j: int, length: int) -> bool:
    """Whether ``length`` code points from i in a and from j in b are equal."""
    return i + length <= a.size and j + length <= b.size and a.span(i, i + length) == b.span(j, j + length)


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """The longest common extension from i in a and j in b, by binary search."""
    low, high = 0, min(a.size - i, b.size - j)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if equal_spans(a, i, b, j, middle) else (low, middle - 1)
    return low


def _smallest(values: np.ndarray) -> np.ndarray:
    """The SMALLEST distinct values."""
    take = SMALLEST * 4
    while take < len(values):
        some = np.unique(np.partition(values, take)[:take])
        if len(some) >= SMALLEST:
            return some[:SMALLEST]
        take *= 4
    return np.unique(values)[:SMALLEST]


def fingerprint(text: str | None) -> str:
    """length, hash, prefix ladder, suffix ladder, smallest span hashes; all in hexadecimal."""
    prefixes = PrefixHash(text or "")
    n = prefixes.size
    steps = LADDER[LADDER <= n]
    zero = np.zeros(len(steps), np.int64)
    ladders = [mix(prefixes.spans(zero, steps)), mix(prefixes.spans(n - steps, zero + n))]
    least = _smallest(mix(prefixes.windows(GRAM)))
    parts = [f"{n:x}", f"{int(mix(np.array([prefixes.span(0, n)], HASH))[0]):016x}"]
    parts += ["".join(f"{v:04x}" for v in (ladder >> HASH(48)).tolist()) for ladder in ladders]
    parts.append("".join(f"{v:010x}" for v in (least >> HASH(24)).tolist()))
    return ":".join(parts)


def _rungs(a: str, b: str) -> int:
    """How many leading rungs of two ladders agree. Equal beginnings give equal rungs, so the
    first difference is found by binary search."""
    low, high = 0, min(len(a), len(b)) // 4
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:4 * middle] == b[:4 * middle] else (low, middle - 1)
    return low


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if one == other:
        return 1.0
    a, b = one.split(":"), other.split(":")
    n, m = int(a[0], 16), int(b[0], 16)
    if not n or not m:
        return 0.0
    reach = [int(LADDER[k - 1]) if (k := _rungs(x, y)) else 0 for x, y in ((a[2], b[2]), (a[3], b[3]))]
    ends = min(sum(reach), n, m) / max(n, m)
    x, y = ({part[k:k + 10] for k in range(0, len(part), 10)} for part in (a[4], b[4]))
    least = sorted(x | y)[:SMALLEST]
    common = sum(v in x and v in y for v in least) / len(least) if least else 0.0
    return min(max(ends, 2 * common / (1 + common)), 1.0)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc_id: int | None, text: str, own: str, following: str, next_one: str) -> tuple:
    """The result row of a document; ``own`` and ``next_one`` are the fingerprints."""
    changed = edited(text, following)
    print_ = fingerprint(changed)
    return doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, print_, likeness(own, print_), likeness(own, next_one)


def _batch(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of
    every document.

    A range partitioning puts documents in order, and within a partition each sees the next. The
    first and the last text of a partition are written beside the results; last texts are then
    joined with the first one of the next partition.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]  # rows of one id may be split
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = _OUT + ", part int, first string, last string"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            data = pa.array([compressor.compress(t.encode()) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data, batch.column(2)], names=["doc_id", "data", "hash"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        decompressor = zstandard.ZstdDecompressor()

        part = TaskContext.get().partitionId()
        kinds = [*_KINDS, pa.int32(), pa.string(), pa.string()]
        before: tuple | None = None  # id, text, fingerprint, text if it is the first
        for batch in slices(batches, most_bytes=2 << 20):
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = decompressor.decompress(data).decode() if data else ""
                own_ = fingerprint(text)
                if before is not None:
                    rows.append((*_row(before[0], before[1], before[2], text, own_), part, before[3], None))
                before = (doc_id, text, own_, text if before is None else None)
            yield _batch(rows, schema, kinds)
        if before is not None:
            yield _batch([(before[0], *[None] * 6, part, before[3], before[1])], schema, kinds)

    # texts are shuffled compressed
    packed = own.select("doc_id", "text", F.xxhash64("text").alias("hash")).mapInArrow(pack, "doc_id bigint, data binary, hash bigint")
    made = stored(packed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(work, schema), "ordered")

    # a row per partition: the partition that follows among those with rows, the first after the last
    present = [r["part"] for r in made.where("last is not null").select("part").collect()]
    numbers = sorted(present)
    after = spark.createDataFrame([(a, b) for a, b in zip(numbers, [*numbers[1:], *numbers[:1]], strict=True)], "part int, next_part int")
    heads = made.where("first is not null").select(F.col("part").alias("next_part"), F.col("first").alias("head"))
    edges = made.where("last is not null").join(after, "part").join(heads, "next_part").select("doc_id", "last", "head")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(d, text, fingerprint(text), head, fingerprint(head)) for d, text, head in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield _batch(rows, _OUT, _KINDS)

    inner = made.where("last is null").drop("part", "first", "last")
    return inner.union(edges.mapInArrow(close, _OUT))
