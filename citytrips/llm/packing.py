"""Packing of documents into training sequences by lexical retrieval.

A document's ids fill whole sequences first; what is left over, a unit, is packed with units that
resemble it. Units are dealt into shards of similar units, each with an inverted index scored by
BM25 with document frequencies of the whole corpus. A seed unit opens a sequence; the unused
neighbours that the index returns for it fill the window, whole ones first. Where none fits, the
best neighbour is cut, and its rest is the next seed. What is left of a shard is split into
sequences whose lengths are powers of two, so no sequence needs padding.

Cases: null text is empty and is its end mark alone. Equal scores go to the earlier unit. Repeated rows are packed
each; null ids are kept; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import mix, slices, stored

WINDOW = 1024
END = 0
#: Units that one index holds.
SHARD_UNITS = 2048
#: Neighbours tried for a window before the best one left of them is cut; if none is left, the next ones follow.
TRIED = 64
#: Terms of more units than this are scored by rows of a matrix.
OFTEN = 128
K1, B = 1.2, 0.75
#: Ids below this one are ranks of frequent tokens, which say little about a text.
COMMON = 2_000
#: Ids that the counts of a vocabulary have room for at first.
SMALL = 1 << 16
#: Added tokens of byte_bpe_50k.json, which the file of ranks leaves out.
ADDED = {"<|endoftext|>": 50_256}
#: Characters up to which tiktoken splits a text: its stack holds fewer than a million white spaces.
SPLIT = 1 << 18


@lru_cache(maxsize=4)
def load_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """A byte-level vocabulary given as ranks; the file is small and read by each worker once."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=ADDED)


def encode(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text of any length; added tokens in it are one id each."""
    if len(text) <= SPLIT:
        return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4")
    out, start = array("I"), 0
    for token in [*regex.finditer("|".join(map(regex.escape, ADDED)), text), None]:
        # a piece never reaches over an added token, nor looks behind one
        for piece in regex.finditer(encoding._pat_str, text[start:token.start() if token else None]):
            out.extend(encoding._encode_single_piece(piece.group()))
        if token:
            out.append(ADDED[token.group()])
            start = token.end()
    return np.array(out, "<u4")


def tokenised(docs: DataFrame, path: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """doc_id, doc_tokens, crcs (of the whole sequences), tail (the ids left over, as bytes) and
    near, the smallest hash of the tail's rarer ids: similar tails tend to share it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path, pattern)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(encoding, text or ""), np.array([END], "<u4"))
                whole = len(ids) // window * window
                tail = ids[whole:]
                rare = tail[tail >= COMMON]
                near = int(mix(rare if len(rare) else tail, 3).min() >> np.uint64(1)) if len(tail) else 0
                rows.append((doc_id, len(ids), [zlib.crc32(ids[k:k + window].tobytes()) for k in range(0, whole, window)], tail.tobytes(), near))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "doc_tokens", "crcs", "tail", "near"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id bigint, doc_tokens bigint, crcs array<bigint>, tail binary, near bigint")


def _ids(tail: bytes) -> np.ndarray:
    return np.frombuffer(tail, "<u4")


def _frequencies(units: DataFrame) -> tuple[np.ndarray, int, float]:
    """In how many units each id occurs (bounded by the vocabulary), the units, their mean length."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SMALL, np.int64)
        for batch in batches:
            for tail in batch.column(0).to_pylist():
                terms = np.unique(_ids(tail))
                if len(terms) and terms[-1] >= len(total):
                    total = np.concatenate([total, np.zeros(int(terms[-1]) + 1 - len(total), np.int64)])
                total[terms] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "units"])

    rows = units.select("tail").mapInArrow(work, "term bigint, units bigint").groupBy("term").agg(F.sum("units").alias("units")).toPandas()
    size = units.agg(F.count("*").alias("n"), F.avg(F.length("tail") / 4).alias("mean")).first()
    out = np.zeros(max(SMALL, int(rows["term"].max()) + 1 if len(rows) else 0))
    out[rows["term"].to_numpy(np.int64)] = rows["units"].to_numpy()
    return out, size["n"], float(size["mean"] or 1.0)


class Index:
    """Inverted index over some units, with BM25 weights."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean: float):
        counted = [np.unique(u, return_counts=True) for u in units]
        many = np.array([len(t) for t, _ in counted])
        terms, tf = np.concatenate([t for t, _ in counted]).astype(np.int64), np.concatenate([c for _, c in counted])
        unit = np.repeat(np.arange(len(units)), many)
        length = np.array([len(u) for u in units])[unit]
        weight = (idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))).astype(np.float32)
        order = np.argsort(terms, kind="stable")
        term = np.unique(terms, return_inverse=True)[1]
        uses = np.bincount(term)
        self.units, self.weights = unit[order], weight[order]
        self.first = np.cumsum(uses) - uses
        often = uses > OFTEN
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.rows = np.zeros((int(often.sum()), len(units)), np.float32)
        in_rows = often[term]
        self.rows[self.row[term[in_rows]], unit[in_rows]] = weight[in_rows]
        self.uses = uses
        self.queries = np.split(term, np.cumsum(many)[:-1])
        self.size = len(units)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every unit for all terms of a seed."""
        terms = self.queries[seed]
        row = self.row[terms]
        out = self.rows[row[row >= 0]].sum(0)
        terms = terms[row < 0]
        uses = self.uses[terms]
        at = np.arange(uses.sum()) + np.repeat(self.first[terms] - (np.cumsum(uses) - uses), uses)
        return out + np.bincount(self.units[at], self.weights[at], self.size)


def pack(lengths: np.ndarray, index: Index, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (unit, from, length): all of exactly ``window`` ids but the last ones, which
    have powers of two."""
    used = np.zeros(len(lengths), bool)
    sequences: list[list[tuple[int, int, int]]] = []
    rest: tuple[int, int] | None = None  # unit, and where its rest starts
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while True:
        if rest is None:
            while at < len(order) and used[order[at]]:
                at += 1
            if at == len(order):
                break
            rest = (int(order[at]), 0)
            used[rest[0]] = True
        seed, start = rest
        rest = None
        pieces = [(seed, start, int(lengths[seed]) - start)]
        room = window - pieces[0][2]
        if room:
            for tried in _ranked(np.where(used, -1.0, index.scores(seed))):
                for u in tried:
                    if lengths[u] <= room:
                        pieces.append((u, 0, int(lengths[u])))
                        used[u] = True
                        room -= int(lengths[u])
                        if not room:
                            break
                u = next((u for u in tried if not used[u]), None)
                if room and u is not None:
                    used[u] = True
                    pieces.append((u, 0, room))
                    rest = (u, room)
                    room = 0
                if not room:
                    break
        sequences.append(pieces)
        if room:
            sequences[-1:] = _powers(pieces)
    return sequences


def _ranked(score: np.ndarray) -> Iterator[list[int]]:
    """The units with a score of 0 or more, the best first, TRIED at a time."""
    left = int((score >= 0).sum())
    if left > TRIED:  # most often the first ones do
        top = np.flatnonzero(score >= np.partition(score, -TRIED)[-TRIED])
        yield top[np.argsort(-score[top], kind="stable")][:TRIED].tolist()
    order = np.argsort(-score, kind="stable")[:left]
    for k in range(TRIED if left > TRIED else 0, left, TRIED):
        yield order[k:k + TRIED].tolist()


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces cut into sequences whose lengths are powers of two, the largest first."""
    out: list[list[tuple[int, int, int]]] = []
    total = sum(n for _, _, n in pieces)
    queue = list(pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            unit, start, n = queue.pop(0)
            take = min(n, room)
            out[-1].append((unit, start, take))
            room -= take
            if take < n:
                queue.insert(0, (unit, start + take, n - take))
    return out


def pack_documents(docs: DataFrame, path: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    rows = stored(tokenised(docs, path, pattern, window), "tokenised")
    whole = rows.where(F.size("crcs") > 0).select("doc_id", "doc_tokens", F.posexplode("crcs").alias("k", "ids_crc32"))
    # odd numbers for whole sequences, even ones for packed ones
    whole = whole.withColumn("at", F.monotonically_increasing_id()).select(
        "doc_id", (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("at") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    units = rows.where(F.length("tail") > 0).select("doc_id", "doc_tokens", "tail", "near")
    frequency, count, mean = _frequencies(units)
    idf = np.log(1 + (count - frequency + 0.5) / (frequency + 0.5))
    shared = spark.sparkContext.broadcast((idf.astype(np.float32), mean))
    shards = max(1, -(-count // SHARD_UNITS))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        weights, mean_ = shared.value
        first = TaskContext.get().partitionId() << 33
        made = 0
        for block in _blocks(batches):
            ids = [_ids(tail) for _, _, tail in block]
            lengths = np.array([len(u) for u in ids])
            out: list[tuple] = []
            for pieces in pack(lengths, Index(ids, weights, mean_), window):
                offset = 0
                for u, start, n in pieces:
                    doc_id, tokens, _ = block[u]
                    out.append((doc_id, tokens - int(lengths[u]) + start, n, zlib.crc32(ids[u][start:start + n].tobytes()), tokens, 2 * (first + made), offset))
                    offset += n
                made += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    # a key that many units share is split by the second column
    dealt = units.repartitionByRange(shards, "near", F.xxhash64("tail", "doc_id")).sortWithinPartitions("near", F.xxhash64("tail", "doc_id"))
    packed = dealt.select("doc_id", "doc_tokens", "tail").mapInArrow(
        fill, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
    return whole.union(packed)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows in blocks of SHARD_UNITS at most."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            if len(held) == SHARD_UNITS:
                yield held
                held = []
    if held:
        yield held
