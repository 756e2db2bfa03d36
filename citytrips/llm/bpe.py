"""Byte-level BPE by ranks, with a rank queue for pre-tokens of any length.

The pairs that can be merged wait in buckets, one per rank, which hold the positions of their
left parts in a linked list. A bitmap over the ranks, summed up level by level in words of 64
bits, shows by two or three find-first-set steps which bucket is next. Merges change their
neighbours' pairs; what they leave behind in old buckets is recognised and skipped. All pre-tokens of
some texts that are not known yet share one list and one queue, so a bucket is merged at once for all
of them. A pre-token of n bytes takes O(n log n) steps at worst, so very long ones do no harm.

Cases: null text is empty and has no ids. Pre-tokens that are in the vocabulary are one id. Of
equal ranks the leftmost pair goes first. Repeated rows are encoded each; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import slices

#: Pre-tokens up to this length are kept with their ids, this many of them in each of two generations.
CACHED_LENGTH, CACHE = 48, 200_000
#: Bytes of text whose pre-tokens are merged together.
TOGETHER = 8 << 20


class RankQueue:
    """Buckets by rank, and bitmaps that show the lowest rank whose bucket is not empty."""

    def __init__(self, ranks: int):
        self.buckets: list[list] = [[] for _ in range(ranks)]
        self.words = [0] * (ranks // 64 + 1)
        self.groups = [0] * (ranks // 4096 + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        heappush(self.open(rank), position)

    def pop(self) -> tuple[int, int]:
        """(rank, lowest position in its bucket), removed; (-1, -1) if there is none."""
        rank = self.first()
        if rank < 0:
            return -1, -1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            self.close(rank)
        return rank, position

    def open(self, rank: int) -> list:
        """The bucket of a rank, to which the caller adds."""
        bucket = self.buckets[rank]
        if not bucket:
            word = rank >> 6
            if not self.words[word]:
                group = word >> 6
                if not self.groups[group]:
                    self.top |= 1 << group
                self.groups[group] |= 1 << (word & 63)
            self.words[word] |= 1 << (rank & 63)
        return bucket

    def first(self) -> int:
        """The lowest rank; -1 if all buckets are empty."""
        top = self.top
        if not top:
            return -1
        group = (top & -top).bit_length() - 1
        bits = self.groups[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self.words[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        """Marks the bucket of a rank, which the caller has emptied."""
        word = rank >> 6
        group = word >> 6
        self.words[word] &= ~(1 << (rank & 63))
        if not self.words[word]:
            self.groups[group] &= ~(1 << (word & 63))
            if not self.groups[group]:
                self.top &= ~(1 << group)


class Encoder:
    """Ranks are ids; ``pattern`` cuts a text into pre-tokens, which are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        tokens: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(size)
        self.bytes = np.array([ranks.get(bytes([k]), -1) for k in range(256)])
        # all ways to put a token together from two
        pairs = {ranks[t[:k]] << 32 | ranks[t[k:]]: rank for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.pairs = np.array([*sorted(pairs), 2**62], np.int64)
        self.merged = np.array([pairs.get(k, -1) for k in self.pairs.tolist()], np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of a pre-token, one merge after the other: of equal ranks the leftmost pair goes first."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        n, get, queue = len(data), ranks.get, self.queue
        after = list(range(1, n + 1))  # where the token at each start ends
        before = list(range(-1, n - 1))  # where the token to its left starts
        pair = [-1] * n  # rank of the pair that starts here
        for k in range(n - 1):
            rank = get(data[k:k + 2])
            if rank is not None:
                pair[k] = rank
                queue.push(rank, k)
        while True:
            rank, at = queue.pop()
            if rank < 0:
                break
            if pair[at] != rank:
                continue  # a merge has changed or taken this pair
            gone = after[at]
            end = after[gone]
            pair[gone] = -1
            after[at] = end
            if end < n:
                before[end] = at
                fresh = get(data[at:after[end]])
            else:
                fresh = None
            pair[at] = -1 if fresh is None else fresh
            if fresh is not None:
                queue.push(fresh, at)
            left = before[at]
            if left >= 0:
                fresh = get(data[left:end])
                if fresh is None:
                    pair[left] = -1
                elif pair[left] != fresh:
                    pair[left] = fresh
                    queue.push(fresh, left)
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k:after[k]]])
            k = after[k]
        return out

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, -1 for those that do not merge."""
        keys = left << 32 | right
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.merged[at], -1)

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens, and where those of each one end. The tokens of all lie in one linked
        list without links from one pre-token to the next. A bucket holds the places of a pair in
        all of them, which merge together. Where that could differ from one merge after the other,
        because a fresh pair has no higher rank, the pre-token is merged again on its own."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        ends = np.cumsum([len(p) for p in pieces])
        ids = np.append(self.bytes[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # n stands for no token
        after[ends - 1] = n
        before[np.append(0, ends[:-1])] = n
        alive = np.ones(n, bool)
        pair = np.full(n, -1)
        odd: list[np.ndarray] = []
        queue = self.queue

        def push(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = [*(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
            a = 0
            for rank, b in zip(ranks[[0, *cuts[:-1]]].tolist(), cuts, strict=True):
                queue.open(rank).append(at[a:b])
                a = b

        inner = np.flatnonzero(after[:n] < n)
        pair[inner] = self.pair_ranks(ids[inner], ids[inner + 1])
        inner = np.flatnonzero(pair >= 0)
        if len(inner):
            push(inner, pair[inner])
        while (rank := queue.first()) >= 0:
            parts = queue.buckets[rank]
            queue.buckets[rank] = []
            queue.close(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[pair[at] == rank]  # merges have changed or taken the other pairs
            if not len(at):
                continue
            gone = after[at]
            if len(at) > 1:
                linked = gone[:-1] == at[1:]
                if linked.any():  # of pairs that share a token every other one merges, from the left
                    place = np.arange(len(at))
                    run = np.maximum.accumulate(np.where(np.append(False, linked), 0, place))
                    keep = (place - run) % 2 == 0
                    at, gone = at[keep], gone[keep]
            end = after[gone]
            if len(at) > 1:
                touching = np.flatnonzero(end[:-1] == at[1:])
                if len(touching):  # the pair there is between this merge and the next one
                    way = self.pair_ranks(np.full(len(touching), rank), ids[end[touching]])
                    odd.append(at[touching[(way >= 0) & (way <= rank)]])
            ids[at] = rank
            after[at] = end
            inside = end < n
            before[end[inside]] = at[inside]
            pair[gone] = -1
            alive[gone] = False
            left = before[at]
            fresh = np.concatenate([at, left[left < n]])
            ranks = self.pair_ranks(ids[fresh], ids[after[fresh]])  # no pair has the id -1 past the end
            changed = pair[fresh] != ranks
            pair[fresh] = ranks
            changed &= ranks >= 0
            if changed.any():
                fresh, ranks = fresh[changed], ranks[changed]
                push(fresh, ranks)
                if int(ranks.min()) <= rank:
                    odd.append(fresh[ranks <= rank])
        out, stops = ids[:n][alive], np.cumsum(alive)[ends - 1]
        again = np.unique(np.searchsorted(ends, np.concatenate(odd), "right")).tolist() if odd else []
        if again:
            own = np.split(out, stops[:-1])
            for k in again:
                own[k] = np.array(self.merge(pieces[k]))
            out, stops = np.concatenate(own), np.cumsum([len(x) for x in own])
        return out, stops

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The packed ids of pre-tokens that are not known; short ones are kept."""
        found: dict[str, bytes] = {}
        rest: list[str] = []
        raw: list[bytes] = []
        for piece in pieces:
            data = piece.encode()
            if (rank := self.ranks.get(data)) is not None:
                found[piece] = struct.pack("<I", rank)
            else:
                rest.append(piece)
                raw.append(data)
        if rest:
            ids, stops = self.merge_all(raw)
            packed = ids.astype("<u4").tobytes()
            a = 0
            for piece, b in zip(rest, (stops * 4).tolist(), strict=True):
                found[piece] = packed[a:b]
                a = b
        if len(self.known) + len(found) > CACHE:
            self.older, self.known = self.known, {}  # what is used again comes back from there
        self.known.update((piece, ids) for piece, ids in found.items() if len(piece) <= CACHED_LENGTH)
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(text) if text else [] for text in texts]
        known, older = self.known, self.older
        fresh: dict[str, None] = {}
        for pieces in split:
            for piece in pieces:
                if piece not in known:
                    if piece in older:
                        known[piece] = older[piece]
                    else:
                        fresh[piece] = None
        found = self.learn(list(fresh)) if fresh else {}
        return [b"".join([known[p] if p in known else found[p] for p in pieces]) for pieces in split]

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, which lie one after the other in the taken array."""
        taken = self.tokens.take(pa.array(np.frombuffer(ids, "<u4")))
        return taken.buffers()[2].to_pybytes() if len(taken) else b""


@lru_cache(maxsize=2)
def load_encoder(path: str, pattern: str) -> Encoder:
    """Reads a file of base64 tokens and ranks; kept by each worker."""
    with open(path, "rb") as lines:
        return Encoder({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of every document."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(path, pattern)
        for batch in slices(batches, most_bytes=TOGETHER):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder.encode_all(batch.column(1).to_pylist()), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (the bytes) of encoded documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([encoder.decode(ids or b"") for ids in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, data binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(path, pattern)
        for batch in slices(batches, most_bytes=TOGETHER):
            ids = encoder.encode_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
