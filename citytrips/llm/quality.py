"""Quality classifier: supervised subword embeddings.

Every word has hashed vectors: one of its own and one for each of its character n-grams. They are
averaged over a document, together with vectors of a few marks (a word repeats the word before,
was seen before in the document, a line repeats an earlier one), and a softmax layer follows. All
vectors are learned by stochastic gradient descent. As the layer is linear, a document's score
needs one number per bucket, and each word's sum is kept.

Cases: null text and text without words have a score from the bias alone. Several labels of a
document, and those of equal texts, count by their rounded mean, halves up. Without labels of both kinds every score is 0.5.
Repeated rows are scored each; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import HASH, bounded_sample, mix, remainder, slices

#: Bound of the labelled sample, in documents.
TRAIN_DOCS = 8_000
BUCKETS, DIMENSIONS = 1 << 17, 12
NGRAMS = (2, 3, 4)
EPOCHS, RATE, SEED = 6, 0.3, 17
WORDS = re.compile(r"\w+|[^\w\s]+")
#: Buckets of the marks, after those of words and n-grams.
REPEATED, SEEN, LINE, MARKS = 0, 1, 2, 3
CACHE = 100_000


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and their n-grams (with the ends of the word marked), one word after
    the other, and how many each word has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    chars = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), np.uint32).astype(HASH)
    left = np.repeat(ends, lengths) - np.arange(len(chars))
    rows = [np.full(len(chars), -1, np.int64)]
    with np.errstate(over="ignore"):
        key = np.zeros(len(chars), HASH)
        for n in range(1, max(NGRAMS) + 1):
            key = key * HASH(0x100000001B3)
            key[:len(chars) - n + 1] += chars[n - 1:] + HASH(1)
            if n in NGRAMS:
                rows.append(np.where(left >= n, (mix(key, n) & HASH(BUCKETS - 1)).astype(np.int64), -1))
        # the whole word: a sum over places, each hashed with its distance from the start
        begin = ends - lengths
        place = np.arange(len(chars)) - np.repeat(begin, lengths)
        whole = np.add.reduceat(mix(chars + (place.astype(HASH) << HASH(32)), 9), begin)
        rows[0][begin] = (mix(whole, 10) & HASH(BUCKETS - 1)).astype(np.int64)
    grid = np.stack(rows, axis=1)
    used = grid >= 0
    return grid[used], np.add.reduceat(used.sum(1), begin)


def marks(words: list[str], text: str) -> tuple[int, int, int]:
    """How many words repeat the one before, were seen before, and lines that were seen before."""
    lines = [line for line in text.split("\n") if line]
    return sum(map(str.__eq__, words, words[1:])), len(words) - len(set(words)), len(lines) - len(set(lines))


@dataclass
class QualityModel:
    """weights: one number for each bucket and mark; bias."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + MARKS, np.float32))
    bias: float = 0.0


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS) -> QualityModel:
    """Stochastic gradient descent over the documents in a fixed random order."""
    if len(set(labels.tolist())) < 2:
        return QualityModel()
    random = np.random.default_rng(SEED)
    documents = [_features(t) for t in texts]
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + MARKS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps = epochs * len(texts)
    for done, d in enumerate(np.concatenate([random.permutation(len(texts)) for _ in range(epochs)])):
        rate = np.float32(RATE * (1 - done / steps))
        buckets, share = documents[d]  # distinct buckets, so plain indexing adds up
        mean = share @ vectors[buckets]
        score = mean @ layer + bias
        p = np.exp(score - score.max())
        p /= p.sum()
        p[labels[d]] -= 1
        change = layer @ p
        layer -= rate * np.outer(mean, p)
        bias -= rate * p
        vectors[buckets] -= np.outer(rate * share, change)
    return QualityModel(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and the share of each in its mean."""
    words = WORDS.findall(text)
    if not words:
        return np.array([BUCKETS + SEEN]), np.zeros(1, np.float32)
    buckets, many = word_buckets(words)
    seen = marks(words, text)
    found, counts = np.unique(buckets, return_counts=True)
    keep = [k for k in range(MARKS) if seen[k]]
    found = np.concatenate([found, [BUCKETS + k for k in keep]]).astype(np.int64)
    # a mark weighs as much as the n-grams of a word
    share = np.concatenate([counts / counts.sum(), [seen[k] / len(words) for k in keep]])
    return found, share.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_DOCS, divisor: int = 3, held: int = 1) -> QualityModel:
    """Fits on labelled documents whose crc32 modulo ``divisor`` is not ``held``."""
    rated = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", divisor) != held))
    rated = rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.floor(F.avg("quality") + 0.5).cast("int").alias("y"))
    rated = bounded_sample(rated, "doc_id", rows)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull()).join(F.broadcast(rated), "doc_id")
    # one row of equal texts with their mean label, halves up: copies are no further evidence
    sample = sample.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.floor(F.avg("y") + 0.5).cast("int").alias("y"))
    frame = sample.toPandas().sort_values(["doc_id", "text"])  # bounded by the sample
    return train(frame["text"].tolist(), frame["y"].to_numpy(np.int64))


class _Scorer:
    def __init__(self, model: QualityModel):
        self.model, self.known = model, {}
        self.sums = self.many = np.zeros(0)

    def score(self, texts: list[str | None]) -> np.ndarray:
        words = [WORDS.findall(t) if t else [] for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = list(chain.from_iterable(words))
        out = np.full(len(texts), self.model.bias)
        if flat:
            if len(self.known) > CACHE:
                self.known, self.sums, self.many = {}, np.zeros(0), np.zeros(0)
            ids = list(map(self.known.get, flat))
            if new := list(dict.fromkeys(w for w, k in zip(flat, ids, strict=True) if k is None)):
                buckets, many = word_buckets(new)
                sums = np.add.reduceat(self.model.weights[buckets].astype(float), np.cumsum(many) - many)
                self.known.update(zip(new, range(len(self.sums), len(self.sums) + len(new)), strict=True))
                self.sums, self.many = np.concatenate([self.sums, sums]), np.concatenate([self.many, many])
                ids = list(map(self.known.__getitem__, flat))
            at = np.array(ids)
            full = np.flatnonzero(lengths)
            starts = (np.cumsum(lengths) - lengths)[full]
            out[full] += np.add.reduceat(self.sums[at], starts) / np.add.reduceat(self.many[at], starts)
            seen = np.array([marks(words[d], texts[d]) for d in full])
            out[full] += seen / lengths[full, None] @ self.model.weights[BUCKETS:].astype(float)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score of every document, by its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in slices(batches, most_bytes=1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.score(batch.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, score double")
