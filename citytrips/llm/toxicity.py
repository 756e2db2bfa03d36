"""Toxicity by maximum-scoring segments.

Every token has a log-odds weight between toxic and other documents, smoothed by a Dirichlet
prior. A constant is taken off so that ordinary text drifts downwards; a linear scan then finds
all maximal scoring segments of a document, which are its suspicious passages. Scores of segments
follow an extreme-value law in ordinary text, whose two parameters are fitted; what a document
has beyond that law is aggregated and mapped to a probability.

Cases: null and empty text have no segments and get the score of that. Ties between segments
keep the first. Several labels of a document, or of equal texts, count as toxic if one is. Without labels of both
kinds every score is 0. Repeated rows are scored each; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import bounded_sample, remainder, slices, with_carried

#: Bound of the labelled sample, in documents; half fits the weights, half the calibration.
TRAIN_DOCS = 24_000
#: Tokens in fewer training documents carry no weight.
LEAST_DOCS = 5
#: Strength of the Dirichlet prior, in tokens.
PRIOR = 500.0
#: Taken off every token's weight.
DRIFT = 0.25
#: A weight is the log-odds less this many standard errors: what the counts make sure of.
CAUTION = 2.5
#: A passage is significant below this expected number of chance passages as good.
SIGNIFICANT = 0.01
TOKENS = re.compile(r"\w+")
#: Beginnings of words are units of their own: they catch inflected forms that are rare as words.
STEMS = (4, 5, 6)
#: Weights of words are kept for this many words at most.
CACHE = 100_000
EULER = 0.5772156649015329


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in linear time.

    Candidates are kept with the sums before and after them; a new one is joined with the
    nearest earlier candidate that starts lower as long as that raises the score. Runs of
    negative scores are summed beforehand, so the scan only visits positive ones.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    after = np.cumsum(scores)
    before = after - scores
    found: list[list] = []  # [start, end, sum before, sum after, nearest earlier that starts lower]
    for k, low, high in zip(at.tolist(), before[at].tolist(), after[at].tolist(), strict=True):
        new = [k, k + 1, low, high, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def units(token: str) -> list[str]:
    """The token and its beginnings, the latter marked by a star."""
    return [token, *(token[:n] + "*" for n in STEMS if len(token) > n)]


class _Weights(dict):
    """Weight of a token: that of its unit with the largest weight; 0 if no unit is known."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, token: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        own = [self.known[u] for u in units(token) if u in self.known]
        value = self[token] = max(own, default=0.0)
        return value


@dataclass
class ToxicityModel:
    """weights of units, none negative; rate (lambda) and size (K) of the extreme-value law; the coefficients
    that map (best excess, density, significant passages) to a probability."""

    weights: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    size: float = 1.0
    coefficients: tuple[float, ...] = ()

    def __post_init__(self):
        self.of = _Weights(self.weights)

    def __reduce__(self):
        return ToxicityModel, (self.weights, self.rate, self.size, self.coefficients)

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal segments in tokens, and the number of tokens."""
        tokens = TOKENS.findall(text.lower()) if text else []
        scores = np.fromiter(map(self.of.__getitem__, tokens), float, len(tokens)) - DRIFT
        return maximal_segments(scores), len(scores)

    def excess(self, scores: list[float], n: int) -> np.ndarray:
        """lambda S - ln(K n) of each segment: minus the logarithm of its expected number."""
        return self.rate * np.asarray(scores, float) - np.log(max(self.size * n, 1e-9))

    def features(self, scores: list[float], n: int) -> tuple[float, float, float]:
        """Of a document with these segment scores and n tokens: excess of the best segment,
        density of all, and the number of significant ones."""
        if not scores:
            return -10.0, 0.0, 0.0
        over = self.excess(scores, n)
        return float(np.clip(over.max(), -10, 40)), float(np.log1p(100 * sum(scores) / (n + 20))), float(np.log1p((over > -np.log(SIGNIFICANT)).sum()))

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.coefficients:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.coefficients[1:]) + self.coefficients[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Newton's method on a few features."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_DOCS, divisor: int = 3, held: int = 1) -> ToxicityModel:
    """Fits on labelled documents whose crc32 modulo ``divisor`` is not ``held``."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", divisor) != held))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("y"))
    marks = bounded_sample(marks, "doc_id", rows)
    # one row of equal texts, toxic if one of them is: copies are no further evidence
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
              .join(F.broadcast(marks), "doc_id").groupBy("text").agg(F.max("y").alias("y"))
              .withColumn("part", F.pmod(F.xxhash64("text"), F.lit(2))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = (Counter(), Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens: Counter = Counter()
                for token, n in Counter(TOKENS.findall(text.lower())).items():
                    for unit in units(token):
                        tokens[unit] += n
                sums[1 if y else 0].update(tokens)
                sums[2].update(tokens.keys())
        rows_ = [(t, sums[0][t], sums[1][t], d) for t, d in sums[2].items()]
        if rows_:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows_, strict=True)], names=["token", "other", "toxic", "docs"])

    tokens = (sample.where("part = 0").select("text", "y")
              .mapInArrow(count, "token string, other bigint, toxic bigint, docs bigint")
              .groupBy("token").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs")))
    # bounded by the sample: two totals, and the tokens that occur in several of its documents
    tokens = tokens.cache()
    totals = tokens.agg(F.sum("other"), F.sum("toxic")).first()
    frame = tokens.where(F.col("docs") >= LEAST_DOCS).toPandas()
    tokens.unpersist()
    if not totals[0] or not totals[1]:
        return ToxicityModel()
    other, toxic = frame["other"].to_numpy(float), frame["toxic"].to_numpy(float)
    prior = 0.5 + PRIOR * (other + toxic) / (totals[0] + totals[1])
    logit = lambda n, total: np.log((n + prior) / (total + PRIOR - n - prior))
    odds = logit(toxic, totals[1]) - logit(other, totals[0])
    odds = np.maximum(odds - CAUTION * np.sqrt(1 / (toxic + prior) + 1 / (other + prior)), 0.0)
    model = ToxicityModel({t: round(float(w), 6) for t, w in zip(frame["token"], odds, strict=True) if w})

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.passages(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n for _, n in found], pa.int64()), pa.array([[s for _, _, s in segs] for segs, _ in found], pa.list_(pa.float64())),
                 pa.array([[e - a for a, e, _ in segs] for segs, _ in found], pa.list_(pa.int64()))],
                names=["y", "n", "scores", "lengths"])

    seen = (sample.where("part = 1").select("text", F.col("y").cast("int").alias("y"))
            .mapInArrow(measure, "y int, n bigint, scores array<double>, lengths array<bigint>").toPandas())  # bounded by the sample
    if seen.empty or seen["y"].nunique() < 2:
        return ToxicityModel()
    plain = seen[(seen["y"] == 0) & (seen["n"] > 0)]
    best = np.array([max(s, default=0.0) if len(s) else 0.0 for s in plain["scores"]])
    n = plain["n"].to_numpy(float)
    # the law of maxima: P(S < s) = exp(-K n exp(-lambda s)); lambda from the tail of chance segments, K from the mean
    chance = np.concatenate([np.asarray(s, float) for s in plain["scores"]] or [np.zeros(0)])
    tail = chance[chance > 0]
    model.rate = float(1 / max(tail.mean(), 1e-3)) if len(tail) else 1.0
    hit = best > 0
    model.size = float(np.exp(np.clip((model.rate * best[hit] - np.log(n[hit])).mean() - EULER, -20, 5))) if hit.any() else float(1 / n.mean())
    x = [model.features(list(s), int(n)) for s, n in zip(seen["scores"], seen["n"], strict=True)]
    model.coefficients = _logistic(np.array(x), seen["y"].to_numpy(float))
    return model


def score(docs: DataFrame, model: ToxicityModel, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score, n_passages, best_start, best_end (tokens of the best passage) of every
    document, by its whole text; columns named in ``carry`` are passed through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            features, many, span = [], [], []
            for text in batch.column(1).to_pylist():
                segments, n = own.passages(text)
                scores = [s for _, _, s in segments]
                features.append(own.features(scores, n))
                strong = int((own.excess(scores, n) > -np.log(SIGNIFICANT)).sum()) if segments else 0
                many.append(strong)
                span.append(segments[int(np.argmax(scores))][:2] if strong else (None, None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own.score(np.array(features).reshape(-1, 3)), pa.float64()), pa.array(many, pa.int32()),
                 pa.array([a for a, _ in span], pa.int32()), pa.array([b for _, b in span], pa.int32()), *batch.columns[2:]],
                names=["doc_id", "score", "n_passages", "best_start", "best_end", *carry])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry).mapInArrow(
        work, with_carried("doc_id bigint, score double, n_passages int, best_start int, best_end int", docs, carry))
