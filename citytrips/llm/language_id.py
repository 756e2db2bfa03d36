"""Language identification by a mixture of languages per document.

Every language has a distribution over hashed character n-grams of words. A document is a
mixture of languages; expectation-maximisation estimates its proportions from the likelihoods
of its words, and a penalised likelihood selects how many languages it holds, for every document.
The prediction is the selected language with the largest proportion.

Cases: null text and text without letters (Unicode category L) give ``und`` with score 0. Ties go to the first
language in alphabetical order. Without any usable training row every text gives ``und``. Repeated rows are predicted
each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import mix, remainder, slices, with_carried

BUCKETS = 1 << 16
#: Bound of the training sample: about so many documents of each language, by a hash of the id.
TRAIN_PER_LANGUAGE = 2_000
SMOOTHING = 0.5
#: n-grams of a word overlap, so their joint evidence is tempered.
TEMPER = 0.5
ROUNDS = 12
#: After so many rounds, documents go on only if a larger set can still win by the bound of the likelihood.
FIRST_ROUNDS = 4
#: Penalty for each further language, in units of half the logarithm of the word count.
PENALTY = 2.0
UNKNOWN = "und"
WORDS = regex.compile(r"\p{L}+")
CACHE = 100_000


def ngram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets [3, characters] of the 1-, 2- and 3-grams that start at each character of
    ``<word>``, -1 beyond the word's end, and where each word starts."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    chars = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), np.uint32).astype(np.uint64)
    left = np.repeat(ends, lengths) - np.arange(len(chars))  # characters from here to the word's end
    out = np.full((3, len(chars)), -1, np.int64)
    key = np.zeros(len(chars), np.uint64)
    for n in (1, 2, 3):
        key[:len(chars) - n + 1] += chars[n - 1:] << np.uint64(21 * (n - 1))
        out[n - 1] = np.where(left >= n, (mix(key, n) & np.uint64(BUCKETS - 1)).astype(np.int64), -1)
    return out, ends - lengths


@dataclass
class LanguageModel:
    """languages in alphabetical order; log_p: float32 [buckets, languages]."""

    languages: list[str]
    log_p: np.ndarray


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, held_out: int = 5) -> LanguageModel:
    """n-gram counts of the training documents (crc32 of the id modulo ``held_out`` not 0)."""
    train = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", held_out) != 0))
    # each language's share of ids below a bound of their hash: no ranking, so no task holds a language
    sizes = F.broadcast(train.groupBy("lang").agg(F.count("*").alias("rows")))  # a row per language
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    sample = train.join(sizes, "lang").where(share * F.col("rows") < per_language).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if words := WORDS.findall(text.lower()):
                    grams = ngram_buckets(words)[0]
                    total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(grams[grams >= 0], minlength=BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"])

    counts = sample.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()  # at most languages x BUCKETS rows
    languages = sorted(rows["lang"].unique())
    weights = np.full((BUCKETS, len(languages)), SMOOTHING)
    for k, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        weights[own["bucket"].to_numpy(), k] += own["n"].to_numpy()
    return LanguageModel(languages, np.log(weights / weights.sum(0, keepdims=True)).astype(np.float32) if languages else np.zeros((BUCKETS, 0), np.float32))


class _Scorer:
    """Likelihoods of words, kept for the words seen last."""

    def __init__(self, model: LanguageModel):
        self.log_p = np.vstack([model.log_p, np.zeros((1, len(model.languages)), np.float32)])  # row -1: no gram
        self.at: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)), np.float32)

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """float32 [languages, words], scaled so that the best language of a word has 1."""
        if len(self.at) > CACHE:
            self.at, self.rows = {}, self.rows[:0]
        ids = list(map(self.at.get, words))
        if new := list(dict.fromkeys(w for w, k in zip(words, ids, strict=True) if k is None)):
            grams, starts = ngram_buckets(new)
            logs = np.add.reduceat(self.log_p[grams[0]] + self.log_p[grams[1]] + self.log_p[grams[2]], starts, axis=0) * TEMPER
            logs -= logs.max(1, keepdims=True)
            self.at.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, np.maximum(np.exp(logs), 1e-30)])
            ids = list(map(self.at.__getitem__, words))
        return np.ascontiguousarray(self.rows[np.array(ids)].T)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over the words of each document, in double precision."""
    return np.add.reduceat(values, np.cumsum(lengths) - lengths, axis=-1, dtype=np.float64)


def _total(like: np.ndarray, lengths: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Likelihood of each word in the mixture of its document."""
    return np.maximum((like * np.repeat(share.astype(np.float32), lengths, axis=1)).sum(0), 1e-37)


def _em(like: np.ndarray, lengths: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    """Proportions [languages, docs] after some rounds."""
    for _ in range(rounds):
        part = like * np.repeat(share.astype(np.float32), lengths, axis=1)
        part /= np.maximum(part.sum(0), 1e-37)
        share = _sums(part, lengths) / lengths
    return share


def _fit_of(like: np.ndarray, lengths: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log-likelihood of each document."""
    return _sums(np.log(_total(like, lengths, share)), lengths)


def _bound(like: np.ndarray, lengths: np.ndarray, share: np.ndarray) -> np.ndarray:
    """No mixture gives a document a larger log-likelihood: it is concave in the proportions, so it
    stays below its tangent at ``share``, which is largest in one of the corners."""
    total = _total(like, lengths, share)
    slopes = _sums(like / total, lengths)
    return _sums(np.log(total), lengths) + slopes.max(0) - lengths


def _penalty(size: int, lengths: np.ndarray) -> np.ndarray:
    return (size - 1) * PENALTY * 0.5 * np.log(lengths + 1.0)


def _words_of(docs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the words of some documents."""
    keep = np.zeros(len(lengths), bool)
    keep[docs] = True
    return np.flatnonzero(np.repeat(keep, lengths))


def mixture(like: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Proportions [languages, docs] of the language set that the penalised likelihood selects,
    for documents whose words' likelihoods follow each other.

    The sets are each document's most likely language alone, and its two, three, … languages with the
    largest proportions. A document is left out of further rounds only where no larger set can win.
    """
    n_lang = len(like)
    alone = _sums(np.log(like), lengths)
    chosen, best = np.zeros_like(alone), alone.max(0)
    chosen[alone.argmax(0), np.arange(len(lengths))] = 1
    share = _em(like, lengths, np.full_like(alone, 1 / n_lang), FIRST_ROUNDS)
    open_ = np.flatnonzero(_bound(like, lengths, share) - _penalty(2, lengths) > best)
    if not len(open_) or n_lang < 2:
        return chosen
    like, lengths, best = like[:, _words_of(open_, lengths)], lengths[open_], best[open_]
    share = _em(like, lengths, share[:, open_], ROUNDS - FIRST_ROUNDS)
    bound = _bound(like, lengths, share)
    rank = np.argsort(np.argsort(-share, axis=0, kind="stable"), axis=0, kind="stable")
    for size in range(2, n_lang + 1):
        some = np.flatnonzero(bound - _penalty(size, lengths) > best)
        if not len(some):
            break
        at = _words_of(some, lengths)
        first = np.where(rank[:, some] < size, share[:, some] + 1e-6, 0)
        got = _em(like[:, at], lengths[some], first / first.sum(0), ROUNDS // 2)
        gain = _fit_of(like[:, at], lengths[some], got) - _penalty(size, lengths[some])
        better = gain > best[some]
        best[some[better]] = gain[better]
        chosen[:, open_[some[better]]] = got[:, better]
    return chosen


def predict(docs: DataFrame, model: LanguageModel, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score, n_languages of every document, by its whole text; columns named
    in ``carry`` are passed through."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, languages = _Scorer(known.value), np.array([*known.value.languages, UNKNOWN], dtype=object)
        for batch in slices(batches, most_bytes=1 << 20):
            words = [WORDS.findall(t.lower()) if t else [] for t in batch.column(1).to_pylist()]
            lengths = np.array([len(w) for w in words])
            pick, score, many = np.full(len(words), len(languages) - 1), np.zeros(len(words)), np.zeros(len(words), int)
            full = np.flatnonzero(lengths)
            if len(full) and len(languages) > 1:
                share = mixture(scorer.likelihoods(list(chain.from_iterable(words))), lengths[full])
                pick[full], score[full], many[full] = share.argmax(0), share.max(0), (share > 0).sum(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages[pick], pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()), pa.array(many, pa.int32()), *batch.columns[2:]],
                names=["doc_id", "lang_pred", "score", "n_languages", *carry])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry).mapInArrow(
        work, with_carried("doc_id bigint, lang_pred string, score double, n_languages int", docs, carry))
