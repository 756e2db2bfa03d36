"""Every stage of the corpus pipeline, and all of them, against brute force of each decision."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from citytrips.llm import toxicity
from tests.llm.test_groups import _joined, _shingles

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _row(doc_id, text):
    return (doc_id, text, "en", None, None if text is None else len(text))


@pytest.fixture(scope="module")
def corpus(spark, folder, tmp_path_factory):
    """A folder with documents and labels: given ones, and odd ones beside them; further columns have clashing names."""
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(r["text"] or "") < 4000]
    long = next(r[1] for r in given if 1500 < len(r[1] or ""))
    odd = [None, "", " \n", "12 34 !!", "one two", "One, two", "é漢 <|endoftext|> b", "same text here", "same text here", f"Intro of its own. {long[:700]} é", f"{long[300:1200]} and an end"]
    rows = [*given, *(_row(10**9 + k, t) for k, t in enumerate(odd)), given[0], _row(None, "no id here"), _row(None, "no id here"), _row(None, None), _row(None, given[1][1])]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("x"), "kept": F.lit(False)}).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path, rows


def _language(rows, scores):
    return [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]


def _clean(rows, scores):
    return [r for r in rows if scores[r[1]] < corpus_pipeline.TOXIC]


def _distinct(rows, scores):
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    bags = {i: _shingles(t) for i, t in texts.items() if t}
    sizes = {i: sum(b.values()) for i, b in bags.items()}
    pairs = []
    for a in bags:
        for b in bags:
            if a < b:
                if texts[a] == texts[b]:
                    pairs.append((a, b))
                elif min(sizes[a], sizes[b]) >= 0.8 * max(sizes[a], sizes[b], 1):
                    common = sum((bags[a] & bags[b]).values())
                    if common and common >= 0.8 * (sizes[a] + sizes[b] - common):
                        pairs.append((a, b))
    least = _joined(texts, pairs)
    return list({(r[0], r[1]): r for r in rows if r[0] is None or least[r[0]] == r[0]}.values())


def _passages(rows, scores):
    n = corpus_pipeline.PASSAGE
    data = [(r[1] or "").encode() for r in rows]
    counts = Counter(hash(d[k:k + n]) for d in data for k in range(len(d) - n + 1))
    out = []
    for r, d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - n + 1):
            if counts[hash(d[k:k + n])] > 1:
                gone[k:k + n] = True
        text = bytes(np.frombuffer(d, np.uint8)[~gone]).decode("utf-8", "ignore")  # a null text is empty
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


WANT = {"language": _language, "toxicity": _clean, "near_duplicates": _distinct, "repeated_passages": _passages}


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def _scores(spark, path):
    """The toxicity of every text by a model of all documents, as the stage has it."""
    docs = spark.read.parquet(f"{path}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    return {r["source"]: r["score"] for r in toxicity.score(docs.withColumn("source", F.col("text")), model, ("source",)).collect()}


def _check_packed(found, rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4") for r in rows]
    assert int(found["length"].sum()) == sum(map(len, ids))
    assert found["doc_id"].isna().any() == any(r[0] is None for r in rows)
    assert set(found["doc_id"].dropna()) == {r[0] for r in rows if r[0] is not None}
    many = Counter(r[0] for r in rows)
    for r, own_ids in zip(rows, ids, strict=True):
        if r[0] is None or many[r[0]] > 1:
            continue
        own = found[found["doc_id"] == r[0]].sort_values("start")
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist() and own["length"].sum() == len(own_ids)
        assert all(p.doc_tokens == len(own_ids) and p.ids_crc32 == zlib.crc32(own_ids[int(p.start):int(p.start + p.length)].tobytes()) for p in own.itertuples())


@pytest.mark.parametrize("name", WANT)
def test_stage_matches_brute_force(spark, corpus, name, monkeypatch):
    path, rows = corpus
    scores = _scores(spark, path) if name == "toxicity" else None
    if scores:  # so that there are rejected ones and one at the limit
        monkeypatch.setattr(corpus_pipeline, "TOXIC", sorted(set(scores.values()))[len(set(scores.values())) // 2])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, path)
    assert tuple(found.columns) == corpus_pipeline.COLUMNS
    want = WANT[name](rows, scores)
    assert _sorted(found.collect()) == _sorted(want) and 0 < len(want)
    assert name == "repeated_passages" and _sorted(want) != _sorted(rows) or len(want) < len(rows)
    if name != "toxicity":  # nothing is fitted on nothing
        assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), path).count() == 0


def test_packing_stage_packs_every_document(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    _check_packed(corpus_pipeline.packed(spark, docs, path).toPandas(), rows)
    assert corpus_pipeline.packed(spark, docs.limit(0), path).count() == 0


def test_all_stages_in_a_row(spark, corpus):
    path, rows = corpus
    found = corpus_pipeline.run(spark, path).toPandas()
    kept = spark.read.parquet(f"{path}/documents.parquet")
    rows = _language(rows, None)
    kept = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(kept, spark.read.parquet(f"{path}/labels.parquet"))
    scores = {r["source"]: r["score"] for r in toxicity.score(kept.withColumn("source", F.col("text")), model, ("source",)).collect()}
    for stage in (_clean, _distinct, _passages):
        rows = stage(rows, scores)
    _check_packed(found, rows)
