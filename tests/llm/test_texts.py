"""Language, toxicity, quality, fingerprints and BPE, against brute force and held-out labels."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from citytrips.llm import bpe, fingerprints, language_id, quality, queries, toxicity

WORDS = {"en": "the and of with house river stone water", "de": "der und mit haus fluss stein wasser über"}
ODD = ["", " ", "\n\t", "1234 !!", "½ ² ① Ⅷ", "a", "é" * 5000, "word " * 20000]


def _text(lang, seed, n=60):
    return " ".join(random.Random(seed).choices(WORDS[lang].split(), k=n))


def test_segments_match_brute_force():
    def brute(scores, low, high):
        best, at = 0.0, None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += scores[j]
                if total > best + 1e-12:
                    best, at = total, (i, j + 1)
        return [] if at is None else [*brute(scores, low, at[0]), (*at, best), *brute(scores, at[1], high)]

    r = random.Random(3)
    for _ in range(200):
        scores = [r.choice([-3, -2, -1, 1, 2, 4]) + r.random() / 8 for _ in range(r.randint(0, 25))]
        got = toxicity.maximal_segments(np.array(scores))
        want = brute(scores, 0, len(scores))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_language_of_mixed_and_odd_texts(spark, documents):
    train = [(i, _text(lang, i), lang) for i, lang in enumerate(["en", "de"] * 60)]
    odd = [(1000 + k, t, None) for k, t in enumerate([None, *ODD])]
    docs = documents(*train, *odd, (None, _text("de", 5), "de"), train[0])
    found = language_id.predict(docs, language_id.fit(docs), ("lang",)).toPandas()
    assert len(found) == len(train) + len(odd) + 2
    known = found[found["doc_id"] < 1000]
    assert (known["lang_pred"] == known["lang"]).mean() > 0.98
    by_id = dict(zip(found["doc_id"], found["lang_pred"], strict=True))
    assert [by_id[1000 + k] for k in range(6)] == ["und"] * 6  # null, empty, white space, no letters
    assert found["score"].between(0, 1).all()
    half = documents((1, _text("en", 1, 80) + " " + _text("de", 2, 40), "en"))
    mixed = language_id.predict(half, language_id.fit(docs)).first()
    assert (mixed["lang_pred"], mixed["n_languages"]) == ("en", 2) and 0.5 < mixed["score"] < 0.85
    empty = language_id.predict(docs.limit(0), language_id.fit(docs.limit(0)))
    assert empty.count() == 0
    untrained = language_id.predict(half, language_id.fit(docs.limit(0))).first()
    assert (untrained["lang_pred"], untrained["score"]) == ("und", 0.0)


def test_em_raises_the_likelihood():
    r = np.random.default_rng(1)
    like = r.random((3, 40)).astype(np.float32)
    lengths = np.array([15, 25])
    share = np.full((3, 2), 1 / 3, np.float32)
    before = language_id._fit_of(like, lengths, share)
    for _ in range(5):
        share = language_id._em(like, lengths, share, 1)
        after = language_id._fit_of(like, lengths, share)
        assert (after >= before - 1e-4).all()
        before = after


def test_language_set_is_the_best_of_all_subsets():
    """Every document, also a long one with a small second language, gets the set that the penalised
    likelihood prefers among all subsets, each fitted to convergence."""
    r = np.random.default_rng(7)
    n_lang, parts = 4, []
    for share in [(60, 0, 0, 0), (0, 45, 15, 0), (12, 0, 0, 9), (3000, 0, 60, 0), (20, 15, 25, 0), (1, 0, 0, 0), (0, 2, 2, 0), (30, 30, 30, 30)]:
        home = np.repeat(np.arange(n_lang), share)
        like = r.random((n_lang, len(home))) * 0.3 + 0.01
        like[home, np.arange(len(home))] = 1
        parts.append(like)
    lengths = np.array([p.shape[1] for p in parts])
    got = language_id.mixture(np.concatenate(parts, axis=1).astype(np.float32), lengths)
    assert np.allclose(got.sum(0), 1, atol=1e-4)
    for d, like in enumerate(parts):
        best = (-np.inf, ())
        for mask in range(1, 1 << n_lang):
            pick = [k for k in range(n_lang) if mask >> k & 1]
            p = np.full(len(pick), 1 / len(pick))
            for _ in range(400):
                part = like[pick] * p[:, None]
                p = (part / part.sum(0)).mean(1)
            value = np.log((like[pick] * p[:, None]).sum(0)).sum() - (len(pick) - 1) * language_id.PENALTY * 0.5 * np.log(like.shape[1] + 1)
            best = max(best, (value, tuple(pick)))
        assert tuple(np.flatnonzero(got[:, d])) == best[1], d
        bound = language_id._bound(like.astype(np.float32), lengths[d:d + 1], np.full((n_lang, 1), 1 / n_lang))
        assert bound[0] >= best[0]


def test_equal_texts_with_different_labels(spark, documents, labels):
    """Labels are gathered by text: the model is the same whichever row comes first."""
    rows, marks = _labelled()
    copies = [(5000 + i, text) for i, text in rows[:40]]
    other = [(5000 + i, 1 - q, 1 - t) for i, q, t in marks[:40]]
    for module in (toxicity, quality):
        models = []
        for turn in (1, -1):
            docs = documents(*[*rows, *copies][::turn]).repartition(3)
            models.append(module.fit(docs, labels(*[*marks, *other][::turn])))
        if module is toxicity:
            assert models[0].weights == models[1].weights and np.allclose(models[0].coefficients, models[1].coefficients)
        else:
            assert np.array_equal(models[0].weights, models[1].weights) and models[0].bias == models[1].bias


def _labelled(n=240):
    bad = ["idiot", "scum", "stupid"]
    rows, marks = [], []
    for i in range(n):
        r = random.Random(i)
        toxic = i % 4 == 0
        words = _text("en", i, 120).split()
        if toxic:
            words[40:44] = [*r.choices(bad, k=3), "x"]
        junk = i % 5 == 0
        text = " ".join(w + "%%%" for w in words) if junk else " ".join(words)
        rows.append((i, text))
        marks.append((i, 0 if junk else 1, int(toxic)))
    return rows, marks


def test_toxicity_on_held_out_rows(documents, labels):
    rows, marks = _labelled()
    odd = [(1000 + k, t) for k, t in enumerate([None, *ODD])]
    docs = documents(*rows, *odd, (None, "idiot scum"))
    model = toxicity.fit(docs, labels(*marks, (0, None, None), (None, 1, 1), marks[1]))
    found = toxicity.score(docs, model).toPandas()
    assert len(found) == len(rows) + len(odd) + 1 and found["score"].between(0, 1).all()
    score = dict(zip(found["doc_id"], found["score"], strict=True))
    right = [(score[i] >= 0.7) == bool(t) for i, _, t in marks]
    assert np.mean(right) > 0.97
    spans = found[(found["doc_id"] < 1000) & (found["n_passages"] > 0)]
    assert spans["best_start"].between(38, 44).mean() > 0.9
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels())
    assert set(toxicity.score(docs, none).toPandas()["score"]) == {0.0}


def test_quality_on_held_out_rows(documents, labels):
    rows, marks = _labelled()
    odd = [(1000 + k, t) for k, t in enumerate([None, *ODD])]
    docs = documents(*rows, *odd, rows[0])
    found = quality.score(docs, quality.fit(docs, labels(*marks))).toPandas()
    assert len(found) == len(rows) + len(odd) + 1 and found["score"].between(0, 1).all()
    score = dict(zip(found["doc_id"], found["score"], strict=True))
    assert np.mean([(score[i] >= 0.5) == bool(q) for i, q, _ in marks]) > 0.97
    assert quality.score(docs.limit(0), quality.fit(docs, labels())).count() == 0
    assert set(quality.score(docs, quality.fit(docs, labels())).toPandas()["score"]) == {0.5}


def test_scores_are_those_of_the_averaged_vectors():
    texts = ["the house THE house", "!! %% a b a b", "", "x"]
    model = quality.QualityModel(np.random.default_rng(2).standard_normal(quality.BUCKETS + quality.MARKS).astype(np.float32), 0.3)
    plain = []
    for t in texts:
        buckets, share = quality._features(t)
        plain.append(1 / (1 + np.exp(-(model.weights[buckets] @ share + model.bias))))
    assert np.allclose(quality._Scorer(model).score(texts), plain, atol=1e-5)


def test_extensions_and_spans():
    r = random.Random(1)
    for _ in range(100):
        a, b = ("".join(r.choices("abé😀", k=r.randint(0, 40))) for _ in range(2))
        x, y = fingerprints.PrefixHash(a), fingerprints.PrefixHash(b)
        i, j = r.randint(0, len(a)), r.randint(0, len(b))
        want = 0
        while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
            want += 1
        assert fingerprints.common_extension(x, i, y, j) == want
        assert fingerprints.equal_spans(x, i, y, j, want) and not fingerprints.equal_spans(x, i, y, j, want + 1)


@pytest.mark.parametrize("shuffles", ["1", "4"])
def test_fingerprints_follow_the_order_of_ids(spark, documents, shuffles):
    texts = {7: _text("en", 1), -3: None, 12: _text("en", 1), 40: "", 41: "short", 3: _text("de", 2, 2000), 100: "é" * 3000}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        found = {r["doc_id"]: r for r in fingerprints.fingerprints(documents(*texts.items())).collect()}
        assert fingerprints.fingerprints(documents(*texts.items()).limit(0)).count() == 0
        one = fingerprints.fingerprints(documents((5, "abcdef"))).first()
        twice = fingerprints.fingerprints(documents((5, "abc"), (5, "abc"), (None, "abc"))).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ids = sorted(texts)
    for k, i in enumerate(ids):
        text, following = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        row = found[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["fingerprint"] == fingerprints.fingerprint(text) and row["edited_fingerprint"] == fingerprints.fingerprint(changed)
        assert row["near_next"] == fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(following))
        assert 0 <= row["near_edited"] <= 1
    assert found[7]["fingerprint"] == found[12]["fingerprint"] != found[3]["fingerprint"]
    assert found[3]["near_edited"] > 0.3 > found[3]["near_next"]
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()
    assert twice == 3


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_agrees_with_the_library(spark, documents, vocabulary):
    path, encoding = vocabulary
    r = random.Random(5)
    alphabet = [chr(r.randint(1, 0x2FFF)) for _ in range(200)] + list(" \n\t'stdre abc019²é漢字😀")
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(500)] + [t for t in ODD] + ["a" * 30000, "ab" * 20000]
    docs = documents(*enumerate(texts), (9000, None), (9000, None))
    found = {r_["doc_id"]: r_ for r_ in bpe.digests(docs, path, public_tokenizers.PATTERN).collect()}
    for i, text in [*enumerate(texts), (9000, "")]:
        ids = encoding.encode_ordinary(text)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    encoded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    decoded = {r_["doc_id"]: bytes(r_["data"]) for r_ in bpe.decode_documents(encoded, path, public_tokenizers.PATTERN).collect()}
    assert all(decoded[i].decode() == t for i, t in enumerate(texts))
    assert bpe.digests(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_any_ranks_merges_one_pair_after_the_other():
    def plain(ranks, data):
        parts = [data[k:k + 1] for k in range(len(data))]
        while True:
            best = min(((ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    r = random.Random(11)
    for _ in range(150):
        tokens = {bytes([k]) for k in range(256)} | {bytes(r.choices(b"abc", k=r.randint(2, 6))) for _ in range(40)}
        order = sorted(sorted(tokens), key=lambda t: (len(t) > 1, r.random()))  # a token may rank before its parts
        encoder = bpe.Encoder({t: k for k, t in enumerate(order)}, r"\S+")
        pieces = ["".join(r.choices("abc", k=r.randint(1, 30))) for _ in range(40)] + ["a" * 60, "ab" * 31]
        want = [[encoder.ranks[p.encode()]] if p.encode() in encoder.ranks else plain(encoder.ranks, p.encode()) for p in pieces]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(pieces)] == want
        assert [encoder.merge(p.encode()) for p in pieces] == want
        rest = [(p.encode(), w) for p, w in zip(pieces, want, strict=True) if p.encode() not in encoder.ranks]  # whole tokens are not merged
        ids, stops = encoder.merge_all([p for p, _ in rest])
        assert [own.tolist() for own in np.split(ids, stops[:-1])] == [w for _, w in rest]


def test_bpe_keeps_two_generations_of_pre_tokens(vocabulary, monkeypatch):
    path, encoding = vocabulary
    monkeypatch.setattr(bpe, "CACHE", 50)
    r = random.Random(3)
    with open(path, "rb") as lines:
        encoder = bpe.Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, public_tokenizers.PATTERN)
    for _ in range(40):
        texts = [" ".join(f"word{r.randint(0, 90)}x{r.randint(0, 3)}" for _ in range(30)), None, ""]
        assert encoder.encode_all(texts) == [np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes() for t in texts]
        assert len(encoder.known) <= 50 + 61


def test_rank_queue_orders_by_rank_and_position():
    r = random.Random(2)
    queue, want = bpe.RankQueue(300_000), []
    for _ in range(2000):
        item = (r.choice([r.randint(0, 299_999), r.randint(0, 50)]), r.randint(0, 9))
        queue.push(*item)
        want.append(item)
        if r.random() < 0.3:
            want.sort()
            assert queue.pop() == want.pop(0)
    for item in sorted(want):
        assert queue.pop() == item
    assert queue.pop() == (-1, -1)


def test_held_out_columns(spark, folder):
    found = queries.op9_language_id(spark, folder).toPandas()
    import zlib

    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(found["doc_id"], found["held_out"], strict=True))
