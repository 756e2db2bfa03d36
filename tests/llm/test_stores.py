"""Conversation tries, centroid clusters and token archives: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from citytrips.llm import prefix_trie, token_ids, zone_maps
from citytrips.llm.common import running_sums, shared_path

TURNS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType()),
                    StructField("words", StringType())])


def _digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _tries(rows):
    """The contract's columns, by a dict from every prefix to its members."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, _digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [w for w in members if w[:len(node)] == node]
        parent = [m for m in members if m == node[:-1]] if node else []
        ends = sorted(c for c in ids if len(rebuilt[c]) == len(node))
        out.append((min(ids), len(node), min(members[parent[0]]) if node else None, len(ids), sum(len(w) == len(node) + 1 for w in below),
                    sum(not any(len(x) == len(w) + 1 and x[:len(w)] == w for x in below) for w in below),
                    sum((len(members[w]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", w[-1][1])) for w in below if w),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def _conversations():
    r = random.Random(3)
    rows = []
    for c in range(140):
        if c in (40, 80):  # absent first conversations of their families
            continue
        for t in range(r.choice([1, 1, 2, 3, 5, 8, 9, 13])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", r.choice(["hello there", "a b c d", "x y \t z"]) if t < 6 else f"turn {t}"))
    rows += [(200, t, "user", "the same") for t in range(30)] + [(201, t, "user", "the same") for t in range(30)]
    rows += [(300 + c, t, "user", "common") for c in range(60) for t in range(4)]
    rows += [(400, None, "user", "null first"), (400, -1, None, None), (400, 5, "a", ""), (400, 5, "a", ""), (400, 5, "", "a"), (400, 5, None, "b"), (None, 1, "user", "of nobody"), (None, None, None, None)]
    return rows


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize(("block", "piece"), [(4, 1 << 18), (3, 5), (1, 1)])
def test_tries_match_brute_force(spark, monkeypatch, block, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows = _conversations()
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS).repartition(3)
    found = prefix_trie.rebuilt_trie(df, block=block)
    assert sorted((tuple(x) for x in found.select(*COLUMNS).collect()), key=repr) == _tries(rows)


def test_tries_of_nothing_and_of_one_endless_conversation(spark):
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.rebuilt_trie(none).count() == 0
    rows = [(1, t, "user", "again and again") for t in range(300)] + [(22, 0, "user", "x")]
    found = prefix_trie.rebuilt_trie(spark.createDataFrame([(*r, None) for r in rows], TURNS).repartition(8))
    assert sorted((tuple(x) for x in found.select(*COLUMNS).collect()), key=repr) == _tries(rows)


def test_running_sums_go_on_over_ranges(spark):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2, -5, 9]), k, r.randint(-9, 9)) for k in range(2000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint").repartition(8)
    found = {(x["a"], x["b"]): x["c_before"] for x in running_sums(df, "a", ["b"], ["c"], "test").collect()}
    sums = defaultdict(int)
    for a, b, c in sorted(rows):
        assert found[a, b] == sums[a]
        sums[a] += c
    assert len(found) == len(rows)


def _clusters(rows, k, rounds, components):
    kept = [(i, [int(np.floor(x * 256)) if abs(x) < 2**40 else int(x) * 256 for x in v]) for i, v in rows
            if v is not None and len(v) == components and None not in v and np.isfinite(v).all()]
    centers = [v for _, v in sorted(kept, key=lambda x: hashlib.sha256(f"2:{x[0]}".encode()).hexdigest())[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, own in groups.items():
            centers[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    best = [(i, *nearest(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, d, n in best:
        inertia[n] += d
    held = lambda x: x if x < 2**63 else None
    return sorted(((i, n, held(d), held(inertia[n]), held(sum(inertia.values())), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, d, n in best), key=repr)


@pytest.mark.parametrize("large", [False, True])
def test_clusters_match_brute_force(vectors, large):
    r = np.random.default_rng(5)
    middles = r.standard_normal((6, 8))
    rows = [(k, [float(x) for x in (middles[k % 6] + r.standard_normal(8) * 0.3).astype(np.float32)]) for k in range(400)]
    rows += [(1000 + k, rows[0][1]) for k in range(100)]  # copies of one vector
    rows += [rows[3], rows[3], (2000, None), (2001, []), (2002, [1.0] * 7), (2003, [None] * 8), (2004, [float("nan")] * 8), (2005, [float("inf")] * 8), (2006, [0.0] * 8), (2007, [-0.001] * 8)]
    if large:
        rows += [(3000, [float(np.float32(1e5))] * 8), (3001, [float(np.float32(-3e30))] + [0.5] * 7), (3002, [float(np.float32(3e38))] * 8)]
    df = vectors(*((i, v, 1) for i, v in rows)).repartition(3)
    found = zone_maps.cluster(df, centroids=7, components=8, block=16)
    assert sorted((tuple(x) for x in found.collect()), key=repr) == _clusters(rows, 7, 5, 8)


def test_clusters_of_few_vectors(vectors):
    assert zone_maps.cluster(vectors((1, None, 1)), components=8).count() == 0
    rows = [(1, [0.5] * 8), (2, [0.25] * 8)]
    found = zone_maps.cluster(vectors(*((i, v, None) for i, v in rows)), components=8)
    assert sorted((tuple(x) for x in found.collect()), key=repr) == _clusters(rows, 40, 5, 8)


def test_boxes_leave_no_centroid_out():
    r = np.random.default_rng(2)
    centers = np.floor(r.standard_normal((40, 6)) * 300)
    fewer = 0
    for _ in range(50):
        own = np.floor(r.standard_normal(6) * 300 + r.standard_normal((30, 6)) * 20)
        kept = zone_maps.candidates(own.min(0), own.max(0), centers)
        distance = ((own[:, None] - centers) ** 2).sum(2)
        number, best = zone_maps.assign(own, own.min(0), own.max(0), centers)
        assert (number == distance.argmin(1)).all() and (best == distance.min(1)).all()
        fewer += len(kept) < 40
    assert fewer == 50


def test_the_curve_visits_neighbours_one_after_the_other():
    for n, bits in ((2, 4), (3, 3)):
        cells = np.array(np.meshgrid(*[np.arange(2**bits)] * n)).reshape(n, -1).T
        keys = zone_maps.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[np.argsort(np.array(keys, object), kind="stable")]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_perfect_hash_gives_every_key_a_slot_of_its_own():
    r = np.random.default_rng(4)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(r.integers(-2**62, 2**62, n)).view(np.uint64)
        index = token_ids.PerfectHash.build(keys)
        assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))


def test_the_index_knows_its_keys_only():
    keys = [*range(0, 6000, 3), None, None, -7, -7]
    entries = [(k, f"s{i % 5}", i, 1) for i, k in enumerate(keys)]
    bucket = token_ids.Bucket.load(token_ids.Bucket.build(*map(list, zip(*entries, strict=True))).dump())
    assert sorted(bucket.find([*range(0, 6000, 3), None, -7]), key=repr) == sorted(entries, key=repr)
    assert len(list(bucket.find(list(range(1, 6000, 3))))) <= 1  # a fingerprint of 32 bits lets one of 2^32 by
    empty = token_ids.Bucket.load(token_ids.Bucket.build([], [], [], []).dump())
    assert list(empty.find([1, None])) == []
    with pytest.raises(ValueError):
        token_ids.Bucket.load(b"something else")


def _library_ids(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]


@pytest.mark.parametrize(("shard", "read", "keys"), [(1 << 23, 1 << 20, 1 << 20), (700, 50, 8)])
def test_archives_of_ids_round_trip(documents, monkeypatch, shard, read, keys):
    for name, value in (("SHARD_IDS", shard), ("READ_IDS", read), ("BUCKET_KEYS", keys)):
        monkeypatch.setattr(token_ids, name, value)
    r = random.Random(6)
    words = ["house", "river", "éclair", "stone", "!!", "12", "<|endoftext|>", "\n"]
    rows = [(k * 3, " ".join(r.choices(words, k=r.randint(0, 200)))) for k in range(80)] + [(1, None), (2, ""), (4, "word " * 9000), (-5, "first")]
    rows += [(7, "same")] * 40 + [(7, f"other {k}") for k in range(5)] + [(None, "no key"), (None, None)]
    r.shuffle(rows)
    ids = token_ids.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = token_ids.round_trip(documents(*rows).repartition(5), ids).toPandas().sort_values("start")
    assert len(found) == len(rows)
    assert found["start"].tolist() == (found["n_tokens"].cumsum() - found["n_tokens"]).tolist()
    order = [None if np.isnan(x) else int(x) for x in found["doc_id"]]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0))
    want = sorted((repr(k), len(x), zlib.crc32(x.tobytes())) for (k, _), x in zip(rows, _library_ids([t for _, t in rows]), strict=True))
    assert sorted((repr(k), n, c) for k, n, c in zip(order, found["n_tokens"], found["ids_crc32"], strict=True)) == want


def test_shards_of_large_ids(documents):
    rows = [(k, "x" * k) for k in range(30)]
    found = token_ids.round_trip(documents(*rows), lambda text: np.arange(len(text)) + (70_000 if len(text) == 20 else 0)).collect()
    want = {k: np.array([*(np.arange(k) + (70_000 if k == 20 else 0)), 2], "<u4") for k, _ in rows}
    assert {x["doc_id"]: (x["n_tokens"], x["ids_crc32"]) for x in found} == {k: (len(v), zlib.crc32(v.tobytes())) for k, v in want.items()}


def test_keyed_access(spark, documents):
    folder = shared_path(spark, "ids-test")
    texts = {k: f"text number {k}" for k in range(50)}
    ids = token_ids.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    _, index = token_ids.archive(documents(*texts.items()), folder, ids)
    wanted = spark.createDataFrame([(3,), (17,), (17,), (999,), (None,)], "key bigint")
    found = {x["key"]: x["ids"] for x in token_ids.read_documents(token_ids.lookup(wanted, index, folder), folder).collect()}
    assert found == {k: _library_ids([texts[k]])[0].tobytes() for k in (3, 17)}
    assert token_ids.round_trip(documents((1, "a")).limit(0), ids).count() == 0
