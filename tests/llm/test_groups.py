"""Near copies, repeated passages, packing, embeddings, archives, components: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citytrips.llm import embeddings, minhash, packing, suffix_array, suffix_dedup, warc
from citytrips.llm.common import components, shared_path


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def _joined(ids, pairs):
    parent = {i: i for i in ids}
    for a, b in pairs:
        x, y = _find(parent, a), _find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {i: _find(parent, i) for i in ids}


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(90)] + [(200 + k, 201 + k) for k in range(40)] + [(300, 300 + k) for k in range(50)] + [(7, 7), (None, 3)]
    found = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == _joined({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_signatures_agree_like_the_similarity():
    base = np.arange(1000, dtype=np.uint64)
    for same in (600, 889, 950):
        other = np.concatenate([base[:same], np.arange(5000, 6000 - same, dtype=np.uint64)])
        a, b = minhash.mix(base), minhash.mix(other)
        got = minhash.signatures(np.concatenate([a, b]), np.array([1000, 1000]), k=3000)
        assert abs((got[0] == got[1]).mean() - same / (2000 - same)) < 0.04
    weights = np.array([0.5, 2.5, 1.0])
    cells, share = minhash.unit_cells(np.array([1, 2, 3], np.uint64), weights)
    more, rest = minhash.unit_cells(np.array([1, 2, 3], np.uint64), weights * [2, 1, 1])
    got = minhash.signatures(np.concatenate([cells, more]), np.array([len(cells), len(more)]), np.concatenate([share, rest]), k=3000)
    assert abs((got[0] == got[1]).mean() - 4.0 / 4.5) < 0.04


def _shingles(text):
    words = re.findall(r"\w+", text.lower())
    return Counter(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def _near_texts():
    r = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    texts = {}
    for g in range(12):
        base = r.choices(words, k=150)
        for c in range(6):
            copy = list(base)
            for _ in range(c):
                copy[r.randrange(150)] = r.choice(words)
            texts[len(texts)] = " ".join(copy)
    texts |= {1000: None, 1001: "", 1002: "", 1003: "!!", 1004: "!!", 1005: "one two", 1006: "One, two", 1007: "one", 1008: "line here\n" * 3000, 1009: "line here\n" * 2900, 1010: texts[0]}
    return texts


@pytest.mark.parametrize(("few", "block"), [(16, 1024), (1, 3)])
def test_near_copies_match_brute_force(documents, monkeypatch, few, block):
    monkeypatch.setattr(minhash, "FEW", few)
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = _near_texts()
    found = {r["doc_id"]: r for r in minhash.near_duplicates(documents(*texts.items(), (0, texts[0]), (None, texts[0]))).collect()}
    bags = {i: _shingles(t) for i, t in texts.items() if t}
    pairs = []
    for a in bags:
        for b in bags:
            if a < b:
                common = sum((bags[a] & bags[b]).values())
                if texts[a] == texts[b] or (common and common >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - common)):
                    pairs.append((a, b))
    want = _joined(texts, pairs)
    assert {i: r["class_id"] for i, r in found.items() if i is not None} == want
    assert all(r["kept"] == (i is None or r["class_id"] == i) for i, r in found.items())
    assert None in found


def test_near_copies_of_nothing(documents):
    assert minhash.near_duplicates(documents((1, "a")).limit(0)).count() == 0


def test_joining_links_joins_the_same_classes():
    r = np.random.default_rng(3)
    cells = [np.unique(r.integers(0, 60, 40)).astype(np.int32) for _ in range(60)]
    links = minhash.joining_links(cells, np.arange(60), None, 0.45)
    every = [(a, b) for a in range(60) for b in range(a) if len(np.intersect1d(cells[a], cells[b])) >= 0.45 * len(np.union1d(cells[a], cells[b]))]
    assert len(links) < len(every) and _joined(range(60), links) == _joined(range(60), every)


def test_suffix_arrays(monkeypatch):
    r = np.random.default_rng(0)
    for k in range(120):
        monkeypatch.setattr(suffix_array, "MOST_NAMES", (1, 2048)[k % 2])
        size = int(r.integers(2, 6))
        text = np.append(r.integers(1, size, r.integers(1, 60)), 0)
        order = suffix_array.suffix_array(text, size)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        common = suffix_array.common_prefixes(text, order)
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert common[b] == n


def _removed(texts, n=400):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[k:k + n] for d in data for k in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for k in range(len(d) - n + 1):
            if counts[d[k:k + n]] > 1:
                gone[k] += 1
                gone[k + n] -= 1
        gone = np.cumsum(gone)[:-1] > 0 if len(d) else np.zeros(0, bool)
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [8192, 3, 1])
def test_repeats_match_brute_force(documents, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    r = random.Random(6)
    noise = lambda n: "".join(r.choices("abcdefgé ", k=n))
    passages = [noise(n) for n in (398, 400, 430, 700, 1500)]
    texts = [None, "", "short", noise(2000), "The " * 300, "x" * 1000, noise(399)]
    for k in range(24):
        texts.append(noise(r.randint(0, 500)) + r.choice(passages) + noise(r.randint(0, 300)) + r.choice(passages)[r.randint(0, 60):] + noise(r.randint(0, 20)))
    near = list(passages[4])
    for k in range(0, 1500, 410):
        near[k] = "#"
    texts += ["".join(near), passages[4], passages[4], texts[8]]
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[9])]
    found = suffix_dedup.remove_repeats(documents(*rows), ("lang",)).collect()
    assert sorted((str(i), *w) for (i, _), w in zip(rows, _removed([t for _, t in rows]), strict=True)) == sorted((str(x["doc_id"]), x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in found)
    assert all(x["lang"] == "en" for x in found)


@pytest.mark.parametrize(("most", "length", "passage"), [(8192, 400, 300), (3, 400, 300), (1, 400, 300), (2, 120, 50), (1, 90, None), (5, 64, 40)])
def test_repeats_of_two_lengths_match_brute_force(documents, monkeypatch, most, length, passage):
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    r = random.Random(16)
    noise = lambda n: "".join(r.choices("abcdefgé ", k=n))
    passages = [noise(n) for n in (38, 60, 119, 290, 310, 330, 398, 430)]
    texts = [None, "", noise(1500), "The " * 200, "x" * 1200, " " * 5000 + noise(50), "ab" * 900, noise(length)]
    texts += ["".join([noise(r.randint(0, 90)), r.choice(passages), noise(r.randint(0, 60)), r.choice(passages)[r.randint(0, 40):], noise(r.randint(0, 20))]) for _ in range(40)]
    texts += [noise(2) + passages[5] + noise(2), passages[7], texts[12], texts[13][:-3] + "#", "#" + texts[13][5:]]
    found = suffix_dedup.remove_repeats(documents(*enumerate(texts)), (), length, passage).collect()
    want = _removed(texts, length)
    assert [tuple(x)[1:5] for x in sorted(found, key=lambda x: x["doc_id"])] == [tuple(w) for w in want]
    if passage:
        assert [(x["n_passage_bytes"], x["n_passages"]) for x in sorted(found, key=lambda x: x["doc_id"])] == [w[1:3] for w in _removed(texts, passage)]


def test_cores_of_all_widths_share_an_array_of_few_symbols(monkeypatch):
    sizes = []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, size: sizes.append(size) or suffix_array.suffix_array(text, size))
    r = random.Random(4)
    texts = []
    for passage in ["".join(r.choices("abcdefg ", k=668)) for _ in range(30)]:
        for _ in range(5):
            k = r.choice([r.randint(0, 120), r.randint(548, 667)])
            texts.append(passage[:k] + "#" + passage[k + 1:])
    contexts = [(k, 268, 268, t.encode()) for k, t in enumerate(texts)]
    found = {k: [] for k in range(len(texts))}
    for k, start, stop in suffix_dedup.solve(contexts, 400, 268):
        found[k].append((start, stop))
    merged = [suffix_dedup._merged(found[k]) for k in range(len(texts))]
    assert [(sum(b - a for a, b in runs), len(runs)) for runs in merged] == [w[1:3] for w in _removed(texts)]
    assert len(sizes) == 1 and sizes[0] < 300  # a bucket for each symbol is what an array costs at least


def test_runs_of_a_character_have_few_anchors(documents):
    keyed = suffix_dedup._keyed(documents((1, " " * 200_000), (2, "ab" * 100_000), (3, "x" + " " * 3000)))
    assert suffix_dedup._anchors(keyed, (300, 400)).count() < 5000
    found = {x["doc_id"]: x for x in suffix_dedup.remove_repeats(documents((1, " " * 200_000), (2, "y" + "ab" * 100_000))).collect()}
    assert (found[1]["n_removed"], found[1]["n_spans"]) == (200_000, 1) and found[2]["n_removed"] == 200_000


def test_lengths_have_an_order(documents):
    for length, passage in ((400, 400), (300, 400), (20, None)):
        with pytest.raises(ValueError):
            suffix_dedup.remove_repeats(documents((1, "a")), (), length, passage)


def test_repeats_of_nothing(documents):
    assert suffix_dedup.remove_repeats(documents((1, "a")).limit(0)).count() == 0


def test_anchors_depend_on_the_string_alone(monkeypatch):
    r = random.Random(9)
    inner = bytes(r.choices(b"ab c", k=900))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    a, b = (bytes(r.choices(b"xyz", k=n)) + inner + bytes(r.choices(b"xyz", k=77)) for n in (13, 600))
    left = {p - 13 for p in suffix_dedup.anchors(a)[0].tolist()}
    right = {p - 600 for p in suffix_dedup.anchors(b)[0].tolist()}
    for k in range(0, 501):
        held = range(k, k + 369)
        assert {p for p in left if p in held} & {p for p in right if p in held}


def test_packing_covers_every_id_once(documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    r = random.Random(2)
    words = ["house", "river", "éclair", "stone", "!!", "12"]
    texts = [None, "", " ", "word " * 6000, *(" ".join(r.choices(words, k=r.randint(1, 900))) for _ in range(60)), "same text", "same text"]
    rows = [*enumerate(texts), (None, "no id")]
    found = packing.pack_documents(documents(*rows), path, public_tokenizers.PATTERN).toPandas()
    for doc_id, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = found[found["doc_id"] == doc_id].sort_values("start")
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist() and own["length"].sum() == len(ids)
        for p in own.itertuples():
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[int(p.start):int(p.start + p.length)].tobytes())
    assert found["doc_id"].isna().sum() == 1
    groups = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (groups["offset"].first() == 0).all()
    for _, own in groups:
        assert own["offset"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
    lengths = groups["length"].sum()
    assert lengths.max() <= 1024 and all(n & (n - 1) == 0 for n in lengths)
    assert packing.pack_documents(documents((1, "a")).limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_packing_of_very_long_white_space(documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(5)
    mixed = "".join(r.choices(["house", " river", "'s", "  ", "\n", "\t\n ", "é", " 漢字", "12", "!!", "\u00a0", "\u2028"], k=120_000))
    texts = [" " * 1_000_000 + "a", "\n" * 1_000_000, mixed]
    assert min(map(len, texts)) > packing.SPLIT
    found = packing.pack_documents(documents(*enumerate(texts)), path, public_tokenizers.PATTERN).toPandas()
    for doc_id, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = found[found["doc_id"] == doc_id].sort_values("start")
        assert own["length"].sum() == len(ids) and (own["doc_tokens"] == len(ids)).all()
        assert all(p.ids_crc32 == zlib.crc32(ids[int(p.start):int(p.start + p.length)].tobytes()) for p in own.itertuples())


def test_packing_knows_the_added_token(documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {t.content: k for k, t in library.get_added_tokens_decoder().items()} == packing.ADDED
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"  {end}  {end}\n", f"<|{end}|>", "<|endoftext", "<|ENDOFTEXT|>", f"é{end}漢 's{end}'s", f"{end} \n x", *(f"{end} a  {end}\n\n" * n for n in (200, 20_000))]
    assert len(texts[-1]) > packing.SPLIT
    found = packing.pack_documents(documents(*enumerate(texts)), path, public_tokenizers.PATTERN).toPandas()
    for doc_id, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = found[found["doc_id"] == doc_id].sort_values("start")
        assert own["length"].sum() == len(ids) and (own["doc_tokens"] == len(ids)).all()
        assert all(p.ids_crc32 == zlib.crc32(ids[int(p.start):int(p.start + p.length)].tobytes()) for p in own.itertuples())


def test_packing_joins_what_resembles():
    r = np.random.default_rng(1)
    units = [r.choice(np.arange(50) + 100 * (k % 2), 300).astype(np.int64) for k in range(40)]
    index = packing.Index(units, np.ones(200), 300.0)
    mixed = sum(len({u % 2 for u, _, _ in seq}) > 1 for seq in packing.pack(np.full(40, 300), index))
    assert mixed <= 2


def test_packing_scores_all_terms(monkeypatch):
    r = np.random.default_rng(2)
    units = [r.zipf(1.3, 150) % 400 for _ in range(60)] + [np.array([7]), np.array([7])]
    idf = r.random(400)
    for often in (2, 1000):
        monkeypatch.setattr(packing, "OFTEN", often, raising=False)
        index = packing.Index(units, idf, 100.0)
        for seed in (0, 31, 60):
            want = [sum(idf[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(u) / 100)) for t, c in Counter(u.tolist()).items() if t in units[seed]) for u in units]
            assert np.allclose(index.scores(seed), want, rtol=1e-4)


def test_packing_goes_on_by_rank_past_the_first_neighbours():
    r = np.random.default_rng(1)
    units = [r.choice(np.arange(6) + 100 * (k % 2), 4, replace=False) for k in range(256)]  # those of a kind share two terms at least
    sequences = packing.pack(np.full(256, 4), packing.Index(units, np.ones(200), 4.0), 512)
    assert sorted(u for seq in sequences for u, _, _ in seq) == list(range(256))
    assert all(len({u % 2 for u, _, _ in seq}) == 1 for seq in sequences)


def test_packing_takes_equal_scores_in_order():
    score = np.array([1.0, 2.0] * 200)
    score[[3, 4]] = -1
    ranked = [u for block in packing._ranked(score) for u in block]
    assert ranked == sorted(set(range(400)) - {3, 4}, key=lambda u: (-score[u], u))


def test_embeddings_match_brute_force(vectors):
    r = np.random.default_rng(7)
    rows, k = [], 0
    for label in (1, 2):
        for _ in range(30):
            center = r.standard_normal(16)
            for _ in range(5):
                rows.append((k, [float(x) for x in (center + r.standard_normal(16) * 0.22).astype(np.float32)], label))
                k += 1
    rows += [(900, rows[0][1], 1), (901, rows[0][1], 2), (902, None, 1), (903, [0.0] * 16, 1), (904, [float("nan")] * 16, 1), (905, [None] * 16, 1), (906, rows[0][1], None),
             (907, [], 1), (908, [1.0, 2.0], 1), (909, [2.0, 4.0], 1), (910, [float("inf")] * 16, 1)]
    found = {x["vec_id"]: x for x in embeddings.near_duplicates(vectors(*rows, rows[3]), leaf=20, sample=60).collect()}
    usable = {i: (np.array(v), lab) for i, v, lab in rows if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    pairs = [(a, b) for a in usable for b in usable if a < b and usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0])
             and usable[a][0] @ usable[b][0] / np.linalg.norm(usable[a][0]) / np.linalg.norm(usable[b][0]) >= 0.93]
    degree = Counter(x for p in pairs for x in p)
    total = sum(degree.values())
    assert sum(x["n_links"] for x in found.values()) >= 0.95 * total
    assert all(x["n_links"] <= degree[i] for i, x in found.items())
    want = _joined([i for i, _, _ in rows], pairs)
    assert np.mean([found[i]["component_id"] == c for i, c in want.items()]) > 0.95
    assert all(found[i]["n_links"] == 0 and found[i]["component_id"] == i for i in (902, 903, 904, 905, 906, 907, 910))
    assert found[908]["n_links"] == found[909]["n_links"] == 1
    assert embeddings.near_duplicates(vectors(*rows[:1]).limit(0)).count() == 0


def test_unsplittable_leaves_are_compared_in_blocks(vectors, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    rows = [(k, [float(k + 1), 2.0 * (k + 1), 0.0], 1) for k in range(40)]
    found = embeddings.near_duplicates(vectors(*rows), leaf=10, sample=30).collect()
    assert all((x["n_links"], x["component_id"]) == (39, 0) for x in found)


def test_archives_round_trip(spark, pages):
    big = "<html>" + "é" * 800
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "x" * 400_000), (9, "u", "WARC/1.1\r\n\r\n" * 99)]
    folder = shared_path(spark, "warc-test")
    index = warc.write_bundles(pages(*rows), folder)
    found = warc.read_bundles(spark, folder, index).collect()
    assert len(found) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    for x in found:
        data = html[x["page_id"]]
        assert (x["payload_bytes"], x["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = x["page_id"] in (1, 2)
        assert (x["record_type"], x["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert x["stored"] is (None if revisit else True)
    for x in index.collect():
        headers, payload = warc.read_record(folder, x["bundle"], x["frame"], x["offset"])
        assert warc.page_of(headers["warc-record-id"]) == x["page_id"]
        assert payload == (b"" if x["page_id"] in (1, 2) else html[x["page_id"]])
    assert warc.round_trip(pages(rows[0]).limit(0)).count() == 0


def test_bundles_without_a_seek_table_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"0123456789abcdef")
    with pytest.raises(ValueError):
        warc.read_record(str(tmp_path), "x", 0, 0)
