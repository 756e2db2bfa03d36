"""Near-duplicate documents by DartMinHash over five-word shingles.

A document is a weighted set: its shingles, weighted by how often they occur. A shingle of weight
w owns the region [0, w) x ranks. Darts are thrown into the regions by hashes, in the order of
their ranks; of the darts that hit one of K coordinates the earliest is kept. Two documents agree
in a coordinate with the probability of their weighted Jaccard similarity, sum of minima by sum of
maxima. Only about K (ln K + 2) darts are made, however many shingles there are.

Signatures are cut in bands, and documents that share a band, a bucket, are candidates. Candidates
are verified exactly. First every document is compared with the hub (smallest id) that it shares
most bands with. Then, in buckets whose documents are still in several classes, all candidates of
different classes are compared: in small buckets pair by pair, in larger ones block by block
within tasks of bounded size that return only the links which join classes. So no candidate pair
that could join two classes is left out, and no group's pairs are listed. Classes are connected
components of the verified links.

Cases: null and empty texts and null ids link with nothing. Equal texts are copies, also such
without words; copies are collapsed before anything else. Texts of fewer than five words are one
shingle of all their words. Repeated rows of an id count once. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import HASH, components, mix, slices, stored

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
#: Two documents of similarity 0.8 share one of 20 bands of 6 with probability 0.998.
BANDS, ROWS = 20, 6
COORDINATES = BANDS * ROWS
#: Pairs of a bucket of up to FEW documents are listed; a task compares two BLOCKs of a larger one.
FEW, BLOCK = 16, 1024
WORDS = re.compile(r"\w+")
CACHE = 100_000
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 | 1 for k in range(WORDS_PER_SHINGLE)], dtype=HASH)


class Shingler:
    """Shingles of texts as 64-bit unit cells: the c-th occurrence of a shingle is a cell of its
    own, so plain set similarity of cells is weighted similarity of shingles."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def cells(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The cells of all texts, one text after the other, and how many each has."""
        words = [WORDS.findall(t.lower()) if t else [] for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = list(chain.from_iterable(words))
        if len(self.known) > CACHE:
            self.known = {}
        known = self.known
        ids = list(map(known.get, flat))
        if None in ids:
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w, k in zip(flat, ids, strict=True) if k is None)
            ids = list(map(known.__getitem__, flat))
        hashes = np.array(ids, dtype=HASH)
        many = np.where(lengths >= WORDS_PER_SHINGLE, lengths - WORDS_PER_SHINGLE + 1, np.minimum(lengths, 1))
        ends, stops = np.cumsum(lengths), np.cumsum(many)
        with np.errstate(over="ignore"):
            rolled = np.zeros(len(hashes), HASH)
            for k in range(WORDS_PER_SHINGLE):
                rolled[:len(hashes) - k] += hashes[k:] * _ODD[k]
            # a shingle starts at each word that has enough words after it in its own text
            room = np.repeat(ends, lengths) - np.arange(len(hashes))
            total = rolled[np.flatnonzero((room >= WORDS_PER_SHINGLE) | ((room == np.repeat(lengths, lengths)) & (room > 0)))]
            for d in np.flatnonzero((lengths > 0) & (lengths < WORDS_PER_SHINGLE)):
                own = hashes[ends[d] - lengths[d]:ends[d]]
                total[stops[d] - 1] = (own * _ODD[:len(own)]).sum(dtype=HASH) + HASH(lengths[d])
            total = mix(total)
            for a, b in zip((stops - many).tolist(), stops.tolist(), strict=True):
                total[a:b].sort()
            at = np.arange(len(total))
            new = np.diff(total, prepend=total[:1] ^ HASH(1)) != 0
            new[(stops - many)[many > 0]] = True
            first = np.maximum.accumulate(np.where(new, at, 0))
            return mix(total + (at - first).astype(HASH) * HASH(0xD6E8FEB86659FD93)), many


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> HASH(11)).astype(np.float64) + 0.5) / 2.0**53


def unit_cells(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of elements (64-bit hashes) with positive real weights, and how much of each cell
    belongs to its element: 1, or the fraction in the last cell."""
    many = np.ceil(weights).astype(np.int64)
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    with np.errstate(over="ignore"):
        cells = mix(np.repeat(elements.astype(HASH), many) + inside.astype(HASH) * HASH(0xD6E8FEB86659FD93))
    return cells, np.minimum(np.repeat(weights, many) - inside, 1.0)


def signatures(cells: np.ndarray, many: np.ndarray, share: np.ndarray | None = None, k: int = COORDINATES) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates, for sets whose cells follow each other:
    uint64 [sets, k]. ``many``: cells of each set, none 0. ``share``: the part of each cell
    that belongs to its set, all of it by default.

    The darts in a cell arrive as a Poisson process over the rank: the distances between them
    are exponential, each from a hash of the cell and the number of the dart. Darts up to the rank
    within which about k (ln k + 2) are expected are made; for sets of which a coordinate stays
    empty, the bound is doubled.
    """
    sets = len(many)
    out = np.zeros((sets, k), HASH)
    open_ = np.arange(sets)
    starts = np.cumsum(many) - many
    weight = many.astype(float) if share is None else np.add.reduceat(share, starts)
    bounds = k * (np.log(k) + 2) / np.maximum(weight, 1e-12)
    chosen = np.repeat(np.arange(sets), many)
    while len(open_):
        live, of, part = cells, chosen, share
        rank, bound = np.zeros(len(cells)), bounds[of]
        darts, ranks, owners, number = [], [], [], 0
        while len(live):
            rank = rank - np.log(_uniform(mix(live, 2 * number + 1)))
            near = np.flatnonzero(rank < bound)
            live, rank, of, bound = live[near], rank[near], of[near], bound[near]
            dart = mix(live, 2 * number + 2)
            hit = slice(None)
            if part is not None:
                part = part[near]
                hit = np.flatnonzero(_uniform(mix(dart, 77)) < part)
            darts.append(dart[hit])
            ranks.append(rank[hit])
            owners.append(of[hit])
            number += 1
        order = np.argsort(-np.concatenate(ranks))
        dart, owner = np.concatenate(darts)[order], np.concatenate(owners)[order]
        kept, filled = np.zeros((sets, k), HASH), np.zeros((sets, k), bool)
        coordinate = (dart % HASH(k)).astype(np.int64)
        kept[owner, coordinate] = dart  # the last one written is the earliest
        filled[owner, coordinate] = True
        full = filled[open_].all(1)
        out[open_[full]] = kept[open_[full]]
        open_ = open_[~full]
        bounds[open_] *= 2
        again = np.isin(chosen, open_)
        cells, chosen, share = cells[again], chosen[again], None if share is None else share[again]
    return out


def band_keys(sigs: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each signature, different from band to band."""
    parts = sigs.reshape(len(sigs), bands, rows)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=HASH), (len(sigs), bands))
    for k in range(rows):
        total = mix(total ^ parts[:, :, k], k)
    return total


def _lists(values: np.ndarray, many: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), pa.array(values))


def _sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n (cells), bands of documents with text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, most_bytes=1 << 20):
            cells, many = shingler.cells(batch.column(1).to_pylist())
            full = many[many > 0]
            keys = band_keys(signatures(cells, full)).ravel().view(np.int64) if len(full) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(many, pa.int32()), _lists(keys, np.where(many > 0, BANDS, 0))],
                names=["doc_id", "digest", "n", "bands"])

    return docs.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")).mapInArrow(
        work, "doc_id bigint, digest binary, n int, bands array<bigint>")


def _cells(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and 32-bit cells of the documents named in ``ids``. Within a document of n cells
    a share of about n / 2^33 coincides."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, most_bytes=1 << 20):
            cells, many = shingler.cells(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists((cells >> HASH(32)).astype(np.uint32).view(np.int32), many)], names=["doc_id", "cells"])

    # the plan is to be the same at every size: neither side is small by nature
    return docs.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(work, "doc_id bigint, cells array<int>")


def verify(pairs: DataFrame, cells: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) with at least this weighted Jaccard similarity of their whole texts."""
    left = cells.select(F.col("doc_id").alias("a"), F.col("cells").alias("cells_a"))
    right = cells.select(F.col("doc_id").alias("b"), F.col("cells").alias("cells_b"))
    common = F.size(F.array_intersect("cells_a", "cells_b"))
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(
        common >= similarity * (F.size("cells_a") + F.size("cells_b") - common)).select("a", "b")


def joining_links(cells: list[np.ndarray], classes: np.ndarray, side: np.ndarray | None, similarity: float) -> list[tuple[int, int]]:
    """Pairs of documents of at least this similarity, enough of them to join all classes that
    such pairs join. ``side``: compare only documents of different sides, if given."""
    many = np.array([len(c) for c in cells], dtype=np.float32)
    _, term, uses = np.unique(np.concatenate(cells), return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(len(cells)), many.astype(np.int64))
    shared = uses[term] > 1
    doc, term = doc[shared], np.unique(term[shared], return_inverse=True)[1]
    common = np.zeros((len(cells), len(cells)), np.float32)
    order = np.argsort(term, kind="stable")
    doc, term = doc[order], term[order]
    for low in range(0, int(term[-1]) + 1 if len(term) else 0, 4096):
        a, b = np.searchsorted(term, [low, low + 4096])
        grid = np.zeros((len(cells), 4096), np.float32)
        grid[doc[a:b], term[a:b] - low] = 1
        common += grid @ grid.T
    linked = common >= similarity * (many[:, None] + many[None, :] - common)
    linked &= classes[:, None] != classes[None, :]
    if side is not None:
        linked &= side[:, None] != side[None, :]
    root = {c: c for c in classes.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for k in np.flatnonzero(linked.any(1)).tolist():
        others = np.flatnonzero(linked[k])
        _, first = np.unique(classes[others], return_index=True)
        for j in others[first].tolist():
            x, y = find(int(classes[k])), find(int(classes[j]))
            if x != y:
                root[x] = y
                out.append((k, j))
    return out


def _blocked(rows: DataFrame, cells: DataFrame, similarity: float) -> DataFrame:
    """Joining links (a, b) of buckets of any size. ``rows``: key, id, class, members."""
    dealt = rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    # a document meets every block once; two blocks meet in one group
    meets = dealt.select("key", "id", "class", "own", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other"))
    grouped = meets.select("key", "id", "class", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        ids, classes = table.column("id").to_numpy(), table.column("class").to_numpy()
        lists = table.column("cells").combine_chunks()
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        found = joining_links([values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], classes, None if i[0] == j[0] else own, similarity)
        return pa.table({"a": pa.array([ids[x] for x, _ in found], pa.int64()), "b": pa.array([ids[y] for _, y in found], pa.int64())})

    full = grouped.join(cells.select(F.col("doc_id").alias("id"), "cells").hint("merge"), "id")
    return full.groupBy("key", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest id of its class), kept (it is that one), one row per document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    full = own.where(F.col("doc_id").isNotNull() & (F.length("text") > 0))
    sketches = stored(_sketches(full), "sketches")
    # aggregates are written before they are joined: with two plain sides a hot key is split
    copies = stored(sketches.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "copies")
    member = sketches.select("doc_id", "digest").join(copies, "digest", "left").select("doc_id", F.coalesce("first", "doc_id").alias("first"))
    single = sketches.join(copies, "digest", "left").where("first is null or first = doc_id")
    banded = single.select(F.col("doc_id").alias("id"), "n", F.explode("bands").alias("key"))
    buckets = stored(banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last").drop("last"), "hubs")
    # (key, id, n, hub) of every document that shares a band with another one
    shared = stored(banded.join(buckets, "key"), "buckets")
    cells = stored(_cells(full, shared.select(F.col("id").alias("doc_id")).distinct()), "cells")

    close = lambda a, b: F.least(a, b) >= similarity * F.greatest(a, b)  # noqa: E731  sizes allow the similarity
    hubs = shared.where("id = hub").select("key", F.col("n").alias("hub_n")).distinct()
    spokes = shared.where("id <> hub").join(hubs, "key").where(close(F.col("n"), F.col("hub_n"))).groupBy("id", "hub").agg(F.count("*").alias("times"))
    best = spokes.groupBy("id").agg(F.max(F.struct("times", (-F.col("hub")).alias("hub"))).alias("best"))
    links = stored(verify(best.select(F.col("id").alias("a"), (-F.col("best.hub")).alias("b")), cells, similarity), "links")

    classes = components(links, "a", "b")
    placed = stored(shared.select("key", "id", "n").distinct().join(classes, F.col("id") == F.col("node"), "left")
                    .select("key", "id", "n", F.coalesce("component", "id").alias("class")), "placed")
    split = placed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("members")).where("low <> high").select("key", "members")
    open_ = stored(placed.join(split, "key"), "open")
    few = open_.where(F.col("members") <= FEW)
    x, y = few.alias("x"), few.alias("y")
    rest = (x.join(y, F.col("x.key") == F.col("y.key"))
            .where((F.col("x.id") < F.col("y.id")) & (F.col("x.class") != F.col("y.class")) & close(F.col("x.n"), F.col("y.n")))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    more = stored(verify(rest, cells, similarity).union(_blocked(open_.where(F.col("members") > FEW), cells, similarity)), "more")

    final = components(links.union(more), "a", "b")
    found = member.join(final, F.col("first") == F.col("node"), "left").select(
        "doc_id", F.coalesce("component", "first").alias("class_id")).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    alone = own.where(F.col("doc_id").isNull() | (F.coalesce(F.length("text"), F.lit(0)) == 0)).select("doc_id").distinct()
    alone = alone.join(found, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("class_id"))
    return found.union(alone).select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
