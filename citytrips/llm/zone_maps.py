"""Centroid clustering of vectors over Hilbert-ordered blocks with zone maps.

Vectors become integers, floor(scale * x). They are put in the order of a Hilbert curve through
their components and cut into blocks, which keep the least and the greatest value of each
component. The box of a block bounds its distance to every centroid from below and from above: a
centroid whose least distance exceeds the greatest distance of another one is no candidate. Only
candidates are compared with the block's vectors, by exact integer arithmetic.

A round adds up the vectors of each cluster within a task and then over all tasks; only one row
for each cluster (and each 30 bits of very large sums) reaches the driver.

Cases: vectors that are null, have another number of components, or hold null or non-finite
components are left out; null ids are kept, and come last among the first centroids. Repeated rows are vectors of their own. Ties
go to the centroid with the smaller number; fewer vectors than centroids make fewer centroids;
an empty table gives no rows. Components of any finite size are exact; a distance or
inertia beyond 64 bits is null. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import discard, stored

COMPONENTS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Vectors of a block.
BLOCK = 512
#: Bits of a component on the curve.
BITS = 6
#: Integers up to this size are exact in sums of products of doubles.
SMALL = 1 << 22
_LIMB = 30


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of rows of cells (0 to 2^bits - 1), as bytes that sort like them.

    The cells are turned into the transposed place bit by bit, from the highest: where a bit is set
    the lower bits of the first component are inverted, else they are exchanged with its own; then
    the bits are Gray-coded across the components."""
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(n):
            is_set = (x[i] & np.uint32(q)) != 0
            swap = np.where(is_set, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    # the highest bits of all components first
    planes = np.concatenate([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(planes.T, axis=1)]


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): doubles that hold integers, or Python integers if some are large."""
    if not values.size or np.abs(values).max() * scale < SMALL:
        return np.floor(values * scale)
    whole = [int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(v * scale)) for v in values.ravel().tolist()]
    return np.array(whole, object).reshape(values.shape)


def candidates(least: np.ndarray, greatest: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector in a box, ascending."""
    below, above = least - centroids, centroids - greatest
    nearest = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero((nearest * nearest).sum(1) <= (farthest * farthest).sum(1).min())


def _whole(matrix: np.ndarray) -> np.ndarray:
    """Python integers."""
    return np.vectorize(int, otypes=[object])(matrix)


def assign(vectors: np.ndarray, least: np.ndarray, greatest: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of the vectors of a block; equal distances go to the smaller number."""
    own = candidates(least, greatest, centroids)
    chosen = centroids[own]
    if vectors.dtype == object or chosen.dtype == object:
        vectors, chosen = _whole(vectors), _whole(chosen)
    distance = (vectors * vectors).sum(1)[:, None] - 2 * (vectors @ chosen.T) + (chosen * chosen).sum(1)
    nearest = distance.argmin(1)
    return own[nearest], distance[np.arange(len(vectors)), nearest]


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    large = any(abs(x) >= SMALL for c in centroids for x in c)
    return np.array(centroids, object if large else float)


def _packed(matrix: np.ndarray) -> bytes:
    return np.ascontiguousarray(matrix, "<f8").tobytes()


def _kept(vectors: DataFrame, components: int) -> DataFrame:
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where((F.size("v") == components) & ~bad)


def _scaled(batch: pa.Array, components: int) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, components)


def blocks(vectors: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """ids, vectors (doubles, row by row), least, greatest (of each component) of every block of the
    vectors in Hilbert order, written in the shared folder."""
    kept = _kept(vectors, components)
    if not components:
        raise ValueError("vectors need components")
    limits = kept.agg(*[f(F.col("v")[k]).alias(f"{f.__name__}_{k}") for k in range(components) for f in (F.min, F.max)]).first()
    low = np.array([limits[f"min_{k}"] or 0.0 for k in range(components)])
    high = np.array([limits[f"max_{k}"] or 0.0 for k in range(components)])
    # one grid for all components keeps the shape of the data; those that vary most turn first
    width = max(float((high / 2 - low / 2).max()) * 2, np.finfo(float).tiny)
    turn = np.argsort(low / 2 - high / 2, kind="stable")

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _scaled(batch.column(1), components)
            with np.errstate(over="ignore"):
                cells = np.clip(np.nan_to_num((values - low) / width) * 2**BITS, 0, 2**BITS - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(hilbert_keys(cells[:, turn], BITS), pa.binary()), batch.column(0), pa.array([_packed(v) for v in values], pa.binary())],
                                             names=["place", "vec_id", "v"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        data: list[bytes] = []

        def closed(n: int) -> pa.RecordBatch:
            raw = b"".join(data[:n])
            own = np.frombuffer(raw, "<f8").reshape(-1, components)
            out = pa.RecordBatch.from_arrays([pa.array([ids[:n]], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in (raw, _packed(own.min(0)), _packed(own.max(0))))],
                                             names=["ids", "vectors", "least", "greatest"])
            del ids[:n], data[:n]
            return out

        for batch in batches:
            ids += batch.column(0).to_pylist()
            data += batch.column(1).to_pylist()
            while len(ids) >= block:
                yield closed(block)
        if ids:
            yield closed(len(ids))

    placed = kept.mapInArrow(ordered, "place binary, vec_id bigint, v binary")
    placed = stored(placed.withColumn("row", F.monotonically_increasing_id()), "placed")
    # equal vectors are split by their ids, and repeated rows by their numbers
    dealt = placed.repartitionByRange("place", "vec_id", "row").sortWithinPartitions("place", "vec_id", "row")
    out = stored(dealt.select("vec_id", "v").mapInArrow(cut, "ids array<bigint>, vectors binary, least binary, greatest binary"), "blocks")
    discard(placed)
    return out


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, components: int, scale: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, clusters, distances) of each block."""
    for ids, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        raw, least, greatest = (np.frombuffer(p, "<f8").reshape(-1, components) for p in parts)
        own, least, greatest = (integers(x, scale) for x in (raw, least, greatest))
        if object in (own.dtype, least.dtype, greatest.dtype, centroids.dtype):
            least, greatest = _whole(least), _whole(greatest)
        yield ids, own, *assign(own, least, greatest, centroids if least.dtype == centroids.dtype else _whole(centroids))


def _sums(table: DataFrame, centroids: np.ndarray, components: int, scale: int) -> dict[int, tuple[int, list[int]]]:
    """(vectors, sums of the components) of each cluster that has vectors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = np.zeros((len(centroids), components), np.int64)
        counts = np.zeros(len(centroids), np.int64)
        large: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, own, cluster, _ in _assigned(batch, centroids, components, scale):
                counts += np.bincount(cluster, minlength=len(centroids))
                if own.dtype == object:
                    for c in np.unique(cluster).tolist():
                        large[c] = large.get(c, 0) + own[cluster == c].sum(0)
                else:
                    for c in np.unique(cluster).tolist():
                        small[c] += own[cluster == c].sum(0).astype(np.int64)
        rows = []
        for c in np.flatnonzero(counts).tolist():
            left = [int(x) + int(y) for x, y in zip(small[c], large.get(c, np.zeros(components, np.int64)), strict=True)]
            limb = 0
            while True:  # 30 bits at a time; the last ones keep the sign
                last = all(-(1 << _LIMB) <= x < 1 << _LIMB for x in left)
                rows.append((c, limb, int(counts[c]) if not limb else 0, left if last else [x & ((1 << _LIMB) - 1) for x in left]))
                if last:
                    break
                left, limb = [x >> _LIMB for x in left], limb + 1
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["cluster", "limb", "n", "sums"])

    parts = table.mapInArrow(work, "cluster int, limb int, n bigint, sums array<bigint>")
    added = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(components)])
    out: dict[int, tuple[int, list[int]]] = {}
    for row in added.collect():  # a row for each cluster and limb
        n, sums = out.get(row["cluster"], (0, [0] * components))
        out[row["cluster"]] = (n + row["n"], [s + (row[f"s{k}"] << _LIMB * row["limb"]) for k, s in enumerate(sums)])
    return out


def first_centroids(vectors: DataFrame, centroids: int = CENTROIDS, seed: int = SEED, components: int = COMPONENTS, scale: int = SCALE) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = _kept(vectors, components).withColumn("h", name).orderBy(F.col("h").asc_nulls_last(), "v").limit(centroids).collect()
    return [[int(x) for x in integers(np.array([row["v"]], float), scale)[0]] for row in top]


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
            components: int = COMPONENTS, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector."""
    centers = first_centroids(vectors, centroids, seed, components, scale)
    if not centers:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    table = blocks(vectors, components, block)
    for _ in range(rounds):
        for number, (n, sums) in _sums(table, _as_array(centers), components, scale).items():
            centers[number] = [s // n for s in sums]
    final = _as_array(centers)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, number, distance in _assigned(batch, final, components, scale):
                whole = [int(d) if d < 2**63 else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(number, pa.int32()), pa.array(whole, pa.int64()), pa.array([digests[k] for k in number.tolist()])],
                                                 names=["vec_id", "cluster", "distance", "centroid_sha256"])

    assigned = stored(table.mapInArrow(work, "vec_id bigint, cluster int, distance bigint, centroid_sha256 string"), "assigned")
    discard(table)
    # null if a distance is; exact beyond 64 bits, but not returned there
    added = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    of_cluster = assigned.groupBy("cluster").agg(added.alias("cluster_inertia"))
    sums = {row["cluster"]: row["cluster_inertia"] for row in of_cluster.collect()}  # a row for each cluster
    total = None if None in sums.values() else int(sum(sums.values()))
    found = {k: None if v is None or v >= 2**63 else int(v) for k, v in sums.items()}
    per_cluster = vectors.sparkSession.createDataFrame(list(found.items()), "cluster int, cluster_inertia bigint")
    inertia = F.lit(None if total is None or total >= 2**63 else total).cast("long").alias("inertia")
    return assigned.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", inertia, "centroid_sha256")
