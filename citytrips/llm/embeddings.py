"""Near-duplicate embeddings by a forest of random-projection trees.

Vectors of one label are split again and again: by the median of a random projection, with the
vectors near the median on both sides (spill). Many trees with different projections are grown;
vectors that share a leaf of any tree are compared exactly, in double precision, and those whose
cosine reaches the threshold are linked. Components of the links are the classes.

Trees are fitted on bounded samples: each round splits every node that holds more than LEAF vectors
by a subtree of at most LEVELS levels fitted on a sample of its vectors, and deals all vectors of
the node to the subtree's leaves. Rounds go on until no leaf is too large, so the depth follows the
data. A node whose projections coincide is not split; its vectors are compared in blocks.

Cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, nor do those with a null label or id. Equal vectors of a label are collapsed first and
counted as links of each other. Vectors of one label with different lengths are compared with
those of their length only. Repeated rows of an id count once (if their vectors differ, each may
link). Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import HASH, components, mix, stored

COSINE = 0.93
TREES, LEAF, LEVELS = 10, 256, 6
#: A subtree is fitted on this many vectors of its node, about.
SAMPLE = 4_096
#: Between these quantiles of a projection a vector goes to both sides.
SPILL = (0.44, 0.56)
#: A side may hold this share of a node's vectors at most, else the node is not split.
MOST = 0.75
#: A task compares two blocks of a leaf that is larger than this.
BLOCK = 1024


def _number(node: int, place: int) -> int:
    """The number of a place of a node's subtree, the same wherever it is computed."""
    return int(mix(np.array([node], np.int64).view(HASH), 11 + place).view(np.int64)[0])


def _direction(node: int, place: int, size: int) -> np.ndarray:
    """The random projection at a place of a node's subtree."""
    return np.random.default_rng(_number(node, place) & (2**63 - 1)).standard_normal(size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def fit_subtree(node: int, vectors: np.ndarray, leaf: int) -> np.ndarray:
    """Lower and upper bound of the spill at every place of the subtree, float32 [2^LEVELS - 1, 2];
    not a number where the subtree ends. The places below place p are 2p + 1 and 2p + 2."""
    bounds = np.full((2**LEVELS - 1, 2), np.nan, np.float32)
    open_ = [(0, _unit(vectors))]
    while open_:
        at, own = open_.pop()
        if len(own) <= leaf or at >= len(bounds):
            continue
        values = own @ _direction(node, at, own.shape[1])
        low, high = np.quantile(values, SPILL).astype(np.float32)
        left, right = values <= high, values >= low
        if max(left.sum(), right.sum()) > MOST * len(own):
            continue
        bounds[at] = low, high
        open_ += [(2 * at + 1, own[left]), (2 * at + 2, own[right])]
    return bounds


def deal(node: int, vectors: np.ndarray, bounds: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows) for all leaves of a node's subtree that its vectors reach."""
    out, open_, unit = [], [(0, np.arange(len(vectors)))], _unit(vectors)
    while open_:
        at, rows = open_.pop()
        if not len(rows):
            continue
        if at >= len(bounds) or np.isnan(bounds[at, 0]):
            out.append((_number(node, at + 1000), rows))
            continue
        values = unit[rows] @ _direction(node, at, vectors.shape[1])
        low, high = bounds[at]
        open_ += [(2 * at + 1, rows[values <= high]), (2 * at + 2, rows[values >= low])]
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def _usable(vectors: DataFrame) -> DataFrame:
    """id, label, vector of those that can link; copies of a vector within a label are one row."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    own = vectors.select(F.col("vec_id").cast("long").alias("id"), "label", F.col("embedding").cast(kind).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where("id is not null and label is not null and size(v) > 0").where(~bad & F.exists("v", lambda x: x != 0))


def _leaves(points: DataFrame, trees: int, leaf: int, sample: int) -> DataFrame:
    """(node, id, v, members): the leaves of all trees."""
    def grow(table: pa.Table) -> pa.Table:
        node, whole = table.column("node")[0].as_py(), table.column("members")[0].as_py()
        vectors = _matrix(table.column("v"))
        # a leaf of the sample stands for whole / sample as many vectors
        bounds = fit_subtree(node, vectors, max(32, int(leaf * 0.8 * len(vectors) / whole)))
        if np.isnan(bounds[0, 0]):
            return pa.table({"node": pa.array([], pa.int64()), "bounds": pa.array([], pa.list_(pa.float32()))})
        return pa.table({"node": pa.array([node], pa.int64()), "bounds": pa.array([bounds.ravel()], pa.list_(pa.float32()))})

    def deal_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, lists, bounds = batch.column(0).to_numpy(), batch.column(2), batch.column(3)
            rows_, nodes_ = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for node in np.unique(nodes).tolist():
                rows = np.flatnonzero(nodes == node)
                subtree = np.array(bounds[int(rows[0])].as_py(), np.float32).reshape(-1, 2)
                for at, own in deal(node, _matrix(lists.take(pa.array(rows))), subtree):
                    rows_.append(rows[own])
                    nodes_.append(np.full(len(own), at))
            take = pa.array(np.concatenate(rows_))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes_), pa.int64()), batch.column(1).take(take), lists.take(take)], names=["node", "id", "v"])

    kind = dict(points.dtypes)["v"]
    current = points.select(F.explode(F.array(*[F.xxhash64("label", F.size("v"), F.lit(t)) for t in range(trees)])).alias("node"), "id", "v")
    done: list[DataFrame] = []
    while True:
        # the number of vectors of each node, by a count that is combined in the map tasks
        counted = stored(current.join(current.groupBy("node").agg(F.count("*").alias("members")), "node"), "nodes")
        done.append(counted.where(F.col("members") <= leaf))
        full = counted.where(F.col("members") > leaf)
        if full.isEmpty():
            break
        chosen = full.where(F.pmod(F.xxhash64("id", "node"), F.col("members")) < sample)
        subtrees = stored(chosen.groupBy("node").applyInArrow(grow, "node bigint, bounds array<float>"), "subtrees")
        done.append(full.join(subtrees, "node", "left_anti"))  # not to be split
        current = stored(full.join(subtrees, "node").select("node", "id", "v", "bounds").mapInArrow(deal_out, f"node bigint, id bigint, v {kind}"), "dealt")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _compare(leaves: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b), a < b, within leaves; leaves that could not be split are compared in blocks."""
    def work(table: pa.Table) -> pa.Table:
        ids, own, raw = table.column("id").to_numpy(), table.column("own").to_numpy(), _matrix(table.column("v"))
        unit = _unit(raw)
        x, y = np.nonzero(np.triu(unit @ unit.T >= cosine - 1e-9, 1))
        # the exact cosine decides, computed the same way for a pair in whatever leaf
        square = np.einsum("ij,ij->i", raw, raw)
        exact = np.einsum("ij,ij->i", raw[x], raw[y]) / (np.sqrt(square[x]) * np.sqrt(square[y]))
        i, j = int(table.column("i")[0].as_py()), int(table.column("j")[0].as_py())
        keep = (exact >= cosine) & (ids[x] != ids[y]) & ((own[x] != own[y]) | (i == j))
        a, b = ids[x[keep]], ids[y[keep]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    dealt = leaves.withColumn("blocks", F.ceil(F.col("members") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    meets = dealt.select("node", "id", "v", "own", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other"))
    grouped = meets.select("node", "id", "v", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return grouped.groupBy("node", "i", "j").applyInArrow(work, "a bigint, b bigint").distinct()


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest id reachable),
    kept (vec_id = component_id), one row per id."""
    usable = _usable(vectors).dropDuplicates(["id", "label", "v"])
    # copies of a vector: one point, named by its smallest id
    keyed = stored(usable.withColumn("key", F.xxhash64("label", "v")), "vectors")
    groups = keyed.groupBy("label", "v").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    points = stored(groups.select(F.col("first").alias("id"), "label", "v", "copies"), "points")
    member = keyed.select("id", "label", "v").join(points.select("label", "v", F.col("id").alias("first"), "copies"), ["label", "v"]).select("id", "first", "copies")

    links = stored(_compare(_leaves(points.select("id", "label", "v"), trees, leaf, sample), cosine), "links")
    weight = points.groupBy("id").agg(F.sum("copies").alias("copies"))
    both = links.union(links.select("b", "a"))
    degree = both.join(weight.select(F.col("id").alias("b"), "copies"), "b").groupBy(F.col("a").alias("first")).agg(F.sum("copies").alias("linked"))
    found = components(links, "a", "b").select(F.col("node").alias("first"), "component")
    out = member.join(degree, "first", "left").join(found, "first", "left").select(
        "id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    out = out.groupBy("id").agg(F.sum("n_links").cast("long").alias("n_links"), F.min("component_id").alias("component_id"))
    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    joined = everyone.join(out, F.col("vec_id") == F.col("id"), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
