"""Helpers of the operators: written intermediates, bounded samples, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from citytrips.session import shared_folder
from citytrips.sources.tables import remove

HASH = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark from wherever the folder lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: cuts the lineage,
    and survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes tables made by ``stored`` that no later step reads: what was built from them must be
    written itself, else a lost executor could not be made good."""
    for df in frames:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            remove(df.sparkSession, folder)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo the divisor; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by a hash of the key: the only place where rows are left
    out, used to fit classifiers. Ids are chosen first, so no text is sorted."""
    ids = df.select(key).distinct().orderBy(F.xxhash64(key), key).limit(rows)
    return df.join(F.broadcast(ids), key, "left_semi")


def with_carried(fields: str, df: DataFrame, carry: tuple[str, ...]) -> StructType:
    """The fields of a schema string, followed by those of columns that are passed through."""
    own = StructType.fromDDL(fields)
    return StructType([*own.fields, *(df.schema[c] for c in carry)])


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of the text column (at least one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        cut = np.cumsum(lengths) // most_bytes
        starts = np.flatnonzero(np.diff(cut, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # a worker lives on after its task


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser, vectorised: equal inputs give equal, well spread outputs."""
    with np.errstate(over="ignore"):
        x = x.astype(HASH) + HASH((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> HASH(30))) * HASH(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> HASH(27))) * HASH(0x94D049BB133111EB)
        return x ^ (x >> HASH(31))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected edges of longs: (node, component), the component
    named by its smallest node. Nodes without edges do not appear.

    Each round moves every node to the neighbour with the smallest hash of that round and
    contracts the edges; the graph shrinks by a constant factor in expectation, whatever
    the ids look like. Only counts reach the driver. Hot nodes are combined in the map tasks
    by ``min`` and split by adaptive skew joins. Rounds are written, so lineage stays short.
    """
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    current = stored(pairs.where("u <> v and u is not null and v is not null")
                     .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    moves: list[DataFrame] = []
    while not current.isEmpty():
        order = F.struct(F.xxhash64(F.col("v"), F.lit(len(moves))), F.col("v"))
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        own = both.select("u", F.col("u").alias("v")).distinct()
        move = stored(both.union(own).groupBy("u").agg(F.min(order)["v"].alias("to")), "moves")
        moves.append(move)
        left = move.select(F.col("u"), F.col("to").alias("x"))
        right = move.select(F.col("u").alias("v"), F.col("to").alias("y"))
        moved = current.join(left, "u").join(right, "v").where("x <> y")
        before, current = current, stored(moved.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), "edges")
        discard(before)
    if not moves:
        return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    final = moves[-1].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        step = move.select(F.col("u").alias("node"), F.col("to").alias("at"))
        onward = final.select(F.col("node").alias("at"), "root")
        final = step.join(onward, "at", "left").select("node", F.coalesce("root", "at").alias("root"))
    final = stored(final, "roots")
    names = final.groupBy("root").agg(F.min("node").alias("component"))
    return final.join(names, "root").select("node", "component")


def running_sums(df: DataFrame, key: str, order: list[str], values: list[str], name: str) -> DataFrame:
    """The rows with ``<value>_before`` for each value (longs, not null): its sum over the rows of the
    same key (a long, not null) that come earlier in the order.

    Rows are sorted in ranges, so a key of any size spreads over tasks. Each task adds up its own
    rows; a key that continues from one range to the next, at most one for each pair of
    neighbours, gets the sums of the earlier ranges added, which are as few as the ranges.
    """
    names = [f"{v}_before" for v in values]
    schema = StructType([*df.schema.fields])
    for column in names:
        schema = schema.add(column, LongType())
    schema = schema.add("_part", IntegerType())
    at, own = df.columns.index(key), [df.columns.index(v) for v in values]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, carried = TaskContext.get().partitionId(), None, [0] * len(own)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.asarray(batch.column(at))
            starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            first = run == 0 if keys[0] == last else np.zeros(n, bool)
            sums = []
            for j, k in enumerate(own):
                x = np.asarray(batch.column(k)).astype(np.int64)
                before = np.cumsum(x) - x
                before = before - before[starts][run] + first * carried[j]
                carried[j] = int(before[-1] + x[-1])
                sums.append(pa.array(before))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, pa.array(np.full(n, part, np.int32))], names=[*batch.schema.names, *names, "_part"])

    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    local = stored(ranged.mapInArrow(work, schema), name)
    ends = local.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    across = ends.select("_part", F.explode(F.array_distinct(F.array("low", "high"))).alias(key)).groupBy(key).count().where("count > 1").select(key)
    parts = local.join(F.broadcast(across), key).groupBy(key, "_part").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(key, "_part", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_{v}") for v in values])
    joined = local.join(F.broadcast(offsets), [key, "_part"], "left")
    return joined.select(*df.columns, *[(F.col(n) + F.coalesce(f"_{v}", F.lit(0))).alias(n) for n, v in zip(names, values, strict=True)])
