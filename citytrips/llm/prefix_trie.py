"""Prefix trie of conversations, by hashes of blocks of turns.

The turns of a conversation are cut into blocks of BLOCK turns. A block of turns is known by the
digest of its own turns and by the digest of all blocks before it, which is a sum over those blocks and
so needs no walk along the conversation. Conversations are grouped by block first; turns are looked
at only once for each different block. Where all conversations that go on after some blocks share the next
block, its turns have the same members as the block itself. Only where siblings diverge are the
turns within their blocks grouped one by one.

The sums over subtrees need no walk either. Every node belongs to its smallest member, and
the nodes that belong to a conversation are the last ones of its path. So a subtree is made of the rest of its
owner's path and of all that belongs to its other members, which is added up block by block.

Cases: null role or text is empty; null turns come first; turns with equal numbers are ordered by the
SHA-256 of length of role, role and text; repeated rows are turns of their own. Rows without a conv_id belong to no
conversation. A conversation without rebuilt turns is a member of the root alone. An empty table has no root and
gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrips.llm.common import running_sums, stored

#: Turns of a block.
BLOCK = 4
#: Conversations of a family share the first turns of its first one: at most FEW - 1 of them.
FAMILY, FEW = 20, 4
#: Bytes of ids that are hashed at once.
PIECE = 1 << 18
#: The words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_SUMS = ["s0", "s1", "s2", "s3"]


def digested(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (of role and text, 16 bytes), words, row; without the texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    own = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(digest, 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return stored(own.withColumn("row", F.monotonically_increasing_id()), "turns")


def rebuilt(conversations: DataFrame, family: int = FAMILY, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id), and their turns (conv_id, place, digest, words): the first h turns
    of the first conversation of the family, then the own ones after the first h."""
    turns = digested(conversations)
    ranked = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest", "row")
    # the rank filter runs in the map tasks already: a conversation of any size shuffles a few turns a task
    heads = stored(turns.withColumn("k", F.row_number().over(ranked)).where(F.col("k") <= max(1, few - 1)).select("conv_id", "k", "digest", "words"), "heads")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % few
    everyone = heads.where("k = 1").select("conv_id")
    first = heads.select(F.col("conv_id").alias("base"), "k", "digest", "words")
    shared = everyone.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(first, "base").where(F.col("k") <= taken)
    rows = shared.select("conv_id", F.lit(0).alias("own"), F.col("k").cast("long").alias("turn"), "digest", "words", F.lit(0).cast("long").alias("row")).union(
        turns.select("conv_id", F.lit(1), F.col("turn"), "digest", "words", "row"))
    # null turns come first, also in ranges: Spark sorts nulls first by default
    rows = rows.withColumn("is_own", F.col("own").cast("long")).withColumn("is_shared", F.lit(1).cast("long") - F.col("own"))
    counted = running_sums(rows, "conv_id", ["own", "turn", "digest", "row"], ["is_own", "is_shared"], "places")
    place = F.col("is_shared_before") + F.when(F.col("own") == 1, F.col("is_own_before") - taken).otherwise(0)
    placed = counted.where((F.col("own") == 0) | (F.col("is_own_before") >= taken))
    return everyone, placed.select("conv_id", place.alias("place"), "digest", "words")


def _key(number: Column, sums: list) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", number.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


def turn_blocks(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, block, up (key of the node before the block), content (digest of its turns), keys (of the
    nodes of its turns), words (of the turns)."""
    held = turns.groupBy("conv_id", F.floor(F.col("place") / block).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("turns"))  # a block's turns at most
    joined = F.aggregate(F.col("turns.digest"), F.lit(b""), lambda a, d: F.concat(a, d))
    held = held.withColumn("content", F.md5(joined))
    keyed = F.md5(F.concat_ws(":", F.col("block").cast("string"), "content").cast("binary"))
    held = held.select("conv_id", "block", "turns", "content", *[F.conv(F.substring(keyed, 1 + 8 * k, 8), 16, 10).cast("long").alias(s) for k, s in enumerate(_SUMS)])
    summed = running_sums(held, "conv_id", ["block"], _SUMS, "blocks")
    up = _key(F.col("block"), [F.col(f"{s}_before") for s in _SUMS])
    after = _key(F.col("block") + 1, [F.col(f"{s}_before") + F.col(s) for s in _SUMS])
    inner = F.transform(F.col("turns.digest"), lambda _, i: F.when(i + 1 == block, F.col("after")).otherwise(
        F.unhex(F.md5(F.aggregate(F.slice(F.col("turns.digest"), F.lit(1), i + 1), F.col("up"), lambda a, d: F.concat(a, d))))))
    return stored(summed.withColumn("up", up).withColumn("after", after).select(
        "conv_id", "block", "up", "content", inner.alias("keys"), F.col("turns.words").alias("words")), "turn-blocks")


def _nodes(blocks: DataFrame, everyone: DataFrame, root: Column, block: int) -> DataFrame:
    """key, up, depth, conv_id (smallest member), n_convs, words."""
    different = stored(blocks.groupBy("up", "content").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("block").alias("block"), F.first("keys").alias("keys"), F.first("words").alias("words")), "different")
    siblings = different.groupBy("up").agg(F.count("*").alias("siblings"))
    turns = different.join(siblings, "up").select("up", "block", "n_convs", "conv_id", "keys", "siblings", F.posexplode(F.arrays_zip("keys", "words")).alias("i", "turn"))
    turns = turns.select(F.col("turn.keys").alias("key"), F.when(F.col("i") == 0, F.col("up")).otherwise(F.get("keys", F.col("i") - 1)).alias("up"),
                         (F.col("block") * block + F.col("i") + 1).alias("depth"), "conv_id", "n_convs", F.col("turn.words").alias("words"), "siblings")
    alone = turns.where("siblings = 1").drop("siblings")
    refined = turns.where("siblings > 1").groupBy("key").agg(
        F.first("up").alias("up"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("words").alias("words"))
    top = everyone.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        root.alias("key"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"))
    return stored(alone.unionByName(refined).unionByName(top), "nodes")


def _ends(everyone: DataFrame, blocks: DataFrame, root: Column) -> DataFrame:
    """key, ends_sha256 of the nodes at which conversations end. The ids of a node are joined in
    pieces by many tasks; one task hashes the pieces one after the other."""
    last = blocks.groupBy("conv_id").agg(F.max_by(F.element_at("keys", -1), "block").alias("key"))
    ends = stored(everyone.join(last, "conv_id", "left").select(F.coalesce("key", root).alias("key"), "conv_id"), "ends")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, size = None, None, 0
        held: list[str] = []
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.binary(), pa.int64(), pa.string()], strict=True)], names=["key", "first", "piece"])
            rows.clear()
            return out

        for batch in batches:
            for own, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (own != key or size >= PIECE):
                    rows.append((key, first, ",".join(held)))
                    held, size = [], 0
                    if len(rows) >= 1000:
                        yield packed()
                if not held:
                    key, first = own, conv_id
                held.append(str(conv_id))
                size += len(held[-1]) + 1
        if held:
            rows.append((key, first, ",".join(held)))
        if rows:
            yield packed()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for own, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            if done:
                yield _digests(done)
        if key is not None:
            yield _digests([(key, state.hexdigest())])

    ranged = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").select("key", "conv_id")
    pieces = ranged.mapInArrow(join, "key binary, first bigint, piece string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "piece").mapInArrow(digest, "key binary, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.binary(), pa.string()], strict=True)], names=["key", "ends_sha256"])


def trie(everyone: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every
    node. ``everyone``: the different conv_id; ``turns``: conv_id, place (0, 1, …), digest, words."""
    root = _key(F.lit(0), [F.lit(0)] * 4)
    blocks = turn_blocks(turns, block)
    nodes = _nodes(blocks, everyone, root, block)
    children = nodes.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("height", -F.col("depth"))
    nodes = stored(running_sums(nodes, "conv_id", ["height"], ["saved", "leaf"], "owned"), "summed")

    # what belongs to a conversation counts in all nodes of its path above the first one of its own
    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    above = F.least(F.size("keys"), (F.col("top") - 1 - F.col("block") * block).cast("int"))
    passed = blocks.join(owners.where("top > 0 and (saved > 0 or leaf > 0)"), "conv_id").withColumn("above", above).where("above > 0")
    passed = passed.groupBy("up", "content", "above").agg(F.first("keys").alias("keys"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    others = passed.select(F.explode(F.slice("keys", F.lit(1), F.col("above"))).alias("key"), "saved", "leaf").groupBy("key").agg(
        F.sum("saved").alias("other_saved"), F.sum("leaf").alias("other_leaf"))
    at_root = owners.where("top > 0").agg(F.sum("saved").alias("other_saved"), F.sum("leaf").alias("other_leaf")).where("other_saved is not null")
    others = others.unionByName(at_root.withColumn("key", root))

    parents = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(others, "key", "left").join(parents, "up", "left").join(_ends(everyone, blocks, root), "key", "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf_before") + F.col("leaf") + F.coalesce("other_leaf", zero)).alias("n_leaves"),
        (F.col("saved_before") + F.col("saved") + F.coalesce("other_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, family: int = FAMILY, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(conversations, family, few), block)
