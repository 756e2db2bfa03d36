"""Removal of passages that occur more than once, byte-exact, over all documents.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. To bring the
starts of equal strings together without comparing all, every document is winnowed: of each
``length`` bytes the gram with the smallest hash is an anchor, so equal strings hold the same anchor
at the same place. What can decide about a string with a given anchor is its context, ``length`` bytes
to either side of the anchor's far end. Strings of a shorter length can be judged at the same time:
its anchors, one for each string's first bytes, serve both.

1. Neighbouring anchors of equal contexts, as in runs of a character, are one. Anchors whose gram occurs once are dropped.
2. Equal contexts are one class; a class of several members is repeated as a whole.
3. Different contexts of one gram form shards. A context is cut into regions, each the union of
   STEP + 1 strings that follow each other; all of them hold the region's core. Equal regions are
   repeated. Unequal regions with equal cores differ in a few bytes at their ends only: with a
   number for the core they are short strings, whose suffix array is built by induced sorting. Runs
   of common prefixes of full length show which strings are repeated.
4. Grams with more contexts than a task should hold are dealt out by the cores of their regions:
   regions whose core is unique are dropped, the others are solved in the same way. A core with very many
   different regions is dealt out once more, by the bytes beside the core in each of its strings.

Cases: null text is empty; texts shorter than ``length`` bytes lose nothing. Null ids are ids. Repeated rows are
documents of their own: they repeat each other. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrips.llm.common import HASH, discard, mix, slices, stored, with_carried
from citytrips.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 400
GRAM = 32
#: Strings of a region, less one.
STEP = 45
#: Grams with more contexts than this, and cores with more regions, are dealt out further.
MOST_CONTEXTS = 16384
#: Contexts that are solved together, about, and rows of one suffix array, about.
SHARD_BYTES, ARRAY_ROWS = 4 << 20, 8192
#: Documents are winnowed in blocks of this many bytes.
BLOCK = 1 << 23
_TABLE = mix(np.arange(256, dtype=HASH), 5)


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of a text, and the hashes of their grams: the rightmost smallest
    hash of every window of ``length`` bytes. ``gram`` is a power of two."""
    found, hashes = [], []
    window = length - gram + 1
    for start in range(0, max(len(data) - length, 0) + 1, BLOCK):
        block = np.frombuffer(data, np.uint8)[start:start + BLOCK + length - 1]
        if len(block) < length:
            break
        h, factor, width = _TABLE[block], 0x9E3779B97F4A7C15, 1
        with np.errstate(over="ignore"):
            while width < gram:
                h = h[:-width] * HASH(factor) + h[width:]
                factor, width = factor * factor % 2**64, width * 2
            h = mix(h)
        n = len(h)
        low = HASH((1 << 24) - 1)
        key = (h & ~low) | (low - np.arange(n, dtype=HASH))
        padded = np.full(-(-n // window) * window, np.iinfo(HASH).max)
        padded[:n] = key
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[:n - window + 1], ahead[window - 1:n])
        at = (low - (least & low)).astype(np.int64)
        at = at[np.flatnonzero(np.diff(at, prepend=-1))]
        found.append(at + start)
        hashes.append(h[at])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, HASH)
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(hashes)[first]


def repeated_starts(text: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, documents: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows, ascending, and offsets in them at which a string starts that also starts elsewhere. ``text``:
    rows of ``sizes`` symbols (2 to size - 1), a 1 after each, 0 at the end. ``lengths``: of the strings
    of each row; rows with different lengths share no string that is as long as the shorter one. ``documents`` and
    ``places``: where the rows lie in the corpus; rows may overlap there, and the same place is not elsewhere."""
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    offset = np.arange(len(owner)) - begin[owner]
    order = suffix_array(text, size)
    common = common_prefixes(text, order)
    fits = offset + lengths[owner] <= sizes[owner]
    ranked = order[1:]
    # suffixes that are too short never lie between two with a common prefix of full length
    ranked = ranked[fits[ranked]]
    if not len(ranked):
        return ranked, ranked
    row = owner[ranked]
    d, p = documents[row], places[row] + offset[ranked]
    starts = np.flatnonzero(np.append(True, common[ranked[1:]] < lengths[row[1:]]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ranked))))
    other = (d != d[starts][group]) | (p != p[starts][group])
    hit = np.sort(ranked[np.logical_or.reduceat(other, starts)[group]])
    return owner[hit], offset[hit]


def regions(left: int, data: bytes, length: int, reach: int) -> Iterator[tuple[int, int, int, bytes, bytes, bytes]]:
    """(low, width, most, ahead, core, behind) of a context with ``left`` bytes before its anchor: each region
    is the union of strings that start up to ``most`` bytes before the anchor. All ``width`` strings that
    start from ``low`` bytes before it on hold the core, which lies between the bytes ahead and behind."""
    right = len(data) - left
    for low in range(0, reach + 1, STEP + 1):
        high = min(low + STEP, reach)
        least, most = max(low, length - right), min(high, left)
        if least <= most:
            yield low, high - low + 1, most, data[left - most:left - low], data[left - low:left - high + length], data[left - high + length:left - least + length]


def solve_cores(groups: Iterable[tuple[int, Iterable[tuple[int, int, int, bytes, bytes]]]], length: int) -> Iterator[tuple[int, int, int]]:
    """Spans (row, start, stop) of the strings repeated among regions with equal cores: groups (width, regions) of
    (row, key, place, bytes ahead of the core, bytes behind it) with different bytes. Of a string of
    ``length`` bytes all but ``width - 1`` are the core, which two symbols beyond all bytes stand for."""
    rows: list[tuple[int, int, int, int, int, int, int]] = []
    parts: list[bytes] = []
    core = 0

    def closed() -> Iterator[tuple[int, int, int]]:
        if not rows:
            return
        numbers, keys, places, widths, cores, ahead, behind = np.array(rows, np.int64).T
        base = math.isqrt(core) + 1  # few symbols, as each has a bucket of its own
        sizes = ahead + behind + 2
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(ends[-1] + 2, np.int32)  # 0: end, 1: between rows
        text[:-1] = np.frombuffer(b"".join(parts), np.uint8)
        text[:-1] += 2
        text[ends] = 1
        at = ends - behind - 2
        text[at], text[at + 1] = 258 + cores // base, 258 + cores % base
        row, offset = repeated_starts(text, sizes, widths + 1, keys, places, 258 + base)
        if len(row):
            start = places[row] + offset
            cut = np.append(True, (np.diff(row) != 0) | (np.diff(start) > length))
            stop = start[np.append(cut[1:], True)] + length
            yield from zip(numbers[row[cut]].tolist(), start[cut].tolist(), stop.tolist(), strict=True)

    for width, group in groups:
        for number, key, place, ahead, behind in group:
            rows.append((number, key, place, width, core, len(ahead), len(behind)))
            parts += (ahead, b"\0\0", behind, b"\0")
        core += 1
        if len(rows) >= ARRAY_ROWS:  # strings of different cores never match
            yield from closed()
            rows, parts, core = [], [], 0
    yield from closed()


def solve(contexts: list[tuple[int, int, int, bytes]], length: int = LENGTH, reach: int = LENGTH - GRAM) -> list[tuple[int, int, int]]:
    """Spans (number of the context, start, stop) of strings repeated among contexts (key, anchor
    position, bytes to the left of it, bytes), each place given once. ``reach``: how far before its
    anchor a string starts at most."""
    found: dict[tuple, list[int]] = {}
    cores: dict[tuple, list[tuple]] = {}
    for at, (_, _, left, data) in enumerate(contexts):
        for low, width, most, ahead, core, behind in regions(left, data, length, reach):
            region = (low, most, ahead, core, behind)
            if region in found:
                found[region].append(at)
            else:
                found[region] = [at]
                cores.setdefault((width, low, core), []).append(region)
    spans = []
    for (_, most, ahead, core, behind), members in found.items():
        if len(members) > 1:
            size = len(ahead) + len(core) + len(behind)
            spans += [(m, contexts[m][1] - most, contexts[m][1] - most + size) for m in members]
    groups = ((key[0], [(found[r][0], contexts[found[r][0]][0], contexts[found[r][0]][1] - r[1], r[2], r[4]) for r in own]) for key, own in cores.items() if len(own) > 1)
    spans += solve_cores(groups, length)
    return spans


def _keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, a key of id and text, text (null: empty)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *carry)
    return own.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text", *carry)


_ANCHORS = "key bigint, pos int, gram bigint, c1 bigint, c2 bigint, l smallint, r smallint, more int"
_SPANS = "key bigint, length int, start bigint, stop bigint"


def _anchors(keyed: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """One row per anchor: key of its document, position, hashes of gram and context, bytes of
    context to the left and right, and how far the last one of neighbours with equal contexts lies behind the first."""
    short, right_most = lengths[0], lengths[-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int32()]
        for batch in slices(batches):
            columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in kinds]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode()
                if len(data) < short:
                    continue
                at, hashes = anchors(data, short)
                left, right = np.minimum(at, short - GRAM), np.minimum(len(data) - at, right_most)
                whole = np.frombuffer(b"".join(
                    [xxhash.xxh3_128_digest(data[p - a:p + b], seed=a) for p, a, b in zip(at.tolist(), left.tolist(), right.tolist(), strict=True)]), np.int64).reshape(-1, 2)
                first = np.flatnonzero(np.append(True, (whole[1:] != whole[:-1]).any(1)))
                more = at[np.append(first[1:], len(at)) - 1] - at[first]
                for column, values in zip(columns, (np.full(len(first), key), at[first], hashes[first].view(np.int64), whole[first, 0], whole[first, 1], left[first], right[first], more), strict=True):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(k) for c, k in zip(columns, kinds, strict=True)], names=["key", "pos", "gram", "c1", "c2", "l", "r", "more"])

    return keyed.select("key", "text").mapInArrow(work, _ANCHORS)


def _contexts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, pos, l, group) with the bytes of the context, cut from the documents."""
    places = wanted.groupBy("key").agg(F.collect_list(F.struct("pos", "l", "r", "group")).alias("places"))  # bounded by the document
    joined = keyed.select("key", "text").join(places, "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for key, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                rows += [(key, p["pos"], p["l"], p["group"], data[p["pos"] - p["l"]:p["pos"] + p["r"]]) for p in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64(), pa.int32(), pa.int16(), pa.int64(), pa.binary()], strict=True)],
                names=["key", "pos", "l", "group", "context"])

    return joined.mapInArrow(work, "key bigint, pos int, l smallint, group bigint, context binary")


def _span_batch(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    """The spans (key, length, start, stop), those that meet merged."""
    spans: list[list[int]] = []
    for key, length, start, stop in sorted(found):
        if spans and spans[-1][:2] == [key, length] and start <= spans[-1][3]:
            spans[-1][3] = max(spans[-1][3], stop)
        else:
            spans.append([key, length, start, stop])
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*spans, strict=True) if spans else [[]] * 4, kinds, strict=True)], names=["key", "length", "start", "stop"])


def _sharded(contexts: DataFrame, shards: int, lengths: tuple[int, ...]) -> DataFrame:
    """Spans found in shards; the contexts of a gram stay together."""
    reach = lengths[0] - GRAM

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, bytes] = {}
        size, last = 0, None

        def solved() -> pa.RecordBatch:
            own, spans = [(*place, data) for place, data in held.items()], []
            for length in lengths:  # a string is repeated only if its first bytes are
                found = solve(own, length, reach)
                spans += [(own[k][0], length, start, stop) for k, start, stop in found]
                own = [own[k] for k in sorted({k for k, _, _ in found})]
            return _span_batch(spans)

        for batch in batches:
            for key, pos, left, group, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SHARD_BYTES and group != last:
                    yield solved()
                    held, size = {}, 0
                held[key, pos, left] = data
                size += len(data)
                last = group
        if held:
            yield solved()

    dealt = contexts.repartition(shards, "group").sortWithinPartitions("group")
    return dealt.mapInArrow(work, _SPANS)


def _dealt(contexts: DataFrame, lengths: tuple[int, ...]) -> tuple[DataFrame, list[DataFrame]]:
    """Spans of groups of any size, dealt out by the cores of their regions; and the tables to delete
    once the spans are written."""
    reach = lengths[0] - GRAM
    names = ["length", "width", "core", "key", "place", "ahead", "behind"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(length, width, xxhash.xxh3_128_digest(core, seed=low), key, pos - most, ahead, behind)
                    for key, pos, left, data in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True)
                    for length in lengths for low, width, most, ahead, core, behind in regions(left, data, length, reach)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names=names)

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple]] = {}
        count, last = 0, None

        def done() -> pa.RecordBatch:
            spans = []
            for length in lengths:
                groups = ((k[1], own) for k, own in held.items() if k[0] == length)
                spans += [(key, length, start, stop) for key, start, stop in solve_cores(groups, length)]
            return _span_batch(spans)

        for batch in batches:
            for length, width, core, key, place, ahead, behind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if count >= ARRAY_ROWS and core != last:
                    yield done()
                    held, count = {}, 0
                held.setdefault((length, width, core), []).append((key, key, place, ahead, behind))
                count, last = count + 1, core
        if held:
            yield done()

    core = ["length", "core"]
    rows = stored(contexts.mapInArrow(cut, "length int, width int, core binary, key bigint, place bigint, ahead binary, behind binary"), "cores")
    again = stored(rows.groupBy(*core).agg(F.count("*").alias("times")).where("times > 1").select(*core), "shared-cores")
    kept = stored(rows.join(again, core, "left_semi"), "regions")
    region = [*core, "ahead", "behind"]
    same = kept.groupBy(*region).agg(F.count("*").alias("times"), F.min(F.struct("key", "place", "width")).alias("first"))
    same = stored(same.select(*region, "times", "first.*"), "same-regions")
    size = F.length("ahead") + F.length("behind") + F.col("length") - F.col("width") + 1
    whole = kept.join(same.where("times > 1").select(*region), region, "left_semi").select("key", "length", F.col("place").alias("start"), (F.col("place") + size).alias("stop"))

    members = same.groupBy(*core).agg(F.count("*").alias("members")).where("members > 1")
    shared = stored(same.join(members, core).select(*names, "members"), "members")
    few = shared.where(F.col("members") <= MOST_CONTEXTS).select(*names).repartition("core").sortWithinPartitions("core").mapInArrow(solved, _SPANS)
    # of a core with very many regions: the strings of each, told apart by the bytes beside the core
    a, b, last = F.length("ahead"), F.length("behind"), F.col("width") - 1
    strings = shared.where(F.col("members") > MOST_CONTEXTS).withColumn("x", F.explode(F.sequence(F.greatest(F.lit(0), last - b), F.least(a, last))))
    strings = strings.select(*core, "x", "key", (F.col("place") + a - F.col("x")).alias("start"),
                             F.concat(F.substring("ahead", a - F.col("x") + 1, F.col("x")), F.substring("behind", F.lit(1), last - F.col("x"))).alias("beside"))
    string = [*core, "x", "beside"]
    twice = strings.groupBy(*string).agg(F.min(F.struct("key", "start")).alias("a"), F.max(F.struct("key", "start")).alias("b")).where("a <> b").select(*string)
    many = strings.join(twice, string, "left_semi").select("key", "length", "start", (F.col("start") + F.col("length")).alias("stop"))
    return whole.union(few).union(many), [rows, again, kept, same, shared]


def repeated_spans(keyed: DataFrame, lengths: tuple[int, ...] = (LENGTH,)) -> DataFrame:
    """Spans (key, length, start, stop) of bytes covered by repeated strings of each length (ascending); they may overlap."""
    spark = keyed.sparkSession
    all_anchors = stored(_anchors(keyed, lengths), "anchors")
    # written, so that the join has two plain sides and a gram with very many anchors is split
    times = F.sum(F.when(F.col("more") > 0, 2).otherwise(1))
    again = stored(all_anchors.groupBy("gram").agg(times.alias("times")).where("times > 1").select("gram"), "grams")
    shared = stored(all_anchors.join(again, "gram", "left_semi"), "shared")
    discard(all_anchors, again)

    classes = shared.groupBy("gram", "c1", "c2").agg(times.alias("times"), F.min(F.struct("key", "pos", "l", "r")).alias("first"))
    classes = stored(classes.select("gram", "c1", "c2", "times", "first.*"), "classes")
    whole = classes.where("times > 1").select("gram", "c1", "c2")
    longest = F.lit(lengths[-1]) if len(lengths) == 1 else F.when(F.col("l") + F.col("r") >= lengths[-1], lengths[-1]).otherwise(lengths[0])  # it counts for the shorter one, too
    copies = shared.join(whole, ["gram", "c1", "c2"], "left_semi").select("key", longest.alias("length"), "pos", "l", "r", "more").where("l + r >= length").select(
        "key", "length", (F.col("pos") - F.col("l")).cast("long").alias("start"), (F.col("pos") + F.col("more") + F.col("r")).cast("long").alias("stop"))

    sizes = classes.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1")
    wanted = stored(classes.select("key", "pos", "l", "r", F.col("gram").alias("group")).join(sizes.withColumnRenamed("gram", "group"), "group"), "wanted")
    small = wanted.where(F.col("members") <= MOST_CONTEXTS)
    large = wanted.where(F.col("members") > MOST_CONTEXTS)
    shards = max(1, small.count() * (lengths[0] + lengths[-1]) // (2 * SHARD_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spans = copies.union(_sharded(_contexts(keyed, small), shards, lengths))
    done = [shared, classes, wanted]
    if not large.isEmpty():
        dealt, tables = _dealt(_contexts(keyed, large), lengths)
        spans = spans.union(dealt)
        done += tables
    found = stored(spans, "spans")
    discard(*done)
    return found


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    runs: list[list[int]] = []
    for start, stop in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return runs


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and ``kept``: the
    remaining bytes as text, without code points of which a part is gone. With a ``passage``, a length
    below ``length``, also n_passage_bytes and n_passages: what strings of that length would have removed.
    Columns named in ``carry`` are passed through."""
    lengths = (length,) if passage is None else (passage, length)
    if lengths[0] < GRAM or list(lengths) != sorted(set(lengths)):
        raise ValueError(f"lengths from {GRAM} bytes on, the passage shorter than the other")
    spans = repeated_spans(_keyed(docs), lengths).groupBy("key").agg(F.collect_set(F.struct("length", "start", "stop")).alias("spans"))  # bounded by the document
    fields = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string" + (", n_passage_bytes bigint, n_passages bigint" if passage else "")
    names = [*(f.split()[0] for f in fields.split(", ")), *carry]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                runs = _merged([(s["start"], s["stop"]) for s in found or () if s["length"] == length])
                edges = [0, *(x for run in runs for x in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if runs else data
                row = (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if runs else text)
                if passage:
                    also = _merged([(s["start"], s["stop"]) for s in found or ()])  # a longer string has shorter ones all along
                    row += (sum(b - a for a, b in also), len(also))
                rows.append(row)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)), *batch.columns[3:]], names=names)

    joined = _keyed(docs, carry).join(spans, "key", "left").select("doc_id", "text", "spans", *carry)
    return joined.mapInArrow(work, with_carried(fields, docs, carry))
