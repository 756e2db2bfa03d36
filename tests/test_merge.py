"""Merge, replacement and high-water marks."""

from __future__ import annotations

from datetime import datetime

import pytest
from citytrips.operators import merge
from citytrips.operators.dedup import keep_first
from citytrips.sources import keyindex, tables
from conftest import values
from pyspark.sql import functions as F

SCHEMA = "k string, t timestamp_ntz, v int"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(spark, *items, schema=SCHEMA):
    return spark.createDataFrame(list(items), schema)


A, B = at("2025-01-10 05:00:00"), at("2025-02-10 06:00:00")


def test_merge_replaces_by_key_and_matches_nulls(spark):
    target = rows(spark, ("a", A, 1), ("b", None, 2), ("c", B, 3))
    batch = rows(spark, ("b", None, 20), ("d", A, 4))
    once = merge.merge_by_key(target, batch, ["k", "t"])
    assert values(once, "k", "v") == [("a", 1), ("b", 20), ("c", 3), ("d", 4)]
    twice = merge.merge_by_key(once, batch, ["k", "t"])
    assert values(twice) == values(once)


def test_merge_brings_a_new_column(spark):
    batch = rows(spark, ("a", A, 9)).withColumn("extra", F.lit("x"))
    merged = merge.merge_by_key(rows(spark, ("a", A, 1), ("b", A, 2)), batch, ["k"])
    assert values(merged, "k", "v", "extra") == [("a", 9, "x"), ("b", 2, None)]


def test_copies_within_a_batch_collapse(spark):
    batch = rows(spark, ("a", A, 1), ("a", A, 3), ("a", A, 2))
    assert values(keep_first(batch, ["k"], [F.col("v").desc()]), "v") == [(3,)]


def test_replace_by_key_follows_the_batch_schema(spark):
    target = rows(spark, ("a", A, 1), ("b", A, 2))
    batch = rows(spark, ("b", B, 5)).drop("v").withColumn("w", F.lit(1.5))
    assert values(merge.replace_by_key(target, batch, "k")) == [("a", A, None), ("b", B, 1.5)]


def test_high_water_mark_is_strict(spark):
    target = rows(spark, ("a", A, 1))
    trips = rows(spark, ("same", A, 1), ("older", at("2025-01-01 00:00:00"), 1), ("newer", B, 1)
                 ).withColumnRenamed("t", "pickup_datetime")
    done = target.withColumnRenamed("t", "pickup_datetime")
    assert values(merge.new_trips(trips, done), "k") == [("newer",)]
    assert values(merge.new_trips(trips, done, lookback_minutes=1), "k") == [("newer",), ("same",)]
    assert merge.new_trips(trips, done, start="2025-01-10").count() == 2
    assert merge.new_trips(trips, None).count() == 3
    assert merge.new_trips(trips, done.limit(0)).count() == 3


def test_a_partly_loaded_hour_is_not_computed_again(spark):
    trips = rows(spark, ("in", at("2025-01-10 05:59:00"), 1), ("next", at("2025-01-10 06:00:00"), 1)
                 ).withColumnRenamed("t", "pickup_datetime")
    hours = spark.createDataFrame([(A,)], "hour_timestamp timestamp_ntz")
    assert values(merge.new_hours(trips, hours), "k") == [("next",)]
    assert merge.new_hours(trips, None).count() == 2


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")

    def put(*items, movable=None, **extra):
        batch = rows(spark, *items).withColumn(
            tables.MONTH, F.year("t") * 100 + F.month("t"))
        for name, value in extra.items():
            batch = batch.withColumn(name, F.lit(value))
        landed = tables.stage(batch, str(tmp_path / "staging"))
        tables.merge_into(spark, path, landed, ["k"], movable)
        return tables.read_table(spark, path, evolving=True)

    put.path = path
    return put


def test_table_merge_touches_only_its_months(spark, table, tmp_path):
    table(("a", A, 1), ("b", B, 2))
    january = {f.name for f in (tmp_path / "table" / "pickup_month=202501").glob("*.parquet")}
    table(("b", B, 20), ("c", B, 3))
    assert january == {f.name for f in (tmp_path / "table" / "pickup_month=202501").glob("*.parquet")}
    assert values(table(("b", B, 20)), "k", "v") == [("a", 1), ("b", 20), ("c", 3)]


def test_table_merge_moves_rows_between_months(table, tmp_path):
    table(("a", A, 1), ("b", B, 2))
    moved = table(("a", B, 10), movable=())
    assert values(moved, "k", "t", "v") == [("a", B, 10), ("b", B, 2)]
    assert not (tmp_path / "table" / "pickup_month=202501").exists()


def test_table_merge_moves_only_rows_that_may(table):
    table(("a", A, 1), ("b", A, 2), ("c", A, 2))
    moved = table(("b", B, 2), movable=("v", "2"))
    assert values(moved, "k", "t") == [("a", A), ("b", B), ("c", A)]


def test_key_index_names_the_months_of_known_keys_only(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "BUCKET_KEYS", 20)
    monkeypatch.setattr(keyindex, "BITMAP", 64)
    many = [(f"k{i}", A if i % 3 else B, i) for i in range(200)]
    table(*many, movable=())
    tables.ensure_index(spark, table.path, ["k"])
    buckets, blocks = keyindex._shape(spark, table.path)
    assert buckets == 10 and blocks > 1
    batch = rows(spark, *many[::7], ("new", A, 1), (None, B, 2)).withColumn(tables.MONTH, F.lit(202512))
    hashes = keyindex._dealt(keyindex.hashed(batch, ["k"]), buckets)
    found = keyindex.held(spark, table.path, hashes, blocks)
    want = {k: 202501 if i % 3 else 202502 for i, (k, _, _) in list(enumerate(many))[::7]}
    named = hashes.drop(tables.MONTH).join(found, "h").join(
        keyindex.hashed(batch.select("k", tables.MONTH), ["k"]).drop(tables.MONTH), "h")
    assert named.count() == len(want)
    keys = batch.select("k", F.xxhash64("k", F.col("k").isNull()).alias("h")).join(found, "h")
    assert {r["k"]: r[tables.MONTH] for r in keys.collect()} == want


def test_new_keys_read_no_key_of_other_months(spark, table, tmp_path):
    table(*[(f"k{i}", A, i) for i in range(50)], movable=())
    table(("x", B, 1), movable=())  # builds the index
    buckets, blocks = keyindex._shape(spark, table.path)
    batch = rows(spark, ("y", B, 1), ("z", B, 2)).withColumn(tables.MONTH, F.lit(202502))
    hashes = keyindex._dealt(keyindex.hashed(batch, ["k"]), buckets)
    assert keyindex.possible(spark, table.path, hashes, blocks).isEmpty()
    january = tmp_path / "table" / "pickup_month=202501"
    for file in january.glob("*.parquet"):
        file.write_bytes(b"unreadable")  # no row of January may be opened
    for file in january.glob(".*.crc"):
        file.unlink()
    table_merge = tables.stage(batch, str(tmp_path / "more"))
    tables.merge_into(spark, table.path, table_merge, ["k"], ())
    assert values(spark.read.parquet(f"{table.path}/pickup_month=202502"), "k") == [("x",), ("y",), ("z",)]


def test_merges_by_index_equal_a_scan_of_all_keys(spark, table):
    import random

    r, want = random.Random(4), {}
    times = [A, B, at("2025-03-05 00:00:00"), at("2025-06-01 00:00:00")]
    for _ in range(6):
        batch = {f"k{r.randint(0, 25)}" if r.random() < 0.9 else None: (r.choice(times), r.randint(0, 9)) for _ in range(12)}
        want.update(batch)
        got = table(*[(k, *v) for k, v in batch.items()], movable=())
        assert values(got, "k", "t", "v") == sorted(((k, *v) for k, v in want.items()), key=repr)
    again = keyindex._filters(spark, table.path).count()
    table(*[(k, *v) for k, v in batch.items()], movable=())
    hashes = spark.read.parquet(f"{keyindex.folder(table.path)}/hashes")
    assert hashes.count() == hashes.select("h", tables.MONTH).distinct().count()
    assert keyindex._filters(spark, table.path).count() == again  # nothing new to note


def test_replacing_a_table_removes_its_index(spark, table):
    table(("a", A, 1), movable=())
    table(("a", B, 1), movable=())
    assert tables.exists(spark, keyindex.folder(table.path))
    fresh = rows(spark, ("b", A, 5)).withColumn(tables.MONTH, F.lit(202501))
    tables.write_table(fresh, table.path, tables.MONTH)
    assert not tables.exists(spark, keyindex.folder(table.path))
    assert values(table(("b", B, 6), movable=()), "k", "t", "v") == [("b", B, 6)]


def test_table_merge_accepts_new_columns(table):
    table(("a", A, 1), ("b", B, 2))
    grown = table(("c", B, 3), extra="new")
    assert values(grown, "k", "v", "extra") == [("a", 1, None), ("b", 2, None), ("c", 3, "new")]
    assert values(table(("d", A, 4)), "k", "extra") == [
        ("a", None), ("b", None), ("c", "new"), ("d", None)]


def test_materialisation_modes(spark, tmp_path):
    df = rows(spark, ("a", A, 1))
    for mode in ("view", "table", "ephemeral"):
        got = tables.materialize(df, mode, "made", str(tmp_path / "made"))
        assert values(got) == values(df)
    with pytest.raises(ValueError):
        tables.materialize(df, "other", "made")
    assert tables.read_table(spark, str(tmp_path / "nothing")) is None


def test_keys_of_a_large_batch_are_not_broadcast(spark, tmp_path, monkeypatch):
    """A landed batch whose files are small enough for Spark to broadcast its keys."""
    monkeypatch.setattr(tables, "FEW_KEYS", 1)
    monkeypatch.setattr(keyindex, "FEW_KEYS", 1)
    plans, plain = [], tables.without_keys_of

    def seen(*arguments, **options):
        plans.append(plain(*arguments, **options))
        return plans[-1]

    monkeypatch.setattr(tables, "without_keys_of", seen)
    path = str(tmp_path / "t")
    batch = tables.stage(rows(spark, ("a", A, 1), ("b", A, 2)).withColumn(tables.MONTH, F.lit(202501)),
                         str(tmp_path / "batch"))
    for _ in range(2):
        tables.merge_into(spark, path, batch, ["k"], ())
    assert values(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 2)]
    hashes = keyindex._dealt(keyindex.hashed(batch, ["k"]), 1)
    found = keyindex.held(spark, path, hashes, 1)
    assert found.count() == 2
    for plan in (plans[-1], found):
        executed = plan._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [k" not in executed and "BroadcastHashJoin [h" not in executed
        assert "SortMergeJoin" in executed
    few = plain(batch, batch, ["k"], few=True)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in few


def test_months_replaced_whole_shuffle_keys_only(spark, tmp_path, monkeypatch):
    """All rows come again, one of them in another month: the table's rows are not joined."""
    monkeypatch.setattr(tables, "FEW_KEYS", 0)
    joined, plain = [], tables.without_keys_of

    def seen(target, *arguments, **options):
        joined.append(target.columns)
        return plain(target, *arguments, **options)

    monkeypatch.setattr(tables, "without_keys_of", seen)
    path, month = str(tmp_path / "t"), F.month("t").cast("int") + 202500
    first = rows(spark, ("a", A, 1), ("b", B, 2)).withColumn(tables.MONTH, month)
    tables.merge_into(spark, path, tables.stage(first, str(tmp_path / "one")), ["k"], ())
    again = rows(spark, ("a", A, 3), ("b", A, 4)).withColumn(tables.MONTH, month)
    tables.merge_into(spark, path, tables.stage(again, str(tmp_path / "two")), ["k"], ())
    assert joined == [["k"]]
    spark.catalog.refreshByPath(path)
    assert values(spark.read.parquet(path), "k", "v", tables.MONTH) == [("a", 3, 202501), ("b", 4, 202501)]
    assert tables.months_present(spark, path) == {202501}


def test_few_rows_that_stay_are_picked_by_their_keys(spark, tmp_path, monkeypatch):
    """One row without a key stays beside a large batch that lies by month; one moves its month."""
    monkeypatch.setattr(tables, "FEW_KEYS", 1)
    joined, plain = [], tables.without_keys_of

    def seen(target, *arguments, **options):
        joined.append(target.columns)
        return plain(target, *arguments, **options)

    monkeypatch.setattr(tables, "without_keys_of", seen)
    path, month = str(tmp_path / "t"), F.month("t").cast("int") + 202500
    first = rows(spark, ("a", A, 1), ("b", B, 2), (None, A, 5)).withColumn(tables.MONTH, month)
    tables.merge_into(spark, path, tables.stage(first, str(tmp_path / "one")), ["k"], ())
    again = rows(spark, ("a", A, 3), ("b", A, 4)).withColumn(tables.MONTH, month)
    shuffled, write = [], tables._write_months
    monkeypatch.setattr(tables, "_write_months", lambda *a: (shuffled.append(not a[5]), write(*a)))
    tables.merge_into(spark, path, tables.stage(again, str(tmp_path / "two")), ["k"], (), ("t",), dealt=True)
    assert joined == [["k"]] and shuffled == [False]
    spark.catalog.refreshByPath(path)
    assert values(spark.read.parquet(path), "k", "v", tables.MONTH) == [
        ("a", 3, 202501), ("b", 4, 202501), (None, 5, 202501)]
    assert tables.months_present(spark, path) == {202501}
