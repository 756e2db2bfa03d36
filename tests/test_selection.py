"""Exact medians by ranges, and numbers of different days and hours from bitmaps."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from citytrips.operators import distinct, selection
from conftest import values
from pyspark.sql import functions as F


def _medians(rows):
    groups = {}
    for key, *numbers in rows:
        for at, x in enumerate(numbers):
            groups.setdefault(key, ([], []))[at].append(x)
    return {k: tuple(float(np.median([x for x in own if x is not None])) if any(x is not None for x in own) else None for own in both) for k, both in groups.items()}


@pytest.mark.parametrize("ranges", [1, 2, 64])
def test_medians_of_groups(spark, ranges):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.choice([None, r.gauss(0, 9)]), float(r.randint(-3, 3))) for _ in range(999)]
    rows += [("one", 1.5, None), ("two", -1.0, 2.0), ("two", 4.0, None), ("same", 7.0, 7.0), ("same", 7.0, 7.0), ("none", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    found = selection.exact_medians(df, ["k"], {"x": F.col("x"), "y": F.col("y")}, ranges)
    want = {k: v for k, v in _medians(rows).items() if v != (None, None)}
    rounded = lambda pair: tuple(None if x is None else round(x, 9) for x in pair)
    assert {r["k"]: rounded((r["x"], r["y"])) for r in found.collect()} == {k: rounded(v) for k, v in want.items()}
    whole = selection.exact_medians(df, [], {"x": F.col("x")}, ranges).collect()
    assert [r["x"] for r in whole] == [pytest.approx(float(np.median([x for _, x, _ in rows if x is not None])))]
    assert selection.exact_medians(df.limit(0), ["k"], {"x": F.col("x")}, ranges).count() == 0


def test_one_group_is_cut_into_even_ranges(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"), F.lit("all").alias("k"))
    cut = selection.ranged(selection.counted_values(df, ["k"], {"x": F.col("x")}), 64)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * n / 64
    assert selection.exact_medians(df, ["k"], {"x": F.col("x")}).first()["x"] == (n - 1) / 2


START = datetime(1969, 12, 1)


def test_states_answer_any_range(spark):
    r = random.Random(9)
    trips = [(r.choice(["x", "y"]), START + timedelta(hours=r.choice([r.randint(0, 2000), r.randint(0, 400_000)]), minutes=r.randint(0, 59))) for _ in range(600)]
    trips.append(("x", None))
    df = spark.createDataFrame(trips, "trip_type string, pickup_datetime timestamp_ntz").withColumn("pickup_month", F.date_format("pickup_datetime", "yyyyMM"))
    half = df.filter(F.col("trip_type") == "x")
    states = distinct.merge_states(distinct.distinct_states(df), distinct.distinct_states(half))
    assert values(states.drop("bits"), "pickup_month", "trip_type", "kind", "part") == values(distinct.distinct_states(df), "pickup_month", "trip_type", "kind", "part")

    def want(own):
        return (len({t.date() for t in own}), len({t.replace(minute=0) for t in own}))

    for first, last in ((None, None), ("1970-01-05", "1970-02-03"), ("1969-12-20", "2014-06-01"), ("2015-09-01", None), (None, "1970-01-01")):
        inside = [(k, t) for k, t in trips if t and (first is None or str(t.date()) >= first) and (last is None or str(t.date()) <= last)]
        bounds = {"first": first, "last": last}
        if first is None and last is not None or first is not None and last is None:
            bounds = {"first": first or "1900-01-01", "last": last or "2100-01-01"}
        got = distinct.distinct_counts(states, ["trip_type"], **bounds)
        assert values(got) == sorted(((k, *want([t for k_, t in inside if k_ == k])) for k in {k for k, _ in inside}), key=repr)
        assert values(distinct.distinct_counts(states, (), **bounds)) == [want([t for _, t in inside])]
