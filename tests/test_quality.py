"""Rules, suites and checks."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from checks import workload
from checks.workspace import Workspace
from citytrips.operators import gaps
from citytrips.plans import quality, suites
from citytrips.plans.quality import between, holds, not_null, relationship, row_count, unique
from conftest import values


def trips_on(spark, *days: date, mode: str = "fhv", weather: bool = True):
    rows = [(str(i), datetime(d.year, d.month, d.day, 9), mode, "mild" if weather else None)
            for i, d in enumerate(days)]
    return spark.createDataFrame(
        rows, "trip_key string, pickup_datetime timestamp_ntz, trip_type string,"
        " temp_category string")


def span(first: date, days: int):
    return [first + timedelta(days=i) for i in range(days)]


def test_declared_rules_are_complete():
    kinds = Counter(r.kind for rs in suites.DECLARED.values() for r in rs)
    assert kinds == {"not_null": 68, "unique": 8, "accepted": 26, "relationship": 4, "between": 2}
    assert len(suites.EXPECTATIONS) == 10
    assert sum(map(len, suites.EXPECTATIONS.values())) == 56


def test_suite_counts_failures_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 5, None), (None, 50, "z"), ("b", None, "x")],
        "k string, n int, c string")
    parent = spark.createDataFrame([("a",)], "k string")
    rules = [*not_null("k", "n"), *unique("k"), quality.accepted("c", ["x", "y"]),
             between("n", 0, 10), between("n", 0, 10, mostly=0.5), row_count(1, 3),
             holds("positive", "n > 0"), relationship("k", "p")]
    result = quality.run_suite(df, rules, {"p": parent}, str(tmp_path))
    got = {(r["kind"], r["column_name"], r["passed"]): r["failing_rows"] for r in result.collect()}
    assert got == {
        ("not_null", "k", False): 1, ("not_null", "n", False): 1, ("unique", "k", False): 1,
        ("accepted", "c", False): 1, ("between", "n", False): 1, ("between", "n", True): 1,
        ("row_count", "*", False): 1, ("holds", "positive", True): 0,
        ("relationship", "k", False): 1}
    stored = spark.read.parquet(str(tmp_path / "rows")).filter("rule = 'accepted_c'")
    assert values(stored, "k", "c") == [(None, "z")]
    row_level = [r for r in rules if r.kind not in ("unique", "relationship")]
    plan = quality.run_suite(df, row_level)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_only_failing_rows_get_lists_of_rules(spark):
    df = spark.createDataFrame([("a", 1), (None, 50), ("b", None), ("b", 5)], "k string, n int")
    rows = quality.rows_by_rule(df, [*not_null("k", "n"), between("n", 0, 10)])
    assert values(rows, "k", "n", "rule") == [
        ("b", None, "not_null_n"), (None, 50, "between_n"), (None, 50, "not_null_k")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "OR coalesce" in plan[plan.index("Generate"):]


def test_rules_of_staged_tables_build_no_facts(spark, folder):
    w = Workspace(spark, folder)
    assert workload._suites(w, suites.BUSINESS).count() == 14
    assert "_built" not in vars(w)
    assert set(workload._checked_tables(w, {"stg_bike": suites.DECLARED["stg_bike"]})) == {"stg_bike"}


@pytest.mark.parametrize("missing, found", [(3, 0), (4, 1)])
def test_gaps_longer_than_three_days(spark, missing, found):
    days = span(date(2025, 1, 1), 3) + span(date(2025, 1, 4 + missing), 2)
    result = quality.date_gaps(trips_on(spark, *days))
    assert result.count() == found
    if found:
        assert tuple(result.first())[:3] == (date(2025, 1, 4), date(2025, 1, 7), 4)


def test_two_gaps_by_both_methods(spark):
    days = [date(2025, 1, 1), date(2025, 1, 3), date(2025, 1, 7), date(2025, 2, 1)]
    df = trips_on(spark, *days, days[0])
    expected = [(date(2025, 1, 2), date(2025, 1, 2), 1), (date(2025, 1, 4), date(2025, 1, 6), 3),
                (date(2025, 1, 8), date(2025, 1, 31), 24)]
    columns = ("gap_start", "gap_end", "days_missing")
    assert values(gaps.missing_ranges(df), *columns) == expected
    assert values(gaps.spine_gaps(df), *columns) == expected
    assert gaps.missing_dates(df).count() == 28
    assert gaps.missing_ranges(trips_on(spark, days[0])).isEmpty()


def test_month_edges_and_estimate(spark):
    days = [*span(date(2025, 5, 1), 31), *span(date(2025, 6, 14), 17), *span(date(2025, 7, 14), 10)]
    df = trips_on(spark, *days)
    edges = gaps.month_edge_gaps(df, "pickup_datetime")
    assert values(edges, "gap_type", "days_missing", "edge_day", "recurring") == [
        ("complete", 0, None, False), ("end", 8, 23, True), ("start", 13, 14, True),
        ("start", 13, 14, True)]
    row = gaps.missing_estimate(df, "pickup_datetime").first()
    assert (row["complete_months"], row["incomplete_months"]) == (1, 2)
    assert row["estimated_missing"] == pytest.approx(31 * 0.43 * 2)


def test_status_takes_the_first_problem(spark):
    whole = trips_on(spark, *span(date(2025, 1, 1), 31))
    bare = trips_on(spark, *span(date(2025, 3, 1), 31), weather=False)
    short = trips_on(spark, *span(date(2025, 2, 1), 20))
    status = quality.month_status(whole.unionByName(bare).unionByName(short), min_trips=20)
    assert [r["status"] for r in status.collect()] == ["Complete", "Partial Month", "Weather Issues"]
    low = quality.month_status(whole, min_trips=32)
    assert low.first()["status"] == "Low Volume"


def test_recommendations_are_sorted_by_severity(spark):
    many = trips_on(spark, *[d for d in span(date(2025, 1, 1), 31) for _ in range(10)])
    few = trips_on(spark, *span(date(2025, 2, 1), 28), weather=False)
    none = trips_on(spark, date(2025, 3, 1))
    rows = quality.recommendations(many.unionByName(few).unionByName(none), min_trips=5).collect()
    assert [(r["severity"], r["month"].month, r["issue"]) for r in rows] == [
        ("high", 3, "low_volume"), ("medium", 2, "partial_month"),
        ("medium", 2, "weather_coverage")]


def test_coverage_grades(spark):
    good = trips_on(spark, *[date(2025, 1, 1)] * 19)
    one = trips_on(spark, date(2025, 1, 1), weather=False)
    assert quality.coverage_status(good).first()["status"] == "Excellent"
    fair = quality.coverage_status(good.unionByName(one)).first()
    assert (fair["value"], fair["status"]) == (95.0, "Fair")
    assert quality.weather_coverage(good).isEmpty()
    assert quality.weather_coverage(good.unionByName(one)).count() == 1


def test_key_health_and_retention(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "trip_key string")
    assert tuple(quality.key_health(df).first()) == (4, 1, 2)
    assert tuple(quality.retention([df, df], df).first()) == (8, 4, 50.0)
    assert tuple(quality.row_count_between(df, 5, 9).first()) == (4, False)


def test_rules_are_counted_while_writing(spark, tmp_path):
    schema = "k string, n int, c string"
    rows = [("a", 1, "x"), ("a", 5, None), (None, 50, "z"), ("b", None, "x")]
    parents = {"p": spark.createDataFrame([("a",)], "k string")}
    rules = [*not_null("k", "n"), *unique("k"), quality.accepted("c", ["x", "y"]),
             between("n", 0, 10), between("n", 0, 10, mostly=0.5), row_count(1, 3), row_count(5),
             holds("small", "n < 20"), relationship("k", "p")]
    frames = (spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame([], schema),
              spark.createDataFrame(rows * 50, schema).repartition("k"))
    for i, df in enumerate(frames):
        for j, some in enumerate((rules, rules[:2], [r for r in rules if r.kind in ("unique", "relationship")])):
            written, result = quality.write_checked(df, f"{tmp_path}/{i}-{j}", some, parents)
            expected = quality.run_suite(df, some, parents)
            assert result.dtypes == expected.dtypes
            assert values(result) == values(expected)
            assert values(written) == values(df)


def test_rows_counted_twice_are_counted_again(spark, tmp_path, monkeypatch):
    class Doubled(quality.Observation):
        """As if a stage had been repeated."""

        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(quality, "Observation", Doubled)
    df = spark.createDataFrame([(1,), (None,), (30,)], "n int")
    rules = [*not_null("n"), between("n", 0, 10)]
    assert values(quality.write_checked(df, f"{tmp_path}/t", rules)[1]) == values(quality.run_suite(df, rules))
