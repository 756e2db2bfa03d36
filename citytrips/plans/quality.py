"""Data-quality checks: rules that run together in one pass, and checks of their own.

Every check returns a DataFrame: failing rows, or one summary row per rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from citytrips import rules as fixed
from citytrips.functions import floor_month, percent
from citytrips.operators.gaps import missing_ranges, spine_gaps
from citytrips.plans.reports import daily_totals, monthly_by_mode

ERROR, WARN = "error", "warn"


class Rule(NamedTuple):
    """One expectation.

    Kinds: ``not_null``, ``accepted`` (values), ``between`` (low, high; None is open),
    ``row_count`` (low, high), ``holds`` (SQL condition in ``values``), ``unique``,
    ``relationship`` (parent table in ``values``). ``mostly`` is the share of checked rows
    that must pass.
    """

    kind: str
    column: str = "*"
    values: tuple = ()
    severity: str = ERROR
    mostly: float = 1.0


def not_null(*columns: str, severity: str = ERROR) -> list[Rule]:
    return [Rule("not_null", c, (), severity) for c in columns]


def unique(*columns: str) -> list[Rule]:
    return [Rule("unique", c) for c in columns]


def accepted(column: str, values: Sequence) -> Rule:
    return Rule("accepted", column, tuple(values))


def flags(*columns: str) -> list[Rule]:
    return [accepted(c, (True, False)) for c in columns]


def between(column: str, low=None, high=None, severity: str = WARN, mostly: float = 1.0) -> Rule:
    return Rule("between", column, (low, high), severity, mostly)


def row_count(low: int | None = None, high: int | None = None, severity: str = ERROR) -> Rule:
    return Rule("row_count", "*", (low, high), severity)


def holds(name: str, condition: str, severity: str = WARN, mostly: float = 1.0) -> Rule:
    return Rule("holds", name, (condition,), severity, mostly)


def relationship(column: str, parent: str) -> Rule:
    return Rule("relationship", column, (parent,))


def _outside(value: Column, low, high) -> Column:
    parts = ([value < low] if low is not None else []) + ([value > high] if high is not None else [])
    return reduce(lambda a, b: a | b, parts)


def _fails(rule: Rule) -> Column:
    """Whether a row breaks the rule; null values only break ``not_null``."""
    value = F.col(rule.column) if rule.kind != "holds" else None
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "accepted":
        return ~value.isin(list(rule.values))
    if rule.kind == "between":
        return _outside(value, *rule.values)
    return ~F.expr(rule.values[0])


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows that break a row-level rule."""
    return df.filter(_fails(rule))


def rows_by_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break row-level rules, once for each rule they break, which ``rule`` names.

    Few rows fail, so lists of rules are made for these only.
    """
    fails = reduce(lambda a, b: a | b, [F.coalesce(_fails(r), F.lit(False)) for r in rules])
    names = F.array(*[F.when(_fails(r), F.lit(f"{r.kind}_{r.column}")) for r in rules])
    return df.filter(fails).withColumn("rule", F.explode(F.array_distinct(F.array_compact(names))))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; counted in the map tasks first."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys of child that parent lacks, with their rows.

    The child is reduced to its distinct keys before the anti-join.
    """
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(key).distinct(), key, "left_anti")


def _result(rule: Rule, failing: Column, total: Column) -> Column:
    """Summary row of a rule."""
    if rule.kind == "row_count":
        bad = F.coalesce(_outside(total, *rule.values), F.lit(False))
        failing, passed = bad.cast("long"), ~bad
    else:
        passed = failing <= (1.0 - rule.mostly) * total
    return F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.column).alias("column_name"),
        F.lit(rule.severity).alias("severity"), failing.cast("long").alias("failing_rows"),
        total.cast("long").alias("total_rows"), passed.alias("passed"),
    )


def _counts(rules: Sequence[Rule]) -> list[Column]:
    """Rows, and failing rows of each row-level rule."""
    return [F.count(F.lit(1)).alias("total"), *[
        F.count(F.when(_fails(r), 1)).alias(f"f{i}") if r.kind != "row_count"
        else F.count(F.lit(None)).alias(f"f{i}")
        for i, r in enumerate(rules)
    ]]


def _summary(wide: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A row for each rule, from the one row of all counts."""
    results = [_result(r, F.col(f"f{i}"), F.col("total")) for i, r in enumerate(rules)]
    return wide.select(F.inline(F.array(*results)))


def _one_pass(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules of a table in a single aggregation over it."""
    return _summary(df.agg(*_counts(rules)), rules)


def _of_groups(groups: DataFrame, rule: Rule, total: Column) -> DataFrame:
    """Summary of a rule that has failing groups with their row counts in ``n``."""
    stats = groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"))
    failing = F.col("groups") if rule.kind == "unique" else F.coalesce("rows", F.lit(0))
    return stats.select(F.inline(F.array(_result(rule, failing, total))))


def _by_kind(rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Rules of single rows, and those that compare rows."""
    grouped = [r for r in rules if r.kind in ("unique", "relationship")]
    return [r for r in rules if r not in grouped], grouped


def _combined(parts: list[DataFrame], df: DataFrame, grouped: Sequence[Rule],
              parents: Mapping[str, DataFrame] | None) -> DataFrame:
    """Summaries of row-level rules with those of uniqueness and relationships."""
    unknown = F.lit(None).cast("long")
    parts = list(parts)
    for rule in grouped:
        if rule.kind == "unique":
            parts.append(_of_groups(duplicates(df, rule.column), rule._replace(mostly=1.0), unknown))
        else:
            groups = orphans(df, parents[rule.values[0]], rule.column)
            parts.append(_of_groups(groups, rule, unknown))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "passed", F.coalesce("passed", F.col("failing_rows") == 0))


def write_checked(df: DataFrame, path: str, rules: Sequence[Rule],
                  parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Write a frame as Parquet and check it on the way: the written table, and what ``run_suite``
    returns for it.

    Row-level rules are counted by the tasks that write, so they need no scan of their own. A
    stage that is repeated after a lost executor may count rows twice; where the observed
    rows are not those of the files' footers, the rules run over the written table instead.
    Uniqueness and relationships read their column of the written table.
    """
    spark = df.sparkSession
    row_level, grouped = _by_kind(rules)
    observed = Observation()
    df.observe(observed, *_counts(row_level)).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    parts = []
    if row_level:
        counts = observed.get
        if counts["total"] == written.count():
            names = ["total", *[f"f{i}" for i in range(len(row_level))]]
            wide = spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))
            parts.append(_summary(wide, row_level))
        else:
            parts.append(_one_pass(written, row_level))
    return written, _combined(parts, written, grouped, parents)


def run_suite(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None,
              store_failures: str | None = None) -> DataFrame:
    """Run all rules of a table: (kind, column_name, severity, failing_rows, total_rows, passed).

    Row-level rules share one pass. Uniqueness and relationships need a shuffle each; their
    failing count is the number of repeated values or of rows without a parent, and
    ``total_rows`` is null. With ``store_failures`` the rows that fail row-level rules are written
    to ``<path>/rows``, by ``rule`` (``<kind>_<column>``) and in one scan, and the failing groups
    of the other rules to ``<path>/<kind>_<column>``.
    """
    row_level, grouped = _by_kind(rules)
    result = _combined([_one_pass(df, row_level)] if row_level else [], df, grouped, parents)
    if store_failures:
        _store(df, rules, parents, result, store_failures)
    return result


def _store(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None,
           result: DataFrame, path: str) -> None:
    failed = {(r["kind"], r["column_name"])
              for r in result.filter("failing_rows > 0").collect()}  # one row per rule
    broken = []
    for rule in rules:
        name = f"{rule.kind}_{rule.column}"
        if (rule.kind, rule.column) not in failed or rule.kind == "row_count":
            continue
        if rule.kind in ("unique", "relationship"):
            groups = (duplicates(df, rule.column) if rule.kind == "unique"
                      else orphans(df, parents[rule.values[0]], rule.column))
            groups.write.mode("overwrite").parquet(f"{path}/{name}")
        else:
            broken.append(rule)
    if broken:
        rows_by_rule(df, broken).write.mode("overwrite").partitionBy("rule").parquet(f"{path}/rows")


# --- checks of their own --------------------------------------------------------------------


def weather_coverage(fct: DataFrame, min_pct: float = fixed.COVERAGE_MINIMUM) -> DataFrame:
    """One row when too few trips have weather, none otherwise."""
    counts = fct.agg(F.count(F.lit(1)).alias("total_trips"),
                     F.count("temp_category").alias("trips_with_weather"))
    share = percent(F.col("trips_with_weather"), F.col("total_trips"))
    return counts.withColumn("coverage_pct", share).filter(F.col("coverage_pct") < min_pct)


def month_completeness(fct: DataFrame, min_trips: int = fixed.MONTH_MINIMUM) -> DataFrame:
    """Months with too few trips."""
    months = fct.groupBy(floor_month(F.col("pickup_datetime")).alias("month")).agg(
        F.count(F.lit(1)).alias("trip_count"))
    return months.filter(F.col("trip_count") < min_trips).withColumn(
        "warning_message", F.lit(fixed.LOW_MONTH_MESSAGE)).orderBy("month")


def date_gaps(fct: DataFrame, min_days: int = fixed.GAP_DAYS) -> DataFrame:
    """Runs of more than min_days days without trips."""
    return spine_gaps(fct, "pickup_datetime", min_days + 1).select(
        "gap_start", "gap_end", F.col("days_missing").alias("consecutive_missing_days"),
        F.lit(fixed.GAP_MESSAGE).alias("warning_message"),
    )


def gap_ranges(fct: DataFrame) -> DataFrame:
    """All runs of days without trips."""
    return missing_ranges(fct).select(
        F.col("gap_start").alias("start_date"), F.col("gap_end").alias("end_date"), "days_missing")


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    n = F.col("row_count")
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "passed", n.between(low, high))


def key_health(fct: DataFrame, key: str = "trip_key") -> DataFrame:
    """Null keys, and rows in excess of the distinct keys (rows without a key included).

    Rows are counted per key first, which the map tasks combine, so neither a distinct
    aggregation nor a key with very many rows is a burden.
    """
    per_key = fct.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = F.col(key).isNull()
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        total.alias("total_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_keys"),
        (total - F.count(F.when(~missing, 1))).alias("duplicate_keys"),
    )


def freshness(fct: DataFrame) -> DataFrame:
    return fct.agg(F.max("pickup_datetime").alias("latest_trip"))


def retention(raws: Sequence[DataFrame], fct: DataFrame) -> DataFrame:
    """Share of raw rows that reached the fact."""

    def counted(df: DataFrame, raw: bool) -> DataFrame:
        n = F.count(F.lit(1))
        zero = F.lit(0).cast("long")
        return df.agg((n if raw else zero).alias("raw_rows"), (zero if raw else n).alias("fact_rows"))

    parts = [counted(r, True) for r in raws] + [counted(fct, False)]
    totals = reduce(DataFrame.unionByName, parts).agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("fact_rows").alias("fact_rows"))
    return totals.withColumn(
        "retention_pct", percent(F.col("fact_rows"), F.col("raw_rows"), 2))


def coverage_status(fct: DataFrame) -> DataFrame:
    """Weather coverage with a grade."""
    value = percent(F.count("temp_category"), F.count(F.lit(1)), 4)
    grade = None
    for minimum, name in fixed.COVERAGE_GRADES:
        grade = (F if grade is None else grade).when(F.col("value") >= minimum, name)
    return fct.agg(value.alias("value")).select(
        F.lit("Weather Coverage").alias("metric"), "value",
        grade.otherwise(fixed.COVERAGE_GRADE_REST).alias("status"),
    )


def month_status(fct: DataFrame, min_trips: int = fixed.MONTH_MINIMUM) -> DataFrame:
    """Month totals with the first problem found: volume, weather, then days.

    Days come from the mode that sorts first, coverage is the plain mean over modes.
    """
    months = monthly_by_mode(fct).groupBy("month").agg(
        F.sum("trip_count").alias("trip_count"),
        F.min_by("days_in_month", "trip_type").alias("days_in_month"),
        F.sum("trips_with_weather").alias("trips_with_weather"),
        F.avg("weather_coverage_pct").alias("weather_coverage_pct"),
        F.min("first_trip").alias("first_trip"),
        F.max("last_trip").alias("last_trip"),
    )
    status = (
        F.when(F.col("trip_count") < min_trips, "Low Volume")
        .when(F.col("weather_coverage_pct") < fixed.MONTH_WEATHER_MINIMUM, "Weather Issues")
        .when(F.col("days_in_month") < fixed.MONTH_DAYS_MINIMUM, "Partial Month")
        .otherwise("Complete")
    )
    per_day = F.floor(F.col("trip_count") / F.col("days_in_month")).cast("long")
    return months.withColumns({"avg_trips_per_day": per_day, "status": status}).orderBy("month")


def low_volume_days(fct: DataFrame, min_trips: int = fixed.DAY_MINIMUM) -> DataFrame:
    return daily_totals(fct).filter(F.col("trip_count") < min_trips).select("date", "trip_count")


def recommendations(fct: DataFrame, min_trips: int = fixed.MONTH_MINIMUM) -> DataFrame:
    """What to load or check again, worst first."""
    months = month_status(fct, min_trips)
    mean = F.avg("trip_count").over(Window.partitionBy())  # one row per month
    low = F.col("trip_count") < min_trips
    partial = ~low & (F.col("trip_count") < F.col("_mean") * fixed.PARTIAL_MONTH_SHARE)
    weather = F.col("weather_coverage_pct") < fixed.MONTH_WEATHER_MINIMUM

    def finding(condition: Column, severity: str, issue: str, value: Column) -> Column:
        return F.when(condition, F.struct(
            F.lit(severity).alias("severity"), F.lit(issue).alias("issue"),
            value.cast("double").alias("value"),
        ))

    findings = F.array(
        finding(low, "high", "low_volume", F.col("trip_count")),
        finding(partial, "medium", "partial_month", F.col("trip_count")),
        finding(weather, "medium", "weather_coverage", F.col("weather_coverage_pct")),
    )
    rows = months.withColumn("_mean", mean).select(
        "month", F.inline(F.filter(findings, lambda x: x.isNotNull())))
    order = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    return rows.select("severity", "month", "issue", "value").orderBy(order, "month", "issue")
