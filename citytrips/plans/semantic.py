"""Semantic layer: models with dimensions and measures, and metric queries over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips.functions import divide, floor_hour, floor_month
from citytrips.operators.selection import exact_medians

_AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "count": F.count,
    "sum": F.sum,
    "average": F.avg,
    "max": F.max,
}


@dataclass(frozen=True)
class Entity:
    """A key of the model; foreign ones lead to a dimension table by ``target``."""

    name: str
    kind: str
    expr: str
    target: str | None = None


@dataclass(frozen=True)
class Dimension:
    name: str
    kind: str = "categorical"
    grain: str | None = None


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str

    def value(self, condition: Column | None) -> Column:
        """What is aggregated, null for rows that do not meet a condition."""
        value = F.expr(self.expr)
        return value if condition is None else F.when(condition, value)


@dataclass(frozen=True)
class Simple:
    """A measure, optionally over rows where the named dimensions have the given values."""

    measure: str
    where: tuple[tuple[str, object], ...] = ()


@dataclass(frozen=True)
class Derived:
    """Arithmetic over other metrics."""

    inputs: tuple[str, ...]
    formula: Callable[..., Column]


@dataclass(frozen=True)
class Ratio:
    """One measure over another."""

    numerator: str
    denominator: str


Metric = Simple | Derived | Ratio


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    time: str
    entities: tuple[Entity, ...]
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)

    def metric(self, name: str) -> Metric:
        """A metric by name; a bare measure counts as a simple metric."""
        if name in self.metrics:
            return self.metrics[name]
        if any(m.name == name for m in self.measures):
            return Simple(name)
        raise KeyError(f"{self.name} has no metric or measure {name}")


def at_grain(ts: Column, grain: str) -> Column:
    """Start of the period a timestamp falls in."""
    if grain == "hour":
        return floor_hour(ts)
    if grain == "month":
        return floor_month(ts)
    day = F.to_date(ts)
    start = day if grain == "day" else F.trunc(day, grain)
    return start.cast("timestamp_ntz")


def _condition(where: Sequence[tuple[str, object]]) -> Column | None:
    result = None
    for name, value in where:
        term = F.col(name) == F.lit(value)
        result = term if result is None else result & term
    return result


class Plan:
    """Aggregates a set of metrics needs, each under a column name of its own."""

    def __init__(self, model: SemanticModel):
        self.model = model
        self.aggregates: dict[str, Column] = {}
        self.medians: dict[str, Column] = {}

    def _aggregate(self, measure: str, where: tuple = ()) -> Column:
        name = "_".join(["", measure, *[f"{k}={v}" for k, v in where]]).replace(".", "_")
        chosen = self.model.measure(measure)
        if chosen.agg == "median":
            self.medians[name] = chosen.value(_condition(where))
        elif name not in self.aggregates:
            self.aggregates[name] = self.reduce(chosen, _condition(where)).alias(name)
        return F.col(f"`{name}`")

    def reduce(self, measure: Measure, condition: Column | None) -> Column:
        """The aggregate of a measure over the rows that meet a condition."""
        return _AGGREGATES[measure.agg](measure.value(condition))

    def value(self, name: str) -> Column:
        metric = self.model.metric(name)
        if isinstance(metric, Simple):
            return self._aggregate(metric.measure, metric.where)
        if isinstance(metric, Ratio):
            return divide(self._aggregate(metric.numerator), self._aggregate(metric.denominator))
        return metric.formula(*[self.value(i) for i in metric.inputs])


def join_entities(base: DataFrame, model: SemanticModel, tables: Mapping[str, DataFrame],
                   names: Sequence[str]) -> DataFrame:
    """Left-join the dimension tables behind names of the form ``entity__column``.

    Only the asked-for columns of a dimension take part. Dimension tables are read from
    Parquet, so Spark knows their size and decides on a broadcast by it.
    """
    wanted: dict[str, list[str]] = {}
    for name in names:
        entity, _, column = name.partition("__")
        if column:
            wanted.setdefault(entity, []).append(column)
    for entity in model.entities:
        if entity.name not in wanted:
            continue
        key = f"_{entity.name}_key"
        target_key = {"date": "date_key", "time": "time_key"}.get(entity.target, "location_key")
        dimension = tables[entity.target].select(
            F.col(target_key).alias(key),
            *[F.col(c).alias(f"{entity.name}__{c}") for c in dict.fromkeys(wanted.pop(entity.name))],
        )
        base = base.join(dimension, F.expr(entity.expr) == F.col(key), "left").drop(key)
    if wanted:
        raise KeyError(f"{model.name} has no entities {sorted(wanted)}")
    return base


def query(model: SemanticModel, tables: Mapping[str, DataFrame], metrics: Sequence[str],
          group_by: Sequence[str] = (), grain: str | None = None, where: str | None = None,
          joined: Sequence[str] = (), order_by: Sequence[str | Column] = (),
          limit: int | None = None, fill: bool = False, source: DataFrame | None = None,
          time: str | None = None, plan: Plan | None = None) -> DataFrame:
    """Evaluate metrics by dimensions.

    All metrics come from one ``groupBy().agg()``: a filtered metric aggregates a
    conditional value instead of scanning again, and derived ones are projected from the
    aggregates. ``group_by`` takes dimensions of the model, ``metric_time`` (with ``grain``)
    and columns of joined tables as ``entity__column``; ``joined`` names further such
    columns that ``where`` uses. ``fill`` adds the periods of ``tables["spine"]`` without rows.
    ``source`` with ``time`` and ``plan`` replaces the table of the model, its time column and the
    way measures are aggregated; see ``rollups``.
    """
    known = {d.name for d in model.dimensions} | {"metric_time"}
    unknown = [g for g in group_by if g not in known and "__" not in g]
    if unknown:
        raise KeyError(f"{model.name} has no dimensions {unknown}")
    base = join_entities(tables[model.table] if source is None else source, model, tables, [*group_by, *joined])
    time, plan = time or model.time, plan or Plan(model)
    if where is not None:
        base = base.filter(where)
    grains = {d.name: d.grain for d in model.dimensions}
    keys = []
    for name in group_by:
        if name == "metric_time" or grains.get(name):
            named = model.time if name == "metric_time" else name
            keys.append(at_grain(F.col(time if named == model.time else named), grain or grains[named]).alias(name))
        else:
            keys.append(F.col(name))
    outputs = [plan.value(m).alias(m) for m in metrics]
    aggregates = list(plan.aggregates.values()) or [F.count(F.lit(1)).alias("_rows")]
    grouped = base.groupBy(*keys).agg(*aggregates)
    if plan.medians:
        medians = exact_medians(
            base.select("*", *[k.alias(f"_by_{i}") for i, k in enumerate(keys)]),
            [f"_by_{i}" for i in range(len(keys))], plan.medians)
        medians = medians.withColumnsRenamed({f"_by_{i}": g for i, g in enumerate(group_by)})
        both = grouped.unionByName(medians, allowMissingColumns=True)
        # one row of each kind per group; grouping matches null keys, a join would not
        grouped = both.groupBy(*[F.col(f"`{g}`") for g in group_by]).agg(*[
            F.max(f"`{c}`").alias(c) for c in both.columns if c not in group_by])
    result = grouped.select(*group_by, *outputs)
    if fill:
        result = _fill(result, tables["spine"], group_by, grain or grains[model.time])
    if order_by:
        result = result.orderBy(*order_by)
    return result if limit is None else result.limit(limit)


def _fill(result: DataFrame, spine: DataFrame, group_by: Sequence[str], grain: str) -> DataFrame:
    """The result and a row for each period of the spine without one; no period of the result is
    lost, whatever the spine covers."""
    time = next((g for g in group_by if g == "metric_time" or g.endswith("datetime")
                 or g.endswith("timestamp")), None)
    if time is None:
        raise ValueError("filling needs a time among the dimensions")
    periods = spine.select(at_grain(F.col("date_day"), grain).alias("_period")).distinct()
    filled = periods.join(result, F.col("_period") == F.col(time), "full")
    return filled.withColumn(time, F.coalesce("_period", time)).select(*result.columns)


def catalog(spark: SparkSession, *models: SemanticModel) -> DataFrame:
    """Names and kinds of all metrics."""
    rows = [(m.name, name, type(metric).__name__.lower())
            for m in models for name, metric in m.metrics.items()]
    return spark.createDataFrame(rows, "model string, metric string, type string")
