"""Aggregate navigation: metric queries answered by the coarsest kept states that can, else by the fact.

A rollup keeps partial states of a model's measures (counts, sums, maxima; a mean is a sum and a
count) for periods and dimensions. States of a coarser rollup, of further rows, and of any question
are made by aggregating states again, so the fact is scanned once for all of them. Medians cannot be
put together from such states; queries with one go to the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import chain

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrips.functions import divide
from citytrips.plans.semantic import (
    Derived, Measure, Plan, Ratio, SemanticModel, at_grain, join_entities, query,
)

#: Start of the period a state is for.
PERIOD = "_period"
#: Grains from fine to coarse, with those that can be told from each.
GRAINS: dict[str, tuple[str, ...]] = {
    "hour": ("hour", "day", "week", "month", "quarter", "year"),
    "day": ("day", "week", "month", "quarter", "year"),
    "week": ("week",),
    "month": ("month", "quarter", "year"),
    "quarter": ("quarter", "year"),
    "year": ("year",),
}
PARTS = {"count": ("count",), "sum": ("sum",), "average": ("sum", "count"), "max": ("max",)}
_AGAIN = {"count": F.sum, "sum": F.sum, "max": F.max}
_FIRST = {"count": F.count, "sum": F.sum, "max": F.max}


@dataclass(frozen=True)
class Rollup:
    """States for each period of a grain and each combination of dimensions. The keys of foreign
    entities that the periods and dimensions determine can be kept as well, for joins."""

    grain: str
    dimensions: tuple[str, ...] = ()
    entities: tuple[str, ...] = ()

    def keys(self, model: SemanticModel) -> list[str]:
        return [*self.dimensions, *[e.expr for e in model.entities if e.name in self.entities]]

    def refines(self, other: Rollup) -> bool:
        """Whether the states of the other can be made from those of this one."""
        return (other.grain in GRAINS[self.grain] and set(other.dimensions) <= set(self.dimensions)
                and set(other.entities) <= set(self.entities))


def _state(model: SemanticModel, measure: Measure, part: str) -> str:
    """Column of a partial state; measures of one expression share it."""
    owner = next(m.name for m in model.measures if m.expr == measure.expr)
    return f"_{part}_{owner}"


def _states(model: SemanticModel) -> dict[str, tuple[str, str]]:
    """Columns of all states of a model: which part, of which expression."""
    return {_state(model, m, part): (part, m.expr) for m in model.measures for part in PARTS.get(m.agg, ())}


def build(model: SemanticModel, fact: DataFrame, rollup: Rollup) -> DataFrame:
    """The states of a rollup from the rows of the fact; partial sums are made in the map tasks."""
    return fact.groupBy(at_grain(F.col(model.time), rollup.grain).alias(PERIOD), *rollup.keys(model)).agg(
        *[_FIRST[part](F.expr(expr)).alias(name) for name, (part, expr) in _states(model).items()])


def derive(model: SemanticModel, states: DataFrame, fine: Rollup, coarse: Rollup) -> DataFrame:
    """The states of a coarser rollup from those of a finer one."""
    if not fine.refines(coarse):
        raise ValueError(f"{coarse} cannot be made from {fine}")
    return states.groupBy(at_grain(F.col(PERIOD), coarse.grain).alias(PERIOD), *coarse.keys(model)).agg(
        *[_AGAIN[part](name).alias(name) for name, (part, _) in _states(model).items()])


def merge(model: SemanticModel, states: DataFrame, more: DataFrame, rollup: Rollup) -> DataFrame:
    """States of the rows of both, which must not be the same rows."""
    return derive(model, states.unionByName(more), rollup, rollup)


class _StatePlan(Plan):
    """Measures from states in place of rows."""

    def reduce(self, measure: Measure, condition: Column | None) -> Column:
        def again(part: str) -> Column:
            state = F.col(_state(self.model, measure, part))
            return _AGAIN[part](state if condition is None else F.when(condition, state))

        if measure.agg == "count":
            return F.coalesce(again("count"), F.lit(0))
        return divide(again("sum"), again("count")) if measure.agg == "average" else again(measure.agg)


def _wanted(model: SemanticModel, name: str) -> tuple[set[str], set[str]]:
    """The measures a metric needs, and the dimensions of its conditions."""
    metric = model.metric(name)
    if isinstance(metric, Derived):
        parts = [_wanted(model, i) for i in metric.inputs]
        return set(chain(*[p[0] for p in parts])), set(chain(*[p[1] for p in parts]))
    if isinstance(metric, Ratio):
        return {metric.numerator, metric.denominator}, set()
    return {metric.measure}, {k for k, _ in metric.where}


def _filters(model: SemanticModel, tables: Mapping[str, DataFrame], rollup: Rollup, states: DataFrame,
             where: str, joined: Sequence[str]) -> bool:
    """Whether a filter names nothing but kept keys and joined columns, as Spark resolves it."""
    try:
        join_entities(states.select(*rollup.keys(model)), model, tables, joined).filter(where).schema  # noqa: B018
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


def choose(model: SemanticModel, tables: Mapping[str, DataFrame], rollups: Mapping[Rollup, DataFrame],
           metrics: Sequence[str], group_by: Sequence[str] = (), grain: str | None = None,
           where: str | None = None, joined: Sequence[str] = ()) -> Rollup | None:
    """The coarsest rollup that answers a query, None where only the fact does."""
    needs = [_wanted(model, m) for m in metrics]
    if any(model.measure(m).agg not in PARTS for m in chain(*[n[0] for n in needs])):
        return None
    times = {"metric_time", model.time}
    default = next((d.grain for d in model.dimensions if d.name == model.time), None)
    columns = {c for c in chain(group_by, *[n[1] for n in needs]) if c not in times and "__" not in c}
    entities = {c.partition("__")[0] for c in chain(group_by, joined) if "__" in c}
    coarse_first = sorted(rollups, key=lambda r: (
        -list(GRAINS).index(r.grain), len(r.dimensions) + len(r.entities)))
    for rollup in coarse_first:
        if not (columns <= set(rollup.dimensions) and entities <= set(rollup.entities)):
            continue
        if times & set(group_by) and (grain or default) not in GRAINS[rollup.grain]:
            continue
        if where is None or _filters(model, tables, rollup, rollups[rollup], where, [
                *[g for g in group_by if "__" in g], *joined]):
            return rollup
    return None


def navigate(model: SemanticModel, tables: Mapping[str, DataFrame], rollups: Mapping[Rollup, DataFrame],
             metrics: Sequence[str], group_by: Sequence[str] = (), grain: str | None = None,
             where: str | None = None, joined: Sequence[str] = (), **options: object) -> DataFrame:
    """``semantic.query`` with equal results, from the states of the rollup that ``choose`` finds."""
    found = choose(model, tables, rollups, metrics, group_by, grain, where, joined)
    if found is None:
        return query(model, tables, metrics, group_by, grain, where, joined, **options)
    return query(model, tables, metrics, group_by, grain, where, joined, source=rollups[found],
                 time=PERIOD, plan=_StatePlan(model), **options)


#: What is kept of the trips: hours with all that an hour and a mode determine, and months of these.
TRIP_HOURS = Rollup("hour", (
    "trip_type", "day_part", "is_weekend", "is_rush_hour", "is_business_hours", "is_late_night",
    "temp_category", "feels_like_category", "precipitation_type", "precipitation_intensity",
    "wind_category", "cloud_cover_category", "humidity_category", "is_pleasant_weather",
    "is_adverse_weather", "is_good_cycling_weather"), ("date", "time"))
TRIP_MONTHS = Rollup("month", TRIP_HOURS.dimensions)
MODE_DAYS = Rollup("day", ("trip_type", "is_weekend"), ("date",))
