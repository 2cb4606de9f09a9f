"""Ad-hoc rollups over any branches of the snowflake."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoarfrost.model import Edge, WarehouseModel
from hoarfrost.operators.aggregates import AGGREGATES, top_n
from hoarfrost.operators.filters import bounded, datekey_bounds, datekey_window, loaded_only
from hoarfrost.operators.joins import BroadcastBudget, climb, sized_join


@dataclass(frozen=True)
class Attribute:
    """A column to group by, and the way to it: the fact's foreign key, then the parent
    tables to climb to. The last table on the way has the column."""

    foreign_key: str
    column: str
    parents: tuple[str, ...] = ()


@dataclass(frozen=True)
class DateWindow:
    column: str
    years_back: int
    as_of: dt.date


def branch_path(model: WarehouseModel, fact: str, foreign_key: str, parents: tuple[str, ...] = ()) -> list[Edge]:
    """The edges from a fact key up to the last parent named. No table is entered twice."""
    first = next((e for e in model.edges(fact) if e.column == foreign_key), None)
    if first is None:
        raise ValueError(f"{fact} has no foreign key {foreign_key}")
    path, seen = [first], {fact, first.parent}
    for parent in parents:
        step = next((e for e in model.edges(path[-1].parent) if e.parent == parent and parent not in seen), None)
        if step is None:
            raise ValueError(f"no way from {path[-1].parent} to {parent}")
        path.append(step)
        seen.add(parent)
    return path


def _grouped(
    model: WarehouseModel,
    tables: dict[str, DataFrame],
    fact: str,
    attributes: list[Attribute],
    window: DateWindow | None,
    measures: list[str],
) -> tuple[DataFrame, list[str]]:
    """The fact's loaded rows with every attribute joined on, and the attributes' labels."""
    if window:
        # The window's keys also bound the raw dates they come from, where the tables know those.
        df = bounded(tables, fact, window.column, *datekey_bounds(window.years_back, window.as_of))
        df = datekey_window(df, window.column, window.years_back, window.as_of)
    else:
        df = tables[fact]
    df = loaded_only(df)
    keep = {a.foreign_key for a in attributes} | set(measures) | {"BatchId"}
    df = df.select(*[c for c in df.columns if c in keep])
    base, labels, budget = df, [], BroadcastBudget()
    for a in attributes:
        path = branch_path(model, fact, a.foreign_key, a.parents)
        label = f"{path[-1].parent}_{a.column}"
        branch = _branch(tables, path, a.column, label, budget)
        first = tables[path[0].parent]
        df = sized_join(df, branch, {a.foreign_key: "__key"}, size_from=first, skew_from=base, budget=budget)
        labels.append(label)
    return df, labels


def _branch(tables: dict[str, DataFrame], path: list[Edge], column: str, label: str, budget: BroadcastBudget) -> DataFrame:
    """The first dimension of a path with the attribute of the last one beside its key."""
    frames = []
    for level, edge in enumerate(path):
        last = level == len(path) - 1
        value = F.col(column).alias(label) if last else F.col(path[level + 1].column).alias(f"__up{level}")
        frames.append(tables[edge.parent].select(F.col(edge.parent_key).alias("__key"), value))
    ups = [f"__up{level}" for level in range(len(frames) - 1)]
    # The pointers of one branch would be ambiguous beside those of the next.
    return climb(frames[0], [(up, frame, "__key") for up, frame in zip(ups, frames[1:])], budget).drop(*ups)


def _totals(aggs: list[tuple[str, str]]) -> tuple[list[Column], list[str]]:
    names = [f"{func.title()}_{measure}" for func, measure in aggs]
    return [AGGREGATES[f](m).alias(n) for (f, m), n in zip(aggs, names)], names


def rollup(
    model: WarehouseModel,
    tables: dict[str, DataFrame],
    fact: str,
    attributes: list[Attribute],
    aggs: list[tuple[str, str]],
    having_min: int | None = None,
    top: int | None = None,
    window: DateWindow | None = None,
) -> DataFrame:
    """Grouped measures over one to three branches, largest groups first.

    `having_min` keeps groups with more rows than that. Ties are ordered by the attributes.
    """
    df, labels = _grouped(model, tables, fact, attributes, window, [m for _, m in aggs])
    totals, _ = _totals(aggs)
    out = df.groupBy(*labels).agg(F.count("*").alias("FactRowCount"), *totals)
    if having_min is not None:
        out = out.filter(F.col("FactRowCount") > having_min)
    order = [F.desc("FactRowCount"), *[F.asc(c) for c in labels]]
    return top_n(out, order, top) if top else out.orderBy(*order)


def top_by_measure(
    model: WarehouseModel,
    tables: dict[str, DataFrame],
    fact: str,
    attributes: list[Attribute],
    aggs: list[tuple[str, str]],
    top: int,
    window: DateWindow | None = None,
) -> DataFrame:
    """The n groups with the largest first measure."""
    df, labels = _grouped(model, tables, fact, attributes, window, [m for _, m in aggs])
    totals, names = _totals(aggs)
    out = df.groupBy(*labels).agg(F.count("*").alias("FactRowCount"), *totals)
    return top_n(out, [F.desc(names[0]), *[F.asc(c) for c in labels]], top)


def distinct_profile(
    model: WarehouseModel,
    tables: dict[str, DataFrame],
    fact: str,
    attributes: list[Attribute],
    top: int | None = None,
    window: DateWindow | None = None,
    distinct_of: list[str] | None = None,
) -> DataFrame:
    """Rows and distinct batches per attribute combination, and distinct values of any
    further columns asked for."""
    extra = distinct_of or []
    df, labels = _grouped(model, tables, fact, attributes, window, extra)
    out = df.groupBy(*labels).agg(
        F.count("*").alias("FactRowCount"),
        F.countDistinct("BatchId").alias("DistinctBatchCount"),
        *[F.countDistinct(c).alias(f"Distinct_{c}") for c in extra],
    )
    order = [F.desc("FactRowCount"), *[F.asc(c) for c in labels]]
    return top_n(out, order, top) if top else out.orderBy(*order)
