"""Fact and bridge loads: natural keys to surrogate keys in one pass over the batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import count_where, days_between
from hoarfrost.model import TableSpec, WarehouseModel
from hoarfrost.operators.filters import batch, with_defaults
from hoarfrost.operators.joins import BroadcastBudget, check_key, resolve_key

MISS = "__miss_"


@dataclass(frozen=True)
class Lookup:
    """How one foreign key of a load gets its value."""

    column: str
    parent: str
    parent_key: str
    source: str | None
    mode: str  # natural, key or unset
    business_key: str | None = None
    current_only: bool = False


def lookup_plan(model: WarehouseModel, table: str, staged: list[str]) -> list[Lookup]:
    """Per foreign key: by natural key when that is staged (under its role), else the staged
    surrogate key is checked, else the key stays unknown."""
    plan = []
    for fk in model[table].references:
        parent = model.tables.get(fk.parent)
        if parent is None:
            continue
        natural = None if parent.explicit_key or parent.business_key is None else model.natural_column(fk)
        if natural in staged:
            plan.append(
                Lookup(fk.column, fk.parent, parent.key, natural, "natural", parent.business_key.name, parent.is_scd2)
            )
        elif fk.column in staged:
            plan.append(Lookup(fk.column, fk.parent, parent.key, fk.column, "key"))
        else:
            plan.append(Lookup(fk.column, fk.parent, parent.key, None, "unset"))
    return plan


def resolve_all(stage: DataFrame, plan: list[Lookup], dims: dict[str, DataFrame], ci_keys: bool = False) -> DataFrame:
    """Resolve every key of the plan, leaving one miss flag per natural-key lookup.

    Heavy keys are counted in the batch as staged, not behind the lookups already made.
    """
    staged, budget = stage, BroadcastBudget()
    for look in plan:
        if look.mode == "natural":
            stage = resolve_key(
                stage,
                dims[look.parent],
                look.source,
                look.business_key,
                look.parent_key,
                look.column,
                look.current_only,
                miss=f"{MISS}{look.column}",
                ci_keys=ci_keys,
                skew_from=staged,
                budget=budget,
            )
        elif look.mode == "key":
            stage = check_key(stage, dims[look.parent], look.column, look.parent_key, skew_from=staged, budget=budget)
    return stage


def lag_days(fact: DataFrame, spec: TableSpec) -> DataFrame:
    """Days from the first to the last date role of an accumulating snapshot."""
    first, last = (f"{role}DateKey" for role in (spec.date_roles[0], spec.date_roles[-1]))
    return fact.withColumn(spec.lag_column, days_between(first, last))


def load_fact(
    model: WarehouseModel,
    table: str,
    stage: DataFrame,
    dims: dict[str, DataFrame],
    batch_id: int,
    now: Column,
    highest: Column | int = 0,
    ci_keys: bool = False,
    keep_misses: bool = False,
) -> DataFrame:
    """Staged rows of one batch as fact rows.

    The row number is unique within a batch, so the fact key is the highest key in use plus
    the row number: unique, and free of any shuffle.
    """
    spec = model[table]
    rows = batch(stage, batch_id)
    plan = lookup_plan(model, table, stage.columns)
    resolved = resolve_all(rows, plan, dims, ci_keys)
    if spec.lag_column:
        resolved = lag_days(resolved, spec)
    base = highest if isinstance(highest, Column) else F.lit(highest)
    keyed = resolved.withColumn(spec.key, base + F.col("RowNumber"))
    flags = [c for c in keyed.columns if c.startswith(MISS)] if keep_misses else []
    return with_defaults(keyed.drop("BatchId"), spec, batch_id, now, extra=flags)


def lookup_misses(flagged: DataFrame, plan: list[Lookup], table: str) -> DataFrame:
    """Rows checked and rows that fell back to -1 for each natural-key lookup."""
    looks = [p for p in plan if p.mode == "natural"]
    checked = [F.count("*").alias("checked")]
    failed = [count_where(F.col(f"{MISS}{p.column}")).alias(f"f_{p.column}") for p in looks]
    totals = flagged.agg(*checked, *failed)
    rows = F.array(
        *[
            F.struct(
                F.lit(f"Missing lookup {p.column}").alias("rule"),
                F.lit(f"fact.{table}").alias("table"),
                F.col("checked"),
                F.col(f"f_{p.column}").alias("failed"),
            )
            for p in looks
        ]
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def unique_members(df: DataFrame, members: list[str], order: str = "RowNumber") -> DataFrame:
    """One row per member combination, the first by `order`; combined before the shuffle."""
    rest = sorted(c for c in df.columns if c not in (*members, order))
    picked = df.groupBy(*members).agg(F.min(F.struct(order, *rest)).alias("__row"))
    return picked.select(*members, "__row.*").select(*df.columns)


def load_bridge(
    model: WarehouseModel,
    table: str,
    stage: DataFrame,
    dims: dict[str, DataFrame],
    batch_id: int,
    now: Column,
    highest: Column | int = 0,
) -> DataFrame:
    """Resolve a bridge's members and keep one row per combination where that is its rule."""
    spec = model[table]
    plan = lookup_plan(model, table, stage.columns)
    resolved = resolve_all(batch(stage, batch_id), plan, dims)
    resolved = resolved.drop(*[c for c in resolved.columns if c.startswith(MISS)])
    if spec.unique_members:
        members = [fk.column for fk in spec.foreign_keys if fk.member]
        resolved = unique_members(resolved, members)
    base = highest if isinstance(highest, Column) else F.lit(highest)
    keyed = resolved.withColumn(spec.key, base + F.col("RowNumber"))
    return with_defaults(keyed.drop("BatchId"), spec, batch_id, now)
