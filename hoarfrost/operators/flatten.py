"""Flattened dimensions: a leaf with the identifying columns of all its ancestors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoarfrost.model import ForeignKey, TableSpec, WarehouseModel
from hoarfrost.operators.joins import BroadcastBudget, sized_join

NAME_LIMIT = 128


@dataclass(frozen=True)
class Branch:
    """One join of a flattened dimension."""

    index: int
    child: int  # index of the branch below, 0 for the leaf
    column: str  # foreign key on the child
    parent: str
    key: str
    outputs: tuple[tuple[str, str], ...]  # parent column, output name


def identifying_columns(spec: TableSpec) -> list[str]:
    """Business key and every name or code; the first column where there is none."""
    bk = spec.business_key.name if spec.business_key else None
    names = [c.name for c in spec.all_columns()]
    return [n for n in names if n == bk or n.endswith(("Name", "Code"))] or names[:1]


def role_alias(path: str, column: str, used: set[str]) -> str:
    """Output name of an ancestor's column, unique within the length limit."""
    wanted = f"{path}_{column}"[:NAME_LIMIT]
    name, n = wanted, 1
    while name in used:
        n += 1
        name = f"{wanted[: NAME_LIMIT - len(str(n)) - 1]}_{n}"
    used.add(name)
    return name


def _parents(model: WarehouseModel, spec: TableSpec, kind: str) -> list[ForeignKey]:
    found = [
        fk
        for fk in spec.references
        if fk.parent in model and model[fk.parent].kind == kind and fk.parent != spec.name
    ]
    return sorted(found, key=lambda fk: (fk.parent, fk.column))


def branches(model: WarehouseModel, leaf: str, max_columns: int | None = None) -> list[Branch]:
    """The joins of a leaf, depth first: lookups before dimensions, each by table and key.

    Lookups are followed to their own lookups only. A table already on the path down to the
    leaf is not entered again. There is no limit to the columns unless one is given.
    """
    found: list[Branch] = []
    used = {c.name for c in model[leaf].all_columns()}

    def enter(child: int, fk: ForeignKey, path: str, below: tuple[str, ...]) -> None:
        parent = model[fk.parent]
        if parent.name in below:
            return
        role = fk.column[:-3]
        path = f"{path}_{role}" if path else role
        outputs = []
        for column in identifying_columns(parent):
            if max_columns is not None and len(used) >= max_columns:
                break
            outputs.append((column, role_alias(path, column, used)))
        branch = Branch(len(found) + 1, child, fk.column, parent.name, parent.key, tuple(outputs))
        found.append(branch)
        descend(parent, branch.index, path, below + (parent.name,))

    def descend(spec: TableSpec, index: int, path: str, below: tuple[str, ...]) -> None:
        for fk in _parents(model, spec, "ref"):
            enter(index, fk, path, below)
        if spec.kind == "dim":
            for fk in _parents(model, spec, "dim"):
                enter(index, fk, path, below)

    descend(model[leaf], 0, "", (leaf,))
    return found


def _needed(all_branches: list[Branch], columns: set[str]) -> list[Branch]:
    """Branches that carry a wanted column, and those on the way to them."""
    by_index = {b.index: b for b in all_branches}
    keep: set[int] = set()
    for b in all_branches:
        if any(name in columns for _, name in b.outputs):
            at = b.index
            while at and at not in keep:
                keep.add(at)
                at = by_index[at].child
    return [b for b in all_branches if b.index in keep]


def flatten(
    model: WarehouseModel,
    tables: dict[str, DataFrame],
    leaf: str,
    columns: list[str] | None = None,
    max_columns: int | None = None,
) -> DataFrame:
    """Left joins from a leaf to its ancestors.

    Spark does not drop an unused left join, so with `columns` only the branches that those
    columns need are joined at all. Parents are read down to their key, the keys that lead
    further up, and the columns that come out.
    """
    every = branches(model, leaf, max_columns)
    wanted = set(columns) if columns is not None else None
    joins = every if wanted is None else _needed(every, wanted)
    out = _with_parents(tables[leaf], 0, tables, joins, wanted, BroadcastBudget())
    names = [*tables[leaf].columns, *[n for b in every for _, n in b.outputs]]
    return out.select(*[n for n in names if n in out.columns and (wanted is None or n in wanted)])


def _with_parents(
    df: DataFrame, index: int, tables: dict[str, DataFrame], joins: list[Branch], wanted: set[str] | None, budget: BroadcastBudget
) -> DataFrame:
    """A table with all its ancestors. Each parent is completed before it is joined, so the
    table meets one frame per parent, and the long chain is joined among the short tables."""
    out = df
    for b in joins:
        if b.child != index:
            continue
        up = sorted({j.column for j in joins if j.child == b.index})
        parent = tables[b.parent].select(
            F.col(b.key).alias("__key"),
            *[F.col(c).alias(f"__{b.index}_{c}") for c in up],
            *[F.col(c).alias(n) for c, n in b.outputs if wanted is None or n in wanted],
        )
        complete = _with_parents(parent, b.index, tables, joins, wanted, budget).drop(*[f"__{b.index}_{c}" for c in up])
        pointer = b.column if index == 0 else f"__{index}_{b.column}"
        out = sized_join(out, complete, {pointer: "__key"}, "left", size_from=parent, skew_from=df, budget=budget)
    return out


def flatten_all(model: WarehouseModel, tables: dict[str, DataFrame], spark: SparkSession) -> list[str]:
    """Register one flattened view for each leaf dimension that has data."""
    made = []
    for spec in model.leaves():
        if spec.name in tables:
            name = f"vwDim{spec.name}"
            flatten(model, tables, spec.name).createOrReplaceTempView(name)
            made.append(name)
    return made
