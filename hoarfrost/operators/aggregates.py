"""Grouped totals, shares, ranks and the order of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import hash_number
from hoarfrost.model import TableSpec, WarehouseModel
from hoarfrost.operators.joins import sized_join
from hoarfrost.session import materialise

AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def rollup_declared(fact: DataFrame, spec: TableSpec, by: list[str]) -> DataFrame:
    """Each measure by the aggregation its table declares; sum where it declares none."""
    totals = [
        AGGREGATES[m.aggregation or "sum"](m.name).alias(m.name)
        for m in spec.columns
        if m.aggregation and m.name in fact.columns
    ]
    return fact.groupBy(*by).agg(F.count("*").alias("FactRowCount"), *totals)


def row_counts(tables: dict[str, DataFrame], model: WarehouseModel | None = None) -> DataFrame:
    """Rows per table, with the table's schema."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(model[name].schema if model and name in model else "raw").alias("schema_name"),
            F.lit(name).alias("table_name"),
            "row_count",
        )
        for name, df in sorted(tables.items())
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_counts(counts: DataFrame) -> DataFrame:
    """Tables and rows per schema."""
    return counts.groupBy("schema_name").agg(
        F.count("*").alias("table_count"), F.sum("row_count").cast("bigint").alias("row_count")
    )


def with_share(grouped: DataFrame, value: str, group: list[str], total: str, percent: str) -> DataFrame:
    """Add the group's total and each row's share of it in percent.

    `grouped` is an aggregate by the group and a lookup, so a group has at most one row per
    lookup value and the window sees no more than that. For groups without such a bound,
    `with_share_of_totals` adds the same columns.
    """
    totals = grouped.withColumn(total, F.sum(value).over(Window.partitionBy(*group)))
    return totals.withColumn(percent, _percent(value, total))


def with_share_of_totals(df: DataFrame, value: str, group: list[str], total: str, percent: str) -> DataFrame:
    """The same for groups of any size: totals by an aggregate, joined back."""
    totals = df.groupBy(*group).agg(F.sum(value).alias(total))
    joined = sized_join(df, totals, {g: g for g in group}, null_safe=True)
    return joined.withColumn(percent, _percent(value, total))


def _percent(value: str, total: str) -> Column:
    hundred = F.lit(100).cast("decimal(3,0)")
    share = F.try_divide(hundred * F.col(value).cast("decimal(20,0)"), F.col(total).cast("decimal(20,0)"))
    return share.cast("decimal(9,4)")


def with_dense_rank(df: DataFrame, group: list[str], measure: str, out: str, bands: int | None = None) -> DataFrame:
    """Dense rank of a measure, largest first, within groups.

    The rank of a value is one more than the number of larger values in its group. Distinct
    values are dealt by range to bands, as many as the session's shuffles have partitions (AQE
    joins small ones) or as asked for, and stored once with their band. They are counted per band and
    ranked inside the band, so a group that holds a third of the rows is ranked by many tasks.
    """
    values = df.select(*group, measure).distinct()
    order = [*[F.asc(g) for g in group], F.desc(measure)]
    dealt = values.repartitionByRange(bands, *order) if bands else values.repartitionByRange(*order)
    banded = materialise(dealt.withColumn("__band", F.spark_partition_id()), "ranked-values")
    per_band = banded.groupBy(*group, "__band").agg(F.count("*").alias("__n"))
    above = Window.partitionBy(*group).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_band.select(
        *[F.col(g).alias(f"__g_{g}") for g in group],
        F.col("__band").alias("__b"),
        F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(*group, "__band").orderBy(F.desc(measure))
    ranked = banded.withColumn("__rank", F.row_number().over(inside))
    on = F.col("__band") == F.col("__b")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    ranks = ranked.join(starts, on).select(
        *group, measure, (F.col("__start") + F.col("__rank")).cast("bigint").alias(out)
    )
    # One value may hold many of the rows; the ranks have it once.
    return sized_join(df, ranks, {c: c for c in (*group, measure)}, null_safe=True)


def top_ranked(df: DataFrame, group: list[str], measure: str, ties: list[str], n: int, out: str) -> DataFrame:
    """The n rows with the largest measure, each with its dense rank within its group.

    Every larger value of a group is ahead of a top row in the overall order too, so ranks
    taken over the top n alone are the ranks over the whole table. The ranking window
    therefore sees n rows, however large the groups are.
    """
    top = top_n(df, [F.desc(measure), *[F.asc(t) for t in ties]], n)
    ranked = Window.partitionBy(*group).orderBy(F.desc(measure))
    return top.withColumn(out, F.dense_rank().over(ranked).cast("bigint"))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First n rows of an order: each task keeps n rows, nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def sort_by_expression(df: DataFrame, expression: Column, *then: Column) -> DataFrame:
    """Sort by a value that is not part of the output."""
    return df.withColumn("__order", expression).orderBy(F.col("__order").desc(), *then).drop("__order")


def sample_keys(df: DataFrame, key: str, n: int = 500) -> DataFrame:
    """A pool of n existing keys, the unknown key left out. Which ones depends on the keys
    alone, so the same table gives the same pool."""
    keys = df.select(key).filter(F.col(key) != -1)
    return keys.withColumn("__h", hash_number(F.col(key))).orderBy("__h", key).limit(n).drop("__h")


def distinct_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of either side, each once; duplicates go before the shuffle."""
    return first.unionByName(second).distinct()


