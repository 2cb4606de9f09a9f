"""Data quality: every column rule of a table in one pass, keys by pre-aggregated counts.

All checks return rows (rule, table, checked, failed); `results` turns them into result
rows with a batch id, a status and a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from hoarfrost.functions.scalars import count_where, rule_code
from hoarfrost.model import UNKNOWN_KEY, TableSpec, WarehouseModel
from hoarfrost.operators.joins import BroadcastBudget, broadcast_bytes, fits_broadcast, pieces_of, sized_join
from hoarfrost.session import materialise

# Parts of a column name that mark a measure which must not be negative.
NON_NEGATIVE = ("Amount", "Quantity", "Cost", "Minutes", "Hours", "Weight")


@dataclass(frozen=True)
class Rule:
    """A user-defined rule: rows of the table that meet the predicate fail it."""

    name: str
    table: str
    fails_when: str
    active: bool = True


def one_pass(df: DataFrame, table: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Evaluate any number of row rules with a single aggregate over the table."""
    totals = df.agg(
        F.count("*").alias("checked"), *[count_where(cond).alias(f"f{i}") for i, (_, cond) in enumerate(rules)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.lit(table).alias("table"), F.col("checked"), F.col(f"f{i}").alias("failed"))
            for i, (name, _) in enumerate(rules)
        ]
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def row_count_rule() -> list[tuple[str, Column]]:
    return [("Row count", F.lit(False))]


def null_key_rules(df: DataFrame, own_key: str) -> list[tuple[str, Column]]:
    return [(f"Null key {c}", F.col(c).isNull()) for c in df.columns if c.endswith("Key") and c != own_key]


def negative_rules(df: DataFrame) -> list[tuple[str, Column]]:
    return [
        (f"Negative measure {c}", F.col(c) < 0) for c in df.columns if any(token in c for token in NON_NEGATIVE)
    ]


def text_length_rules(df: DataFrame, spec: TableSpec) -> list[tuple[str, Column]]:
    return [
        (f"Text length {c.name}", F.length(c.name) > c.limit)
        for c in spec.all_columns()
        if c.limit and c.name in df.columns
    ]


def fact_key_filled_rules(df: DataFrame, spec: TableSpec) -> list[tuple[str, Column]]:
    return [(f"Unfilled key {fk.column}", F.col(fk.column).isNull()) for fk in spec.references if fk.column in df.columns]


def user_rules(rules: list[Rule], table: str) -> list[tuple[str, Column]]:
    return [(r.name, F.expr(r.fails_when)) for r in rules if r.table == table and r.active]


def profile(df: DataFrame, spec: TableSpec, extra: list[Rule] | None = None) -> DataFrame:
    """Row count, NULL keys, negatives of a fact and user rules, in one pass."""
    name = f"{spec.schema}.{spec.name}"
    rules = row_count_rule() + null_key_rules(df, spec.key)
    if spec.kind == "fact":
        rules += negative_rules(df)
    return one_pass(df, name, rules + user_rules(extra or [], name))


def orphan_checks(
    df: DataFrame, table: str, parents: dict[str, tuple[DataFrame, str]], exempt_unknown: bool = True, budget: BroadcastBudget | None = None
) -> DataFrame:
    """Rows per foreign key whose parent is missing, in one pass over the table.

    Small parents are looked up row by row, if the plan's budget holds them all. Otherwise the rows and
    the parents are counted together by key.
    """
    budget = BroadcastBudget() if budget is None else budget
    present = [parent.select(F.col(key).alias("__k"), F.lit(True).alias(f"__has{n}")) for n, (parent, key) in enumerate(parents.values())]
    if not all(fits_broadcast(p) for p in present) or not budget.take(sum(broadcast_bytes(p) for p in present)):
        return _counted_orphans(df, table, parents, exempt_unknown)
    probe, rules = df.select(*parents), []
    for n, fk in enumerate(parents):
        probe = sized_join(probe, present[n], {fk: "__k"}, "left")
        missing = F.col(fk).isNotNull() & F.col(f"__has{n}").isNull()
        if exempt_unknown:
            missing = missing & (F.col(fk) != UNKNOWN_KEY)
        rules.append((f"Orphan FK {fk}", missing))
    return one_pass(probe, table, rules)


def _counted_orphans(df: DataFrame, table: str, parents: dict[str, tuple[DataFrame, str]], exempt_unknown: bool) -> DataFrame:
    """Orphans of any number of large parents: one row per key and foreign key is left before the shuffle,
    whatever the table's size and skew, and nothing is broadcast."""
    types = [f.dataType for fk, (parent, key) in parents.items() for f in (df.schema[fk], parent.schema[key])]
    kind = "bigint" if all(isinstance(t, IntegralType) for t in types) else "string"
    # No. of the foreign key, key, rows that carry it, whether the parent has it.
    used = F.explode(F.array(*[F.struct(F.lit(n).alias("fk"), F.col(fk).cast(kind).alias("key")) for n, fk in enumerate(parents)]))
    sides = [df.select(used.alias("k")).select("k.*", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("known"))] + [
        parent.select(F.lit(n).alias("fk"), F.col(key).cast(kind).alias("key"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("known"))
        for n, (parent, key) in enumerate(parents.values())
    ]
    met = reduce(DataFrame.unionByName, sides).groupBy("fk", "key").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    missing = F.col("key").isNotNull() & ~F.col("known")
    if exempt_unknown:
        missing = missing & (F.col("key") != F.lit(UNKNOWN_KEY).cast(kind))
    count_of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    totals = met.agg(*[c for n in range(len(parents)) for c in (
        count_of(F.col("fk") == n).alias(f"c{n}"), count_of((F.col("fk") == n) & missing).alias(f"f{n}")
    )])
    rows = F.array(*[
        F.struct(F.lit(f"Orphan FK {fk}").alias("rule"), F.lit(table).alias("table"), F.col(f"c{n}").alias("checked"), F.col(f"f{n}").alias("failed"))
        for n, fk in enumerate(parents)
    ])
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def spark_of(tables: dict[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def foreign_key_checks(model: WarehouseModel, tables: dict[str, DataFrame], kinds: tuple[str, ...], exempt_unknown: bool) -> DataFrame:
    """Orphan checks for every declared foreign key of the tables present, in one plan with one budget."""
    parts, budget = [], BroadcastBudget()
    for spec in model.of_kind(*kinds):
        if spec.name not in tables:
            continue
        df = tables[spec.name]
        parents = {
            e.column: (tables[e.parent], e.parent_key)
            for e in model.edges(spec.name)
            if e.parent in tables and e.column in df.columns
        }
        if parents:
            parts.append(orphan_checks(df, f"{spec.schema}.{spec.name}", parents, exempt_unknown, budget))
    if not parts:  # no table of these kinds has data yet
        return spark_of(tables).createDataFrame([], "rule string, `table` string, checked bigint, failed bigint")
    return reduce(DataFrame.unionByName, parts)


def _duplicate_rows(df: DataFrame, keys: list[str], table: str, rule: str, null_fails: bool) -> DataFrame:
    """Rows beyond the first of each key, and rows without a key where that fails too.

    Nearly every key stands alone, so counting before the shuffle would only fill memory: rows are dealt
    by key to as many tasks as the table's size asks for. Rows without a key need not meet, and stay spread.
    """
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows, parts = df.select(*keys, F.when(empty, F.spark_partition_id()).alias("__part")), pieces_of(df)
    by = [*keys, "__part"]
    dealt = rows.repartition(parts, *by) if parts else rows.repartition(*by)
    groups = dealt.groupBy(*by).agg(F.count("*").alias("n"))
    extra = F.when(empty, F.col("n") if null_fails else 0).otherwise(F.col("n") - 1)
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"), F.coalesce(F.sum(extra), F.lit(0)).alias("failed")
    ).select(F.lit(rule).alias("rule"), F.lit(table).alias("table"), "checked", "failed")


def primary_key_unique(df: DataFrame, spec: TableSpec) -> DataFrame:
    return _duplicate_rows(df, [spec.key], f"{spec.schema}.{spec.name}", f"Primary key {spec.key}", True)


def business_key_unique(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Business key unique; on a versioned dimension, one current row per key."""
    rows = df.filter(F.col("IsCurrent")) if spec.is_scd2 else df
    bk = spec.business_key.name
    return _duplicate_rows(rows, [bk], f"{spec.schema}.{spec.name}", f"Business key {bk}", True)


def members_unique(df: DataFrame, spec: TableSpec) -> DataFrame:
    members = [fk.column for fk in spec.foreign_keys if fk.member]
    return _duplicate_rows(df, members, f"{spec.schema}.{spec.name}", "Unique members", False)


def unknown_member_present(df: DataFrame, spec: TableSpec) -> DataFrame:
    counted = df.agg(F.count("*").alias("checked"), F.count_if(F.col(spec.key) == UNKNOWN_KEY).alias("n"))
    return counted.select(
        F.lit("Unknown member").alias("rule"),
        F.lit(f"{spec.schema}.{spec.name}").alias("table"),
        "checked",
        F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("failed"),
    )


def empty_tables(counts: DataFrame, ignored_schemas: tuple[str, ...] = ("stg",)) -> DataFrame:
    """Tables with no rows, staging left out."""
    return counts.filter((F.col("row_count") == 0) & ~F.col("schema_name").isin(*ignored_schemas))


def results(checks: DataFrame, batch_id: int, checked_at: Column) -> DataFrame:
    """Result rows: a pass has no failed rows, a failure has at least one."""
    failed = F.coalesce(F.col("failed"), F.lit(0))
    passed = failed == 0
    return checks.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        rule_code(F.concat_ws("_", "rule", "table")).alias("rule_code"),
        "rule",
        "table",
        F.col("checked").cast("bigint").alias("checked"),
        F.when(passed, 0).otherwise(F.greatest(failed, F.lit(1))).cast("bigint").alias("failed"),
        F.when(passed, "Pass").otherwise("Fail").alias("status"),
        checked_at.alias("checked_at"),
    )


def new_rules(registry: DataFrame, checks: DataFrame) -> DataFrame:
    """Rules not registered yet, to be appended to the registry."""
    seen = checks.select(
        rule_code(F.concat_ws("_", "rule", "table")).alias("RuleCode"),
        F.col("rule").alias("RuleName"),
        F.col("table").alias("TargetTableName"),
        F.concat_ws(" on ", "rule", "table").alias("RuleExpression"),
        F.lit(True).alias("IsActive"),
    ).distinct()
    return sized_join(seen, registry.select("RuleCode").distinct(), {"RuleCode": "RuleCode"}, "left_anti")


def catalog_edges(spark: SparkSession, model: WarehouseModel) -> DataFrame:
    """The model's foreign keys as rows."""
    rows = [
        (model[e.child].schema, e.child, e.column, model[e.parent].schema, e.parent, e.parent_key)
        for spec in model.of_kind("ref", "dim", "bridge", "fact")
        for e in model.edges(spec.name)
    ]
    return spark.createDataFrame(
        rows,
        "child_schema string, child_table string, child_column string, "
        "parent_schema string, parent_table string, parent_column string",
    )


def catalog_columns(spark: SparkSession, model: WarehouseModel) -> DataFrame:
    rows = [
        (s.schema, s.name, n, c.name, c.type, c.nullable)
        for s in model.of_kind("ref", "dim", "bridge", "fact")
        for n, c in enumerate(s.all_columns(), 1)
    ]
    return spark.createDataFrame(
        rows,
        "schema_name string, table_name string, ordinal int, column_name string, data_type string, nullable boolean",
    )


def climb_closure(edges: DataFrame) -> DataFrame:
    """Every (child, ancestor, depth) of an edge list with columns child and parent.

    One join per level climbs all paths at once; a node is not entered twice on a path, and
    the longest way to an ancestor counts. Each level is written before the next one reads
    it, so the plan does not grow with the depth.
    """
    steps = edges.select("child", "parent").filter("child <> parent").distinct()
    level = steps.select("child", F.col("parent").alias("ancestor"), F.array("child", "parent").alias("path"))
    levels = []
    for depth in count(1):
        level = materialise(level, "climb")
        if level.isEmpty():
            break
        levels.append(level.select("child", "ancestor", F.lit(depth).alias("depth")))
        up = steps.select(F.col("child").alias("__from"), F.col("parent").alias("__to"))
        level = (
            sized_join(level, up, {"ancestor": "__from"})
            .filter(~F.array_contains("path", F.col("__to")))
            .select("child", F.col("__to").alias("ancestor"), F.array_append("path", F.col("__to")).alias("path"))
        )
    every = reduce(DataFrame.unionByName, levels) if levels else level.select("child", "ancestor", F.lit(0).alias("depth"))
    return every.groupBy("child", "ancestor").agg(F.max("depth").alias("depth"))


def snowflake_depth(edges: DataFrame) -> DataFrame:
    """Longest chain of dimensions above each dimension, deepest first."""
    dims = edges.filter("child_schema = 'dim' AND parent_schema = 'dim'").selectExpr(
        "child_table AS child", "parent_table AS parent"
    )
    return (
        climb_closure(dims)
        .groupBy("child")
        .agg(F.max("depth").alias("depth"))
        .withColumnRenamed("child", "table_name")
        .orderBy(F.desc("depth"), "table_name")
    )
