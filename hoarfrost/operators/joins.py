"""Equi-joins of large rows to dimensions, with a size check in front of every broadcast."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.model import UNKNOWN_KEY

# A side is broadcast only while the size Spark's planner gives it, times what compressed
# columns may grow to in memory, stays under the limit: a megabyte by the planner. The planner counts the
# bytes of files, in which narrow rows take next to nothing: parts and customers took 25 to 53 times as
# much when broadcast, so a side of the limit takes some 55 MB. The driver also holds the collected rows while it
# builds the table, so a side is kept far below its heap.
BROADCAST_LIMIT = 16 * 1024 * 1024
EXPANSION = 16
# All sides that one plan broadcasts are in memory together, on the driver and on every executor: they may
# take as much as this many sides of the limit.
BROADCAST_SIDES = 2
# Beyond the limit both sides are shuffled on their key. A key with more rows than this on
# the left, NULL and the unknown key included, is cut into pieces of about this size.
HEAVY_ROWS = 5_000_000
# Bytes of files that one task is dealt where it keeps what it reads in memory, a million rows at most as a
# rule; sizes from which the planner does not know a table's size.
PIECE_BYTES, UNKNOWN_BYTES = 8 * 1024 * 1024, 1 << 60


def plan_bytes(df: DataFrame) -> int:
    """The planner's upper estimate of a DataFrame's size."""
    return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())


def pieces_of(df: DataFrame, piece: int = PIECE_BYTES) -> int | None:
    """How many pieces the files below a DataFrame are cut into; None if their size isn't known.

    Joins and aggregates on the way do not count: the planner's estimates of them are far off.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return None if size >= UNKNOWN_BYTES else max(1, ceil(size / piece))


class BroadcastBudget:
    """What the broadcasts of one plan may take together. Each side that fits takes its share."""

    def __init__(self, size: int | None = None):
        self.left = BROADCAST_SIDES * BROADCAST_LIMIT if size is None else size

    def take(self, size: float) -> bool:
        if size > self.left:
            return False
        self.left -= size
        return True


def row_bytes(df: DataFrame) -> int:
    """The planner's size of a row, from the types of its columns."""
    return 8 + df._jdf.schema().defaultSize()


def broadcast_bytes(df: DataFrame, size_from: DataFrame | None = None) -> float:
    """What a side may take in memory. With `size_from`, a frame of as many rows, its rows times the
    width of `df`: the planner's own estimate grows with every join below, and would be far too high."""
    if size_from is None:
        return plan_bytes(df) * EXPANSION
    return plan_bytes(size_from) / row_bytes(size_from) * row_bytes(df) * EXPANSION


def fits_broadcast(df: DataFrame, limit: int | None = None, size_from: DataFrame | None = None, budget: BroadcastBudget | None = None) -> bool:
    size = broadcast_bytes(df, size_from)
    return size <= (BROADCAST_LIMIT if limit is None else limit) and (budget is None or budget.take(size))


def sized_join(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, str],
    how: str = "inner",
    limit: int | None = None,
    heavy_rows: int | None = HEAVY_ROWS,
    size_from: DataFrame | None = None,
    skew_from: DataFrame | None = None,
    null_safe: bool = False,
    budget: BroadcastBudget | None = None,
) -> DataFrame:
    """Join left rows to a right side that has few rows per key, one as a rule.

    `keys` maps left columns to right columns. The result holds the left columns and the
    right columns that are not keys. A small right side is broadcast. With a larger one,
    both sides are shuffled, and the left's heavy keys are spread over many tasks. Where the
    left keys are unique there is nothing to spread: pass `heavy_rows=None`. The hint keeps the
    planner, which broadcasts up to ten megabytes by the bytes of files, from doing so all the same.

    The planner multiplies sizes at each join, so for a right side that was itself joined
    to its parents, row by row, `size_from` names the table it has the rows of; the width is that
    of all its columns. `skew_from` names a cheaper frame with the left's keys to count them in.
    Joins of one plan share a `budget`: what they broadcast is held together.
    """
    names = {r: f"__right_{i}" for i, r in enumerate(keys.values())}
    picked = right.select(
        *[F.col(r).alias(n) for r, n in names.items()],
        *[F.col(c) for c in right.columns if c not in names],
    )
    pairs = [(F.col(k), F.col(names[r])) for k, r in keys.items()]
    on = reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    if fits_broadcast(picked, limit, size_from, budget):
        joined = left.join(F.broadcast(picked), on, how)
    elif heavy_rows is None:
        joined = left.join(picked.hint("merge"), on, how)
    else:
        heavy = heavy_keys(left if skew_from is None else skew_from, list(keys), heavy_rows)
        spread = _mark(left, list(keys), heavy).withColumn(
            "__salt", F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.col("__pieces"))
        )
        copies = _mark(picked, list(names.values()), heavy).withColumn(
            "__copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__pieces") - 1))
        )
        joined = spread.drop("__pieces").join(
            copies.drop("__pieces").hint("merge"), on & (F.col("__salt") == F.col("__copy")), how
        ).drop("__salt", "__copy")
    return joined.drop(*names.values())


def heavy_keys(df: DataFrame, keys: list[str], heavy_rows: int) -> DataFrame:
    """Hashes of the keys with more than `heavy_rows` rows, and the pieces to cut each into.

    Counting combines before its shuffle, and there is at most one such key per
    `heavy_rows` rows of the table, so the list is small enough to broadcast.
    """
    counted = df.groupBy(F.xxhash64(*keys).alias("__heavy")).agg(F.count("*").alias("__rows"))
    pieces = F.ceil(F.col("__rows") / heavy_rows).cast("bigint")
    return counted.filter(F.col("__rows") > heavy_rows).select("__heavy", pieces.alias("__cut"))


def _mark(df: DataFrame, keys: list[str], heavy: DataFrame) -> DataFrame:
    """Add the number of pieces a row's key is cut into, 1 for most."""
    found = df.join(F.broadcast(heavy), F.xxhash64(*keys) == F.col("__heavy"), "left")
    return found.withColumn("__pieces", F.coalesce("__cut", F.lit(1).cast("bigint"))).drop("__heavy", "__cut")


def star_join(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Inner join of a fact to each dimension on its surrogate key."""
    joined, budget = fact, BroadcastBudget()
    for fk, (dim, key) in dims.items():
        joined = sized_join(joined, dim, {fk: key}, skew_from=fact, budget=budget)
    return joined


def climb(df: DataFrame, levels: list[tuple[str, DataFrame, str]], budget: BroadcastBudget | None = None) -> DataFrame:
    """Inner chain up one branch: each level is (column pointing up, parent, parent key).

    The levels are joined to each other from the top down, so the rows at the bottom, the
    many, meet one table however deep the branch is.
    """
    if not levels:
        return df
    (column, parent, key), above = levels[0], levels[1:]
    budget = BroadcastBudget() if budget is None else budget
    return sized_join(df, climb(parent, above, budget), {column: key}, size_from=parent, skew_from=df, budget=budget)


def role_join(fact: DataFrame, dim: DataFrame, key: str, roles: dict[str, str], how: str = "inner") -> DataFrame:
    """Join one dimension several times. `roles` maps a role to the fact column it plays;
    the dimension's columns come out prefixed with the role."""
    joined, budget = fact, BroadcastBudget()
    for role, fk in roles.items():
        played = dim.select(F.col(key), *[F.col(c).alias(f"{role}{c}") for c in dim.columns if c != key])
        joined = sized_join(joined, played, {fk: key}, how, skew_from=fact, budget=budget)
    return joined


def resolve_key(
    stage: DataFrame,
    dim: DataFrame,
    natural: str,
    business_key: str,
    key: str,
    out: str,
    current_only: bool = False,
    miss: str | None = None,
    ci_keys: bool = False,
    skew_from: DataFrame | None = None,
    budget: BroadcastBudget | None = None,
) -> DataFrame:
    """Add `out`: the key of the parent with the staged business key, or -1.

    With `miss`, also add a flag that is true when a staged key found no parent. With
    `ci_keys`, letter case is ignored, as in a case-insensitive database.
    """
    if current_only:
        dim = dim.filter(F.col("IsCurrent"))
    fold = F.lower if ci_keys else (lambda c: c)
    parents = dim.select(fold(F.col(business_key)).alias("__bk"), F.col(key).alias("__key"))
    probe = stage.withColumn("__natural", fold(F.col(natural)))
    counted = None if skew_from is None else skew_from.select(fold(F.col(natural)).alias("__natural"))
    joined = sized_join(probe, parents, {"__natural": "__bk"}, "left", skew_from=counted, budget=budget)
    if miss:
        joined = joined.withColumn(miss, F.col(natural).isNotNull() & F.col("__key").isNull())
    return joined.withColumn(out, F.coalesce(F.col("__key"), F.lit(UNKNOWN_KEY))).drop("__key", "__natural")


def check_key(
    stage: DataFrame, dim: DataFrame, fk: str, key: str, skew_from: DataFrame | None = None, budget: BroadcastBudget | None = None
) -> DataFrame:
    """Keep a staged surrogate key only if the parent has it, else -1."""
    parents = dim.select(F.col(key).alias("__bk"), F.col(key).alias("__key"))
    joined = sized_join(stage, parents, {fk: "__bk"}, "left", skew_from=skew_from, budget=budget)
    return joined.withColumn(fk, F.coalesce(F.col("__key"), F.lit(UNKNOWN_KEY))).drop("__key")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, key: str, exempt_unknown: bool = True) -> DataFrame:
    """Keys of a fact that no parent has, with the number of rows that carry each.

    The fact is reduced to its distinct keys first, so what meets the dimension is at most
    one row per key whatever the fact's size and skew.
    """
    keys = fact.select(F.col(fk)).filter(F.col(fk).isNotNull())
    if exempt_unknown:
        keys = keys.filter(F.col(fk) != UNKNOWN_KEY)
    counted = keys.groupBy(fk).agg(F.count("*").alias("row_count"))
    return sized_join(counted, dim.select(key), {fk: key}, "left_anti", heavy_rows=None)


def lookup_miss(stage: DataFrame, dim: DataFrame, natural: str, business_key: str) -> DataFrame:
    """Staged business keys, NULL left out, that no parent row has."""
    return orphans(stage, dim.select(business_key).distinct(), natural, business_key, exempt_unknown=False)


def via_bridge(df: DataFrame, bridge: DataFrame, member: str, other: DataFrame, other_member: str, other_key: str) -> DataFrame:
    """Reach a many-to-many dimension through its resolver.

    One row comes out per matching bridge row, so measures of `df` repeat: aggregate them
    before the bridge, or weight them by the bridge's share. A member may hold a large part
    of the bridge, so the bridge is the side whose heavy keys are spread.
    """
    pairs = bridge.select(member, other_member)
    reached = sized_join(pairs, df, {member: member})
    return sized_join(reached, other, {other_member: other_key}, skew_from=pairs)
