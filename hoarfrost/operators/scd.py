"""Type 1 and type 2 dimension merges, written as a rewrite of the dimension.

Both merges join on the business key and take the staged batch as the small side: while it
fits a broadcast, the dimension itself is read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import row_hash
from hoarfrost.model import OPEN_END, VERSION_COLUMNS, TableSpec, WarehouseModel
from hoarfrost.operators.filters import batch, changed, project_shared, with_defaults
from hoarfrost.operators.joins import BroadcastBudget, resolve_key, sized_join
from hoarfrost.operators.keys import assign_keys, highest_key
from hoarfrost.session import materialise


#: What a batch had to say of a dimension, kept by batch: every staged key, its hash (none where the table
#: has no versions) and the time the batch was merged as of.
OBSERVED = "BusinessKeyValue string, RowHash binary, ObservedAtUtc timestamp_ntz, BatchId bigint"


@dataclass(frozen=True)
class Merge:
    """A merged dimension, and what became of every staged business key."""

    table: DataFrame
    changes: DataFrame  # business key, action (insert, update, unchanged), old and new hash, whether a row changed


@dataclass(frozen=True)
class Insertion:
    """A dimension with a late batch put into its histories, and where facts of later batches must look anew."""

    table: DataFrame
    seen: DataFrame  # every staged business key, with its hash and the time it counts from (`OBSERVED`)
    changed: DataFrame  # business key, one row or more, of every row that was written or changed
    moved: DataFrame  # business key, OldKey (the key such facts carry now, NULL: none), UntilBatch (NULL: no end)


def latest_per_key(stage: DataFrame, business_key: str) -> DataFrame:
    """One row per business key, the one staged last. Rows without a key cannot be stored.

    A maximum over whole rows combines before the shuffle, so a key staged over and over
    arrives as one row per task.
    """
    rest = sorted(c for c in stage.columns if c not in ("RowNumber", business_key))
    latest = (
        stage.filter(F.col(business_key).isNotNull())
        .groupBy(business_key)
        .agg(F.max(F.struct("RowNumber", *rest)).alias("__row"))
    )
    return latest.select(business_key, "__row.*").select(*stage.columns)


def resolve_parents(model: WarehouseModel, spec: TableSpec, stage: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Turn the staged natural keys of a dimension's parents into foreign keys."""
    staged, budget = stage, BroadcastBudget()
    for fk in spec.foreign_keys:
        parent = model[fk.parent]
        natural = model.natural_column(fk)
        if fk.parent in dims and natural in stage.columns:
            stage = resolve_key(
                stage, dims[fk.parent], natural, parent.business_key.name, parent.key, fk.column, parent.is_scd2,
                skew_from=staged, budget=budget,
            )
    return stage


def hash_columns(model: WarehouseModel | None, spec: TableSpec, stage: DataFrame, target: list[str]) -> list[str]:
    """What a row's hash covers: business key, own attributes, then parents by natural key.

    Parents count by natural key, so a new version of a parent does not make a new version
    of all its children.
    """
    keys = {fk.column for fk in spec.references}
    bk = spec.business_key.name
    own = [c for c in project_shared(stage, target, {bk, spec.key, *VERSION_COLUMNS}) if c not in keys]
    naturals = [model.natural_column(fk) for fk in spec.foreign_keys] if model else []
    staged = [n for n in naturals if n in stage.columns]
    plain = [fk.column for fk in spec.foreign_keys if fk.column in stage.columns] if not staged else []
    return [bk, *own, *staged, *plain]


def _existing(current: DataFrame, staged: DataFrame, business_key: str) -> DataFrame:
    """The rows of a dimension that the batch touches."""
    return sized_join(current, staged.select(business_key), {business_key: business_key}, "left_semi", heavy_rows=None)


def _hashed(dim: DataFrame, stage: DataFrame, spec: TableSpec, batch_id: int, model: WarehouseModel | None) -> DataFrame:
    """A batch's last row of each key, with its hash."""
    staged = latest_per_key(batch(stage, batch_id), spec.business_key.name)
    covered = hash_columns(model, spec, staged, dim.columns)
    computed = row_hash(staged.schema, covered)
    given = F.col("RowHash") if "RowHash" in staged.columns else F.lit(None)
    return staged.withColumn("RowHash", F.coalesce(given, computed))


def scd2_merge(
    dim: DataFrame,
    stage: DataFrame,
    spec: TableSpec,
    batch_id: int,
    now: Column,
    model: WarehouseModel | None = None,
    dims: dict[str, DataFrame] | None = None,
    highest: Column | int | None = None,
) -> Merge:
    """Close the current version of each changed row and open a new one.

    Unchanged rows stay as they are, rows missing from the batch stay current, and a batch
    applied twice changes nothing the second time, because every hash then agrees. `dim` may be
    a part of the dimension that holds all staged keys; then `highest` is the whole one's highest key.
    """
    bk = spec.business_key.name
    staged = _hashed(dim, stage, spec, batch_id, model)

    current = dim.filter(F.col("IsCurrent")).select(bk, F.col("RowHash").alias("__old"))
    compared = sized_join(staged, _existing(current, staged, bk), {bk: bk}, "left", heavy_rows=None)
    action = (
        F.when(F.col("__old").isNull(), "insert")
        .when(changed(F.col("__old"), F.col("RowHash")), "update")
        .otherwise("unchanged")
    )
    # Four later passes read this set; written once, they see the same rows and keys.
    compared = materialise(compared.withColumn("__action", action), f"scd2-{spec.name}")

    closing = compared.filter(F.col("__action") == "update").select(bk, F.lit(True).alias("__close"))
    marked = sized_join(dim, closing, {bk: bk}, "left", heavy_rows=None)  # a key has a row per version
    closes = F.col("IsCurrent") & F.coalesce(F.col("__close"), F.lit(False))
    end_type = dim.schema["EffectiveToUtc"].dataType
    kept = marked.withColumns(
        {
            "EffectiveToUtc": F.when(closes, now.cast(end_type)).otherwise(F.col("EffectiveToUtc")),
            "IsCurrent": F.col("IsCurrent") & ~closes,
        }
    ).select(*dim.columns)

    opened = compared.filter(F.col("__action") != "unchanged")
    if dims:
        opened = resolve_parents(model, spec, opened, dims)
    opened = assign_keys(opened, [bk], spec.key, highest_key(dim, spec.key) if highest is None else highest)
    fresh = _shaped(opened.drop("BatchId", *VERSION_COLUMNS[:3]), dim, spec, batch_id, now)
    changes = compared.select(
        F.col(bk).cast("string").alias("BusinessKeyValue"),
        F.col("__action").alias("action"),
        F.col("__old").alias("old_hash"),
        F.col("RowHash").alias("new_hash"),
        (F.col("__action") != "unchanged").alias("changed"),
    )
    return Merge(kept.unionByName(fresh), changes)


def scd1_merge(
    dim: DataFrame,
    stage: DataFrame,
    spec: TableSpec,
    batch_id: int,
    now: Column,
    model: WarehouseModel | None = None,
    dims: dict[str, DataFrame] | None = None,
    highest: Column | int | None = None,
) -> Merge:
    """Overwrite the shared attributes of known rows and insert unknown ones.

    Matched rows keep their key and audit columns; an inserted row carries the batch id. A
    matched row counts as an update, and as changed if an attribute is another. `dim` may be
    a part of the dimension that holds all staged keys; then `highest` is the whole one's highest key.
    """
    bk = spec.business_key.name
    staged = latest_per_key(batch(stage, batch_id), bk)
    if dims:
        staged = resolve_parents(model, spec, staged, dims)
    shared = project_shared(staged, dim.columns, {bk, spec.key, "SourceSystemKey", "LoadedAtUtc"})
    known = dim.select(bk, F.struct(*[F.col(c) for c in shared], F.lit(True).alias("__is")).alias("__known"))
    existing = _existing(known, staged, bk)
    compared = sized_join(staged, existing, {bk: bk}, "left", heavy_rows=None)
    same = [F.col(c).cast(dim.schema[c].dataType).eqNullSafe(F.col("__known")[c]) for c in shared]
    compared = compared.withColumn("__same", reduce(lambda a, b: a & b, same, F.col("__known").isNotNull()))
    compared = materialise(compared, f"scd1-{spec.name}")

    incoming = compared.filter(F.col("__known").isNotNull() & ~F.col("__same")).select(
        bk, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in shared]
    )
    joined = sized_join(dim, incoming, {bk: bk}, "left", heavy_rows=None)
    updated = joined.withColumns(
        {c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).cast(dim.schema[c].dataType) for c in shared}
    ).select(*dim.columns)

    added = compared.filter(F.col("__known").isNull())
    added = assign_keys(added, [bk], spec.key, highest_key(dim, spec.key) if highest is None else highest)
    fresh = _shaped(added.drop("BatchId", "SourceSystemKey"), dim, spec, batch_id, now)
    changes = compared.select(
        F.col(bk).cast("string").alias("BusinessKeyValue"),
        F.when(F.col("__known").isNotNull(), "update").otherwise("insert").alias("action"),
        F.lit(None).cast("binary").alias("old_hash"),
        F.lit(None).cast("binary").alias("new_hash"),
        (~F.col("__same")).alias("changed"),
    )
    return Merge(updated.unionByName(fresh), changes)


def observed(changes: DataFrame, now: Column) -> DataFrame:
    """What a merge saw, for batches that come late: see `OBSERVED`."""
    return changes.select("BusinessKeyValue", F.col("new_hash").alias("RowHash"), now.cast("timestamp_ntz").alias("ObservedAtUtc"))


def scd2_insert(
    dim: DataFrame,
    stage: DataFrame,
    spec: TableSpec,
    batch_id: int,
    now: Column,
    later: DataFrame,
    model: WarehouseModel | None = None,
    dims: dict[str, DataFrame] | None = None,
    highest: Column | int | None = None,
) -> Insertion:
    """Put a late batch into the histories of its own keys.

    `later` holds what the batches after it observed (`OBSERVED`). From a key's first later observation on
    its history is what it was, so only the stretch before that changes. A staged row that differs from the
    version before the batch closes that version, and

    - with nothing observed later, becomes the current one;
    - if the next observation agrees with it, that one's version starts earlier, under its own key;
    - if the next observation agrees with the version before, which then went on, stands in between, and
      that version opens again at the next observation, under a new key;
    - else ends where the next version starts.

    A version starts no earlier than the one before it and no later than the next observation, whatever
    `now` says. Parents are resolved by `dims`, to be given as of the batch.
    """
    bk, key = spec.business_key.name, spec.key
    staged = materialise(_hashed(dim, stage, spec, batch_id, model), f"late-{spec.name}")
    moment = dim.schema["EffectiveFromUtc"].dataType
    own = _existing(dim, staged, bk)
    before = own.filter(F.col("BatchId") < batch_id).groupBy(bk).agg(
        F.max_by(F.struct(*dim.columns), F.struct("BatchId", key)).alias("__before")
    )
    following = later.groupBy(F.col("BusinessKeyValue").alias("__of")).agg(
        F.min(F.struct("BatchId", F.col("ObservedAtUtc").cast(moment).alias("At"), "RowHash")).alias("__next")
    )
    met = sized_join(staged, before, {bk: bk}, "left", heavy_rows=None)
    met = sized_join(met, following, {bk: "__of"}, "left", heavy_rows=None)
    differs = F.col("__before").isNull() | changed(F.col("__before.RowHash"), F.col("RowHash"))
    kind = (
        F.when(F.col("__next").isNull(), "open")
        .when(F.col("__next.RowHash") == F.col("RowHash"), "adopt")
        .when(F.col("__next.RowHash") == F.col("__before.RowHash"), "return")
        .otherwise("between")
    )
    start = F.greatest(F.least(now.cast(moment), F.col("__next.At")), F.col("__before.EffectiveFromUtc"))
    every = materialise(met.withColumns({"__differs": differs, "__kind": kind, "__start": start}), f"late-{spec.name}")
    met = every.filter("__differs")

    closes = met.filter(F.col("__before").isNotNull()).select(
        F.col(f"__before.{key}").alias("__row"), F.col("__start").alias("__to"), F.lit(None).cast(moment).alias("__from")
    )
    adopting = met.filter("__kind = 'adopt'").select(bk, F.col("__next.BatchId").alias("__batch"), "__start")
    adopts = sized_join(adopting, own.select(bk, "BatchId", key), {bk: bk, "__batch": "BatchId"}, heavy_rows=None).select(
        F.col(key).alias("__row"), F.lit(None).cast(moment).alias("__to"), F.col("__start").alias("__from")
    )
    marked = sized_join(dim, closes.unionByName(adopts), {key: "__row"}, "left", heavy_rows=None)
    kept = marked.withColumns(
        {
            "EffectiveToUtc": F.coalesce("__to", "EffectiveToUtc"),
            "IsCurrent": F.col("IsCurrent") & F.col("__to").isNull(),
            "EffectiveFromUtc": F.coalesce("__from", "EffectiveFromUtc"),
            "BatchId": F.when(F.col("__from").isNotNull(), batch_id).otherwise(F.col("BatchId")).cast(dim.schema["BatchId"].dataType),
        }
    ).select(*dim.columns)

    entering = met.filter("__kind <> 'adopt'")
    if dims:
        entering = resolve_parents(model, spec, entering, dims)
    ends = F.when(F.col("__kind") == "open", F.lit(OPEN_END).cast(moment)).otherwise(F.col("__next.At"))
    entering = entering.withColumns(
        {"EffectiveFromUtc": F.col("__start"), "EffectiveToUtc": ends, "IsCurrent": F.col("__kind") == "open", key: F.lit(None).cast("bigint")}
    )
    entering = _shaped(entering.drop("BatchId"), dim, spec, batch_id, now)
    going_on = met.filter("__kind = 'return'").select("__before.*", F.col("__next.At").alias("__at"), F.col("__next.BatchId").alias("__batch"))
    returning = going_on.withColumns({"EffectiveFromUtc": F.col("__at"), "BatchId": F.col("__batch")}).select(*dim.columns)
    fresh = entering.unionByName(returning).drop(key)
    fresh = assign_keys(fresh, [bk, "BatchId"], key, highest_key(dim, key) if highest is None else highest)
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    until = F.when(F.col("__kind").isin("adopt", "between"), F.col("__next.BatchId"))
    return Insertion(
        kept.unionByName(fresh),
        every.select(F.col(bk).cast("string").alias("BusinessKeyValue"), "RowHash", F.col("__start").cast("timestamp_ntz").alias("ObservedAtUtc")),
        met.select(bk),
        met.select(bk, F.col(f"__before.{key}").alias("OldKey"), until.alias("UntilBatch")),
    )


def scd1_insert(
    dim: DataFrame,
    stage: DataFrame,
    spec: TableSpec,
    batch_id: int,
    now: Column,
    later: DataFrame,
    model: WarehouseModel | None = None,
    dims: dict[str, DataFrame] | None = None,
    highest: Column | int | None = None,
) -> Insertion:
    """Merge a late batch into a table without versions: what later batches said of a key stays.

    Keys that no later batch names are merged as ever. A row that a later batch entered counts from
    this one on, by its batch id; `moved` names these keys and the new ones.
    """
    bk = spec.business_key.name
    staged = materialise(latest_per_key(batch(stage, batch_id), bk), f"late-{spec.name}")
    named = later.select("BusinessKeyValue").distinct()
    told = sized_join(staged.select(bk), named, {bk: "BusinessKeyValue"}, "left_semi", heavy_rows=None)
    done = scd1_merge(dim, sized_join(staged, named, {bk: "BusinessKeyValue"}, "left_anti", heavy_rows=None), spec, batch_id, now, model, dims, highest)
    entered = dim.filter(F.col("BatchId") > batch_id).select(bk, F.col("BatchId").alias("__entered"))
    earlier = materialise(_existing(entered, told, bk), f"late-{spec.name}")
    marked = sized_join(done.table, earlier, {bk: bk}, "left", heavy_rows=None)
    counts_from = F.when(F.col("__entered").isNotNull(), batch_id).otherwise(F.col("BatchId"))
    table = marked.withColumn("BatchId", counts_from.cast(dim.schema["BatchId"].dataType)).select(*dim.columns)
    kind, key_type = dim.schema[bk].dataType, dim.schema[spec.key].dataType
    entering = done.changes.filter("action = 'insert'").select(F.col("BusinessKeyValue").cast(kind).alias(bk), F.lit(None).cast("bigint").alias("__entered"))
    rewritten = done.changes.filter("changed").select(F.col("BusinessKeyValue").cast(kind).alias(bk))
    moved = earlier.unionByName(entering).select(bk, F.lit(None).cast(key_type).alias("OldKey"), F.col("__entered").alias("UntilBatch"))
    at = now.cast("timestamp_ntz").alias("ObservedAtUtc")
    seen = staged.select(F.col(bk).cast("string").alias("BusinessKeyValue"), F.lit(None).cast("binary").alias("RowHash"), at)
    return Insertion(table, seen, rewritten.unionByName(earlier.select(bk)), moved)


def as_of_batch(dim: DataFrame, spec: TableSpec, batch_id: int) -> DataFrame:
    """A dimension as the facts of a batch see it: without what later batches entered, and with the last
    version of every key up to the batch as its current one."""
    known = dim.filter(F.col("BatchId") <= batch_id)
    if not spec.is_scd2:
        return known
    last = known.groupBy(spec.business_key.name).agg(F.max(F.struct("BatchId", spec.key)).alias("__last"))
    picked = last.select(F.col(f"__last.{spec.key}").alias("__row"), F.lit(True).alias("__is"))
    marked = sized_join(known, picked, {spec.key: "__row"}, "left", heavy_rows=None)
    return marked.withColumn("IsCurrent", F.coalesce("__is", F.lit(False))).select(*dim.columns)


def _shaped(rows: DataFrame, dim: DataFrame, spec: TableSpec, batch_id: int, now: Column) -> DataFrame:
    full = with_defaults(rows, spec, batch_id, now)
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dim.schema.fields])


def merge_dimensions(
    model: WarehouseModel,
    dims: dict[str, DataFrame],
    stages: dict[str, DataFrame],
    batch_id: int,
    now: Column,
    enabled: set[str] | None = None,
    keep: Callable[[str, Callable[[DataFrame, Column | int | None], Merge]], tuple[Merge, DataFrame]] | None = None,
) -> dict[str, Merge]:
    """Merge every staged dimension, parents before children and otherwise by name.

    A dimension is versioned exactly when it has all version columns. Tables without a
    business key, or switched off in the load settings, are left out. With `keep`, each merge is
    handed over as a function of the dimension's rows (all, or all that staged keys may meet) and its
    highest key; `keep` stores it and returns it with the whole table, which children are resolved by.
    """
    done: dict[str, Merge] = {}
    latest = dict(dims)
    for name in merge_order(model, stages):
        spec = model[name]
        if spec.business_key is None or spec.business_key.name not in stages[name].columns:
            continue
        if enabled is not None and name not in enabled:
            continue
        versioned = all(c in dims[name].columns for c in VERSION_COLUMNS)

        def merge(part: DataFrame, highest: Column | int | None = None, name=name, spec=spec, how=scd2_merge if versioned else scd1_merge) -> Merge:  # noqa: ANN001
            return how(part, stages[name], spec, batch_id, now, model, latest, highest)

        if keep is None:
            done[name] = merge(latest[name])
            latest[name] = done[name].table
        else:
            done[name], latest[name] = keep(name, merge)
    return done


def merge_order(model: WarehouseModel, names) -> list[str]:
    """Staged dimensions in name order, each after the staged parents it points at."""
    pending = sorted(n for n in names if n in model and model[n].kind in ("ref", "dim"))
    ordered: list[str] = []
    while pending:
        ready = [
            n
            for n in pending
            if not any(fk.parent in pending and fk.parent != n for fk in model[n].foreign_keys)
        ]
        if not ready:
            raise ValueError(f"dimensions refer to each other in a circle: {pending}")
        ordered += ready
        pending = [n for n in pending if n not in ready]
    return ordered


def change_log(changes: DataFrame, dimension: str, batch_id: int) -> DataFrame:
    """One row per business key that a merge inserted or updated."""
    return changes.filter(F.col("action") != "unchanged").select(
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        F.lit(dimension).alias("DimensionName"),
        "BusinessKeyValue",
        F.col("action").alias("ChangeTypeCode"),
        F.col("old_hash").alias("PreviousRowHash"),
        F.col("new_hash").alias("NewRowHash"),
    )


def load_audit(changes: DataFrame, schema: str, table: str, batch_id: int, rejected: Column | int = 0) -> DataFrame:
    """Counts of one load: staged, inserted, updated, matched and rejected rows."""
    rejects = rejected if isinstance(rejected, Column) else F.lit(rejected)
    is_action = lambda name: F.count_if(F.col("action") == name)
    counted = changes.agg(
        F.count("*").alias("SourceRowCount"),
        is_action("insert").alias("InsertedRowCount"),
        is_action("update").alias("UpdatedRowCount"),
        F.count_if(F.col("action") != "insert").alias("MatchedRowCount"),
    )
    return counted.select(
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        F.lit(schema).alias("SchemaName"),
        F.lit(table).alias("TableName"),
        "SourceRowCount",
        "InsertedRowCount",
        "UpdatedRowCount",
        "MatchedRowCount",
        rejects.cast("bigint").alias("RejectedRowCount"),
    )


def open_version(rows: DataFrame, spec: TableSpec, start: Column, batch_id: int, model: WarehouseModel | None = None) -> DataFrame:
    """First load of a versioned dimension: every row is current from `start`."""
    covered = hash_columns(model, spec, rows, [c.name for c in spec.all_columns()])
    hashed = rows.withColumn("RowHash", row_hash(rows.schema, covered)).withColumns(
        {"EffectiveFromUtc": start, "EffectiveToUtc": F.lit(OPEN_END), "IsCurrent": F.lit(True)}
    )
    return with_defaults(hashed, spec, batch_id, start)
