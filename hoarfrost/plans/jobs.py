"""The scheduled jobs: load a landed batch, check quality, run the reports, keep house.

Each job is a driver program over the operators. A scheduler outside decides when it runs;
running one again with the same batch id leaves the warehouse as one run does.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoarfrost.model import VERSION_COLUMNS, TableSpec, WarehouseModel
from hoarfrost.operators import quality as dq
from hoarfrost.operators.control import (
    AGE_COLUMN,
    BY_BATCH,
    CONTROL_TABLES,
    RETENTION_DAYS,
    append_control,
    base_of,
    batch_loads,
    batch_run,
    disabled_tables,
    expired_files,
    key_ranges,
    load_increment,
    log_error,
    read_control,
    record_step,
    replace_control,
    stale_batches,
)
from hoarfrost.operators.facts import load_bridge, load_fact, lookup_misses, lookup_plan
from hoarfrost.operators.joins import sized_join
from hoarfrost.operators.keys import numbered
from hoarfrost.operators.scd import Merge, change_log, load_audit, merge_dimensions
from hoarfrost.plans.reports import run_reports, timings
from hoarfrost.plans.warehouse import Warehouse
from hoarfrost.session import materialise
from hoarfrost.sources import files, landing, tables


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def stored_dims(spark: SparkSession, model: WarehouseModel, root: str, before: int | None = None) -> dict[str, DataFrame]:
    """Every lookup and dimension that has a committed version (older than `before`)."""
    found = {}
    for spec in model.of_kind("ref", "dim"):
        kept = tables.versions(spark, f"{root}/{spec.name}")
        if any(before is None or v < before for v in kept):
            found[spec.name] = tables.read_version(spark, f"{root}/{spec.name}", before, spec.schema_type())
    return found


def load_batch(
    spark: SparkSession,
    model: WarehouseModel,
    landing_root: str,
    root: str,
    batch_id: int,
    now: Column | None = None,
    enabled: set[str] | None = None,
    later: str = "rebuild",
) -> dict[str, int]:
    """Stage what has landed, merge dimensions, load facts and bridges, and record it all.

    Returns the rows loaded per fact. Control tables live below `<root>/control`. Tables that the load
    settings there switch off are left out, as are those not in `enabled` if that is given.

    A load stands on the load of the batch before it, and says so. When a batch is loaded again, or comes
    late, the batches after it stand on something that is no more: they are loaded again too, in order,
    each as of its own first time, or with `later="refuse"` nothing is loaded at all. The same goes for
    batches that an interrupted load has left behind. If the files of one of them are gone, it is refused.
    """
    if later not in ("rebuild", "refuse"):
        raise ValueError(f"later is rebuild or refuse, not {later}")
    control = f"{root}/control"
    loads = batch_loads(spark, control)
    others = {b for b in loads if b > batch_id} | {b for b in stale_batches(loads) if b < batch_id}
    gone = [b for b in sorted(others) if not landing.landed_tables(spark, landing_root, b, model)]
    if others and (later == "refuse" or gone):
        why = f"the files of {gone} are gone" if gone else "that was not asked for"
        raise ValueError(f"batch {batch_id} needs batches {sorted(others)} to be loaded again, and {why}")
    counts = {}
    for b in sorted({*others, batch_id}):
        told = F.lit(loads[b].LoadedAtUtc) if b in loads else F.current_timestamp()
        at = now if b == batch_id and now is not None else told
        counts[b] = _load_one(spark, model, landing_root, root, b, at, enabled)
    return counts[batch_id]


def _note_load(spark: SparkSession, control: str, batch_id: int, token: str, at: dt.datetime) -> None:
    loads = batch_loads(spark, control)
    below = [b for b in sorted(loads) if b < batch_id]
    row = [(batch_id, token, loads[below[-1]].LoadToken if below else None, at)]
    tables.replace_batch(spark.createDataFrame(row, CONTROL_TABLES["BatchLoad"]), f"{control}/BatchLoad", batch_id)


def _load_one(
    spark: SparkSession, model: WarehouseModel, landing_root: str, root: str, batch_id: int, now: Column, enabled: set[str] | None
) -> dict[str, int]:
    control = f"{root}/control"
    counts: dict[str, int] = {}
    with batch_run(spark, control, batch_id, "load"):
        started = _now()
        moment = spark.range(1).select(now.cast("timestamp_ntz")).first()[0]
        at, token = F.lit(moment), uuid.uuid4().hex
        if batch_id in batch_loads(spark, control):
            # From here on the batches after this one count as built on something else.
            _note_load(spark, control, batch_id, token, moment)
        stages, off = {}, disabled_tables(spark, control)
        for name in landing.landed_tables(spark, landing_root, batch_id, model):
            if name not in off and (enabled is None or name in enabled):
                staged = landing.read_landing(spark, landing_root, batch_id, name, model.staging_schema(name))
                tables.stage(staged, f"{root}/stage/{name}")
                stages[name] = spark.read.schema(staged.schema).parquet(f"{root}/stage/{name}")
        record_received(spark, model, landing_root, control, batch_id, list(stages))
        record_step(spark, control, batch_id, "stage", "Succeeded", started, _now())

        started = _now()
        # A rerun starts from the versions before this batch and writes its own again.
        dims = stored_dims(spark, model, root, before=batch_id)
        for name in (n for n in stages if model[n].kind in ("ref", "dim") and n not in dims):
            dims[name] = spark.createDataFrame([], model[name].schema_type())
        # A batch may come before any that brings a parent: its rows are unknown members till then.
        parents = {e.parent for n in stages if model[n].kind in ("fact", "bridge") for e in model.edges(n)} - set(dims)
        for name in (p for p in sorted(parents) if model[p].business_key is not None and not model[p].explicit_key):
            dims[name] = spark.createDataFrame([], model[name].schema_type())
        staged_dims = {n: s for n, s in stages.items() if model[n].kind in ("ref", "dim")}
        audits, logs = [], []

        def keep(name: str, merge) -> tuple[Merge, DataFrame]:
            spec, path = model[name], f"{root}/{name}"
            done = tables.merge_version(spark, path, batch_id, spec, stages[name], merge)
            keyless = stages[name].filter(F.col(spec.business_key.name).isNull()).agg(F.count("*")).scalar()
            audits.append(load_audit(done.changes, spec.schema, name, batch_id, keyless))  # a row without its key cannot be stored
            dims[name] = tables.read_version(spark, path, batch_id + 1, spec.schema_type())
            if all(c in dims[name].columns for c in VERSION_COLUMNS):
                logs.append(change_log(done.changes, name, batch_id).withColumn("ChangedAtUtc", at))
            return done, dims[name]

        merge_dimensions(model, dims, staged_dims, batch_id, at, keep=keep)
        none = spark.createDataFrame([], CONTROL_TABLES["ScdChangeLog"])
        replace_control(spark, control, "ScdChangeLog", reduce(DataFrame.unionByName, logs, none), f"load-{batch_id}")
        if audits:
            tables.replace_batch(reduce(DataFrame.unionByName, audits), f"{control}/LoadAudit", batch_id)
        record_step(spark, control, batch_id, "merge", "Succeeded", started, _now())

        started = _now()
        missed = spark.createDataFrame([], CONTROL_TABLES["DqResult"])
        for name, staged in stages.items():
            spec, path = model[name], f"{root}/{name}"
            if spec.kind not in ("fact", "bridge"):
                continue
            base = fact_keys(spark, control, spec, staged, path, batch_id)
            if spec.kind == "bridge":
                write_bridge(spark, model, name, staged, dims, path, batch_id, at, base)
                continue
            flagged = materialise(load_fact(model, name, staged, dims, batch_id, at, highest=base, keep_misses=True), f"fact-{name}")
            main_date = f"{spec.date_roles[0]}DateKey" if spec.date_roles else None
            fact = flagged.select(*[c.name for c in spec.all_columns()])
            counts[name] = tables.replace_batch(fact, path, batch_id, main_date)
            plan = [p for p in lookup_plan(model, name, staged.columns) if p.mode == "natural"]
            if plan:
                misses = dq.results(lookup_misses(flagged, plan, name), batch_id, at)
                missed = missed.unionByName(misses.filter("status = 'Fail'"))
        replace_control(spark, control, "DqResult", missed, f"load-{batch_id}")
        if stages:
            _note_load(spark, control, batch_id, token, moment)
        record_step(spark, control, batch_id, "load facts", "Succeeded", started, _now())
    return counts


def fact_keys(spark: SparkSession, control: str, spec: TableSpec, staged: DataFrame, path: str, batch_id: int) -> Column:
    """What is added to a staged row's number to make its key: from the batch's own range of keys.

    The table itself is not read, but for the first range given out for one that was there before.
    """
    rows = staged.agg(F.max("RowNumber")).first()[0] or 0

    def first_base() -> int:
        if not files.exists(spark, path):
            return 0
        kept = spark.read.schema(spec.schema_type()).parquet(path).filter(F.col("BatchId") != batch_id)
        return kept.agg(F.coalesce(F.max(spec.key), F.lit(0))).first()[0]

    return base_of(key_ranges(spark, control, spec.name, batch_id, rows, first_base))


def record_received(spark: SparkSession, model: WarehouseModel, landing_root: str, control: str, batch_id: int, names: list[str]) -> None:
    """Note every file of a batch with its rows read and loaded, and every row that did not
    fit its table. A rerun replaces the notes of its batch."""
    if not names:
        return
    found = [
        landing.file_ingest(spark, landing.landing_path(landing_root, batch_id, n), model.staging_schema(n)).withColumn("TableName", F.lit(n))
        for n in names
    ]
    tables.replace_batch(reduce(DataFrame.unionByName, found), f"{control}/LandingFile", batch_id)
    noted = read_control(spark, control, "LandingFile").filter((F.col("BatchId") == batch_id) & (F.col("IngestStatusCode") != "Loaded"))
    partial = [r[0] for r in noted.select("TableName").distinct().collect()]  # at most the tables of the model
    raw = {n: landing.read_raw(spark, landing.landing_path(landing_root, batch_id, n), model.staging_schema(n)) for n in partial}
    lost = [landing.rejects(raw[n], model.staging_schema(n), batch_id, "stg", n) for n in sorted(raw)]
    none = spark.createDataFrame([], CONTROL_TABLES["RejectedRow"])
    tables.replace_batch(reduce(DataFrame.unionByName, lost, none), f"{control}/RejectedRow", batch_id)


def write_bridge(
    spark: SparkSession, model: WarehouseModel, name: str, staged: DataFrame, dims: dict[str, DataFrame], path: str, batch_id: int, now: Column, base: Column
) -> None:
    """Write a batch's new member combinations to its own folder of a bridge; known ones stay where they are.

    Known are the combinations of earlier batches, of which the member keys alone are read.
    """
    spec = model[name]
    loaded = load_bridge(model, name, staged, dims, batch_id, now, base)
    if spec.unique_members and files.exists(spark, path):
        members = {fk.column: fk.column for fk in spec.foreign_keys if fk.member}
        known = spark.read.schema(spec.schema_type()).parquet(path).filter(F.col("BatchId") < batch_id)
        loaded = sized_join(loaded, known.select(*members), members, "left_anti", heavy_rows=None)
    tables.replace_batch(materialise(loaded, f"bridge-{name}"), path, batch_id)


def check_quality(spark: SparkSession, model: WarehouseModel, root: str, batch_id: int, now: Column, rules: list[dq.Rule] | None = None) -> DataFrame:
    """Profile every stored table and check every foreign key; the results are kept."""
    found = stored_dims(spark, model, root)
    for spec in model.of_kind("fact", "bridge"):
        if files.exists(spark, f"{root}/{spec.name}"):
            found[spec.name] = spark.read.schema(spec.schema_type()).parquet(f"{root}/{spec.name}")
    parts = [dq.profile(found[n], model[n], rules) for n in sorted(found)]
    parts.append(dq.foreign_key_checks(model, found, ("fact", "bridge"), exempt_unknown=True))
    checked = materialise(dq.results(reduce(DataFrame.unionByName, parts), batch_id, now), "quality")
    control = f"{root}/control"
    replace_control(spark, control, "DqResult", checked, f"quality-{batch_id}")
    # Rules that are met for the first time are registered.
    known = read_control(spark, control, "DqRule") if files.exists(spark, f"{control}/DqRule") else spark.createDataFrame([], CONTROL_TABLES["DqRule"])
    append_control(spark, control, "DqRule", materialise(dq.new_rules(known, checked), "rules"))
    return checked


def run_analytics(
    spark: SparkSession, model: WarehouseModel, root: str, batch_id: int, as_of: dt.date, names: list[str] | None = None
) -> DataFrame:
    """Run the registered reports over the stored warehouse, in name order, and keep rows, time and status of each.

    The reports and their windows are fixed, so their times can be compared from run to run. One that fails is
    recorded as an error, and the rest go on.
    """
    control = f"{root}/control"
    with batch_run(spark, control, batch_id, "analytics"):
        started = _now()
        runs = run_reports(Warehouse.stored(spark, model, root), as_of, names)
        for r in runs.filter("status = 'Failed'").collect():  # at most one row per report
            log_error(spark, control, batch_id, "report", r.name, r.message, _now())
        replace_control(spark, control, "QueryTiming", timings(runs, batch_id), f"analytics-{batch_id}")
        record_step(spark, control, batch_id, "reports", "Succeeded", started, _now())
    return runs


def slower_reports(spark: SparkSession, root: str, batch_id: int, factor: float = 2.0) -> DataFrame:
    """Reports of a run that took more than `factor` times the median of their earlier runs."""
    kept = read_control(spark, f"{root}/control", "QueryTiming").filter("status = 'Succeeded'")
    usual = kept.filter(F.col("BatchId") < batch_id).groupBy("name").agg(
        F.median("milliseconds").alias("usual_milliseconds"), F.count("*").alias("run_count")
    )
    run = kept.filter(F.col("BatchId") == batch_id).select("name", "row_count", "milliseconds")
    return sized_join(run, usual, {"name": "name"}, heavy_rows=None).filter(F.col("milliseconds") > factor * F.col("usual_milliseconds"))


def land_increment(
    spark: SparkSession, model: WarehouseModel, source: DataFrame, table: str, column: str, landing_root: str, root: str, batch_id: int
) -> tuple[str | None, str | None]:
    """Land a source's rows above the table's watermark as a batch's file, for `load_batch` to pick up.

    `source` has the table's staging columns but for batch and row number, and `column`, by which it grows.
    """
    names = [c.name for c in model.staging_columns(table)]

    def land(rows: DataFrame) -> None:
        kept = [c for c in rows.columns if c in names]
        # Numbered over the increment as it was written once: a rerun writes it again from the same bounds.
        numbered_rows = numbered(materialise(rows, f"increment-{table}"), [column, *[c for c in kept if c != column]], "RowNumber")
        out = numbered_rows.withColumn("BatchId", F.lit(batch_id).cast("bigint"))
        missing = [F.lit(None).cast(c.spark_type).alias(c.name) for c in model.staging_columns(table) if c.name not in out.columns]
        tables.write_extract(out.select("*", *missing).select(*names), landing.landing_path(landing_root, batch_id, table))

    return load_increment(spark, f"{root}/control", source, table, column, batch_id, land)


def save_catalog(spark: SparkSession, model: WarehouseModel, root: str) -> DataFrame:
    """The table list as rows: kind, versions or batches, files and bytes of each, and whether loads take it."""
    off, lines = disabled_tables(spark, f"{root}/control"), []
    for spec in model.of_kind("ref", "dim", "bridge", "fact"):
        path = f"{root}/{spec.name}"
        there = files.exists(spark, path)
        parts = [n for n, is_folder, _, _ in files.children(spark, path) if is_folder and n.startswith(("v=", "BatchId="))]
        count, size = files.total(spark, path) if there else (0, 0)
        lines.append((spec.schema, spec.name, spec.kind, len(parts), count, size, spec.name not in off))
    made = spark.createDataFrame(lines, CONTROL_TABLES["TableCatalog"])
    replace_control(spark, f"{root}/control", "TableCatalog", made, "tables")
    return made


def cluster_facts(spark: SparkSession, model: WarehouseModel, root: str, target_bytes: int = tables.TARGET_FILE_BYTES) -> dict[str, list[int]]:
    """Cluster the batches of every fact by its main date, and note the statistics of facts that changed."""
    done = {}
    for spec in model.of_kind("fact"):
        path = f"{root}/{spec.name}"
        if not files.exists(spark, path):
            continue
        main_date = f"{spec.date_roles[0]}DateKey" if spec.date_roles else None
        done[spec.name] = tables.compact_batches(spark, path, spec.schema_type(), main_date, target_bytes)
        if done[spec.name]:
            fact = spark.read.schema(spec.schema_type()).parquet(path)
            columns = [fk.column for fk in spec.references]
            stats = tables.column_statistics(fact, columns).withColumn("TableName", F.lit(spec.name))
            replace_control(spark, f"{root}/control", "ColumnStatistic", stats, spec.name)
    return done


def keep_house(
    spark: SparkSession, landing_root: str, root: str, now: dt.datetime, days: int = RETENTION_DAYS, model: WarehouseModel | None = None
) -> dict[str, int]:
    """Drop what is past its retention: landing folders, control rows, old versions. With the model, also
    cluster the facts' files and write the table list and statistics anew."""
    control = f"{root}/control"
    cutoff = now - dt.timedelta(days=days)
    done = {"landing": landing.purge_landing(spark, landing_root, int(cutoff.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))}
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    for table in sorted(AGE_COLUMN):
        if files.exists(spark, f"{control}/{table}"):
            for name in expired_files(spark, control, table, at, days):
                files.delete(spark, f"{control}/{table}/{name}")
    for table in BY_BATCH:
        landing.purge_landing(spark, f"{control}/{table}", int(cutoff.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
    for name, is_folder, _, _ in files.children(spark, root):
        if is_folder and tables.versions(spark, f"{root}/{name}"):
            done[name] = len(tables.drop_old_versions(spark, f"{root}/{name}"))
    if model:
        done |= {name: len(batches) for name, batches in cluster_facts(spark, model, root).items()}
        save_catalog(spark, model, root)
    return done
