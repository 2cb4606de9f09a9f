"""Landing files as a stream: each file once, each micro-batch safe to repeat."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hoarfrost.model import UNKNOWN_KEY, WarehouseModel
from hoarfrost.operators.facts import load_fact, lookup_plan
from hoarfrost.operators.joins import sized_join
from hoarfrost.operators.scd import OBSERVED, Merge, as_of_batch, merge_dimensions, merge_order, observed, scd1_insert, scd2_insert
from hoarfrost.session import materialise
from hoarfrost.sources import buckets, files, tables
from hoarfrost.sources.landing import payload, raw_options, reject_reason, text_schema, typed

LANDING_FILE, REASON, PAYLOAD = "LandingFile", "RejectReasonText", "RejectedPayload"
EPOCH, LANDED = "epoch", "Landed"
#: Batch of rejected rows that name none.
NO_BATCH = -1
BATCH_FOLDER = r"/([0-9]+)/stg\.[^/]+\.csv(?:/[^/]+)?$"


def landing_stream(spark: SparkSession, pattern: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """All rows of the landing files that match a path pattern, as they arrive, with the file each
    came from. The batch id is that of the landing folder, else the staged one.

    A row that does not fit its table keeps what does, and carries the reason and its line; for the
    others both are NULL. No row is dropped here: `accepted` and `dead_letters` tell them apart.
    """
    raw = (
        spark.readStream.schema(text_schema(schema))
        .options(**raw_options())
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(pattern)
    ).select("*", F.col("_metadata.file_path").alias(LANDING_FILE))
    # The line is kept as it came, before the folder's batch id takes its place.
    raw = raw.withColumns({REASON: reject_reason(schema), PAYLOAD: payload(schema)})
    if "BatchId" in schema.names:
        folder = F.regexp_extract(LANDING_FILE, BATCH_FOLDER, 1)
        raw = raw.withColumn("BatchId", F.when(folder != "", folder).otherwise(F.col("BatchId")))
    columns = [typed(f.name, f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*columns, LANDING_FILE, REASON, F.when(F.col(REASON).isNotNull(), F.col(PAYLOAD)).alias(PAYLOAD))


def accepted(landed: DataFrame) -> DataFrame:
    """The landed rows that fit their table, without the notes on those that do not."""
    return landed.filter(F.col(REASON).isNull()).drop(REASON, PAYLOAD, LANDED, EPOCH)


def dead_letters(landed: DataFrame) -> DataFrame:
    """The landed rows that do not fit: batch, file, row number as far as there is one, reason and line."""
    known = [c for c in ("BatchId", LANDING_FILE, "RowNumber") if c in landed.columns]
    return landed.filter(F.col(REASON).isNotNull()).select(*known, REASON, PAYLOAD)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that has arrived, then stop. The checkpoint remembers the files."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest(stream: DataFrame, checkpoint: str, target: str) -> None:
    """Stage each micro-batch under its own number, rows that do not fit beside the others.

    Both are written by one job under one number, so a micro-batch that is repeated replaces
    both, and good rows and dead letters always add up to what landed.
    """
    run_available(stream, checkpoint, lambda df, epoch: _stage_epoch(df, target, epoch))


def _stage_epoch(df: DataFrame, target: str, epoch: int) -> None:
    kind = F.when(F.col(REASON).isNull(), "rows").otherwise("rejects")
    out = df.withColumn(LANDED, kind).write.mode("overwrite").option("partitionOverwriteMode", "static")
    out.partitionBy(LANDED).parquet(f"{target}/{EPOCH}={epoch}")


def staged(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All that `ingest` has staged, to be told apart by `accepted` and `dead_letters`; a reader of one
    of the two reads its folders only."""
    notes = [T.StructField(c, T.StringType()) for c in (LANDING_FILE, REASON, PAYLOAD)]
    kept = spark.read.schema(T.StructType([*schema.fields, *notes, T.StructField(EPOCH, T.LongType()), T.StructField(LANDED, T.StringType())])).parquet(target)
    return kept.filter((F.col(LANDED) == "rows") == F.col(REASON).isNull())


def apply_stream(
    stream: DataFrame,
    checkpoint: str,
    model: WarehouseModel,
    warehouse: str,
    fact: str,
    now: Column,
    dim_of: Callable[[DataFrame], dict[str, DataFrame]],
    stage_of: Callable[[DataFrame], DataFrame],
) -> None:
    """Merge the dimensions that landed batches bring, then load their facts.

    Rows are kept by landed batch and file below the warehouse, so a file that comes again
    replaces itself and a batch may come in several micro-batches. Every landed batch is
    loaded by itself, from the versions before its id.

    A batch that comes late, after ones with higher ids, is put into the histories of its own keys: the
    later batches' observations of these keys say where its versions end. Facts of later batches are
    loaded again only where one names such a key in the stretch that changed. Where that cannot be done
    (a dimension that others refer to, a batch that comes again or whose load was interrupted, versions
    that something else wrote), the batches after it are loaded again, in order.

    Rows that do not fit are kept beside the others, by the same batch and file: `dead_letters` of the
    landed table gives them, and a file that comes again in order leaves none behind.
    """
    landed, target = f"{warehouse}/landed/{fact}", f"{warehouse}/{fact}"
    path_of = lambda name: f"{warehouse}/{name}"
    log_of = lambda name: f"{warehouse}/observed/{name}"

    def handle(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        done = tables.batches(spark, target)
        seen = Observation("landed")
        fits = F.col(REASON).isNull()
        batch_id = F.when(fits, F.col("BatchId")).otherwise(F.coalesce("BatchId", F.lit(NO_BATCH)))
        again = F.min(F.when(F.col("BatchId").isin(done), F.col("BatchId")))
        kept = df.withColumns({LANDING_FILE: F.sha2(LANDING_FILE, 256), "BatchId": batch_id}).observe(
            seen, again.alias("again"), F.count_if(F.col("BatchId").isNull()).alias("lost")
        )
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("BatchId", LANDING_FILE).parquet(landed)
        if seen.get["lost"]:
            raise ValueError(f"{seen.get['lost']} rows of {fact} have no batch id")
        start = seen.get["again"]
        stored = accepted(spark.read.schema(kept.schema).parquet(landed)).drop(LANDING_FILE)
        known = [b for b in tables.batches(spark, landed) if b != NO_BATCH]
        fresh = [b for b in known if b not in done]
        if start is None:
            for b in [b for b in fresh if done and b < done[-1]]:
                if not _insert_batch(stored, b):
                    start = b
                    break
                fresh.remove(b)
        if start is not None:
            start = _replay_from(spark, min([start, *fresh]))
            fresh = [b for b in known if b >= start]
        for b in fresh:
            _apply_batch(stored.filter(F.col("BatchId") == b), b)

    def _replay_from(spark: SparkSession, start: int) -> int:
        """The first batch to load again when `start` is: a version that its load could start from may lack batches
        that were put in later."""
        low = start
        for name, _, _, _ in files.children(spark, f"{warehouse}/observed"):
            base = max([v for v in tables.versions(spark, path_of(name)) if v < start], default=None)
            low = min([low, *[b for b in tables.batches(spark, log_of(name)) if b < start and (base is None or b > base)]])
        return start if low == start else _replay_from(spark, low)

    def _note(name: str, seen: DataFrame, batch_id: int) -> None:
        tables.replace_batch(seen, log_of(name), batch_id, "BusinessKeyValue")

    def _apply_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        dims = {
            t.name: tables.read_version(spark, path_of(t.name), batch_id)
            for t in model.of_kind("ref", "dim")
            if any(v < batch_id for v in tables.versions(spark, path_of(t.name)))
        }
        stages = dim_of(df)

        def keep(name: str, merge) -> tuple[Merge, DataFrame]:
            done = tables.merge_version(spark, path_of(name), batch_id, model[name], stages[name], merge)
            _note(name, observed(done.changes, now), batch_id)
            dims[name] = tables.read_version(spark, path_of(name), batch_id + 1)
            return done, dims[name]

        merge_dimensions(model, dims, stages, batch_id, now, keep=keep)
        _load(df, batch_id, dims)

    def _load(df: DataFrame, batch_id: int, dims: dict[str, DataFrame]) -> None:
        loaded = load_fact(model, fact, stage_of(df), dims, batch_id, now, highest=F.lit(batch_id) * 2**40)
        tables.replace_batch(loaded, target, batch_id)

    def _insertable(spark: SparkSession, name: str, stage: DataFrame, batch_id: int) -> bool:
        """Whether a late batch's rows can be put into a dimension: nothing hangs on its rows, its parents have no
        versions, and its own versions from the batch on are those of observed batches, none of them this one."""
        spec, path = model[name], path_of(name)
        if any(e.parent == name for t in model.of_kind("ref", "dim") for e in model.edges(t.name)):
            return False
        if any(model[fk.parent].is_scd2 for fk in spec.foreign_keys if fk.parent in model and model.natural_column(fk) in stage.columns):
            return False
        noted, found = tables.batches(spark, log_of(name)), tables.versions(spark, path)
        if not noted or not found or batch_id in noted or noted[-1] != found[-1] or found[-1] < batch_id:
            return False
        return all(v in noted for v in found if v > batch_id) and tables.bucketed(spark, path) is not None

    def _insert_batch(stored: DataFrame, batch_id: int) -> bool:
        """Put a late batch into the histories of its keys; False, with nothing done, where that is not possible.

        The notes come first and the batch's facts last: notes without facts tell a load that was cut.
        """
        spark = stored.sparkSession
        df = stored.filter(F.col("BatchId") == batch_id)
        stages = dim_of(df)
        names = [n for n in merge_order(model, stages) if model[n].business_key is not None and model[n].business_key.name in stages[n].columns]
        if not all(_insertable(spark, n, stages[n], batch_id) for n in names):
            return False
        affected: set[int] = set()
        for name in names:
            spec, base = model[name], tables.bucketed(spark, path_of(name))
            rows = buckets.read(spark, path_of(name), base, buckets.touched(stages[name], spec.business_key.name, base.buckets), spec.schema_type())
            # `now` may be later than what later batches were merged as of: the insertion keeps to their times.
            later = spark.read.schema(OBSERVED).parquet(log_of(name)).filter(F.col("BatchId") > batch_id)
            parents = {fk.parent for fk in spec.foreign_keys if fk.parent in model and tables.versions(spark, path_of(fk.parent))}
            dims = {p: as_of_batch(tables.read_version(spark, path_of(p)), model[p], batch_id) for p in parents if model[p].business_key is not None}
            put = scd2_insert if spec.is_scd2 else scd1_insert
            done = put(rows, stages[name], spec, batch_id, now, later, model, dims, base.highest)
            moved = materialise(done.moved, f"moved-{name}")
            _note(name, done.seen, batch_id)
            tables.insert_version(spark, path_of(name), batch_id, spec, done.table, done.changed, base)
            affected |= _affected(stored, name, moved, batch_id)
        for b in [*sorted(affected), batch_id]:
            mine = stored.filter(F.col("BatchId") == b)
            _load(mine, b, _dims_at(mine, b))
        return True

    def _affected(stored: DataFrame, name: str, moved: DataFrame, batch_id: int) -> set[int]:
        """The later batches with a fact that carries a key where another one holds now, or none where there is one."""
        spark, spec = stored.sparkSession, model[name]
        facts = spark.read.schema(model[fact].schema_type()).parquet(target).filter(F.col("BatchId") > batch_id)
        in_reach = F.col("UntilBatch").isNull() | (F.col("BatchId") < F.col("UntilBatch"))
        replaced = moved.filter(F.col("OldKey").isNotNull()).select("OldKey", "UntilBatch")
        missing = moved.filter(F.col("OldKey").isNull()).select(F.col(spec.business_key.name).alias("__bk"), "UntilBatch")
        found: set[int] = set()
        looks = [p for p in lookup_plan(model, fact, stage_of(stored).columns) if p.parent == name and p.mode == "natural"]
        for look in looks:
            hit = sized_join(facts.select("BatchId", look.column), replaced, {look.column: "OldKey"}).filter(in_reach)
            found |= {r.BatchId for r in hit.select("BatchId").distinct().collect()}  # at most one row a batch
            unknown = [r.BatchId for r in facts.filter(F.col(look.column) == UNKNOWN_KEY).select("BatchId").distinct().collect()]
            unknown = [b for b in unknown if b not in found]
            if unknown and not missing.isEmpty():
                named = stage_of(stored.filter(F.col("BatchId").isin(unknown))).select("BatchId", look.source)
                hit = sized_join(named, missing, {look.source: "__bk"}).filter(in_reach)
                found |= {r.BatchId for r in hit.select("BatchId").distinct().collect()}
        return found

    def _dims_at(df: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        """The dimensions as a batch's facts see them; of one that batches are merged into, the buckets of the keys
        that the batch names."""
        spark, staged, dims = df.sparkSession, stage_of(df), {}
        plan = lookup_plan(model, fact, staged.columns)
        for t in model.of_kind("ref", "dim"):
            looks = [p for p in plan if p.parent == t.name and p.mode != "unset"]
            if not looks or not tables.versions(spark, path_of(t.name)):
                continue
            noted, base = tables.batches(spark, log_of(t.name)), tables.bucketed(spark, path_of(t.name))
            if not noted:
                dims[t.name] = tables.read_version(spark, path_of(t.name), batch_id)
            elif base is None or any(p.mode == "key" for p in looks):
                dims[t.name] = as_of_batch(tables.read_version(spark, path_of(t.name)), t, batch_id)
            else:
                names = reduce(DataFrame.unionByName, [staged.select(F.col(p.source).alias("__bk")) for p in looks])
                near = buckets.touched(names, "__bk", base.buckets)
                dims[t.name] = as_of_batch(buckets.read(spark, path_of(t.name), base, near, t.schema_type()), t, batch_id)
        return dims

    run_available(stream, checkpoint, handle)
