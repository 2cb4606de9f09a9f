"""Batch control, watermarks, audit and retention over append-only control tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hoarfrost.operators.filters import older_than
from hoarfrost.sources import files

# Control tables and their columns.
CONTROL_TABLES = {
    "BatchRun": "BatchId bigint, SourceSystemCode string, BatchStatusCode string, StartedAtUtc timestamp_ntz, "
    "EndedAtUtc timestamp_ntz, RequestedByName string, CorrelationId string",
    "BatchRunStep": "BatchId bigint, StepName string, StepStatusCode string, StartedAtUtc timestamp_ntz, "
    "EndedAtUtc timestamp_ntz, ErrorMessage string",
    "LoadError": "BatchId bigint, SchemaName string, TableName string, ErrorCode string, ErrorMessage string, "
    "OccurredAtUtc timestamp_ntz",
    "LoadWatermark": "BatchId bigint, SourceSystemCode string, SchemaName string, TableName string, "
    "WatermarkColumnName string, WatermarkValue string",
    "DqResult": "batch_id bigint, rule_code string, rule string, `table` string, checked bigint, failed bigint, "
    "status string, checked_at timestamp_ntz",
    "ScdChangeLog": "BatchId bigint, DimensionName string, BusinessKeyValue string, ChangeTypeCode string, "
    "PreviousRowHash binary, NewRowHash binary, ChangedAtUtc timestamp_ntz",
    "RejectedRow": "BatchId bigint, TargetSchemaName string, TargetTableName string, SourceRowNumber bigint, "
    "RejectReasonText string, RejectedPayload string",
    "LandingFile": "BatchId bigint, TableName string, FilePathText string, FileName string, RowsReadCount bigint, "
    "RowsLoadedCount bigint, IngestStatusCode string",
    "LoadAudit": "BatchId bigint, SchemaName string, TableName string, SourceRowCount bigint, InsertedRowCount bigint, "
    "UpdatedRowCount bigint, MatchedRowCount bigint, RejectedRowCount bigint",
    "LoadIncrement": "BatchId bigint, SchemaName string, TableName string, WatermarkColumnName string, LowValue string, "
    "HighValue string",
    "LoadConfig": "SchemaName string, TableName string, IsEnabled boolean",
    "TableCatalog": "SchemaName string, TableName string, TableKind string, VersionCount bigint, FileCount bigint, "
    "SizeBytes bigint, IsEnabled boolean",
    "ColumnStatistic": "TableName string, ColumnName string, TotalRowCount bigint, NullRowCount bigint, DistinctCount bigint, "
    "LowValue string, HighValue string",
    "DqRule": "RuleCode string, RuleName string, TargetTableName string, RuleExpression string, IsActive boolean",
    "KeyRange": "BatchId bigint, TableName string, BaseKey bigint, KeyCount bigint",
    "BatchLoad": "BatchId bigint, LoadToken string, BuiltOnToken string, LoadedAtUtc timestamp_ntz",
    "QueryTiming": "BatchId bigint, name string, row_count bigint, milliseconds double, status string, "
    "MeasuredAtUtc timestamp_ntz",
}

# The time column by which each control table ages.
AGE_COLUMN = {
    "BatchRun": "StartedAtUtc",
    "BatchRunStep": "StartedAtUtc",
    "LoadError": "OccurredAtUtc",
    "DqResult": "checked_at",
    "ScdChangeLog": "ChangedAtUtc",
    "QueryTiming": "MeasuredAtUtc",
}
RETENTION_DAYS = 14
RUN = "run"

# Control tables kept by batch: a batch folder ages as a whole.
BY_BATCH = ("LandingFile", "RejectedRow", "LoadAudit")
MESSAGE_LIMIT = 4000


def fit_columns(rows: DataFrame, target: list[str]) -> DataFrame:
    """Keep the columns the target really has; unknown ones are dropped."""
    return rows.select(*[c for c in rows.columns if c in target])


def _fitted(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """Rows with the columns and types of a control table; missing columns are NULL."""
    empty = spark.createDataFrame([], CONTROL_TABLES[table])
    fitted = fit_columns(rows, empty.columns)
    typed = fitted.select(*[F.col(c).cast(empty.schema[c].dataType).alias(c) for c in fitted.columns])
    return empty.unionByName(typed, allowMissingColumns=True)


def append_control(spark: SparkSession, root: str, table: str, rows: DataFrame) -> None:
    """Append rows to a control table."""
    _fitted(spark, table, rows).write.mode("append").parquet(f"{root}/{table}")


def replace_control(spark: SparkSession, root: str, table: str, rows: DataFrame, run: str) -> None:
    """Write what one run has to say to a control table. The rows lie in a folder of the run,
    so the same run, made again, takes the place of the first."""
    path = f"{root}/{table}/{RUN}={run}"
    _fitted(spark, table, rows).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_control(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = spark.createDataFrame([], CONTROL_TABLES[table]).schema
    return spark.read.schema(schema).parquet(f"{root}/{table}").select(*schema.names)


def expired_files(spark: SparkSession, root: str, table: str, now: Column, days: int = RETENTION_DAYS) -> list[str]:
    """Files of a control table of which every row is past its retention, below the table's folder.

    Rows are appended and never changed, so a file ages as a whole. Deleting such files takes
    nothing else along, wherever it stops, and there are few: some per run of a job.
    """
    schema = spark.createDataFrame([], CONTROL_TABLES[table]).schema
    at = F.col(AGE_COLUMN[table])
    aged = spark.read.schema(schema).parquet(f"{root}/{table}").select("_metadata.file_path", at.alias("at"))
    newest = aged.groupBy("file_path").agg(F.max("at").alias("at"), F.count_if(F.col("at").isNull()).alias("undated"))
    old = newest.filter((F.col("undated") == 0) & (F.col("at") < now - F.make_dt_interval(F.lit(days))))
    return [r[0] for r in old.select(F.regexp_extract("file_path", f"/{table}/(.+)$", 1)).collect()]


def latest_runs(runs: DataFrame) -> DataFrame:
    """The state of each batch: start from its first row, status and end from its last."""
    return runs.groupBy("BatchId").agg(
        F.min("StartedAtUtc").alias("StartedAtUtc"),
        F.max("EndedAtUtc").alias("EndedAtUtc"),
        F.max_by("BatchStatusCode", F.coalesce("EndedAtUtc", "StartedAtUtc")).alias("BatchStatusCode"),
    )


@contextmanager
def batch_run(spark: SparkSession, root: str, batch_id: int, job: str, clock=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)):
    """Record a run's start and end around a block.

    The error row is written on its own, after the data write failed, so it stays.
    """
    started = clock()

    def write(status: str, ended: dt.datetime | None) -> None:
        row = [(batch_id, "LOADER", status, started, ended, f"loader:{job}")]
        columns = "BatchId bigint, SourceSystemCode string, BatchStatusCode string, StartedAtUtc timestamp_ntz, EndedAtUtc timestamp_ntz, RequestedByName string"
        append_control(spark, root, "BatchRun", spark.createDataFrame(row, columns))

    write("Running", None)
    try:
        yield batch_id
    except Exception as error:
        log_error(spark, root, batch_id, "etl", job, str(error), clock())
        write("Failed", clock())
        raise
    write("Succeeded", clock())


def record_step(spark: SparkSession, root: str, batch_id: int, step: str, status: str, started: dt.datetime, ended: dt.datetime, message: str | None = None) -> None:
    row = [(batch_id, step, status, started, ended, message)]
    append_control(spark, root, "BatchRunStep", spark.createDataFrame(row, CONTROL_TABLES["BatchRunStep"]))


def log_error(spark: SparkSession, root: str, batch_id: int, schema: str, table: str, message: str, at: dt.datetime) -> None:
    row = [(batch_id, schema, table, None, message[:MESSAGE_LIMIT], at)]
    append_control(spark, root, "LoadError", spark.createDataFrame(row, CONTROL_TABLES["LoadError"]))


def load_config(config: DataFrame) -> DataFrame:
    """Enabled load settings; a setting without a flag counts as enabled."""
    return config.filter(F.coalesce("IsEnabled", F.lit(True)))


def latest_watermarks(marks: DataFrame) -> DataFrame:
    """The value of the last batch per source, schema and table."""
    return marks.groupBy("SourceSystemCode", "SchemaName", "TableName").agg(
        F.max_by("WatermarkValue", "BatchId").alias("WatermarkValue"), F.max("BatchId").alias("BatchId")
    )


def upsert_watermarks(marks: DataFrame, updates: DataFrame) -> DataFrame:
    """One mark per source, schema and table, the update's where there is one."""
    return latest_watermarks(marks.unionByName(updates))


def above_watermark(df: DataFrame, column: str, mark: Column) -> DataFrame:
    """Rows loaded after the mark; all rows while there is no mark."""
    return df.filter(mark.isNull() | (F.col(column) > mark))


def load_increment(
    spark: SparkSession, root: str, source: DataFrame, table: str, column: str, batch_id: int, load: Callable[[DataFrame], object],
    system: str = "LOADER", schema: str = "stg",
) -> tuple[str | None, str | None]:
    """Load the source rows above the table's watermark as one batch, and move the mark when that is done.

    The batch's bounds are written down before anything is read for it: above the mark, up to the highest
    value there is. They bound the source's scan. A load that stops half-way is made again with the
    same bounds, whatever arrived meanwhile, so `load` meets the same rows and has only to replace what
    the batch had written. The mark moves after `load` has returned. Rows that arrive later with a value
    at or below a mark are not seen: the column must grow. NULL is above no mark.

    Returns the bounds (exclusive, inclusive); without new rows nothing is loaded and the bounds are equal.
    A batch whose mark is already moved is loaded again with its bounds, and the mark stays.
    """
    kind = source.schema[column].dataType
    value = lambda text: F.lit(text).cast(kind)
    own = (F.col("SchemaName") == schema) & (F.col("TableName") == table)
    told = lambda name: [r for r in read_control(spark, root, name).filter(own).collect()] if files.exists(spark, f"{root}/{name}") else []
    noted = {r.BatchId: r for r in told("LoadIncrement")}  # a row a batch
    marks = {r.BatchId: r.WatermarkValue for r in told("LoadWatermark")}
    open_ = sorted(b for b in noted if b not in marks and b != batch_id)
    if open_:
        raise ValueError(f"batch {open_[0]} of {table} has not been loaded to its end: load it again first")
    if batch_id in noted:
        low, high = noted[batch_id].LowValue, noted[batch_id].HighValue
    else:
        if marks and batch_id < max(marks):
            raise ValueError(f"batch {max(marks)} of {table} is loaded: batch {batch_id} would come before it")
        low = marks[max(marks)] if marks else None
        fresh = source if low is None else source.filter(F.col(column) > value(low))
        high = fresh.agg(F.max(column).cast("string")).first()[0]
        if high is None:
            return low, low
        row = [(batch_id, schema, table, column, low, high)]
        replace_control(spark, root, "LoadIncrement", spark.createDataFrame(row, CONTROL_TABLES["LoadIncrement"]), f"{schema}-{table}-{batch_id}")
    bounds = F.col(column) <= value(high)
    load(source.filter(bounds if low is None else (F.col(column) > value(low)) & bounds))
    row = [(batch_id, system, schema, table, column, high)]
    replace_control(spark, root, "LoadWatermark", spark.createDataFrame(row, CONTROL_TABLES["LoadWatermark"]), f"{schema}-{table}-{batch_id}")
    return low, high


def disabled_tables(spark: SparkSession, root: str) -> set[str]:
    """Tables that the load settings switch off. A table without a setting is on."""
    if not files.exists(spark, f"{root}/LoadConfig"):
        return set()
    settings = read_control(spark, root, "LoadConfig")
    off = settings.join(load_config(settings), ["SchemaName", "TableName"], "left_anti")
    return {r.TableName for r in off.select("TableName").distinct().collect()}  # at most the tables of the model


def purge(df: DataFrame, table: str, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """What remains of a control table once rows older than the retention time are gone."""
    at = F.col(AGE_COLUMN[table])
    return df.filter(at.isNull() | ~(at < now - F.make_dt_interval(F.lit(days))))


def expired(df: DataFrame, timestamp: str, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return older_than(df, timestamp, days, now)




def key_ranges(spark: SparkSession, root: str, table: str, batch_id: int, rows: int, first_base: Callable[[], int]) -> list[tuple[int, int]]:
    """The keys that belong to a batch of a table, as (base, count): keys base + 1 to base + count.

    A batch gets its range once, before its rows are written, and has it whenever it is loaded again, in
    whatever order. A batch that comes again with more rows gets one range more for the rest.
    `first_base` is asked only where nothing was ever given out for the table.
    """
    given = []
    if files.exists(spark, f"{root}/KeyRange"):
        told = read_control(spark, root, "KeyRange").filter(F.col("TableName") == table)
        own = told.filter(F.col("BatchId") == batch_id).orderBy("BaseKey").collect()  # one, as a rule
        given = [(r.BaseKey, r.KeyCount) for r in own]
        top = told.agg(F.max(F.col("BaseKey") + F.col("KeyCount"))).first()[0]
    else:
        top = None
    missing = rows - sum(n for _, n in given)
    if missing > 0:
        base = first_base() if top is None else top
        row = [(batch_id, table, base, missing)]
        append_control(spark, root, "KeyRange", spark.createDataFrame(row, CONTROL_TABLES["KeyRange"]))
        given.append((base, missing))
    return given


def base_of(ranges: list[tuple[int, int]], row_number: str = "RowNumber") -> Column:
    """What a row's number is added to, so that numbers from 1 fill the ranges one after the other."""
    out, before = None, sum(n for _, n in ranges)
    for base, n in reversed(ranges):
        before -= n
        own = F.lit(base - before).cast("bigint")
        out = own if out is None else F.when(F.col(row_number) <= before + n, own).otherwise(out)
    return F.lit(0).cast("bigint") if out is None else out


def batch_loads(spark: SparkSession, root: str) -> dict[int, Row]:
    """The last completed load of every batch: its token, the token it was built on, and its time.

    A row a batch; batches are counted in thousands, whatever the size of their tables.
    """
    if not files.exists(spark, f"{root}/BatchLoad"):
        return {}
    return {r.BatchId: r for r in read_control(spark, root, "BatchLoad").collect()}


def stale_batches(loads: dict[int, Row]) -> list[int]:
    """Batches that were built on a load of the batch before them which has been made again since."""
    order = sorted(loads)
    before = [None, *(loads[b].LoadToken for b in order)]
    return [b for b, token in zip(order, before, strict=False) if loads[b].BuiltOnToken != token]
