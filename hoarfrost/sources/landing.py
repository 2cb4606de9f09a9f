"""Landing and seed files: typed CSV reads, rejects, and what was received."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoarfrost.model import WarehouseModel
from hoarfrost.sources import files

log = logging.getLogger(__name__)
CORRUPT = "__corrupt"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSS]"


def text_schema(schema: T.StructType) -> T.StructType:
    """Schema of the raw file: what CSV cannot parse as such is read as text. The last
    column takes any line whose number of fields is wrong."""
    fields = [T.StructField(f.name, T.StringType(), True) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])


def raw_options() -> dict[str, str]:
    """A quoted field may hold line breaks, so a file is read by one task: sources land large
    tables as folders of files, as `write_extract` does."""
    return {
        "header": "true",
        "multiLine": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "escape": '"',
        "enforceSchema": "true",
        # A pruned parser does not count fields, so a short line would pass unnoticed in a
        # query that reads few columns.
        "columnPruning": "false",
    }


def typed(name: str, data_type: T.DataType) -> Column:
    """A text field as its declared type; NULL where it does not fit."""
    c = F.col(name)
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.BooleanType):
        low = F.lower(c)
        return F.when(low.isin("1", "true"), True).when(low.isin("0", "false"), False)
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(c, F.lit("hex"))
    return c.try_cast(data_type)


def typed_rows(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that fit the schema."""
    good = raw.filter(~bad_row(schema))
    return good.select(*[typed(f.name, f.dataType).alias(f.name) for f in schema.fields])


def _misfit(f: T.StructField) -> Column:
    return F.col(f.name).isNotNull() & typed(f.name, f.dataType).isNull()


def bad_row(schema: T.StructType) -> Column:
    checks = [F.col(CORRUPT).isNotNull()] + [
        _misfit(f) for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    return reduce(lambda a, b: a | b, checks)


def reject_reason(schema: T.StructType) -> Column:
    """Why a raw row does not fit the schema; NULL for one that does."""
    reasons = [F.when(F.col(CORRUPT).isNotNull(), "wrong number of fields")] + [
        F.when(_misfit(f), f"{f.name} is not {f.dataType.simpleString()}")
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return F.when(bad_row(schema), F.concat_ws("; ", *reasons))


def payload(schema: T.StructType) -> Column:
    """What a raw row held, as a line."""
    return F.coalesce(F.rtrim(F.col(CORRUPT), F.lit("\r\n")), F.to_csv(F.struct(*[f.name for f in schema.fields])))


def rejects(raw: DataFrame, schema: T.StructType, batch_id: int, target_schema: str, table: str) -> DataFrame:
    """Rows that do not fit the schema, with the reason and what the row held."""
    number = F.col("RowNumber").try_cast("bigint") if "RowNumber" in schema.names else F.lit(None).cast("bigint")
    return raw.filter(bad_row(schema)).select(
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        F.lit(target_schema).alias("TargetSchemaName"),
        F.lit(table).alias("TargetTableName"),
        number.alias("SourceRowNumber"),
        reject_reason(schema).alias("RejectReasonText"),
        payload(schema).alias("RejectedPayload"),
    )


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(text_schema(schema)).options(**raw_options()).csv(path)


def landing_path(root: str, batch_id: int, table: str) -> str:
    return f"{root}/{batch_id}/stg.{table}.csv"


def read_landing(spark: SparkSession, root: str, batch_id: int, table: str, schema: T.StructType) -> DataFrame:
    """Staged rows of one table and batch. A batch that did not arrive is a warning and no
    rows."""
    path = landing_path(root, batch_id, table)
    if not files.exists(spark, path):
        log.warning("landing batch %s has no file for %s", batch_id, table)
        return spark.createDataFrame([], schema)
    return typed_rows(read_raw(spark, path, schema), schema)


def landed_tables(spark: SparkSession, root: str, batch_id: int, model: WarehouseModel) -> list[str]:
    """Tables with a file in the batch folder; files of unknown tables are skipped."""
    found = []
    for name, _, _, _ in files.children(spark, f"{root}/{batch_id}"):
        if name.startswith("stg.") and name.endswith(".csv"):
            table = name[len("stg.") : -len(".csv")]
            if table in model:
                found.append(table)
            else:
                log.warning("no staging table for %s", name)
    return sorted(found)


def read_seed(spark: SparkSession, root: str, schema_name: str, table: str, schema: T.StructType) -> DataFrame:
    """A table's seed file, keys included."""
    return typed_rows(read_raw(spark, f"{root}/{schema_name}/{table}.csv", schema), schema)


def file_ingest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files received below a path, with the rows read and rejected from each."""
    raw = read_raw(spark, path, schema).select("*", F.col("_metadata.file_path").alias("__file"))
    counted = raw.withColumn("__bad", bad_row(schema)).groupBy("__file").agg(
        F.count("*").alias("RowsReadCount"), F.count_if(~F.col("__bad")).alias("RowsLoadedCount")
    )
    return counted.select(
        F.col("__file").alias("FilePathText"),
        F.element_at(F.split("__file", "/"), -1).alias("FileName"),
        "RowsReadCount",
        "RowsLoadedCount",
        F.when(F.col("RowsReadCount") == F.col("RowsLoadedCount"), "Loaded").otherwise("Partial").alias("IngestStatusCode"),
    )


def expired_batches(spark: SparkSession, root: str, cutoff_ms: int) -> list[str]:
    """Landing folders last changed before the cutoff."""
    return [name for name, is_folder, changed, _ in files.children(spark, root) if is_folder and changed < cutoff_ms]


def purge_landing(spark: SparkSession, root: str, cutoff_ms: int) -> int:
    old = expired_batches(spark, root, cutoff_ms)
    for name in old:
        files.delete(spark, f"{root}/{name}")
    return len(old)
