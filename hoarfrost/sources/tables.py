"""Stored tables: whole-table versions, batch replacement, extracts and compaction.

A table kept by version has a folder for each. Spark's writer leaves a success marker only when
the write is committed, so the current version is the latest one that has the marker: a failed
write changes nothing, and a rerun writes its version again. Dimensions that batches are merged
into keep their rows in buckets, and a version is then a manifest of them (see `buckets`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from math import ceil
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoarfrost.model import TableSpec
from hoarfrost.operators.joins import row_bytes
from hoarfrost.session import materialise
from hoarfrost.sources import buckets, files

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Bytes of rows, by the types of their columns, that one task sorts to write a file. A file is compressed, by much
# where its columns repeat, so that its size alone says little of the rows in it.
SORT_BYTES = 128 * 1024 * 1024


class Merged(Protocol):
    """A merged table, and what became of every business key: BusinessKeyValue, action and changed."""

    table: DataFrame
    changes: DataFrame


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    found = []
    for name, is_folder, _, _ in files.children(spark, path):
        if is_folder and name.startswith("v=") and files.exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(name[2:]))
    return sorted(found)


def write_version(df: DataFrame, path: str, version: int) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/v={version}")


def read_version(spark: SparkSession, path: str, before: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The current version; with `before`, the last one older than that, which is what a
    rerun of a batch must start from."""
    found = [v for v in versions(spark, path) if before is None or v < before]
    if not found:
        raise FileNotFoundError(f"no committed version of {path}")
    if buckets.is_bucketed(spark, path, found[-1]):
        return buckets.read(spark, path, buckets.load_version(spark, path, found[-1]), schema=schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/v={found[-1]}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 3) -> list[int]:
    found = versions(spark, path)
    for v in found[:-keep]:
        files.delete(spark, f"{path}/v={v}")
    if files.exists(spark, f"{path}/{buckets.DATA}"):
        buckets.drop_unused(spark, path, found[-keep:])
    return found[:-keep]


def bucketed(spark: SparkSession, path: str, before: int | None = None) -> buckets.Version | None:
    """The manifest of the current version of a bucketed table, or of the last one older than `before`."""
    found = [v for v in versions(spark, path) if before is None or v < before]
    return buckets.load_version(spark, path, found[-1]) if found and buckets.is_bucketed(spark, path, found[-1]) else None


def merge_version(
    spark: SparkSession, path: str, number: int, spec: TableSpec, stage: DataFrame, merge: Callable[[DataFrame, int | None], Merged],
    bucket_rows: int = buckets.BUCKET_ROWS,
) -> Merged:
    """Merge a batch into a stored dimension and commit the result as a version; returns the merge.

    `merge` gets the rows of the buckets that staged keys fall into, and the highest key in use, from the
    manifest. Of those buckets only the ones with a changed row are written; the new version points at
    the older ones' folders for the rest. The first version, and a table that has outgrown its number of
    buckets, is written whole.
    """
    key, base = spec.business_key.name, bucketed(spark, path, number)
    if base is None:
        older = any(v < number for v in versions(spark, path))
        whole = read_version(spark, path, number, spec.schema_type()) if older else spark.createDataFrame([], spec.schema_type())
        done = merge(whole, None)
        buckets.write(done.table, path, number, key, spec.key, None, None, bucket_rows)
        return done
    near = buckets.touched(stage, key, base.buckets)
    done = merge(buckets.read(spark, path, base, near, spec.schema_type()), base.highest)
    moved = done.changes.filter("changed")
    if buckets.outgrown(base, moved.count(), bucket_rows):
        rest = buckets.read(spark, path, base, set(base.places) - near, spec.schema_type())
        buckets.write(done.table.unionByName(rest), path, number, key, spec.key, base, None, bucket_rows)
    else:
        buckets.write(done.table, path, number, key, spec.key, base, buckets.touched(moved, "BusinessKeyValue", base.buckets), bucket_rows)
    return done


def batches(spark: SparkSession, path: str) -> list[int]:
    """The batches that a table stored by batch has folders of, in order."""
    found = [name for name, is_folder, _, _ in files.children(spark, path) if is_folder and name.startswith("BatchId=")]
    return sorted(int(name.split("=")[1]) for name in found)


def insert_version(
    spark: SparkSession, path: str, batch_id: int, spec: TableSpec, table: DataFrame, changed: DataFrame, base: buckets.Version
) -> None:
    """Commit a late batch's rows into the current version. The versions between are dropped first: they lack
    the batch, so that a later rerun of one of them starts from the version before the batch."""
    only = buckets.touched(changed, spec.business_key.name, base.buckets)
    for v in versions(spark, path):
        if batch_id < v < base.number:
            files.delete(spark, f"{path}/v={v}")
    if only:
        buckets.write(table, path, base.number, spec.business_key.name, spec.key, replace(base, number=base.built_from), only)


def replace_batch(df: DataFrame, path: str, batch_id: int, date_column: str | None = None) -> int:
    """Replace the rows of one batch in a fact stored by batch; returns the rows written.

    Only the batch's partition is overwritten, so a rerun leaves the table as one run does.
    Rows are sorted by the main date key inside each file: that is what lets a date filter
    skip row groups. A batch that came out empty overwrites its own folder, since a dynamic
    overwrite touches only the partitions it has rows for.
    """
    rows = Observation("replace_batch")
    batch = df.withColumn("BatchId", F.lit(batch_id).cast("bigint"))
    if date_column:
        batch = batch.sortWithinPartitions(date_column)
    observed = batch.observe(rows, F.count(F.lit(1)).alias("n"))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("BatchId").parquet(path)
    written = rows.get["n"]
    if not written:
        own = batch.drop("BatchId").limit(0)
        own.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/BatchId={batch_id}")
    return written


def stage(df: DataFrame, path: str) -> None:
    """Replace a staging table by the rows of the latest landing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def load_if_empty(df: DataFrame, path: str) -> bool:
    """Load a table that has no rows yet; a rerun does nothing."""
    spark = df.sparkSession
    if files.exists(spark, f"{path}/_SUCCESS") and not spark.read.schema(df.schema).parquet(path).isEmpty():
        return False
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return True


def csv_ready(df: DataFrame) -> DataFrame:
    """Columns as landing files hold them: flags as 0 and 1, binary as hex, times in ISO."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, T.BinaryType):
            c = F.lower(F.hex(c))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def write_extract(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, quotes only where needed, doubled inside a quoted value."""
    csv_ready(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns by which a stored table is cut into folders, outermost first."""
    found, at = [], path
    while True:
        below = [name for name, is_folder, _, _ in files.children(spark, at) if is_folder and "=" in name]
        if not below:
            return found
        found.append(below[0].partition("=")[0])
        at = f"{at}/{below[0]}"


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite a table of many small files into files of about the target size, in the same
    partition folders; returns the number of files that size asks for.

    Without folders, whole files are merged by reading them in larger splits and no row is
    shuffled. With folders, rows are brought together by folder, and Spark cuts a large
    folder at its advisory partition size.
    """
    wanted = max(1, ceil(files.total_bytes(spark, source) / target_bytes))
    df, folders = spark.read.parquet(source), partition_columns(spark, source)
    if not folders:
        df.coalesce(wanted).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
        return wanted
    # As text, a folder's value keeps its spelling, leading zeros included.
    kept = T.StructType([T.StructField(f.name, T.StringType() if f.name in folders else f.dataType) for f in df.schema.fields])
    together = spark.read.schema(kept).parquet(source).hint("rebalance", *folders)
    together.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*folders).parquet(target)
    return wanted


def overlapping(ranges: list[tuple[object, object]]) -> int:
    """How many of the ranges (low, high) begin before an earlier one has ended."""
    found, end = 0, None
    for low, high in sorted(ranges):
        found += end is not None and low <= end
        end = high if end is None else max(end, high)
    return found


def compact_batches(
    spark: SparkSession, path: str, schema: T.StructType, sort_by: str | None = None, target_bytes: int = TARGET_FILE_BYTES
) -> list[int]:
    """Cluster the files of a fact stored by batch, in place; returns the batches rewritten.

    Touched are batches with more than twice the files that their size asks for (and, if sorted, their rows), and, if `sort_by` is
    named, those in which half the files or more overlap another in that column, so that a filter on it cannot skip
    them. Such a batch is dealt to files by range, and sorted in each. It is replaced as one partition
    from a copy written first, so a failure leaves the other batches alone and the copy whole.
    """
    sizes: dict[int, list[int]] = {}
    for name, is_folder, _, _ in files.children(spark, path):
        if is_folder and name.startswith("BatchId="):
            parts = [size for part, _, _, size in files.children(spark, f"{path}/{name}") if part.endswith(".parquet")]
            sizes[int(name.partition("=")[2])] = parts
    several = [b for b, parts in sizes.items() if len(parts) > 1]
    spans: dict[int, list[tuple[object, object]]] = {}
    rows: dict[int, int] = {}
    if sort_by and several:
        # One column of the batches that have several files; a row a file comes back.
        kept = spark.read.schema(schema).parquet(path).filter(F.col("BatchId").isin(several))
        by_file = kept.groupBy("BatchId", F.col("_metadata.file_path").alias("f")).agg(F.min(sort_by).alias("low"), F.max(sort_by).alias("high"), F.count("*").alias("n"))
        for r in by_file.collect():
            rows[r.BatchId] = rows.get(r.BatchId, 0) + r.n
            if r.low is not None:
                spans.setdefault(r.BatchId, []).append((r.low, r.high))
    done, width = [], row_bytes(spark.createDataFrame([], schema))
    for batch_id, parts in sorted(sizes.items()):
        wanted = max(1, ceil(sum(parts) / target_bytes), ceil(rows.get(batch_id, 0) * width / SORT_BYTES))
        if len(parts) <= 1 or len(parts) <= 2 * wanted and 2 * overlapping(spans.get(batch_id, [])) < len(parts):
            continue
        batch = spark.read.schema(schema).parquet(path).filter(F.col("BatchId") == batch_id)
        copy = materialise(batch, f"compact-{batch_id}")
        dealt = copy.repartitionByRange(wanted, sort_by) if sort_by and wanted > 1 else copy.coalesce(wanted)
        replace_batch(dealt, path, batch_id, sort_by)
        done.append(batch_id)
    return done


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, NULLs, about how many values, lowest and highest of each column, in one pass."""
    each = [
        F.struct(
            F.lit(c).alias("ColumnName"), F.count(F.lit(1)).alias("TotalRowCount"), F.count_if(F.col(c).isNull()).alias("NullRowCount"),
            F.approx_count_distinct(c).alias("DistinctCount"), F.min(c).cast("string").alias("LowValue"), F.max(c).cast("string").alias("HighValue"),
        )
        for c in columns
    ]
    return df.agg(F.array(*each).alias("s")).select(F.inline("s"))


def analyze(spark: SparkSession, table: str) -> None:
    """Column statistics of a catalog table, for the planner's join order and sizes."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


