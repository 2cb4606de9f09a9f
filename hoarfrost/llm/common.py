"""Helpers shared by the corpus operators: tables, stored intermediates, Arrow text buffers, files."""

from __future__ import annotations

import contextlib
import ctypes
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoarfrost.session import materialise, scratch

#: UTF-8 bytes of text that one vectorised step looks at together. A longer text is one step by itself.
CHUNK_BYTES = 2_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: lineage is cut there, and a lost
    executor costs a reread instead of a recomputation."""
    return materialise(df, label)


def unlike(df: DataFrame, name: str) -> str:
    """A column name like the given one that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    folder = new_folder(spark, "code")
    file = SharedFile(folder, "package.zip")
    file.write(data.getvalue())
    file.close()
    context.addPyFile(f"{folder}/package.zip")
    _sent.add(context.applicationId)


#: What a worker remembers between tasks of the same kind.
CACHES: list[dict | list] = []


def forget() -> None:
    """Drop what tasks of another kind have left in this worker."""
    for cache in CACHES:
        cache.clear()


def release() -> None:
    """Hand freed memory back to the system: a worker lives on, and its next task may need another shape."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no such call
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: bool = False) -> DataFrame:
    """mapInArrow with this package on the executors, and memory released after each task. With `keeps`,
    the task goes on with what earlier ones have left in the worker."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        try:
            yield from f(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column, without copying. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], (starts - starts[0]).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a column's bytes stay near the limit however long its texts are."""
    for batch in batches:
        values = batch.column(column)
        lengths = values.fill_null("") if values.null_count else values
        ends = text_buffers(lengths)[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def gapless(df: DataFrame, group: str, row: str, name: str, rows_a_bucket: int | None = None) -> DataFrame:
    """Number the rows of each group from 0 without gaps, whatever the size of a group.

    A group is cut into buckets by a hash of `row`, a column that is unique and stable (a stored
    one). Rows are numbered in their bucket, and a running sum of the bucket sizes gives each
    bucket its first number. Only the sizes of buckets meet in one place.
    """
    spark = df.sparkSession
    if rows_a_bucket is None:
        spread = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows_a_bucket = max(256, min(50_000, df.count() // spread))
    sizes = df.groupBy(F.col(group).alias("_of")).agg(F.ceil(F.count(F.lit(1)) / rows_a_bucket).alias("_buckets"))
    dealt = df.join(sizes, F.col(group).eqNullSafe(F.col("_of"))).drop("_of")
    dealt = dealt.withColumn("_bucket", F.pmod(F.xxhash64(row), F.col("_buckets"))).drop("_buckets")
    counts = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")
    )
    own = Window.partitionBy(group, "_bucket").orderBy(row)
    numbered = dealt.withColumn("_n", F.row_number().over(own).cast("long") - 1)
    joined = numbered.join(counts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return joined.select(*df.columns, (F.col("_first") + F.col("_n")).alias(name))


def running_total(df: DataFrame, order: str, value: str, name: str, block: int = 1024) -> DataFrame:
    """The sum of `value` over all rows with a smaller `order`, an integer that is unique. Two levels:
    inside blocks of neighbouring numbers, then over the totals of the blocks."""
    df = df.withColumn("_block", F.floor(F.col(order) / block))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("_block").agg(F.sum(value).alias("_total"))
    totals = totals.select(F.col("_block").alias("_of"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    df = df.join(totals, F.col("_block") == F.col("_of"))
    return df.withColumn(name, F.col("_before") + F.col("_inside")).drop("_block", "_of", "_before", "_inside")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder, for raw files that no Spark writer can make."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, made so that tasks can write files to it."""
    uri = scratch(spark, label)
    fs, path = file_system(uri)
    fs.create_dir(path, recursive=True)
    return uri


class SharedFile:
    """A file that appears under its name only once it is whole, so a task may be run again at any time."""

    def __init__(self, uri: str, name: str):
        self.fs, folder = file_system(uri)
        self.final, self.draft = f"{folder}/{name}", f"{folder}/_draft-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.draft)

    def write(self, data: bytes | memoryview | pa.Buffer) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.draft, self.final)


def read_file(uri: str, name: str, offset: int = 0, length: int | None = None) -> bytes:
    fs, folder = file_system(uri)
    with fs.open_input_file(f"{folder}/{name}") as file:
        if offset:
            file.seek(offset)
        return file.read(length)
