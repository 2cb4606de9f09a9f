"""Dimensions kept in hash buckets: a version is a manifest, and a batch rewrites the buckets it changes.

Below a table's folder lie `v=<version>`, the manifest of each version, and `data`, the bucket folders that
manifests point at. Versions share the folders that no batch between them has changed. Spark's success
marker in a manifest's folder commits the version: what a failed write leaves in `data` is pointed at by
nothing, and goes with the next clean-up.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoarfrost.sources import files

DATA = "data"
BUCKET, MARK = "__bucket", "manifest"
#: Rows of a bucket that a new layout aims at. A table that has outgrown its layout twice over gets a new one.
BUCKET_ROWS = 1_000_000
#: A manifest's rows: one for each bucket that has rows, and one (bucket -1) for the version itself, whose
#: place is the schema, whose highest key counts every key ever given, and which names the version below.
MANIFEST = "bucket int, buckets int, place string, rows bigint, highest bigint, built_from bigint"
VERSION_ROW = -1


@dataclass(frozen=True)
class Version:
    """One committed version of a bucketed table."""

    number: int
    buckets: int
    places: dict[int, str]
    rows: dict[int, int]
    highest: int
    built_from: int | None
    schema: T.StructType
    highest_of: dict[int, int]


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a business key, from its text alone."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def is_bucketed(spark: SparkSession, path: str, number: int) -> bool:
    """Whether a version is a manifest; a table's first versions may have been written whole."""
    return files.exists(spark, f"{path}/v={number}/{MARK}=1")


def load_version(spark: SparkSession, path: str, number: int) -> Version:
    """A manifest. It has a row for each bucket, and the number of buckets grows with the table's rows only."""
    found = spark.read.schema(MANIFEST).parquet(f"{path}/v={number}/{MARK}=1").collect()
    own = next(r for r in found if r.bucket == VERSION_ROW)
    kept = [r for r in found if r.bucket != VERSION_ROW]
    return Version(
        number, own.buckets, {r.bucket: r.place for r in kept}, {r.bucket: r.rows for r in kept}, own.highest, own.built_from,
        T.StructType.fromJson(json.loads(own.place)), {r.bucket: r.highest for r in kept},
    )


def read(spark: SparkSession, path: str, version: Version, only: set[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets. Only their folders are listed and read."""
    wanted = [f"{path}/{place}" for b, place in sorted(version.places.items()) if only is None or b in only]
    schema = schema or version.schema
    return spark.read.schema(schema).parquet(*wanted) if wanted else spark.createDataFrame([], schema)


def touched(df: DataFrame, key: str, buckets: int) -> set[int]:
    """The buckets that hold the given keys, at most all buckets."""
    found = df.filter(F.col(key).isNotNull()).select(bucket_of(F.col(key), buckets).alias("b")).distinct()
    return {r.b for r in found.collect()}


def layout(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """The number of buckets for so many rows, a power of two."""
    return 1 << max(0, -(-rows // bucket_rows) - 1).bit_length()


def write(
    df: DataFrame, path: str, number: int, business_key: str, key: str, base: Version | None = None, only: set[int] | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> Version:
    """Commit a version made of `df`'s rows for the buckets in `only`, and of `base`'s folders for all others.

    `df` may hold other buckets' rows too; they are left out. Without a base, or for a table that has
    outgrown its layout, `df` is taken as the whole table and all buckets are written.
    """
    spark, schema = df.sparkSession, T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    whole = base is None or only is None
    buckets = layout(df.count(), bucket_rows) if whole else base.buckets
    rows = df.withColumn(BUCKET, F.coalesce(bucket_of(F.col(business_key), buckets), F.lit(0)))
    places = {} if whole else {b: p for b, p in base.places.items() if b not in only}
    counts = {b: base.rows[b] for b in places}
    highest = {b: base.highest_of[b] for b in places}
    if whole or only:
        if not whole:
            rows = rows.filter(F.col(BUCKET).isin(sorted(only)))
        folder = f"{DATA}/{number}-{uuid.uuid4().hex[:8]}"
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        stored = spark.read.schema(T.StructType([schema[key], T.StructField(BUCKET, T.IntegerType())])).parquet(f"{path}/{folder}")
        for r in stored.groupBy(BUCKET).agg(F.count("*").alias("n"), F.max(key).alias("most")).collect():
            places[r[BUCKET]], counts[r[BUCKET]], highest[r[BUCKET]] = f"{folder}/{BUCKET}={r[BUCKET]}", r.n, r.most
    most = max([0, base.highest if base else 0, *(h for h in highest.values() if h is not None)])
    built_from = base.number if base else None
    lines = [(b, buckets, places[b], counts[b], highest[b], built_from) for b in sorted(places)]
    lines.append((VERSION_ROW, buckets, schema.json(), sum(counts.values()), most, built_from))
    made = spark.createDataFrame(lines, MANIFEST).coalesce(1).withColumn(MARK, F.lit(1))
    made.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MARK).parquet(f"{path}/v={number}")
    return Version(number, buckets, places, counts, most, built_from, schema, highest)


def outgrown(base: Version, more: int, bucket_rows: int = BUCKET_ROWS) -> bool:
    """Whether the layout should change: buckets of more than twice the rows that one aims at."""
    return sum(base.rows.values()) + more > 2 * bucket_rows * base.buckets


def drop_unused(spark: SparkSession, path: str, numbers: list[int]) -> int:
    """Delete the bucket folders that no version of `numbers` points at; the number of folders deleted.

    Folders written for a version after the last one are left alone: a load may be writing them.
    """
    used = {place for n in numbers if is_bucketed(spark, path, n) for place in load_version(spark, path, n).places.values()}
    gone = 0
    for folder, is_folder, _, _ in files.children(spark, f"{path}/{DATA}"):
        if not is_folder or not numbers or int(folder.partition("-")[0]) > max(numbers):
            continue
        inside = [name for name, below, _, _ in files.children(spark, f"{path}/{DATA}/{folder}") if below and name.startswith(f"{BUCKET}=")]
        unused = [name for name in inside if f"{DATA}/{folder}/{name}" not in used]
        if len(unused) == len(inside):
            files.delete(spark, f"{path}/{DATA}/{folder}")
        else:
            for name in unused:
                files.delete(spark, f"{path}/{DATA}/{folder}/{name}")
        gone += len(unused)
    return gone
