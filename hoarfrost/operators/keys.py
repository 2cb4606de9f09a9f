"""Row numbers, surrogate keys, unknown members and unique business keys.

A global row number over one window would run in one task. Here rows are cut into buckets
by a hash of their content, numbered inside each bucket, and shifted by the number of rows
in the buckets before it. Buckets depend on content alone, so reruns give the same numbers.
"""

from __future__ import annotations

import re
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoarfrost.functions.scalars import HASH_DIGITS, hash_bucket
from hoarfrost.model import UNKNOWN_KEY, TableSpec
from hoarfrost.operators.joins import plan_bytes, row_bytes
from hoarfrost.session import materialise

#: Rows of a bucket that numbering aims at, by the planner's estimate, and hex digits of a bucket at most.
BUCKET_ROWS, MOST_DIGITS = 100_000, 5
#: Digits up to which the list of bucket sizes, 16 to their power at most, is broadcast.
BROADCAST_DIGITS = 3


def bucket_digits(df: DataFrame) -> int:
    """Hex digits of a content hash that cut a table into buckets of about BUCKET_ROWS rows."""
    buckets = plan_bytes(df) / row_bytes(df) / BUCKET_ROWS
    return min(MOST_DIGITS, max(1, ceil(log(max(buckets, 1), 16))))


def numbered(df: DataFrame, order: list[str], out: str, within: list[str] | None = None) -> DataFrame:
    """Add a row number from 1, over the whole table or within groups.

    Rows are ordered by the hash of `order`, which must be unique, and then by `order`. A bucket is a
    first part of the hash, as long as the table's size asks for: the numbers are the same however many
    there are. A group that holds a third of the table is still spread over all of its buckets, and
    the list of bucket sizes has at most one row per bucket (and group).
    """
    within = within or []
    digits = bucket_digits(df)
    bucketed = df.withColumn("__hash", hash_bucket(HASH_DIGITS, *[F.col(c) for c in order]))
    bucketed = bucketed.withColumn("__bucket", F.substring("__hash", 1, digits))
    sizes = bucketed.groupBy(*within, "__bucket").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(*within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"__g_{c}") for c in within],
        F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(*within, "__bucket").orderBy("__hash", *order)
    ranked = bucketed.withColumn("__rank", F.row_number().over(inside))
    on = F.col("__bucket") == F.col("__b")
    for c in within:
        on = on & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    if not within and digits <= BROADCAST_DIGITS:
        starts = F.broadcast(starts)  # at most 16 ** BROADCAST_DIGITS rows
    joined = ranked.join(starts, on, "inner")
    return joined.withColumn(out, (F.col("__start") + F.col("__rank")).cast("bigint")).drop(
        "__hash", "__bucket", "__b", "__rank", "__start", *[f"__g_{c}" for c in within]
    )


def highest_key(dim: DataFrame, key: str) -> Column:
    """The largest key in use, as a scalar subquery."""
    return F.coalesce(dim.agg(F.max(key)).scalar(), F.lit(0))


def assign_keys(df: DataFrame, order: list[str], key: str, highest: Column | int = 0) -> DataFrame:
    """Give each row the next free surrogate key. Keys start at 1: -1 is the unknown member."""
    base = highest if isinstance(highest, Column) else F.lit(highest)
    return numbered(df, order, "__n").withColumn(
        key, F.greatest(base, F.lit(0)) + F.col("__n")
    ).drop("__n")


# What the unknown member holds, by declared type, and for text by the end of the column's name.
UNKNOWN_BY_TYPE = {
    **dict.fromkeys(("int", "bigint", "smallint", "tinyint", "decimal", "money", "float"), 0),
    "bit": False,
    **dict.fromkeys(("date", "datetime2"), "1900-01-01"),
    "time": "00:00:00",
    "uniqueidentifier": "00000000-0000-0000-0000-000000000000",
}
UNKNOWN_TEXT = {"Name": "Unknown", "Code": "UNKNOWN", "Number": "UNKNOWN"}


def unknown_value(name: str, declared: str) -> Column:
    """The value a column takes in the unknown member: -1 for keys, zero bytes for binary."""
    base, width = re.match(r"([a-z0-9]+)(?:\((\d+))?", declared).groups()
    text = next((value for end, value in UNKNOWN_TEXT.items() if name.endswith(end)), "N/A")
    values = {
        **UNKNOWN_BY_TYPE,
        **dict.fromkeys(("binary", "varbinary"), bytes(int(width or 32))),
    }
    return F.lit(UNKNOWN_KEY if name.endswith("Key") else values.get(base, text[: int(width)] if width else text))


def with_unknown(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the row keyed -1 unless the table already has one."""
    declared = {c.name: c for c in spec.all_columns()}
    row = df.sparkSession.range(1).select(
        *[
            unknown_value(f.name, declared[f.name].type if f.name in declared else _declared_for(f.dataType))
            .cast(f.dataType)
            .alias(f.name)
            for f in df.schema.fields
        ]
    )
    present = df.filter(F.col(spec.key) == UNKNOWN_KEY).agg(F.count("*")).scalar()
    missing = row.filter(present == 0)
    return df.unionByName(missing)


def _declared_for(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, (T.IntegerType, T.LongType, T.ShortType)):
        return "int"
    if isinstance(data_type, T.BooleanType):
        return "bit"
    if isinstance(data_type, T.DateType):
        return "date"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "datetime2"
    if isinstance(data_type, T.BinaryType):
        return "binary"
    if isinstance(data_type, T.DoubleType):
        return "float"
    return "nvarchar"


def dedupe_business_key(df: DataFrame, business_key: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Make a business key unique: the second and later rows of a key get -2, -3, ...

    The suffix replaces the end of a key that would outgrow `limit`. A made key may meet
    one that was there before, so the result is checked, and what is double is numbered
    again with numbers not used so far, until no key is double. Each such round is stored, and
    leaves out twice as many numbers as the one before while there are plenty. It fails only if
    the limit leaves no number.
    """
    used, step = 1, 1
    while limit is None or used < 10**limit:
        ranked = numbered(df, order, "__n", within=[business_key])
        suffix = F.concat(F.lit("-"), (F.col("__n") + (used - 1)).cast("string"))
        text = F.col(business_key)
        if limit is not None:
            text = F.substring(text, F.lit(1), F.greatest(F.lit(1), F.lit(limit) - F.length(suffix)))
        made = F.when(F.col(business_key).isNull() | (F.col("__n") == 1), F.col(business_key)).otherwise(
            F.concat(text, suffix) if limit is None else F.right(F.concat(text, suffix), F.lit(limit))
        )
        df = ranked.withColumn(business_key, made).drop("__n")
        twice = df.filter(F.col(business_key).isNotNull()).groupBy(business_key).count().filter("count > 1")
        if twice.isEmpty():
            return df
        used += step * (ranked.filter(F.col(business_key).isNotNull()).agg(F.max("__n")).first()[0] - 1)
        if limit is None or 2 * used < 10 ** (limit - 4):
            step *= 2
        else:
            step = 1
        df = materialise(df, "unique-keys")
    raise ValueError(f"{business_key} cannot be made unique within {limit} characters")
