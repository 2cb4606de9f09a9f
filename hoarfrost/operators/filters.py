"""Projections and row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoarfrost.functions.scalars import literal_date_key, months_before
from hoarfrost.model import AUDIT_COLUMNS, OPEN_END, STAGE_COLUMNS, UNKNOWN_KEY, VERSION_COLUMNS, TableSpec

SYSTEM_COLUMNS = set(AUDIT_COLUMNS) | set(VERSION_COLUMNS) | {"UpdatedAtUtc", "RowNumber"}
RAW_DATE = "__raw_date"  # suffix of a date column a fact view keeps beside its key


def project_shared(stage: DataFrame, target: list[str], exclude: set[str]) -> list[str]:
    """Columns that stage and target have in common, bookkeeping columns left out."""
    left_out = set(STAGE_COLUMNS) | exclude
    return [c for c in stage.columns if c in target and c not in left_out]


def with_defaults(
    df: DataFrame, spec: TableSpec, batch_id: Column | int, now: Column, extra: list[str] | None = None
) -> DataFrame:
    """Complete rows to the table's columns: supplied ones stay, the others take their default.
    Columns named in `extra` are kept behind them."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    injected = {
        "SourceSystemKey": F.lit(UNKNOWN_KEY),
        "BatchId": batch,
        "LoadedAtUtc": now,
        "EffectiveFromUtc": now,
        "EffectiveToUtc": F.lit(OPEN_END),
        "IsCurrent": F.lit(True),
    }
    keys = {fk.column: fk for fk in spec.references}
    out = []
    for c in spec.all_columns():
        if c.name in df.columns:
            value = F.col(c.name)
            if c.name in keys and (spec.kind == "fact" or not keys[c.name].nullable):
                value = F.coalesce(value, F.lit(UNKNOWN_KEY))
        elif c.name in injected:
            value = injected[c.name]
        elif c.name in keys and (spec.kind == "fact" or not keys[c.name].nullable):
            value = F.lit(UNKNOWN_KEY)
        else:
            value = F.lit(None)
        out.append(value.cast(c.spark_type).alias(c.name))
    return df.select(*out, *(extra or []))


def attribute_columns(df: DataFrame) -> list[str]:
    """Text columns one may group by."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and not f.name.endswith("Key") and f.name not in SYSTEM_COLUMNS
    ]


def measure_columns(df: DataFrame) -> list[str]:
    """Numeric columns one may aggregate."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and not f.name.endswith("Key") and f.name not in SYSTEM_COLUMNS
    ]


def date_key_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("DateKey")]


def batch(df: DataFrame, batch_id: int) -> DataFrame:
    """Rows of one batch; prunes partitions on tables partitioned by BatchId."""
    return df.filter(F.col("BatchId") == batch_id)


def loaded_only(df: DataFrame) -> DataFrame:
    """Rows that a batch loaded; unknown and default rows carry batch 0."""
    return df.filter(F.col("BatchId") > 0)


def rolling_months(fact: DataFrame, date_column: str, months: int, as_of: dt.date) -> DataFrame:
    """Fact rows dated within the last n months.

    The date key grows with the date and the unknown key is below every date, so the
    window is a comparison on the fact's own column and reaches its Parquet scan: no
    calendar join is needed to apply it. A view that derives its key from a raw date
    carries that date along, and the same bound is put on it.
    """
    since = months_before(as_of, months)
    raw = f"{date_column}{RAW_DATE}"
    if raw in fact.columns:
        bound = F.lit(since.isoformat()).cast(fact.schema[raw].dataType)
        return fact.filter(F.col(raw) >= bound).drop(raw)
    return fact.filter(F.col(date_column) >= literal_date_key(since))


def datekey_bounds(years_back: int, as_of: dt.date) -> tuple[int, int]:
    """First and last day key of whole calendar years, from n years back to as_of's."""
    return (as_of.year - years_back) * 10000 + 101, as_of.year * 10000 + 1231


def datekey_window(df: DataFrame, date_column: str, years_back: int, as_of: dt.date) -> DataFrame:
    """Whole calendar years: from January first n years back to the end of as_of's year."""
    return df.filter(F.col(date_column).between(*datekey_bounds(years_back, as_of)))


def bounded(tables: Mapping[str, DataFrame], name: str, column: str, low: int | None, high: int | None) -> DataFrame:
    """A table of which no row with a key from low to high is missing: the bounds as they reach its source,
    if the tables know where the key comes from, else the whole table. The key is still to be compared."""
    return tables.bounded(name, column, low, high) if hasattr(tables, "bounded") else tables[name]


def flagged(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(F.col(flag))


def current_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("IsCurrent"))


def known_only(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key) != UNKNOWN_KEY)


def changed(old_hash: Column, new_hash: Column) -> Column:
    """True for a new row, which has no old hash, and for one whose hash differs."""
    return old_hash.isNull() | (old_hash != new_hash)


def older_than(df: DataFrame, timestamp: str, days: int, now: Column) -> DataFrame:
    return df.filter(F.col(timestamp) < now - F.make_dt_interval(F.lit(days)))
