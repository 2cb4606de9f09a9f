"""Column expressions shared by the operators. All of them stay inside Catalyst."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates -----------------------------------------------------------------------------

def date_key(c: Column | str) -> Column:
    """A date or timestamp as the integer yyyymmdd."""
    c = col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def key_date(c: Column | str) -> Column:
    """A yyyymmdd key as a date; NULL for the unknown key."""
    c = col(c)
    return F.when(
        c > 0,
        F.make_date((c / 10000).cast("int"), ((c % 10000) / 100).cast("int"), (c % 100).cast("int")),
    )


def literal_date_key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def months_before(as_of: dt.date, months: int) -> dt.date:
    """Same day n months earlier, or the last day of that month when it is shorter."""
    total = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(total, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(as_of.day, last))


def days_between(first_key: Column | str, last_key: Column | str) -> Column:
    """Days from one date key to another; NULL when either is unknown or missing."""
    return F.datediff(key_date(last_key), key_date(first_key))


# --- time of day -----------------------------------------------------------------------

def seconds_of_day(c: Column | str) -> Column:
    c = col(c)
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def shift_name(hour: Column) -> Column:
    return F.when((hour < 6) | (hour >= 22), "Night").when(hour < 14, "Day").otherwise("Evening")


# --- numbers ---------------------------------------------------------------------------

def wide_sum(c: Column | str) -> Column:
    """Sum of an integer measure as a 64-bit number."""
    return F.sum(col(c).cast("bigint"))


def ratio(top: Column, base: Column, precision: int, scale: int, percent: bool = False) -> Column:
    """Quotient of two totals, NULL when the base is NULL or zero.

    It is taken at ten digits, and a percentage multiplied afterwards: a wider numerator
    would cost the quotient its digits, since a decimal has 38 in all.
    """
    quotient = F.try_divide(top.cast("decimal(28,4)"), base.cast("decimal(28,4)"))
    if percent:
        quotient = quotient.cast("decimal(30,10)") * F.lit(100).cast("decimal(3,0)")
    return quotient.cast(T.DecimalType(precision, scale))


def decimal_average(c: Column | str) -> Column:
    """Average that does not truncate integers."""
    return F.avg(col(c).cast("decimal(18,4)"))


def count_where(condition: Column) -> Column:
    """Rows meeting a condition; NULL counts as not met."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


# --- text and hashes -------------------------------------------------------------------

def canonical_text(name: str, data_type: T.DataType) -> Column:
    """One fixed rendering per type, so equal values hash alike on every run. NULL is empty."""
    c = F.col(name)
    if isinstance(data_type, T.BooleanType):
        c = c.cast("int").cast("string")
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
    elif isinstance(data_type, T.BinaryType):
        c = F.lower(F.hex(c))
    else:
        c = c.cast("string")
    return F.coalesce(c, F.lit(""))


def row_hash(schema: T.StructType, columns: list[str]) -> Column:
    """SHA-256 over the columns in the given order, joined by a bar."""
    parts = [canonical_text(c, schema[c].dataType) for c in columns]
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


HASH_DIGITS = 64  # of a whole SHA-256


def hash_bucket(digits: int, *columns: Column) -> Column:
    """The first hex digits of a SHA-256: a bucket that depends on content alone, so a
    recomputed task puts each row where the lost one did."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.substring(F.sha2(text, 256), 1, digits)


def hash_number(*columns: Column) -> Column:
    """A content hash as a number between 0 and 2^32 - 1."""
    return F.conv(hash_bucket(8, *columns), 16, 10).cast("bigint")


def rule_code(text: Column, limit: int = 50) -> Column:
    """Upper-case code of a rule name. A name too long for the column keeps its start and
    ends in a hash of the whole, so that two long names never share a code."""
    code = F.upper(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    short = F.concat(F.substring(code, 1, limit - 9), F.lit("_"), F.upper(hash_bucket(8, code)))
    return F.when(F.length(code) > limit, short).otherwise(code)


def text_or_empty(*parts: Column | str) -> Column:
    """Concatenation that takes NULL as empty text."""
    return F.concat(*[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])


def clean_label(text: Column) -> Column:
    """Upper-case text with everything but letters and digits turned into underscores."""
    return F.upper(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"))
