"""States of the customer and supplier dimensions on two days, shared by load queries.

The orders and shipments themselves give the changes. The first state is what was known on
a day; the second holds every customer and supplier and takes in all orders and shipments.
Between them some customers order for the first time, some order more than ever before, and
the rest stay as they were.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoarfrost.operators.joins import resolve_key
from hoarfrost.operators.scd import open_version
from hoarfrost.operators.filters import with_defaults
from hoarfrost.plans.check_sql import dec
from hoarfrost.sources import trade
from hoarfrost.sources.trade import MODEL, trade_warehouse

# The days that date the two states; the second day is after all orders and shipments.
FIRST, SECOND = dt.date(1996, 1, 1), dt.date(2002, 1, 1)
SHIP_FIRST = dt.date(1995, 1, 5)


def CUSTOMERS_AT(day: dt.date | None = None) -> str:  # noqa: N802 - a piece of SQL
    before, how = (f"WHERE o_orderdate < DATE '{day}'", "") if day else ("", "LEFT")
    return f"""SELECT c_custkey + 1 AS CustomerKey, c_name AS CustomerNumber, c_mktsegment AS MarketSegmentName,
      CAST(coalesce(largest, 0) AS DECIMAL(18,4)) AS AccountBalanceAmount, n_nationkey AS NationKey, n_name AS NationNationCode,
      sha256(concat_ws('|', c_name, coalesce(c_mktsegment, ''), CAST(CAST(coalesce(largest, 0) AS DECIMAL(18,4)) AS VARCHAR), n_name)) AS RowHash
    FROM customer {how} JOIN (SELECT o_custkey, max({dec('o_totalprice')}) AS largest FROM orders
        {before} GROUP BY o_custkey) s ON o_custkey = c_custkey
      JOIN nation ON n_nationkey = c_nationkey"""


def SUPPLIERS_AT(day: dt.date | None = None) -> str:  # noqa: N802 - a piece of SQL
    before, how = (f"WHERE l_shipdate < DATE '{day}'", "") if day else ("", "LEFT")
    return f"""SELECT s_suppkey + 1 AS SupplierKey, s_name AS SupplierNumber,
      CAST(coalesce(shipped, 0) AS DECIMAL(18,4)) AS AccountBalanceAmount, n_nationkey AS NationKey
    FROM supplier {how} JOIN (SELECT l_suppkey, sum({dec('l_extendedprice')}) AS shipped FROM lineitem
        {before} GROUP BY l_suppkey) s ON l_suppkey = s_suppkey
      JOIN nation ON n_nationkey = s_nationkey"""


def numbered_sql(order: str) -> str:
    """The order in which new surrogate keys are given out: by the hash of the value's
    text, then by the value itself."""
    return f"row_number() OVER (ORDER BY sha256(CAST({order} AS VARCHAR)), {order})"


def customer_rows(spark: SparkSession, folder: str, day: dt.date, batch_id: int) -> DataFrame:
    """Staged customers with their nation resolved and the key the first load gave them."""
    stage = trade.customer_stage(spark, folder, day, batch_id)
    nations = trade_warehouse(spark, folder)["Nation"]
    named = resolve_key(stage, nations, "NationNationCode", "NationCode", "NationKey", "NationKey")
    return named.withColumn("CustomerKey", F.col("RowNumber"))


def customer_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The customer dimension after its first load."""
    start = F.lit(FIRST.isoformat()).cast("timestamp_ntz")
    rows = customer_rows(spark, folder, FIRST, 1).drop("BatchId")
    return open_version(rows, MODEL["Customer"], start, 1, MODEL)


def supplier_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The supplier dimension after its first load."""
    stage = trade.supplier_stage(spark, folder, SHIP_FIRST, 1)
    nations = trade_warehouse(spark, folder)["Nation"]
    rows = resolve_key(stage, nations, "NationNationCode", "NationCode", "NationKey", "NationKey")
    keyed = rows.withColumn("SupplierKey", F.col("RowNumber")).drop("BatchId")
    return with_defaults(keyed, MODEL["Supplier"], 1, F.lit(SHIP_FIRST.isoformat()))
