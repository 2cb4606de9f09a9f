"""Projections, filters, joins, aggregates, windows, sorts, set operations and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoarfrost.functions.scalars import (
    clean_label,
    count_where,
    date_key,
    decimal_average,
    hash_number,
    key_date,
    ratio,
    row_hash,
    seconds_of_day,
    shift_name,
    text_or_empty,
    wide_sum,
    months_before,
)
from hoarfrost.operators import filters as flt
from hoarfrost.operators import joins as jn
from hoarfrost.operators.aggregates import (
    distinct_union,
    rollup_declared,
    row_counts,
    sample_keys,
    sort_by_expression,
    top_n,
    with_dense_rank,
    with_share,
)
from hoarfrost.operators.flatten import flatten
from hoarfrost.operators.quality import climb_closure
from hoarfrost.plans.check_sql import average, big, code_key, dec, key_of, month_of, quotient, share, total, units
from hoarfrost.plans.check_sql import hash_number as sql_hash
from hoarfrost.plans.registry import query
from hoarfrost.plans.states import CUSTOMERS_AT, FIRST, customer_dim
from hoarfrost.sources import trade
from hoarfrost.sources.trade import AS_OF, MODEL, TABLES, money, read, trade_warehouse

PRIORITY_CODES = tuple(p[0] for p in trade.PRIORITIES)
LINES = f"""(
  SELECT l_orderkey AS OrderNumber, l_linenumber AS LineNumber, l_partkey AS PartKey, l_suppkey AS SupplierKey,
    o_custkey AS CustomerKey, {key_of('o_orderdate')} AS OrderDateKey, {key_of('l_shipdate')} AS ShipDateKey,
    l_returnflag AS ReturnFlagCode, l_linestatus AS LineStatusCode, {dec('l_quantity')} AS QuantityAmount,
    {dec('l_extendedprice')} AS ExtendedAmount, {dec('l_discount')} AS DiscountRate, {dec('l_tax')} AS TaxRate,
    {month_of('l_shipdate')} AS BatchId
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey) AS lines"""
CYCLES = f"""(
  SELECT o_orderkey AS OrderNumber, o_custkey AS CustomerKey, {code_key('o_orderpriority', PRIORITY_CODES)} AS OrderPriorityKey,
    {key_of('o_orderdate')} AS OrderDateKey, coalesce({key_of('first')}, -1) AS FirstShipDateKey,
    coalesce({key_of('last')}, -1) AS LastShipDateKey, {dec('o_totalprice')} AS TotalAmount,
    CAST(coalesce(n, 0) AS INTEGER) AS LineCount, {month_of('o_orderdate')} AS BatchId,
    CAST(date_diff('day', o_orderdate, last) AS INTEGER) AS OrderCycleLagDays
  FROM orders LEFT JOIN (
    SELECT l_orderkey AS k, min(l_shipdate) AS first, max(l_shipdate) AS last, count(*) AS n FROM lineitem GROUP BY 1
  ) s ON k = o_orderkey) AS cycles"""

# --- projections and filters -------------------------------------------------------------


@query(
    "prj_shared",
    f"SELECT MarketSegmentName, AccountBalanceAmount FROM ({CUSTOMERS_AT()}) s",
)
def prj_shared(spark, folder):
    stage = trade.customer_stage(spark, folder, None, 2)
    target = [c.name for c in MODEL["Customer"].all_columns()]
    return stage.select(*flt.project_shared(stage, target, {"CustomerNumber", "RowHash"}))


@query(
    "prj_defaults",
    f"""SELECT CAST(-1 AS BIGINT) AS SupplierKey, SupplierNumber, CAST(-1 AS INTEGER) AS NationKey, AccountBalanceAmount,
      CAST(-1 AS INTEGER) AS SourceSystemKey, CAST(7 AS BIGINT) AS BatchId, TIMESTAMP '1996-07-01' AS LoadedAtUtc
    FROM (SELECT s_name AS SupplierNumber, {dec('s_acctbal')} AS AccountBalanceAmount FROM supplier) s""",
)
def prj_defaults(spark, folder):
    rows = trade_warehouse(spark, folder)["Supplier"].select("SupplierNumber", "AccountBalanceAmount")
    full = flt.with_defaults(rows, MODEL["Supplier"], 7, F.lit("1996-07-01"))
    return full.withColumn("SupplierKey", F.coalesce("SupplierKey", F.lit(-1)))


@query("flt_batch", f"SELECT * FROM {LINES} WHERE BatchId = 199906")
def flt_batch(spark, folder):
    return flt.batch(flt.bounded(trade_warehouse(spark, folder), "OrderLine", "BatchId", 199906, 199906), 199906)


@query("flt_loaded", f"SELECT OrderNumber, BatchId FROM (SELECT OrderNumber, CASE WHEN LineCount > 0 THEN BatchId ELSE 0 END AS BatchId FROM {CYCLES}) WHERE BatchId > 0")
def flt_loaded(spark, folder):
    cycles = trade_warehouse(spark, folder)["OrderCycle"]
    # An order without a line has not been loaded by any batch yet.
    marked = cycles.withColumn("BatchId", F.when(F.col("LineCount") > 0, F.col("BatchId")).otherwise(0))
    return flt.loaded_only(marked).select("OrderNumber", "BatchId")


@query("flt_rolling_months", f"SELECT * FROM {LINES} WHERE ShipDateKey >= 20010201")
def flt_rolling_months(spark, folder):
    wh = trade_warehouse(spark, folder)
    return flt.rolling_months(flt.bounded(wh, "OrderLine", "ShipDateKey", int(f"{months_before(AS_OF, 6):%Y%m%d}"), None), "ShipDateKey", 6, AS_OF)


@query("flt_datekey_years", f"SELECT * FROM {CYCLES} WHERE OrderDateKey BETWEEN 20000101 AND 20011231")
def flt_datekey_years(spark, folder):
    wh = trade_warehouse(spark, folder)
    return flt.datekey_window(flt.bounded(wh, "OrderCycle", "OrderDateKey", *flt.datekey_bounds(1, AS_OF)), "OrderDateKey", 1, AS_OF)


@query("flt_flag", "SELECT o_orderkey AS OrderNumber, o_orderpriority AS OrderPriorityCode FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def flt_flag(spark, folder):
    wh = trade_warehouse(spark, folder)
    urgent = flt.flagged(wh["OrderPriority"], "RequiresEscalation").select("OrderPriorityKey", "OrderPriorityCode")
    orders = wh["OrderCycle"].select("OrderNumber", "OrderPriorityKey")
    return jn.sized_join(orders, urgent, {"OrderPriorityKey": "OrderPriorityKey"}).drop("OrderPriorityKey")


@query("flt_known", f"SELECT OrderNumber, FirstShipDateKey FROM {CYCLES} WHERE FirstShipDateKey <> -1")
def flt_known(spark, folder):
    cycles = trade_warehouse(spark, folder)["OrderCycle"].select("OrderNumber", "FirstShipDateKey")
    return flt.known_only(cycles, "FirstShipDateKey")


CHANGES = f"""
  SELECT b.CustomerNumber, a.AccountBalanceAmount AS before, b.AccountBalanceAmount AS after,
    CASE WHEN a.CustomerNumber IS NULL THEN 'insert' WHEN a.RowHash <> b.RowHash THEN 'update' ELSE 'unchanged' END AS action
  FROM ({CUSTOMERS_AT()}) b LEFT JOIN ({CUSTOMERS_AT(FIRST)}) a ON a.CustomerNumber = b.CustomerNumber"""


def _hashed(spark, folder, day, batch):
    rows = trade.customer_stage(spark, folder, day, batch)
    names = ["CustomerNumber", "MarketSegmentName", "AccountBalanceAmount", "NationNationCode"]
    return rows.withColumn("RowHash", row_hash(rows.schema, names))


def _compared(spark, folder):
    before = _hashed(spark, folder, FIRST, 1).select(
        "CustomerNumber", F.col("RowHash").alias("old"), F.col("AccountBalanceAmount").alias("before")
    )
    after = _hashed(spark, folder, None, 2)
    # Both sides hold a customer once, so a plain join on the number has no skew.
    return jn.sized_join(after, before, {"CustomerNumber": "CustomerNumber"}, "left", heavy_rows=None)


@query("flt_changed", f"SELECT CustomerNumber, before, after FROM ({CHANGES}) WHERE action <> 'unchanged'")
def flt_changed(spark, folder):
    changed = _compared(spark, folder).filter(flt.changed(F.col("old"), F.col("RowHash")))
    return changed.select("CustomerNumber", "before", F.col("AccountBalanceAmount").alias("after"))


@query("jn_change_detect", CHANGES)
def jn_change_detect(spark, folder):
    action = F.when(F.col("old").isNull(), "insert").when(F.col("old") != F.col("RowHash"), "update").otherwise("unchanged")
    return _compared(spark, folder).select(
        "CustomerNumber", "before", F.col("AccountBalanceAmount").alias("after"), action.alias("action")
    )


@query(
    "jn_expire",
    f"""SELECT a.CustomerNumber, a.AccountBalanceAmount FROM ({CUSTOMERS_AT(FIRST)}) a
    WHERE EXISTS (SELECT 1 FROM ({CHANGES}) c WHERE c.CustomerNumber = a.CustomerNumber AND c.action = 'update')""",
)
def jn_expire(spark, folder):
    changed = _compared(spark, folder).filter(F.col("old") != F.col("RowHash")).select("CustomerNumber")
    current = customer_dim(spark, folder).filter("IsCurrent").select("CustomerNumber", "AccountBalanceAmount")
    return jn.sized_join(current, changed, {"CustomerNumber": "CustomerNumber"}, "left_semi", heavy_rows=None)


@query("flt_null_negative", f"""SELECT c_name AS CustomerNumber, {dec('c_acctbal')} AS AccountBalanceAmount FROM customer
  WHERE c_acctbal IS NULL OR c_acctbal < 0""")
def flt_null_negative(spark, folder):
    customers = trade_warehouse(spark, folder)["Customer"].select("CustomerNumber", "AccountBalanceAmount")
    return customers.filter(F.col("AccountBalanceAmount").isNull() | (F.col("AccountBalanceAmount") < 0))


@query("flt_retention", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY")
def flt_retention(spark, folder):
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    return flt.older_than(read(spark, folder, "events").select("event_id", "ts"), "ts", 14, now)


# --- joins -------------------------------------------------------------------------------


@query("jn_star", f"""SELECT p_name AS PartName, s_name AS SupplierNumber, c_name AS CustomerNumber, QuantityAmount
  FROM {LINES} JOIN part ON p_partkey = PartKey JOIN supplier ON s_suppkey = SupplierKey JOIN customer ON c_custkey = CustomerKey""")
def jn_star(spark, folder):
    wh = trade_warehouse(spark, folder)
    lines = wh["OrderLine"].select("PartKey", "SupplierKey", "CustomerKey", "QuantityAmount")
    joined = jn.star_join(
        lines,
        {
            "PartKey": (wh["Part"].select("PartKey", "PartName"), "PartKey"),
            "SupplierKey": (wh["Supplier"].select("SupplierKey", "SupplierNumber"), "SupplierKey"),
            "CustomerKey": (wh["Customer"].select("CustomerKey", "CustomerNumber"), "CustomerKey"),
        },
    )
    return joined.select("PartName", "SupplierNumber", "CustomerNumber", "QuantityAmount")


@query("jn_branch", f"""SELECT OrderNumber, c_name AS CustomerNumber, n_name AS NationName, r_name AS RegionName
  FROM {CYCLES} JOIN customer ON c_custkey = CustomerKey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey""")
def jn_branch(spark, folder):
    wh = trade_warehouse(spark, folder)
    climbed = jn.climb(
        wh["OrderCycle"].select("OrderNumber", "CustomerKey"),
        [
            ("CustomerKey", wh["Customer"].select("CustomerKey", "CustomerNumber", "NationKey"), "CustomerKey"),
            ("NationKey", wh["Nation"].select("NationKey", "NationName", "RegionKey"), "NationKey"),
            ("RegionKey", wh["Region"].select("RegionKey", "RegionName"), "RegionKey"),
        ],
    )
    return climbed.select("OrderNumber", "CustomerNumber", "NationName", "RegionName")


@query("jn_role", """SELECT o_orderkey AS OrderNumber, strftime(o_orderdate, '%A') AS OrderDayName,
    strftime(first, '%A') AS FirstShipDayName, strftime(last, '%A') AS LastShipDayName
  FROM orders JOIN (SELECT l_orderkey AS k, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY 1) s
    ON k = o_orderkey""")
def jn_role(spark, folder):
    wh = trade_warehouse(spark, folder)
    cycles = wh["OrderCycle"].select("OrderNumber", "OrderDateKey", "FirstShipDateKey", "LastShipDateKey")
    days = wh["Date"].select("DateKey", "DayName")
    joined = jn.role_join(
        cycles, days, "DateKey", {"Order": "OrderDateKey", "FirstShip": "FirstShipDateKey", "LastShip": "LastShipDateKey"}
    )
    return joined.select("OrderNumber", "OrderDayName", "FirstShipDayName", "LastShipDayName")


@query("jn_left_flatten", """SELECT p_partkey AS PartKey, p_name AS PartName, p_brand AS Brand_BrandName,
  upper(p_type[1]) || lower(p_type[2:]) AS PartType_PartTypeName FROM part""")
def jn_left_flatten(spark, folder):
    return flatten(MODEL, trade_warehouse(spark, folder), "Part", ["PartKey", "PartName", "Brand_BrandName", "PartType_PartTypeName"])


@query("jn_lookup", f"""SELECT o_orderkey + 1 AS RowNumber, CASE WHEN o_orderstatus <> 'P' THEN c_name END AS CustomerCustomerNumber,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN coalesce(k, -1) ELSE -1 END AS BIGINT) AS CustomerKey,
    (o_orderstatus <> 'P' AND k IS NULL) AS Missed
  FROM orders JOIN customer ON c_custkey = o_custkey
  LEFT JOIN (SELECT CustomerNumber, CustomerKey AS k FROM ({CUSTOMERS_AT(FIRST)}) d) d ON d.CustomerNumber = c_name""")
def jn_lookup(spark, folder):
    stage = trade.order_stage(spark, folder, 1).select("RowNumber", "CustomerCustomerNumber")
    return jn.resolve_key(
        stage, customer_dim(spark, folder), "CustomerCustomerNumber", "CustomerNumber", "CustomerKey", "CustomerKey",
        current_only=True, miss="Missed",
    )


@query("jn_key_check", f"""SELECT OrderNumber, CAST(coalesce(k, -1) AS BIGINT) AS CustomerKey FROM {CYCLES}
  LEFT JOIN (SELECT CustomerKey AS k FROM ({CUSTOMERS_AT(FIRST)}) d) d ON k = CustomerKey + 1""")
def jn_key_check(spark, folder):
    orders = trade_warehouse(spark, folder)["OrderCycle"].select("OrderNumber", (F.col("CustomerKey") + 1).alias("CustomerKey"))
    return jn.check_key(orders, customer_dim(spark, folder), "CustomerKey", "CustomerKey")


@query("jn_orphan", f"""SELECT CustomerKey, count(*) AS row_count FROM (SELECT CustomerKey + 1 AS CustomerKey FROM {CYCLES}) c
  WHERE CustomerKey NOT IN (SELECT CustomerKey FROM ({CUSTOMERS_AT(FIRST)}) d) GROUP BY CustomerKey""")
def jn_orphan(spark, folder):
    orders = trade_warehouse(spark, folder)["OrderCycle"].select((F.col("CustomerKey") + 1).alias("CustomerKey"))
    return jn.orphans(orders, customer_dim(spark, folder), "CustomerKey", "CustomerKey")


@query("jn_lookup_miss", f"""SELECT c_name AS CustomerCustomerNumber, count(*) AS row_count
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P'
  AND c_name NOT IN (SELECT CustomerNumber FROM ({CUSTOMERS_AT(FIRST)}) d) GROUP BY c_name""")
def jn_lookup_miss(spark, folder):
    stage = trade.order_stage(spark, folder, 1)
    return jn.lookup_miss(stage, customer_dim(spark, folder), "CustomerCustomerNumber", "CustomerNumber")


@query("jn_bridge", """SELECT p_partkey AS PartKey, p_name AS PartName, s_name AS SupplierNumber
  FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) b ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey""")
def jn_bridge(spark, folder):
    wh = trade_warehouse(spark, folder)
    parts = wh["Part"].select("PartKey", "PartName")
    suppliers = wh["Supplier"].select("SupplierKey", "SupplierNumber")
    return jn.via_bridge(parts, wh["PartSupplier"], "PartKey", suppliers, "SupplierKey", "SupplierKey").select(
        "PartKey", "PartName", "SupplierNumber"
    )


# --- aggregates --------------------------------------------------------------------------

def _lines(spark, folder):
    """Line items in fact shape, without the order they belong to."""
    return read(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("ReturnFlagCode"), F.col("l_linestatus").alias("LineStatusCode"),
        F.col("l_partkey").alias("PartKey"), F.col("l_suppkey").alias("SupplierKey"), F.col("l_orderkey").alias("OrderNumber"),
        F.col("l_linenumber").alias("LineNumber"), money("l_quantity").alias("QuantityAmount"),
        money("l_extendedprice").alias("ExtendedAmount"), money("l_discount").alias("DiscountRate"),
        money("l_tax").alias("TaxRate"), F.col("l_shipdate").alias("ShipDate"),
    )


BY = "l_returnflag AS ReturnFlagCode, l_linestatus AS LineStatusCode"


def _grouped_query(name: str, sql_agg: str, *aggs):
    sql = f"SELECT {BY}, {sql_agg} FROM lineitem GROUP BY l_returnflag, l_linestatus"

    @query(name, sql)
    def run(spark, folder):
        return _lines(spark, folder).groupBy("ReturnFlagCode", "LineStatusCode").agg(*[a() for a in aggs])

    return run


_grouped_query("ag_count", "count(*) AS RowTotal", lambda: F.count("*").alias("RowTotal"))
_grouped_query(
    "ag_count_distinct",
    "count(DISTINCT l_partkey) AS Parts, count(DISTINCT l_suppkey) AS Suppliers, count(DISTINCT l_orderkey) AS Orders",
    lambda: F.countDistinct("PartKey").alias("Parts"),
    lambda: F.countDistinct("SupplierKey").alias("Suppliers"),
    lambda: F.countDistinct("OrderNumber").alias("Orders"),
)
_grouped_query("ag_sum_wide", f"{big('sum(l_linenumber)')} AS Lines", lambda: wide_sum("LineNumber").alias("Lines"))
_grouped_query("ag_sum", f"{total(dec('l_extendedprice'))} AS Amount", lambda: F.sum("ExtendedAmount").alias("Amount"))
_grouped_query("ag_avg", f"{average(dec('l_quantity'))} AS AvgQuantity", lambda: F.avg("QuantityAmount").alias("AvgQuantity"))
_grouped_query("ag_min", f"min({dec('l_extendedprice')}) AS Least", lambda: F.min("ExtendedAmount").alias("Least"))
_grouped_query("ag_max", f"max({dec('l_extendedprice')}) AS Most", lambda: F.max("ExtendedAmount").alias("Most"))
_grouped_query(
    "ag_cond_sum",
    f"{big('sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END)')} AS Discounted",
    lambda: count_where(F.col("DiscountRate") > F.lit("0.05").cast("decimal(18,4)")).alias("Discounted"),
)
_grouped_query(
    "ag_ratio",
    quotient(f"sum({units(dec('l_extendedprice'))})", f"sum({units(dec('l_quantity'))})", 18, 6) + " AS AmountPerUnit",
    lambda: ratio(F.sum("ExtendedAmount"), F.sum("QuantityAmount"), 18, 6).alias("AmountPerUnit"),
)
_grouped_query(
    "ag_avg_cast",
    f"{average('l_linenumber', scale_in=0)} AS AvgLineNumber",
    lambda: decimal_average("LineNumber").alias("AvgLineNumber"),
)


@query("ag_max_attr", """SELECT CAST(month(o_orderdate) AS INTEGER) AS MonthNumber, max(strftime(o_orderdate, '%B')) AS MonthName, count(*) AS Orders
  FROM orders GROUP BY month(o_orderdate)""")
def ag_max_attr(spark, folder):
    wh = trade_warehouse(spark, folder)
    months = wh["Date"].select("DateKey", F.col("CalendarMonthNumber").cast("int").alias("MonthNumber"), "CalendarMonthName")
    joined = jn.star_join(wh["OrderCycle"].select("OrderDateKey"), {"OrderDateKey": (months, "DateKey")})
    return joined.groupBy("MonthNumber").agg(F.max("CalendarMonthName").alias("MonthName"), F.count("*").alias("Orders"))


@query("ag_having", "SELECT l_partkey AS PartKey, l_suppkey AS SupplierKey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def ag_having(spark, folder):
    pairs = _lines(spark, folder).groupBy("PartKey", "SupplierKey").agg(F.count("*").alias("n"))
    return pairs.filter(F.col("n") > 1)


@query("ag_declared", f"""SELECT SupplierKey, count(*) AS FactRowCount, {total('QuantityAmount')} AS QuantityAmount,
    {total('ExtendedAmount')} AS ExtendedAmount, {average('DiscountRate')} AS DiscountRate, max(TaxRate) AS TaxRate
  FROM {LINES} GROUP BY SupplierKey""")
def ag_declared(spark, folder):
    return rollup_declared(_lines(spark, folder), MODEL["OrderLine"], ["SupplierKey"])


@query("ag_rows_by_table", " UNION ALL ".join(f"SELECT 'raw' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def ag_rows_by_table(spark, folder):
    return row_counts({t: read(spark, folder, t) for t in TABLES})


# --- windows, order, sets ----------------------------------------------------------------


@query("wn_share", f"""WITH g AS (SELECT n_name AS NationName, c_mktsegment AS MarketSegmentName, count(*) AS Customers
    FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2),
  t AS (SELECT NationName AS k, {big('sum(Customers)')} AS n FROM g GROUP BY 1)
  SELECT g.*, n AS NationCustomers, {share('Customers', 'n')} AS PercentOfNation
  FROM g JOIN t ON k = NationName""")
def wn_share(spark, folder):
    wh = trade_warehouse(spark, folder)
    customers = wh["Customer"].groupBy("NationKey", "MarketSegmentName").agg(F.count("*").alias("Customers"))
    named = jn.sized_join(customers, wh["Nation"].select("NationKey", "NationName"), {"NationKey": "NationKey"})
    grouped = named.drop("NationKey")
    return with_share(grouped, "Customers", ["NationName"], "NationCustomers", "PercentOfNation")


@query("wn_dense_rank", f"""SELECT c_custkey AS CustomerKey, c_nationkey AS NationKey, {dec('c_acctbal')} AS AccountBalanceAmount,
  dense_rank() OVER (PARTITION BY c_nationkey ORDER BY {dec('c_acctbal')} DESC) AS BalanceRank FROM customer""")
def wn_dense_rank(spark, folder):
    customers = trade_warehouse(spark, folder)["Customer"].select("CustomerKey", "NationKey", "AccountBalanceAmount")
    return with_dense_rank(customers, ["NationKey"], "AccountBalanceAmount", "BalanceRank")


@query("sl_sort_multi", f"""SELECT OrderNumber, OrderDateKey, OrderPriorityKey, TotalAmount FROM {CYCLES}
  ORDER BY OrderDateKey DESC, OrderPriorityKey, TotalAmount DESC, OrderNumber""")
def sl_sort_multi(spark, folder):
    cycles = trade_warehouse(spark, folder)["OrderCycle"].select("OrderNumber", "OrderDateKey", "OrderPriorityKey", "TotalAmount")
    return cycles.orderBy(F.desc("OrderDateKey"), F.asc("OrderPriorityKey"), F.desc("TotalAmount"), F.asc("OrderNumber"))


@query("sl_sort_expr", f"SELECT c_nationkey AS NationKey, {total(dec('c_acctbal'))} AS Balance FROM customer GROUP BY 1 ORDER BY abs(sum({dec('c_acctbal')})) DESC, 1")
def sl_sort_expr(spark, folder):
    balances = trade_warehouse(spark, folder)["Customer"].groupBy("NationKey").agg(F.sum("AccountBalanceAmount").alias("Balance"))
    return sort_by_expression(balances, F.abs("Balance"), F.asc("NationKey"))


@query("sl_top_n", f"SELECT OrderNumber, TotalAmount FROM {CYCLES} ORDER BY TotalAmount DESC, OrderNumber LIMIT 100")
def sl_top_n(spark, folder):
    cycles = trade_warehouse(spark, folder)["OrderCycle"].select("OrderNumber", "TotalAmount")
    return top_n(cycles, [F.desc("TotalAmount"), F.asc("OrderNumber")], 100)


@query("sl_sample_keys", f"SELECT c_custkey AS CustomerKey FROM customer ORDER BY {sql_hash('CAST(c_custkey AS VARCHAR)')}, c_custkey LIMIT 500")
def sl_sample_keys(spark, folder):
    return sample_keys(trade_warehouse(spark, folder)["Customer"], "CustomerKey")


@query("so_union", "SELECT l_partkey AS PartKey, l_suppkey AS PartnerKey FROM lineitem UNION SELECT l_partkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def so_union(spark, folder):
    wh = trade_warehouse(spark, folder)
    bought = wh["PartSupplier"].select("PartKey", F.col("SupplierKey").alias("PartnerKey"))
    sold = wh["OrderLine"].select("PartKey", F.col("CustomerKey").alias("PartnerKey"))
    return distinct_union(bought, sold)


@query("so_distinct", "SELECT DISTINCT c_name AS CustomerCustomerNumber FROM events JOIN customer ON c_custkey = user_id")
def so_distinct(spark, folder):
    return trade.event_stage(spark, folder, 1).select("CustomerCustomerNumber").distinct()


@query("so_union_all_recursive", """WITH RECURSIVE edges AS (
    SELECT c_name AS child, n_name AS parent FROM customer JOIN nation ON n_nationkey = c_nationkey
    UNION ALL SELECT s_name, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
    UNION ALL SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
  ), climb AS (
    SELECT child, parent AS ancestor, 1 AS depth FROM edges
    UNION ALL SELECT climb.child, edges.parent, depth + 1 FROM climb JOIN edges ON edges.child = climb.ancestor
  ) SELECT child, ancestor, max(depth) AS depth FROM climb GROUP BY child, ancestor""")
def so_union_all_recursive(spark, folder):
    wh = trade_warehouse(spark, folder)
    nations = wh["Nation"].select("NationKey", F.col("NationCode").alias("parent"))
    owned = [
        jn.sized_join(wh[t].select("NationKey", F.col(f"{t}Number").alias("child")), nations, {"NationKey": "NationKey"})
        for t in ("Customer", "Supplier")
    ]
    regions = wh["Region"].select("RegionKey", F.col("RegionCode").alias("parent"))
    above = jn.sized_join(wh["Nation"].select("RegionKey", F.col("NationCode").alias("child")), regions, {"RegionKey": "RegionKey"})
    edges = owned[0].select("child", "parent").unionByName(owned[1].select("child", "parent"))
    return climb_closure(edges.unionByName(above.select("child", "parent")))


# --- scalars -----------------------------------------------------------------------------


@query("fn_date", f"""SELECT o_orderkey, {key_of('o_orderdate')} AS DateKey,
    CAST(o_orderdate - INTERVAL 3 MONTH AS DATE) AS ThreeMonthsBefore, CAST(o_orderdate AS DATE) - 14 AS TwoWeeksBefore,
    CAST(year(o_orderdate) AS INTEGER) AS OrderYear, CAST(o_orderdate AS DATE) AS BackFromKey,
    CAST(last_day(o_orderdate) AS DATE) AS MonthEnd FROM orders""")
def fn_date(spark, folder):
    d = F.col("o_orderdate")
    return read(spark, folder, "orders").select(
        "o_orderkey", date_key(d).alias("DateKey"), F.add_months(d, -3).alias("ThreeMonthsBefore"),
        F.date_sub(d, 14).alias("TwoWeeksBefore"), F.year(d).alias("OrderYear"),
        key_date(date_key(d)).alias("BackFromKey"), F.last_day(d).alias("MonthEnd"),
    )


@query("fn_time", """SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS INTEGER) AS SecondOfDay,
    CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'Night' WHEN hour(ts) < 14 THEN 'Day' ELSE 'Evening' END AS Shift FROM events""")
def fn_time(spark, folder):
    return read(spark, folder, "events").select(
        "event_id", seconds_of_day("ts").alias("SecondOfDay"), shift_name(F.hour("ts")).alias("Shift")
    )


@query("fn_convert", f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS OrderDate, CAST(round(o_totalprice) AS BIGINT) AS WholeAmount,
    {dec('o_totalprice')} AS ExactAmount, CAST({dec('o_totalprice')} AS VARCHAR) AS AmountText, TIMESTAMP '9999-12-31' AS OpenEnd FROM orders""")
def fn_convert(spark, folder):
    return read(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.round("o_totalprice").cast("bigint").alias("WholeAmount"), money("o_totalprice").alias("ExactAmount"),
        money("o_totalprice").cast("string").alias("AmountText"), F.lit("9999-12-31").cast("timestamp_ntz").alias("OpenEnd"),
    )


@query("fn_null", """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS SettledStatus, coalesce(nullif(o_orderstatus, 'P'), 'N/A') AS StatusText FROM orders""")
def fn_null(spark, folder):
    settled = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return read(spark, folder, "orders").select(
        "o_orderkey", settled.alias("SettledStatus"), F.coalesce(settled, F.lit("N/A")).alias("StatusText")
    )


@query("fn_math", f"""SELECT c_custkey, abs({dec('c_acctbal')}) AS Size,
    {quotient(units(dec('c_acctbal')), '(CAST(c_nationkey AS HUGEINT) * 10000)', 18, 4, 100)} AS PercentOfNationKey FROM customer""")
def fn_math(spark, folder):
    return read(spark, folder, "customer").select(
        "c_custkey", F.abs(money("c_acctbal")).alias("Size"),
        ratio(money("c_acctbal"), F.col("c_nationkey"), 18, 4, percent=True).alias("PercentOfNationKey"),
    )


@query("fn_case", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_linestatus = 'O' THEN 'open' ELSE 'done' END AS state FROM lineitem""")
def fn_case(spark, folder):
    state = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_linestatus") == "O", "open").otherwise("done")
    return read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", state.alias("state"))


@query("fn_string", """SELECT p_partkey, concat(p_name, '/', nullif(p_type, 'PROMO')) AS Label, left(p_brand, 5) AS Stem,
    upper(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g')) AS Code, p_name LIKE 'red %' AS IsRed FROM part""")
def fn_string(spark, folder):
    kind = F.nullif(F.col("p_type"), F.lit("PROMO"))
    return read(spark, folder, "part").select(
        "p_partkey", text_or_empty("p_name", F.lit("/"), kind).alias("Label"), F.left("p_brand", F.lit(5)).alias("Stem"),
        clean_label(F.col("p_name")).alias("Code"), F.col("p_name").like("red %").alias("IsRed"),
    )


HASHED = f"concat_ws('|', c_name, coalesce(c_mktsegment, ''), CAST({dec('c_acctbal')} AS VARCHAR))"


@query("fn_hash", f"SELECT c_custkey, sha256({HASHED}) AS Digest, {sql_hash('c_name')} AS HashNumber FROM customer")
def fn_hash(spark, folder):
    rows = trade_warehouse(spark, folder)["Customer"]
    digest = row_hash(rows.schema, ["CustomerNumber", "MarketSegmentName", "AccountBalanceAmount"])
    return rows.select(
        F.col("CustomerKey").alias("c_custkey"), F.lower(F.hex(digest)).alias("Digest"),
        hash_number(F.col("CustomerNumber")).alias("HashNumber"),
    )
