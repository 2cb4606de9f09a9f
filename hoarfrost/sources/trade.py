"""The trade tables bound to warehouse roles.

`trade_warehouse` gives them the shape of a snowflake: regions above nations, nations above
customers and suppliers, parts under brands and types, three facts and a bridge.
`manufacturing_warehouse` gives the same rows the shape the fixed reports read.
All tables are views: a query reads only the columns it needs from the files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import date_key, days_between, seconds_of_day, shift_name
from hoarfrost.model import Column as C
from hoarfrost.model import ForeignKey as FK
from hoarfrost.model import Origin, TableSpec, WarehouseModel
from hoarfrost.operators.filters import RAW_DATE
from hoarfrost.operators.generate import date_dimension, time_dimension
from hoarfrost.operators.joins import sized_join
from hoarfrost.plans.manufacturing import CALENDAR
from hoarfrost.plans.manufacturing import MODEL as MANUFACTURING
from hoarfrost.plans.warehouse import Warehouse

# The trade tables and their columns. Declared, so that opening a table
# reads no file footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Calendar range, and the day the reports look back from.
CALENDAR_START, CALENDAR_END = dt.date(1995, 1, 1), dt.date(2024, 12, 31)
AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# Code lists of the trade tables.
RETURN_FLAGS = (("A", "Accepted", False), ("N", "None", True), ("R", "Returned", True))
LINE_STATUSES = (("F", "Finished"), ("O", "Open"))
PRIORITIES = (
    ("1-URGENT", "Urgent", 5, True),
    ("2-HIGH", "High", 4, True),
    ("3-MEDIUM", "Medium", 3, False),
    ("4-NOT SPECIFIED", "Not specified", 2, False),
    ("5-LOW", "Low", 1, False),
)
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SHIFTS = ("Night", "Day", "Evening")

MODEL = WarehouseModel.of(
    *CALENDAR,
    TableSpec("Region", "dim", (C("RegionName", "nvarchar(120)"),), C("RegionCode", "nvarchar(30)"), hierarchy=True),
    TableSpec(
        "Nation", "dim", (C("NationName", "nvarchar(120)"),), C("NationCode", "nvarchar(30)"), (FK("Region"),),
        hierarchy=True,
    ),
    TableSpec("OrderPriority", "ref",
        (C("OrderPriorityName", "nvarchar(60)"), C("PriorityRank", "tinyint"), C("RequiresEscalation", "bit")),
        C("OrderPriorityCode", "nvarchar(30)")),
    TableSpec("Brand", "dim", (C("BrandName", "nvarchar(60)"),), C("BrandCode", "nvarchar(30)"), hierarchy=True),
    TableSpec("PartType", "dim", (C("PartTypeName", "nvarchar(60)"),), C("PartTypeCode", "nvarchar(30)"), hierarchy=True),
    TableSpec(
        "Customer", "dim",
        (C("MarketSegmentName", "nvarchar(60)"), C("AccountBalanceAmount", "decimal(18,4)")),
        C("CustomerNumber", "nvarchar(40)"), (FK("Nation"),), scd=2, key_type="bigint",
    ),
    TableSpec(
        "Supplier", "dim", (C("AccountBalanceAmount", "decimal(18,4)"),), C("SupplierNumber", "nvarchar(40)"),
        (FK("Nation"),), key_type="bigint",
    ),
    TableSpec(
        "Part", "dim",
        (C("PartName", "nvarchar(60)"), C("SizeNumber", "int"), C("RetailPriceAmount", "decimal(18,4)")),
        C("PartNumber", "nvarchar(40)"), (FK("Brand"), FK("PartType")), key_type="bigint",
    ),
    TableSpec(
        "PartSupplier", "bridge", (C("SupplyCount", "bigint"),),
        foreign_keys=(FK("Part", member=True), FK("Supplier", member=True)),
    ),
    TableSpec(
        "OrderLine", "fact",
        (
            C("OrderNumber", "bigint"), C("LineNumber", "int"), C("ReturnFlagCode", "nvarchar(10)"),
            C("LineStatusCode", "nvarchar(10)"), C("QuantityAmount", "decimal(18,4)", False, "sum"),
            C("ExtendedAmount", "decimal(18,4)", False, "sum"), C("DiscountRate", "decimal(18,4)", False, "avg"),
            C("TaxRate", "decimal(18,4)", False, "max"),
        ),
        foreign_keys=(FK("Part"), FK("Supplier"), FK("Customer")),
        date_roles=("Order", "Ship"),
    ),
    TableSpec(
        "OrderCycle", "fact",
        (C("OrderNumber", "bigint"), C("TotalAmount", "decimal(18,4)", False, "sum"), C("LineCount", "int", False, "sum")),
        foreign_keys=(FK("Customer"), FK("OrderPriority")),
        fact_kind="accumulating", date_roles=("Order", "FirstShip", "LastShip"),
    ),
    TableSpec(
        "CustomerEvent", "fact",
        (C("EventTypeCode", "nvarchar(30)"), C("EventAmount", "decimal(18,4)", False, "sum")),
        foreign_keys=(FK("Customer"),), date_roles=("Event",), time_roles=("Event",),
    ),
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{folder}/{table}.parquet")


#: What is done to source tables before anything is computed from them.
Narrow = dict[str, Callable[[DataFrame], DataFrame]]


def opened(spark: SparkSession, folder: str, only: Narrow | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The trade tables, each opened when first used, some of them narrowed."""
    narrow = only or {}
    return {name: cache(lambda name=name: narrow.get(name, lambda df: df)(read(spark, folder, name))) for name in TABLES}


def money(c: str) -> Column:
    """A stored double as an exact amount, before any arithmetic on it."""
    return F.col(c).cast("decimal(18,4)")


def inline(spark: SparkSession, columns: str, rows) -> DataFrame:
    """A lookup with curated rows."""
    def text(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return "NULL" if v is None else str(v)

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def code_key(c: Column, codes: tuple[str, ...]) -> Column:
    """Position of a code in its list, from 1; -1 for any other."""
    key = F.lit(-1)
    for n, code in enumerate(codes, 1):
        key = F.when(c == code, n).otherwise(key)
    return key.cast("int")


#: Keys of the trade tables that are computed from a date of the table whose rows they are keys of.
ORIGINS = {
    ("OrderLine", "ShipDateKey"): Origin("lineitem", "l_shipdate"),
    ("OrderLine", "BatchId"): Origin("lineitem", "l_shipdate", "month"),
    ("OrderCycle", "OrderDateKey"): Origin("orders", "o_orderdate"),
    ("OrderCycle", "BatchId"): Origin("orders", "o_orderdate", "month"),
    ("CustomerEvent", "EventDateKey"): Origin("events", "ts"),
    ("CustomerEvent", "BatchId"): Origin("events", "ts", "month"),
}


def trade_warehouse(spark: SparkSession, folder: str, only: Narrow | None = None) -> Warehouse:
    t = opened(spark, folder, only)

    def shipped() -> DataFrame:
        """Lines of the orders that are wanted, before they are put together by order."""
        lines, wanted = t["lineitem"](), t["orders"]().select(F.col("o_orderkey").alias("__wanted"))
        return lines.join(wanted, F.col("l_orderkey") == F.col("__wanted"), "left_semi") if only and "orders" in only else lines

    def part() -> DataFrame:
        return t["part"]().select(
            F.col("p_partkey").alias("PartKey"),
            F.concat(F.lit("Part#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("PartNumber"),
            brand_key(F.col("p_brand")).alias("BrandKey"),
            code_key(F.col("p_type"), PART_TYPES).alias("PartTypeKey"),
            F.col("p_name").alias("PartName"),
            F.col("p_size").alias("SizeNumber"),
            money("p_retailprice").alias("RetailPriceAmount"),
        )

    def order_line() -> DataFrame:
        orders = t["orders"]().select(
            "o_orderkey", F.col("o_custkey").alias("CustomerKey"), date_key("o_orderdate").alias("OrderDateKey")
        )
        lines = t["lineitem"]().select(
            F.col("l_orderkey").alias("OrderNumber"),
            F.col("l_linenumber").alias("LineNumber"),
            F.col("l_partkey").alias("PartKey"),
            F.col("l_suppkey").alias("SupplierKey"),
            date_key("l_shipdate").alias("ShipDateKey"),
            F.col("l_returnflag").alias("ReturnFlagCode"),
            F.col("l_linestatus").alias("LineStatusCode"),
            money("l_quantity").alias("QuantityAmount"),
            money("l_extendedprice").alias("ExtendedAmount"),
            money("l_discount").alias("DiscountRate"),
            money("l_tax").alias("TaxRate"),
            ship_month("l_shipdate").alias("BatchId"),
        )
        # Two tables that grow together: beyond the limit this is a shuffle join on the order,
        # and an order that holds a large part of the lines is cut into pieces.
        return sized_join(lines, orders, {"OrderNumber": "o_orderkey"}, "left")

    def order_cycle() -> DataFrame:
        ships = shipped().groupBy("l_orderkey").agg(
            F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.count("*").alias("n")
        )
        orders = t["orders"]()
        joined = orders.join(ships, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        cycle = joined.select(
            F.col("o_orderkey").alias("OrderNumber"),
            F.col("o_custkey").alias("CustomerKey"),
            code_key(F.col("o_orderpriority"), tuple(p[0] for p in PRIORITIES)).alias("OrderPriorityKey"),
            date_key("o_orderdate").alias("OrderDateKey"),
            F.coalesce(date_key("first"), F.lit(-1)).alias("FirstShipDateKey"),
            F.coalesce(date_key("last"), F.lit(-1)).alias("LastShipDateKey"),
            money("o_totalprice").alias("TotalAmount"),
            F.coalesce("n", F.lit(0)).cast("int").alias("LineCount"),
            ship_month("o_orderdate").alias("BatchId"),
        )
        return cycle.withColumn("OrderCycleLagDays", days_between("OrderDateKey", "LastShipDateKey"))

    return Warehouse(
        spark,
        MODEL,
        {
            "Date": lambda: date_dimension(spark, CALENDAR_START, CALENDAR_END, AS_OF),
            "TimeOfDay": lambda: time_dimension(spark),
            "Region": lambda: t["region"]().select(
                F.col("r_regionkey").alias("RegionKey"), F.col("r_name").alias("RegionCode"), F.col("r_name").alias("RegionName")
            ),
            "Nation": lambda: t["nation"]().select(
                F.col("n_nationkey").alias("NationKey"), F.col("n_name").alias("NationCode"),
                F.col("n_regionkey").alias("RegionKey"), F.col("n_name").alias("NationName"),
            ),
            "OrderPriority": lambda: inline(
                spark,
                "OrderPriorityKey, OrderPriorityCode, OrderPriorityName, PriorityRank, RequiresEscalation",
                [(n, *p) for n, p in enumerate(PRIORITIES, 1)],
            ),
            "Brand": lambda: t["part"]().select(
                brand_key(F.col("p_brand")).alias("BrandKey"), F.col("p_brand").alias("BrandCode"),
                F.col("p_brand").alias("BrandName"),
            ).distinct(),
            "PartType": lambda: inline(
                spark, "PartTypeKey, PartTypeCode, PartTypeName", [(n, c, c.title()) for n, c in enumerate(PART_TYPES, 1)]
            ),
            "Customer": lambda: t["customer"]().select(
                F.col("c_custkey").alias("CustomerKey"), F.col("c_name").alias("CustomerNumber"),
                F.col("c_nationkey").alias("NationKey"), F.col("c_mktsegment").alias("MarketSegmentName"),
                money("c_acctbal").alias("AccountBalanceAmount"),
            ),
            "Supplier": lambda: t["supplier"]().select(
                F.col("s_suppkey").alias("SupplierKey"), F.col("s_name").alias("SupplierNumber"),
                F.col("s_nationkey").alias("NationKey"), money("s_acctbal").alias("AccountBalanceAmount"),
            ),
            "Part": part,
            "PartSupplier": lambda: t["lineitem"]().groupBy(
                F.col("l_partkey").alias("PartKey"), F.col("l_suppkey").alias("SupplierKey")
            ).agg(F.count("*").alias("SupplyCount")),
            "OrderLine": order_line,
            "OrderCycle": order_cycle,
            "CustomerEvent": lambda: t["events"]().select(
                F.col("user_id").alias("CustomerKey"), date_key("ts").alias("EventDateKey"),
                event_minute("ts").alias("EventTimeOfDayKey"), F.col("event_type").alias("EventTypeCode"),
                money("value").alias("EventAmount"), ship_month("ts").alias("BatchId"),
            ),
        },
        ORIGINS,
        lambda narrow: trade_warehouse(spark, folder, narrow),
    )


def brand_key(code: Column) -> Column:
    return F.regexp_extract(code, "([0-9]+)", 1).cast("int")


def ship_month(c: str) -> Column:
    """The batch a row came with: the month of its date."""
    return (F.year(c) * 100 + F.month(c)).cast("bigint")


def event_minute(c: str) -> Column:
    second = seconds_of_day(c)
    return (second - second % 60).cast("int")


def manufacturing_warehouse(spark: SparkSession, folder: str, only: Narrow | None = None) -> Warehouse:
    """Nations stand for plants and work centers, suppliers for machines, parts for products
    under their sizes, line items for machine, quality and cost rows, orders for incidents,
    events for confirmations."""
    t = opened(spark, folder, only)
    flags = tuple(f[0] for f in RETURN_FLAGS)

    def with_plant(lines: DataFrame) -> DataFrame:
        plants = t["supplier"]().select("s_suppkey", F.col("s_nationkey").alias("PlantKey"))
        return sized_join(lines, plants, {"MachineKey": "s_suppkey"})

    def lines(date_role: str, *extra: Column) -> DataFrame:
        return t["lineitem"]().select(
            F.col("l_suppkey").alias("MachineKey"),
            F.col("l_partkey").alias("ProductKey"),
            date_key("l_shipdate").alias(f"{date_role}DateKey"),
            F.col("l_shipdate").alias(f"{date_role}DateKey{RAW_DATE}"),
            *extra,
        )

    event_measures = (
        F.col("l_linenumber").alias("EventCount"),
        money("l_quantity").alias("QuantityAmount"),
        (money("l_tax") * 100).cast("decimal(18,4)").alias("DurationMinutes"),
        F.col("l_extendedprice").cast("decimal(19,4)").alias("CostAmount"),
    )
    flag_key = code_key(F.col("l_returnflag"), flags)

    def incidents() -> DataFrame:
        shipped = t["lineitem"]()
        if only and "orders" in only:  # only lines of the wanted orders are put together
            shipped = shipped.join(t["orders"]().select(F.col("o_orderkey").alias("__wanted")), F.col("l_orderkey") == F.col("__wanted"), "left_semi")
        ships = shipped.groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("last"), F.count("*").alias("n"), F.sum(money("l_quantity")).alias("q")
        )
        orders = sized_join(
            t["orders"]().withColumn("__customer", F.col("o_custkey")),
            t["customer"]().select("c_custkey", F.col("c_nationkey").alias("PlantKey")),
            {"__customer": "c_custkey"},
        )
        return orders.join(ships, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            "PlantKey",
            date_key("o_orderdate").alias("OccurredDateKey"),
            F.col("o_orderdate").alias(f"OccurredDateKey{RAW_DATE}"),
            code_key(F.col("o_orderpriority"), tuple(p[0] for p in PRIORITIES)).alias("SeverityKey"),
            F.coalesce("n", F.lit(0)).cast("int").alias("InjuredPersonCount"),
            F.coalesce("q", F.lit(0)).cast("decimal(18,4)").alias("LostWorkdayCount"),
            F.col("o_totalprice").cast("decimal(19,4)").alias("EstimatedCostAmount"),
            F.datediff("last", "o_orderdate").alias("SafetyIncidentLagDays"),
        )

    def variances() -> DataFrame:
        price = money("l_extendedprice")
        actual = (price * (F.lit(1).cast("decimal(1,0)") - money("l_discount"))).cast("decimal(19,4)")
        return with_plant(
            lines(
                "Posting",
                flag_key.alias("FinanceVarianceTypeKey"),
                price.cast("decimal(19,4)").alias("StandardAmount"),
                actual.alias("ActualAmount"),
                (actual - price).cast("decimal(19,4)").alias("VarianceAmount"),
            )
        )

    def confirmations() -> DataFrame:
        events = sized_join(
            t["events"]().withColumn("__user", F.col("user_id")),
            t["customer"]().select("c_custkey", F.col("c_nationkey").alias("WorkCenterKey")),
            {"__user": "c_custkey"},
        )
        return events.select(
            "WorkCenterKey",
            date_key("ts").alias("ConfirmationDateKey"),
            F.col("ts").alias(f"ConfirmationDateKey{RAW_DATE}"),
            code_key(shift_name(F.hour("ts")), SHIFTS).alias("ProductionShiftKey"),
            F.col("event_id").alias("ProductionWorkOrderKey"),
            F.col("user_id").alias("OperatorEmployeeKey"),
            F.lit(1).alias("EventCount"),
            money("value").alias("QuantityAmount"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("decimal(18,4)").alias("DurationMinutes"),
            F.col("value").cast("decimal(19,4)").alias("CostAmount"),
        )

    @cache
    def sizes() -> DataFrame:
        return t["part"]().select(F.col("p_size").alias("size")).distinct()

    family = F.floor((F.col("size") - 1) / 10).cast("int") + 1
    line = F.when(family <= 2, 1).otherwise(2)
    division = F.when(F.col("size") <= 50, 1).otherwise(2)

    def level(name: str, key: Column, code: Column, above: str | None = None, up: Column | None = None) -> DataFrame:
        pointer = [up.cast("int").alias(f"{above}Key")] if above else []
        cols = [key.cast("int").alias(f"{name}Key"), code.alias(f"{name}Code"), code.alias(f"{name}Name"), *pointer]
        return sizes().select(*cols).distinct()

    def nation(role: str) -> DataFrame:
        return t["nation"]().select(
            F.col("n_nationkey").alias(f"{role}Key"), F.col("n_name").alias(f"{role}Code"), F.col("n_name").alias(f"{role}Name")
        )

    return Warehouse(
        spark,
        MANUFACTURING,
        {
            "Date": lambda: date_dimension(spark, CALENDAR_START, CALENDAR_END, AS_OF),
            "TimeOfDay": lambda: time_dimension(spark),
            "Plant": lambda: nation("Plant"),
            "WorkCenter": lambda: nation("WorkCenter"),
            "Machine": lambda: t["supplier"]().select(
                F.col("s_suppkey").alias("MachineKey"), F.col("s_name").alias("MachineNumber"),
                F.col("s_name").alias("MachineName"), F.col("s_nationkey").alias("PlantKey"),
            ),
            "MachineState": lambda: inline(
                spark, "MachineStateKey, MachineStateCode, MachineStateName", [(n, *s) for n, s in enumerate(LINE_STATUSES, 1)]
            ),
            "MachineStateType": lambda: inline(
                spark, "MachineStateTypeKey, StateTypeCode, StateTypeName",
                [(n, c, name) for n, (c, name, _) in enumerate(RETURN_FLAGS, 1)],
            ),
            "QualityResultStatus": lambda: inline(
                spark, "QualityResultStatusKey, ResultStatusCode, ResultStatusName",
                [(n, c, name) for n, (c, name, _) in enumerate(RETURN_FLAGS, 1)],
            ),
            "FinanceVarianceType": lambda: inline(
                spark, "FinanceVarianceTypeKey, VarianceTypeCode, VarianceTypeName, IsManufacturingVariance",
                [(n, *f) for n, f in enumerate(RETURN_FLAGS, 1)],
            ),
            "Severity": lambda: inline(
                spark, "SeverityKey, SeverityCode, SeverityName, SeverityRank, RequiresEscalation",
                [(n, *p) for n, p in enumerate(PRIORITIES, 1)],
            ),
            "ProductionShift": lambda: inline(
                spark, "ProductionShiftKey, ProductionShiftCode, ProductionShiftName",
                [(n, s.upper(), s) for n, s in enumerate(SHIFTS, 1)],
            ),
            "Product": lambda: t["part"]().select(
                F.col("p_partkey").alias("ProductKey"), F.col("p_name").alias("ProductName"),
                F.col("p_size").alias("ProductSubfamilyKey"),
            ),
            "ProductSubfamily": lambda: level(
                "ProductSubfamily", F.col("size"), F.concat(F.lit("SIZE-"), F.col("size").cast("string")), "ProductFamily", family
            ),
            "ProductFamily": lambda: level(
                "ProductFamily", family, F.concat(F.lit("BAND-"), family.cast("string")), "ProductLine", line
            ),
            "ProductLine": lambda: level(
                "ProductLine", line, F.when(family <= 2, "COMPACT").otherwise("BULK"), "ProductDivision", division
            ),
            "ProductDivision": lambda: level(
                "ProductDivision", division, F.when(division == 1, "PARTS").otherwise("OVERSIZE")
            ),
            "OeePeriodicSnapshot": lambda: with_plant(lines("Snapshot", *event_measures)),
            "QualityInspectionResult": lambda: lines(
                "Inspection", flag_key.alias("QualityResultStatusKey"), *event_measures
            ),
            "MachineStateEvent": lambda: with_plant(
                lines(
                    "Start",
                    code_key(F.col("l_linestatus"), tuple(s[0] for s in LINE_STATUSES)).alias("MachineStateKey"),
                    flag_key.alias("MachineStateTypeKey"),
                    *event_measures,
                )
            ),
            "SafetyIncident": incidents,
            "FinanceManufacturingVariance": variances,
            "ProductionOperationConfirmation": confirmations,
        },
        {("SafetyIncident", "OccurredDateKey"): Origin("orders", "o_orderdate")},
        lambda narrow: manufacturing_warehouse(spark, folder, narrow),
    )


def _before(df: DataFrame, column: str, day: dt.date | None) -> DataFrame:
    return df if day is None else df.filter(F.col(column) < F.lit(day.isoformat()).cast("timestamp_ntz"))


def customer_stage(spark: SparkSession, folder: str, until: dt.date | None, batch_id: int) -> DataFrame:
    """Customers as a source system knows them, with their largest order so far as their
    balance: on a day, those who have ordered before it; without a day, all of them."""
    largest = (
        _before(read(spark, folder, "orders"), "o_orderdate", until)
        .groupBy("o_custkey")
        .agg(F.max(money("o_totalprice")).alias("largest"))
    )
    nations = read(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("NationNationCode"))
    known = F.col("c_custkey") == F.col("o_custkey")
    customers = read(spark, folder, "customer").join(largest, known, "left" if until is None else "inner")
    return sized_join(customers, nations, {"c_nationkey": "n_nationkey"}).select(
        F.col("c_name").alias("CustomerNumber"),
        F.col("c_mktsegment").alias("MarketSegmentName"),
        F.coalesce("largest", F.lit(0)).cast("decimal(18,4)").alias("AccountBalanceAmount"),
        "NationNationCode",
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        (F.col("c_custkey") + 1).alias("RowNumber"),
    )


def supplier_stage(spark: SparkSession, folder: str, until: dt.date | None, batch_id: int) -> DataFrame:
    """Suppliers with the value shipped as their balance: on a day, those who have shipped
    before it; without a day, all of them."""
    shipped = (
        _before(read(spark, folder, "lineitem"), "l_shipdate", until)
        .groupBy("l_suppkey")
        .agg(F.sum(money("l_extendedprice")).alias("shipped"))
    )
    nations = read(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("NationNationCode"))
    known = F.col("s_suppkey") == F.col("l_suppkey")
    suppliers = read(spark, folder, "supplier").join(shipped, known, "left" if until is None else "inner")
    return sized_join(suppliers, nations, {"s_nationkey": "n_nationkey"}).select(
        F.col("s_name").alias("SupplierNumber"),
        F.coalesce("shipped", F.lit(0)).cast("decimal(18,4)").alias("AccountBalanceAmount"),
        "NationNationCode",
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        (F.col("s_suppkey") + 1).alias("RowNumber"),
    )


def order_stage(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """All orders as staged rows of the order cycle. A pending order names no customer."""
    wh = trade_warehouse(spark, folder)
    names = wh["Customer"].select(F.col("CustomerKey").alias("__c"), "CustomerNumber")
    cycle = sized_join(wh["OrderCycle"], names, {"CustomerKey": "__c"}, "left")
    priorities = wh["OrderPriority"].select("OrderPriorityKey", "OrderPriorityCode")
    cycle = sized_join(cycle, priorities, {"OrderPriorityKey": "OrderPriorityKey"}, "left")
    status = read(spark, folder, "orders").select(F.col("o_orderkey").alias("__o"), "o_orderstatus")
    cycle = cycle.join(status, F.col("OrderNumber") == F.col("__o"))
    return cycle.select(
        "OrderNumber", "TotalAmount", "LineCount", "OrderDateKey", "FirstShipDateKey", "LastShipDateKey",
        F.when(F.col("o_orderstatus") != "P", F.col("CustomerNumber")).alias("CustomerCustomerNumber"),
        F.col("OrderPriorityCode").alias("OrderPriorityOrderPriorityCode"),
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        (F.col("OrderNumber") + 1).alias("RowNumber"),
    )


def event_stage(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """All events as staged rows, with the customer by number."""
    wh = trade_warehouse(spark, folder)
    names = wh["Customer"].select("CustomerKey", F.col("CustomerNumber").alias("CustomerCustomerNumber"))
    events = sized_join(read(spark, folder, "events"), names, {"user_id": "CustomerKey"}, "left")
    return events.select(
        F.col("event_type").alias("EventTypeCode"),
        money("value").alias("EventAmount"),
        date_key("ts").alias("EventDateKey"),
        event_minute("ts").alias("EventTimeOfDayKey"),
        "CustomerCustomerNumber",
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        (F.col("event_id") + 1).alias("RowNumber"),
    )
