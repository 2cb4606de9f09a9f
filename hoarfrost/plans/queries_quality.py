"""Quality checks, control tables, flattened views and ad-hoc rollups."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoarfrost.model import Column
from hoarfrost.operators import joins as jn
from hoarfrost.operators import quality as dq
from hoarfrost.operators.aggregates import row_counts
from hoarfrost.operators.control import above_watermark, append_control, latest_watermarks, load_increment, purge, read_control, upsert_watermarks
from hoarfrost.operators.flatten import flatten, flatten_all
from hoarfrost.operators.keys import with_unknown
from hoarfrost.operators.rollup import Attribute, DateWindow, distinct_profile, rollup, top_by_measure
from hoarfrost.plans.check_sql import average, bucket, dec, total
from hoarfrost.plans.queries_loads import MERGED, _customer_merge, _customer_rows
from hoarfrost.plans.queries_relational import CYCLES, LINES
from hoarfrost.plans.registry import query
from hoarfrost.plans.states import CUSTOMERS_AT, FIRST, customer_dim
from hoarfrost.session import scratch
from hoarfrost.sources import tables
from hoarfrost.sources.trade import AS_OF, MODEL, TABLES, inline, money, read, trade_warehouse

CHECKED_AT = "2001-08-01"


def _at():
    return F.lit(CHECKED_AT).cast("timestamp_ntz")


def _check(rule: str, table: str, failed: str, source: str, checked: str = "count(*)") -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS \"table\", {checked} AS checked, "
        f"CAST(coalesce({failed}, 0) AS BIGINT) AS failed FROM {source}"
    )


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- quality -----------------------------------------------------------------------------


def _faulty_cycles(spark, folder) -> DataFrame:
    """Order cycles as they are before defaults: a pending order has no customer key yet."""
    cycles = trade_warehouse(spark, folder)["OrderCycle"]
    status = read(spark, folder, "orders").select(F.col("o_orderkey").alias("__o"), "o_orderstatus")
    joined = cycles.join(status, F.col("OrderNumber") == F.col("__o"))
    return joined.withColumn("CustomerKey", F.when(F.col("o_orderstatus") != "P", F.col("CustomerKey"))).drop(
        "__o", "o_orderstatus"
    )


FAULTY = f"(SELECT cycles.* REPLACE (CASE WHEN o_orderstatus <> 'P' THEN CustomerKey END AS CustomerKey) FROM {CYCLES} JOIN orders ON o_orderkey = OrderNumber) f"
ROW_COUNTS = _union(*[f"SELECT 'Row count' AS rule, 'raw.{t}' AS \"table\", count(*) AS checked, CAST(0 AS BIGINT) AS failed FROM {t}" for t in TABLES])


@query("dq_row_count", ROW_COUNTS)
def dq_row_count(spark, folder):
    return _all([dq.one_pass(read(spark, folder, t), f"raw.{t}", dq.row_count_rule()) for t in TABLES])


CYCLE_KEYS = ("CustomerKey", "OrderPriorityKey", "OrderDateKey", "FirstShipDateKey", "LastShipDateKey")
NULL_KEYS = _union(*[_check(f"Null key {k}", "fact.OrderCycle", f"count(*) FILTER (WHERE {k} IS NULL)", FAULTY) for k in CYCLE_KEYS])


@query("dq_null_key", NULL_KEYS)
def dq_null_key(spark, folder):
    faulty = _faulty_cycles(spark, folder)
    return dq.one_pass(faulty, "fact.OrderCycle", dq.null_key_rules(faulty, "OrderCycleKey"))


@query("dq_fact_fk_filled", NULL_KEYS.replace("Null key", "Unfilled key"))
def dq_fact_fk_filled(spark, folder):
    faulty = _faulty_cycles(spark, folder)
    return dq.one_pass(faulty, "fact.OrderCycle", dq.fact_key_filled_rules(faulty, MODEL["OrderCycle"]))


LEDGER = f"(SELECT c_custkey, {dec('c_acctbal')} AS AccountBalanceAmount FROM customer) l"


@query("dq_negative", _union(
    _check("Negative measure AccountBalanceAmount", "fact.Ledger", "count(*) FILTER (WHERE AccountBalanceAmount < 0)", LEDGER),
    _check("Negative measure TotalAmount", "fact.OrderCycle", "count(*) FILTER (WHERE TotalAmount < 0)", CYCLES),
))
def dq_negative(spark, folder):
    wh = trade_warehouse(spark, folder)
    return _all(
        [
            dq.one_pass(df, name, dq.negative_rules(df))
            for name, df in (("fact.Ledger", wh["Customer"]), ("fact.OrderCycle", wh["OrderCycle"]))
        ]
    )


CUSTOMER_KEYS = f"(SELECT CustomerKey FROM ({CUSTOMERS_AT(FIRST)}) x)"


@query("dq_orphan_fk", _union(
    _check("Orphan FK CustomerKey", "fact.OrderCycle", f"count(*) FILTER (WHERE CustomerKey + 1 NOT IN {CUSTOMER_KEYS})", CYCLES),
    _check("Orphan FK OrderPriorityKey", "fact.OrderCycle", "count(*) FILTER (WHERE OrderPriorityKey <> -1 AND OrderPriorityKey NOT BETWEEN 1 AND 5)", CYCLES),
    _check("Orphan FK LastShipDateKey", "fact.OrderCycle", "count(*) FILTER (WHERE LastShipDateKey <> -1 AND LastShipDateKey NOT BETWEEN 19950101 AND 20241231)", CYCLES),
))
def dq_orphan_fk(spark, folder):
    wh = trade_warehouse(spark, folder)
    # Against the customers of an early day, those who came later are missing.
    cycles = wh["OrderCycle"].withColumn("CustomerKey", F.col("CustomerKey") + 1)
    parents = {
        "CustomerKey": (customer_dim(spark, folder), "CustomerKey"),
        "OrderPriorityKey": (wh["OrderPriority"], "OrderPriorityKey"),
        "LastShipDateKey": (wh["Date"], "DateKey"),
    }
    return dq.orphan_checks(cycles, "fact.OrderCycle", parents)


FKS = _union(
    _check("Orphan FK NationKey", "dim.Customer", "count(*) FILTER (WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation))", "customer"),
    _check("Orphan FK NationKey", "dim.Supplier", "count(*) FILTER (WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation))", "supplier"),
    _check("Orphan FK RegionKey", "dim.Nation", "count(*) FILTER (WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region))", "nation"),
    _check("Orphan FK BrandKey", "dim.Part", "0", "part"),
    _check("Orphan FK PartTypeKey", "dim.Part", "count(*) FILTER (WHERE p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'))", "part"),
    _check("Orphan FK PartKey", "bridge.PartSupplier", "count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part))", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) b"),
    _check("Orphan FK SupplierKey", "bridge.PartSupplier", "count(*) FILTER (WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) b"),
    *[_check(f"Orphan FK {k}", "fact.OrderLine", "0", LINES) for k in ("PartKey", "SupplierKey", "CustomerKey", "OrderDateKey", "ShipDateKey")],
    # Without the exemption, the unknown key fails while the calendar has no unknown member.
    *[_check(f"Orphan FK {k}", "fact.OrderCycle", f"count(*) FILTER (WHERE {k} = -1)", CYCLES) for k in CYCLE_KEYS],
    *[_check(f"Orphan FK {k}", "fact.CustomerEvent", "0", "events") for k in ("CustomerKey", "EventDateKey", "EventTimeOfDayKey")],
)


@query("dq_fk_revalidate", FKS)
def dq_fk_revalidate(spark, folder):
    wh = trade_warehouse(spark, folder)
    return dq.foreign_key_checks(MODEL, wh, ("ref", "dim", "bridge", "fact"), exempt_unknown=False)


def _dups(rule: str, table: str, keys: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS \"table\", CAST(sum(n) AS BIGINT) AS checked, "
        f"CAST(sum(n - 1) AS BIGINT) AS failed FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY ALL) g"
    )


KEYED = {"Customer": "customer:c_custkey", "Supplier": "supplier:s_suppkey", "Part": "part:p_partkey", "Nation": "nation:n_nationkey", "Region": "region:r_regionkey"}


@query("dq_pk_unique", _union(
    *[_dups(f"Primary key {t}Key", f"dim.{t}", src.split(":")[1], src.split(":")[0]) for t, src in KEYED.items()],
    _dups("Primary key OrderLineKey", "fact.OrderLine", "l_orderkey, l_linenumber", "lineitem"),
))
def dq_pk_unique(spark, folder):
    wh = trade_warehouse(spark, folder)
    checks = [dq.primary_key_unique(wh[t], MODEL[t]) for t in KEYED]
    # Order and line number look like the key of a line, and are not.
    lines = read(spark, folder, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("OrderLineKey"))
    return _all([*checks, dq.primary_key_unique(lines, MODEL["OrderLine"])])


@query("dq_bk_unique", _union(
    _dups("Business key CustomerNumber", "dim.Customer", "CustomerNumber", f"(SELECT * FROM ({MERGED}) x WHERE IsCurrent) m"),
    _dups("Business key PartName", "dim.Part", "p_name", "part"),
))
def dq_bk_unique(spark, folder):
    by_name = replace(MODEL["Part"], business_key=Column("PartName", "nvarchar(60)"))
    customers = _customer_merge(spark, folder).table
    return dq.business_key_unique(customers, MODEL["Customer"]).unionByName(
        dq.business_key_unique(trade_warehouse(spark, folder)["Part"], by_name)
    )


@query("dq_member_unique", _union(
    _dups("Unique members", "bridge.PartSupplier", "l_partkey, l_suppkey", "lineitem"),
    _dups("Unique members", "bridge.PartSupplier", "l_partkey, l_suppkey", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) b"),
))
def dq_member_unique(spark, folder):
    raw = read(spark, folder, "lineitem").select(F.col("l_partkey").alias("PartKey"), F.col("l_suppkey").alias("SupplierKey"))
    built = trade_warehouse(spark, folder)["PartSupplier"]
    spec = MODEL["PartSupplier"]
    return dq.members_unique(raw, spec).unionByName(dq.members_unique(built, spec))


@query("dq_unknown_member", _union(
    "SELECT 'Unknown member' AS rule, 'dim.Customer' AS \"table\", count(*) + 1 AS checked, CAST(0 AS BIGINT) AS failed FROM customer",
    "SELECT 'Unknown member', 'dim.Supplier', count(*), CAST(1 AS BIGINT) FROM supplier",
))
def dq_unknown_member(spark, folder):
    wh = trade_warehouse(spark, folder)
    complete = dq.unknown_member_present(with_unknown(wh["Customer"], MODEL["Customer"]), MODEL["Customer"])
    return complete.unionByName(dq.unknown_member_present(wh["Supplier"], MODEL["Supplier"]))


@query("dq_empty_tables", """SELECT 'raw' AS schema_name, 'cancelled' AS table_name, CAST(0 AS BIGINT) AS row_count
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'C')""")
def dq_empty_tables(spark, folder):
    found = {t: read(spark, folder, t) for t in TABLES}
    found["cancelled"] = found["orders"].filter("o_orderstatus = 'C'")
    return dq.empty_tables(row_counts(found))


@query("dq_text_length", _union(
    _check("Text length PartNumber", "dim.Part", "0", "part"),
    _check("Text length PartName", "dim.Part", "count(*) FILTER (WHERE length(p_name) > 10)", "part"),
))
def dq_text_length(spark, folder):
    spec = replace(MODEL["Part"], columns=(Column("PartName", "nvarchar(10)"), *MODEL["Part"].columns[1:]))
    parts = trade_warehouse(spark, folder)["Part"]
    return dq.one_pass(parts, "dim.Part", dq.text_length_rules(parts, spec))


USER_RULES = (
    dq.Rule("Shipped before ordered", "fact.OrderLine", "ShipDateKey < OrderDateKey"),
    dq.Rule("Discount above ten percent", "fact.OrderLine", "DiscountRate > 0.1"),
    dq.Rule("Switched off", "fact.OrderLine", "true", active=False),
)


@query("ud_dq_rule", _union(
    _check("Shipped before ordered", "fact.OrderLine", "count(*) FILTER (WHERE ShipDateKey < OrderDateKey)", LINES),
    _check("Discount above ten percent", "fact.OrderLine", "count(*) FILTER (WHERE DiscountRate > 0.1)", LINES),
))
def ud_dq_rule(spark, folder):
    lines = trade_warehouse(spark, folder)["OrderLine"]
    return dq.one_pass(lines, "fact.OrderLine", dq.user_rules(list(USER_RULES), "fact.OrderLine"))


def _code_sql(text: str) -> str:
    code = f"upper(trim(regexp_replace({text}, '[^A-Za-z0-9]+', '_', 'g'), '_'))"
    return f"CASE WHEN length({code}) > 50 THEN left({code}, 41) || '_' || upper({bucket(code, 8)}) ELSE {code} END"


PROFILED = [("Row count", "false")] + [(f"Null key {k}", f"{k} IS NULL") for k in CYCLE_KEYS] + [
    ("Negative measure TotalAmount", "TotalAmount < 0"),
    ("More than five lines in an order that took over two hundred days", "LineCount > 5 AND OrderCycleLagDays > 200"),
]
PROFILE = _union(*[_check(rule, "fact.OrderCycle", f"count(*) FILTER (WHERE {cond})", FAULTY) for rule, cond in PROFILED])


def _profile(spark, folder):
    slow = dq.Rule(PROFILED[-1][0], "fact.OrderCycle", PROFILED[-1][1])
    return dq.profile(_faulty_cycles(spark, folder), MODEL["OrderCycle"], [slow])


@query("dq_result", f"""SELECT CAST(9 AS BIGINT) AS batch_id, {_code_sql("rule || '_' || \"table\"")} AS rule_code, rule, "table", checked,
    failed, CASE WHEN failed = 0 THEN 'Pass' ELSE 'Fail' END AS status, TIMESTAMP '{CHECKED_AT}' AS checked_at FROM ({PROFILE}) p""")
def dq_result(spark, folder):
    return dq.results(_profile(spark, folder), 9, _at())


@query("dq_rule_registry", f"""SELECT {_code_sql("rule || '_' || \"table\"")} AS RuleCode, rule AS RuleName, "table" AS TargetTableName,
    rule || ' on ' || "table" AS RuleExpression, true AS IsActive FROM ({PROFILE}) p WHERE rule <> 'Row count'""")
def dq_rule_registry(spark, folder):
    known = inline(spark, "RuleCode", [("ROW_COUNT_FACT_ORDERCYCLE",)])
    return dq.new_rules(known, _profile(spark, folder))


@query("dq_snowflake_depth", _union(
    *[f"SELECT '{t}' AS table_name, {d} AS depth, count(*) AS row_count FROM {s}"
      for t, d, s in (("Customer", 2, "customer"), ("Supplier", 2, "supplier"), ("Nation", 1, "nation"), ("Part", 1, "part"))]
))
def dq_snowflake_depth(spark, folder):
    wh = trade_warehouse(spark, folder)
    depths = dq.snowflake_depth(dq.catalog_edges(spark, MODEL))
    sizes = row_counts({t: wh[t] for t in ("Customer", "Supplier", "Nation", "Part", "Region")})
    return depths.join(sizes.drop("schema_name"), "table_name")


# --- flattened views ---------------------------------------------------------------------


@query("vw_flatten", f"""SELECT CAST(CustomerKey AS BIGINT) AS CustomerKey, c.CustomerNumber, c.NationKey, c.MarketSegmentName, c.AccountBalanceAmount,
    c.BatchId, c.EffectiveFromUtc, c.EffectiveToUtc, c.IsCurrent, c.RowHash, n_name AS Nation_NationCode, n_name AS Nation_NationName,
    r_name AS Nation_Region_RegionCode, r_name AS Nation_Region_RegionName
  FROM ({MERGED}) c LEFT JOIN nation ON n_nationkey = c.NationKey LEFT JOIN region ON r_regionkey = n_regionkey""")
def vw_flatten(spark, folder):
    wh = trade_warehouse(spark, folder)
    merged = _customer_rows(_customer_merge(spark, folder).table)
    return flatten(MODEL, {"Customer": merged, "Nation": wh["Nation"], "Region": wh["Region"]}, "Customer")


@query("vw_all", """SELECT 'vwDimCustomer' AS view_name, count(*) AS row_count, 9 AS column_count, count(DISTINCT n_regionkey) AS regions
    FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL SELECT 'vwDimSupplier', count(*), 8, count(DISTINCT n_regionkey) FROM supplier JOIN nation ON n_nationkey = s_nationkey
  UNION ALL SELECT 'vwDimPart', count(*), 11, 0 FROM part""")
def vw_all(spark, folder):
    wh = trade_warehouse(spark, folder)
    names = [n for n in wh if n not in ("Date", "TimeOfDay")]
    made = flatten_all(MODEL, {n: wh[n] for n in names}, spark)
    parts = []
    for name in made:
        view = spark.table(name)
        regions = F.countDistinct("Nation_Region_RegionName") if "Nation_Region_RegionName" in view.columns else F.lit(0).cast("bigint")
        parts.append(
            view.agg(F.count("*").alias("row_count"), regions.alias("regions")).select(
                F.lit(name).alias("view_name"), "row_count", F.lit(len(view.columns)).alias("column_count"), "regions"
            )
        )
    return _all(parts)


# --- ad-hoc rollups ----------------------------------------------------------------------

REGION = Attribute("CustomerKey", "RegionName", ("Nation", "Region"))
BRAND = Attribute("PartKey", "BrandName", ("Brand",))
NATION = Attribute("SupplierKey", "NationName", ("Nation",))
ROLLED = f"""FROM {LINES} JOIN customer ON c_custkey = CustomerKey JOIN nation cn ON cn.n_nationkey = c_nationkey
  JOIN region ON r_regionkey = cn.n_regionkey JOIN part ON p_partkey = PartKey JOIN supplier ON s_suppkey = SupplierKey
  JOIN nation sn ON sn.n_nationkey = s_nationkey WHERE BatchId > 0"""


@query("ah_rollup", f"""SELECT r_name AS Region_RegionName, p_brand AS Brand_BrandName, sn.n_name AS Nation_NationName, count(*) AS FactRowCount,
    {total('QuantityAmount')} AS Sum_QuantityAmount, {average('DiscountRate')} AS Avg_DiscountRate, min(ExtendedAmount) AS Min_ExtendedAmount,
    max(ExtendedAmount) AS Max_ExtendedAmount {ROLLED} AND ShipDateKey BETWEEN 19990101 AND 20011231 GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def ah_rollup(spark, folder):
    wh = trade_warehouse(spark, folder)
    return rollup(
        MODEL, wh, "OrderLine", [REGION, BRAND, NATION],
        [("sum", "QuantityAmount"), ("avg", "DiscountRate"), ("min", "ExtendedAmount"), ("max", "ExtendedAmount")],
        having_min=1, window=DateWindow("ShipDateKey", 2, AS_OF),
    )


@query("ah_top_measure", f"""SELECT p_brand AS Brand_BrandName, sn.n_name AS Nation_NationName, count(*) AS FactRowCount, {total('ExtendedAmount')} AS Sum_ExtendedAmount
  {ROLLED} GROUP BY 1, 2 ORDER BY Sum_ExtendedAmount DESC, 1, 2 LIMIT 25""")
def ah_top_measure(spark, folder):
    wh = trade_warehouse(spark, folder)
    return top_by_measure(MODEL, wh, "OrderLine", [BRAND, NATION], [("sum", "ExtendedAmount")], 25)


@query("ah_distinct", f"""SELECT r_name AS Region_RegionName, count(*) AS FactRowCount, count(DISTINCT BatchId) AS DistinctBatchCount,
    count(DISTINCT PartKey) AS Distinct_PartKey {ROLLED} GROUP BY 1""")
def ah_distinct(spark, folder):
    wh = trade_warehouse(spark, folder)
    return distinct_profile(MODEL, wh, "OrderLine", [REGION], distinct_of=["PartKey"])


# --- control -----------------------------------------------------------------------------

MARK = "strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f')"


def _marks(events: DataFrame, batch: int) -> DataFrame:
    high = events.groupBy("event_type").agg(F.max("ts").alias("ts"))
    return high.select(
        F.lit(batch).cast("bigint").alias("BatchId"), F.lit("LOADER").alias("SourceSystemCode"), F.lit("fact").alias("SchemaName"),
        F.col("event_type").alias("TableName"), F.lit("LoadedAtUtc").alias("WatermarkColumnName"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("WatermarkValue"),
    )


@query("ct_watermark", f"""SELECT 'LOADER' AS SourceSystemCode, 'fact' AS SchemaName, event_type AS TableName, {MARK} AS WatermarkValue,
    CAST(2 AS BIGINT) AS BatchId, (SELECT count(*) FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')) AS NewRowCount
  FROM events GROUP BY event_type""")
def ct_watermark(spark, folder):
    events = read(spark, folder, "events")
    first = _marks(events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")), 1)
    mark = latest_watermarks(first).agg(F.max("WatermarkValue").cast("timestamp_ntz")).scalar()
    arrived = above_watermark(events, "ts", mark).agg(F.count("*")).scalar()
    return upsert_watermarks(first, _marks(events, 2)).withColumn("NewRowCount", arrived)


@query("ct_increment", """SELECT event_id, user_id, CAST(CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS BIGINT) AS BatchId FROM events""")
def ct_increment(spark, folder):
    """Events as two increments over their time; the second one stops once after it has loaded."""
    control, path = scratch(spark, "control"), scratch(spark, "events")
    events = read(spark, folder, "events").select("event_id", "user_id", "ts")
    early = events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))

    def load(batch_id):
        return lambda rows: tables.replace_batch(rows, path, batch_id)

    def stop(rows):
        load(2)(rows)
        raise InterruptedError

    load_increment(spark, control, early, "CustomerEvent", "ts", 1, load(1))
    try:
        load_increment(spark, control, events, "CustomerEvent", "ts", 2, stop)
    except InterruptedError:
        load_increment(spark, control, events, "CustomerEvent", "ts", 2, load(2))
    return spark.read.parquet(path).select("event_id", "user_id", F.col("BatchId").cast("bigint"))


@query("ct_cluster", f"""SELECT CAST(year(l_shipdate) AS BIGINT) AS BatchId, count(*) AS n, {total(dec('l_extendedprice'))} AS amount,
    true AS sorted FROM lineitem GROUP BY 1""")
def ct_cluster(spark, folder):
    """Lines stored by year in many files, then clustered in place by their day."""
    path = scratch(spark, "fact")
    lines = read(spark, folder, "lineitem").select(
        F.year("l_shipdate").cast("bigint").alias("BatchId"), F.col("l_shipdate").alias("ShipDay"), money("l_extendedprice").alias("amount")
    )
    # Sixteen tasks or more, each with rows that it can sort by year in memory.
    lines.repartition(max(16, jn.pieces_of(lines) or 0), "amount").write.partitionBy("BatchId").parquet(path)
    tables.compact_batches(spark, path, lines.schema, "ShipDay")
    stored = spark.read.schema(lines.schema).parquet(path).withColumn("__file", F.col("_metadata.file_path"))
    by_file = stored.groupBy("BatchId", "__file").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount"), F.min("ShipDay").alias("low"), F.max("ShipDay").alias("high")
    )
    # Files of a batch follow each other in time.
    after = Window.partitionBy("BatchId").orderBy("low")
    apart = F.coalesce(F.lag("high").over(after) <= F.col("low"), F.lit(True))
    return by_file.withColumn("apart", apart).groupBy("BatchId").agg(
        F.sum("n").alias("n"), F.sum("amount").cast("decimal(28,4)").alias("amount"), F.min("apart").alias("sorted")
    )


@query("ct_retention", "SELECT event_type AS DimensionName, count(*) AS kept, min(ts) AS oldest FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 14 DAY GROUP BY 1")
def ct_retention(spark, folder):
    root = scratch(spark, "control")
    log = read(spark, folder, "events").select(
        F.lit(1).alias("BatchId"), F.col("event_type").alias("DimensionName"), F.col("event_id").cast("string").alias("BusinessKeyValue"),
        F.lit("insert").alias("ChangeTypeCode"), F.col("ts").alias("ChangedAtUtc"),
    )
    append_control(spark, root, "ScdChangeLog", log)
    kept = purge(read_control(spark, root, "ScdChangeLog"), "ScdChangeLog", F.lit("2024-01-31").cast("timestamp_ntz"))
    tables.write_version(kept, f"{root}/ScdChangeLogKept", 1)
    remaining = tables.read_version(spark, f"{root}/ScdChangeLogKept")
    return remaining.groupBy("DimensionName").agg(F.count("*").alias("kept"), F.min("ChangedAtUtc").alias("oldest"))


@query("ct_maintain", f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {total(dec('l_extendedprice'))} AS amount,
    'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus AS folder FROM lineitem GROUP BY 1, 2""")
def ct_maintain(spark, folder):
    source, target = scratch(spark, "small"), scratch(spark, "compact")
    lines = read(spark, folder, "lineitem")
    # Sixteen tasks or more, each with rows that it can sort by folder in memory.
    small = lines.repartition(max(16, jn.pieces_of(lines) or 0), "l_orderkey")
    small.write.partitionBy("l_returnflag", "l_linestatus").parquet(source)
    tables.compact(spark, source, target)
    compacted = spark.read.parquet(target).withColumn("folder", F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)/[^/]+$", 1))
    return compacted.groupBy("l_returnflag", "l_linestatus", "folder").agg(
        F.count("*").alias("n"), F.sum(money("l_extendedprice")).alias("amount")
    )
