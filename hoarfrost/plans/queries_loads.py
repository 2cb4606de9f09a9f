"""Loads: sources and sinks, dimension merges, facts and bridges, streams."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoarfrost.functions.scalars import row_hash
from hoarfrost.model import Column, TableSpec
from hoarfrost.operators.control import append_control, base_of, key_ranges, read_control
from hoarfrost.operators.facts import lag_days, load_bridge, load_fact, lookup_misses, lookup_plan, unique_members
from hoarfrost.operators.filters import current_only
from hoarfrost.operators.generate import date_dimension
from hoarfrost.operators.joins import sized_join
from hoarfrost.operators.keys import assign_keys, highest_key, with_unknown
from hoarfrost.operators.quality import results
from hoarfrost.operators.scd import change_log, load_audit, merge_dimensions, scd1_merge, scd2_merge
from hoarfrost.plans.check_sql import dec, key_of
from hoarfrost.plans.queries_relational import CYCLES, LINES
from hoarfrost.plans.registry import query
from hoarfrost.plans.states import (
    CUSTOMERS_AT,
    FIRST,
    SECOND,
    SHIP_FIRST,
    SUPPLIERS_AT,
    customer_dim,
    numbered_sql,
    supplier_dim,
)
from hoarfrost.session import scratch
from hoarfrost.sources import buckets, landing, tables, trade
from hoarfrost.sources.trade import MODEL, money, read, trade_warehouse
from hoarfrost.streaming import ingest

def _at(day: dt.date):
    return F.lit(day.isoformat()).cast("timestamp_ntz")


# --- sources and sinks -------------------------------------------------------------------

STAGED_EVENTS = f"""SELECT event_type AS EventTypeCode, {dec('value')} AS EventAmount, {key_of('ts')} AS EventDateKey,
    CAST(hour(ts) * 3600 + minute(ts) * 60 AS INTEGER) AS EventTimeOfDayKey, c_name AS CustomerCustomerNumber,
    CAST(1 AS BIGINT) AS BatchId, event_id + 1 AS RowNumber
  FROM events LEFT JOIN customer ON c_custkey = user_id"""


@query("src_landing", STAGED_EVENTS)
def src_landing(spark, folder):
    root = scratch(spark, "landing")
    tables.write_extract(trade.event_stage(spark, folder, 1), landing.landing_path(root, 1, "CustomerEvent"))
    return landing.read_landing(spark, root, 1, "CustomerEvent", MODEL.staging_schema("CustomerEvent"))


@query("src_stage_reload", f"SELECT CustomerNumber, AccountBalanceAmount, NationNationCode, CAST(2 AS BIGINT) AS BatchId FROM ({CUSTOMERS_AT()}) s")
def src_stage_reload(spark, folder):
    path = scratch(spark, "stage")
    for batch, day in ((1, FIRST), (2, None)):
        tables.stage(trade.customer_stage(spark, folder, day, batch), path)
    return spark.read.parquet(path).select("CustomerNumber", "AccountBalanceAmount", "NationNationCode", "BatchId")


@query("src_seed_csv", f"""SELECT p_partkey AS PartKey, 'Part#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS PartNumber,
    p_name AS PartName, p_size AS SizeNumber, {dec('p_retailprice')} AS RetailPriceAmount FROM part""")
def src_seed_csv(spark, folder):
    root = scratch(spark, "seed")
    parts = trade_warehouse(spark, folder)["Part"].select("PartKey", "PartNumber", "PartName", "SizeNumber", "RetailPriceAmount")
    tables.write_extract(parts, f"{root}/dim/Part.csv")
    return landing.read_seed(spark, root, "dim", "Part", parts.schema)


@query("src_load_if_empty", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_load_if_empty(spark, folder):
    path = scratch(spark, "once")
    suppliers = read(spark, folder, "supplier")
    tables.load_if_empty(suppliers, path)
    tables.load_if_empty(suppliers.withColumn("s_name", F.lit("again")), path)
    return spark.read.parquet(path)


@query("snk_csv", "SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_day, o_orderstatus = 'P' AS pending FROM orders")
def snk_csv(spark, folder):
    path = scratch(spark, "extract")
    out = read(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("o_day"),
        (F.col("o_orderstatus") == "P").alias("pending"),
    )
    tables.write_extract(out, path)
    return landing.typed_rows(landing.read_raw(spark, path, out.schema), out.schema)


@query("snk_replace_batch", f"""SELECT OrderNumber, LineNumber, PartKey, QuantityAmount, BatchId FROM {LINES}
  WHERE BatchId <> 199906 UNION ALL
  SELECT OrderNumber, LineNumber, PartKey, CAST(QuantityAmount * 2 AS DECIMAL(18,4)), BatchId FROM {LINES} WHERE BatchId = 199906""")
def snk_replace_batch(spark, folder):
    path = scratch(spark, "fact")
    lines = trade_warehouse(spark, folder)["OrderLine"].select("OrderNumber", "LineNumber", "PartKey", "QuantityAmount", "BatchId")
    # The whole table is loaded first; one batch then arrives again with other amounts.
    # Shuffling on the batch gives each its own few files; AQE splits a batch too big for one.
    by_batch = lines.hint("rebalance", "BatchId")
    by_batch.write.mode("error").partitionBy("BatchId").parquet(path)
    again = lines.filter(F.col("BatchId") == 199906).withColumn(
        "QuantityAmount", (F.col("QuantityAmount") * 2).cast("decimal(18,4)")
    )
    for _ in range(2):
        tables.replace_batch(again, path, 199906, "PartKey")
    return spark.read.schema(lines.schema).parquet(path)


@query("snk_control_append", "SELECT CAST(1 AS BIGINT) AS BatchId, 'etl' AS SchemaName, o_orderpriority AS TableName, 'Pending ' || o_orderkey AS ErrorMessage FROM orders WHERE o_orderstatus = 'P'")
def snk_control_append(spark, folder):
    root = scratch(spark, "control")
    rows = read(spark, folder, "orders").filter("o_orderstatus = 'P'").select(
        F.lit(1).alias("BatchId"), F.lit("etl").alias("SchemaName"), F.col("o_orderpriority").alias("TableName"),
        F.concat(F.lit("Pending "), F.col("o_orderkey").cast("string")).alias("ErrorMessage"),
        F.lit("no such column").alias("Unknown"),
    )
    append_control(spark, root, "LoadError", rows)
    return read_control(spark, root, "LoadError").select("BatchId", "SchemaName", "TableName", "ErrorMessage")


# --- dimensions --------------------------------------------------------------------------

ACTIONS = f"""SELECT b.*, a.CustomerKey AS old_key, a.RowHash AS old_hash,
    CASE WHEN a.CustomerNumber IS NULL THEN 'insert' WHEN a.RowHash <> b.RowHash THEN 'update' ELSE 'unchanged' END AS action
  FROM ({CUSTOMERS_AT()}) b LEFT JOIN ({CUSTOMERS_AT(FIRST)}) a ON a.CustomerNumber = b.CustomerNumber"""
MERGED = f"""SELECT CAST(CustomerKey AS BIGINT) AS CustomerKey, CustomerNumber, NationKey, MarketSegmentName, AccountBalanceAmount,
    CAST(1 AS BIGINT) AS BatchId, TIMESTAMP '{FIRST}' AS EffectiveFromUtc,
    CASE WHEN closed THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '9999-12-31' END AS EffectiveToUtc, NOT closed AS IsCurrent, RowHash
  FROM (SELECT a.*, EXISTS (SELECT 1 FROM ({ACTIONS}) x WHERE x.CustomerNumber = a.CustomerNumber AND x.action = 'update') AS closed
    FROM ({CUSTOMERS_AT(FIRST)}) a) k
  UNION ALL
  SELECT CAST((SELECT max(CustomerKey) FROM ({CUSTOMERS_AT(FIRST)}) m) + {numbered_sql('CustomerNumber')} AS BIGINT),
    CustomerNumber, NationKey, MarketSegmentName, AccountBalanceAmount, CAST(2 AS BIGINT), TIMESTAMP '{SECOND}',
    TIMESTAMP '9999-12-31', true, RowHash
  FROM ({ACTIONS}) n WHERE action <> 'unchanged'"""


#: Rows of a bucket in the queries, so that the given tables already fill several.
QUERY_BUCKET_ROWS = 2000


def _stored_merge(spark, name: str, first: DataFrame, stage: DataFrame, merge) -> DataFrame:
    """A dimension kept in buckets, its first version as given and a second one with a batch merged in."""
    path, spec = scratch(spark, name), MODEL[name]
    buckets.write(first, path, 1, spec.business_key.name, spec.key, bucket_rows=QUERY_BUCKET_ROWS)
    tables.merge_version(spark, path, 2, spec, stage, merge, QUERY_BUCKET_ROWS)
    return tables.read_version(spark, path, schema=first.schema)


def _customer_merge(spark, folder, dim: DataFrame | None = None, highest=None):
    dims = {"Nation": trade_warehouse(spark, folder)["Nation"]}
    stage = trade.customer_stage(spark, folder, None, 2)
    return scd2_merge(customer_dim(spark, folder) if dim is None else dim, stage, MODEL["Customer"], 2, _at(SECOND), MODEL, dims, highest)


def _customer_rows(dim: DataFrame) -> DataFrame:
    return dim.select(
        "CustomerKey", "CustomerNumber", "NationKey", "MarketSegmentName", "AccountBalanceAmount", "BatchId",
        "EffectiveFromUtc", "EffectiveToUtc", "IsCurrent", F.lower(F.hex("RowHash")).alias("RowHash"),
    )


@query("ld_scd2", MERGED)
def ld_scd2(spark, folder):
    stage = trade.customer_stage(spark, folder, None, 2)
    merge = lambda part, highest=None: _customer_merge(spark, folder, part, highest)
    return _customer_rows(_stored_merge(spark, "Customer", customer_dim(spark, folder), stage, merge))


@query("flt_current", f"SELECT * FROM ({MERGED}) WHERE IsCurrent")
def flt_current(spark, folder):
    return _customer_rows(current_only(_customer_merge(spark, folder).table))


@query("ld_row_hash", f"SELECT CustomerNumber, RowHash FROM ({CUSTOMERS_AT()}) s")
def ld_row_hash(spark, folder):
    rows = trade.customer_stage(spark, folder, None, 2)
    names = ["CustomerNumber", "MarketSegmentName", "AccountBalanceAmount", "NationNationCode"]
    return rows.select("CustomerNumber", F.lower(F.hex(row_hash(rows.schema, names))).alias("RowHash"))


SUPPLIER_ACTIONS = f"""SELECT b.*, a.SupplierKey AS old_key, a.SupplierNumber IS NULL AS is_new
  FROM ({SUPPLIERS_AT()}) b LEFT JOIN ({SUPPLIERS_AT(SHIP_FIRST)}) a ON a.SupplierNumber = b.SupplierNumber"""
MERGED_SUPPLIERS = f"""SELECT CAST(a.SupplierKey AS BIGINT) AS SupplierKey, a.SupplierNumber, a.NationKey,
    coalesce(b.AccountBalanceAmount, a.AccountBalanceAmount) AS AccountBalanceAmount, CAST(1 AS BIGINT) AS BatchId
  FROM ({SUPPLIERS_AT(SHIP_FIRST)}) a LEFT JOIN ({SUPPLIERS_AT()}) b ON b.SupplierNumber = a.SupplierNumber
  UNION ALL
  SELECT CAST((SELECT max(SupplierKey) FROM ({SUPPLIERS_AT(SHIP_FIRST)}) m) + {numbered_sql('SupplierNumber')} AS BIGINT),
    SupplierNumber, NationKey, AccountBalanceAmount, CAST(2 AS BIGINT) FROM ({SUPPLIER_ACTIONS}) n WHERE is_new"""


@query("ld_scd1", MERGED_SUPPLIERS)
def ld_scd1(spark, folder):
    dims = {"Nation": trade_warehouse(spark, folder)["Nation"]}
    stage = trade.supplier_stage(spark, folder, None, 2)
    merge = lambda part, highest=None: scd1_merge(part, stage, MODEL["Supplier"], 2, _at(SECOND), MODEL, dims, highest)
    return _stored_merge(spark, "Supplier", supplier_dim(spark, folder), stage, merge).select(
        "SupplierKey", "SupplierNumber", "NationKey", "AccountBalanceAmount", "BatchId"
    )


def _all_merges(spark, folder):
    wh = trade_warehouse(spark, folder)
    dims = {"Customer": customer_dim(spark, folder), "Supplier": supplier_dim(spark, folder), "Nation": wh["Nation"]}
    stages = {
        "Customer": trade.customer_stage(spark, folder, None, 2),
        "Supplier": trade.supplier_stage(spark, folder, None, 2),
    }
    return merge_dimensions(MODEL, dims, stages, 2, _at(SECOND))


AUDIT = f"""SELECT CAST(2 AS BIGINT) AS BatchId, 'dim' AS SchemaName, 'Customer' AS TableName, count(*) AS SourceRowCount,
    count(*) FILTER (WHERE action = 'insert') AS InsertedRowCount, count(*) FILTER (WHERE action = 'update') AS UpdatedRowCount,
    count(*) FILTER (WHERE action <> 'insert') AS MatchedRowCount, CAST(0 AS BIGINT) AS RejectedRowCount FROM ({ACTIONS}) c
  UNION ALL SELECT CAST(2 AS BIGINT), 'dim', 'Supplier', count(*), count(*) FILTER (WHERE is_new), count(*) FILTER (WHERE NOT is_new),
    count(*) FILTER (WHERE NOT is_new), CAST(0 AS BIGINT) FROM ({SUPPLIER_ACTIONS}) s"""


@query("ct_load_audit", AUDIT)
def ct_load_audit(spark, folder):
    merges = _all_merges(spark, folder)
    return reduce(DataFrame.unionByName, [load_audit(m.changes, "dim", name, 2) for name, m in merges.items()])


@query("ld_merge_all", f"""SELECT 'Customer' AS table_name, CustomerKey AS key, CustomerNumber AS number, AccountBalanceAmount, BatchId FROM ({MERGED}) c
  UNION ALL SELECT 'Supplier', SupplierKey, SupplierNumber, AccountBalanceAmount, BatchId FROM ({MERGED_SUPPLIERS}) s""")
def ld_merge_all(spark, folder):
    parts = [
        merge.table.select(
            F.lit(name).alias("table_name"), F.col(f"{name}Key").alias("key"), F.col(f"{name}Number").alias("number"),
            "AccountBalanceAmount", "BatchId",
        )
        for name, merge in _all_merges(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("ld_change_log", f"""SELECT CAST(2 AS BIGINT) AS BatchId, 'Customer' AS DimensionName, CustomerNumber AS BusinessKeyValue,
    action AS ChangeTypeCode, old_hash AS PreviousRowHash, RowHash AS NewRowHash FROM ({ACTIONS}) c WHERE action <> 'unchanged'""")
def ld_change_log(spark, folder):
    log = change_log(_customer_merge(spark, folder).changes, "Customer", 2)
    return log.withColumns({c: F.lower(F.hex(c)) for c in ("PreviousRowHash", "NewRowHash")})


@query("ld_surrogate_key", f"""SELECT c_name AS CustomerNumber, (SELECT max(s_suppkey) FROM supplier) + {numbered_sql('c_name')} AS PartyKey FROM customer""")
def ld_surrogate_key(spark, folder):
    wh = trade_warehouse(spark, folder)
    return assign_keys(wh["Customer"].select("CustomerNumber"), ["CustomerNumber"], "PartyKey", highest_key(wh["Supplier"], "SupplierKey"))


@query("ld_unknown_member", f"""SELECT c_custkey AS CustomerKey, c_name AS CustomerNumber, c_nationkey AS NationKey, c_mktsegment AS MarketSegmentName,
    {dec('c_acctbal')} AS AccountBalanceAmount FROM customer UNION ALL SELECT -1, 'UNKNOWN', -1, 'Unknown', 0""")
def ld_unknown_member(spark, folder):
    customers = trade_warehouse(spark, folder)["Customer"]
    once = with_unknown(customers, MODEL["Customer"])
    return with_unknown(once, MODEL["Customer"])


# --- facts and bridges -------------------------------------------------------------------

CALENDAR_END = dt.date(2000, 12, 31)  # later days fall back to the unknown day


def _day(column: str) -> str:
    return f"CASE WHEN {column} BETWEEN 19950101 AND 20001231 THEN {column} ELSE -1 END"


LOADED = f"""SELECT OrderNumber + 1 AS OrderCycleKey, OrderNumber, TotalAmount, LineCount, {_day('OrderDateKey')} AS OrderDateKey,
    {_day('FirstShipDateKey')} AS FirstShipDateKey, {_day('LastShipDateKey')} AS LastShipDateKey,
    CAST(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE coalesce(d.CustomerKey, -1) END AS BIGINT) AS CustomerKey, OrderPriorityKey,
    CASE WHEN {_day('OrderDateKey')} > 0 AND {_day('LastShipDateKey')} > 0 THEN OrderCycleLagDays END AS OrderCycleLagDays,
    CAST(-1 AS INTEGER) AS SourceSystemKey, CAST(3 AS BIGINT) AS BatchId
  FROM {CYCLES} JOIN orders ON o_orderkey = OrderNumber JOIN customer ON c_custkey = cycles.CustomerKey
  LEFT JOIN ({MERGED}) d ON d.CustomerNumber = c_name AND d.IsCurrent"""


def _order_load(spark, folder, customers, keep_misses=False):
    wh = trade_warehouse(spark, folder)
    dims = {
        "Customer": _stored(customers),
        "OrderPriority": wh["OrderPriority"],
        "Date": date_dimension(spark, trade.CALENDAR_START, CALENDAR_END, trade.AS_OF),
    }
    stage = trade.order_stage(spark, folder, 3)
    staged = stage.agg(F.max("RowNumber")).first()[0] or 0
    own = key_ranges(spark, scratch(spark, "control"), "OrderCycle", 3, staged, lambda: 0)
    return load_fact(MODEL, "OrderCycle", stage, dims, 3, _at(SECOND), highest=base_of(own), keep_misses=keep_misses)


def _stored(dim: DataFrame) -> DataFrame:
    """A merged dimension as a load meets it: written as a version and read back."""
    path = scratch(dim.sparkSession, "dim")
    tables.write_version(dim, path, 2)
    return tables.read_version(dim.sparkSession, path, schema=dim.schema)


@query("ld_fact", LOADED)
def ld_fact(spark, folder):
    return _order_load(spark, folder, _customer_merge(spark, folder).table).drop("LoadedAtUtc")


MISSES = f"""SELECT CAST(3 AS BIGINT) AS batch_id, 'Missing lookup CustomerKey' AS rule, 'fact.OrderCycle' AS "table", count(*) AS checked,
    count(*) FILTER (WHERE o_orderstatus <> 'P' AND d.CustomerKey IS NULL) AS failed,
    CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'P' AND d.CustomerKey IS NULL) > 0 THEN 'Fail' ELSE 'Pass' END AS status
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN ({CUSTOMERS_AT(FIRST)}) d ON d.CustomerNumber = c_name
  UNION ALL SELECT CAST(3 AS BIGINT), 'Missing lookup OrderPriorityKey', 'fact.OrderCycle', count(*), CAST(0 AS BIGINT), 'Pass' FROM orders"""


def _misses(spark, folder):
    stage_columns = [c.name for c in MODEL.staging_columns("OrderCycle")]
    # All orders against the customers of the first day: those who ordered later are not found.
    flagged = _order_load(spark, folder, customer_dim(spark, folder), keep_misses=True)
    return lookup_misses(flagged, lookup_plan(MODEL, "OrderCycle", stage_columns), "OrderCycle")


@query("ld_lookup_dq", f'SELECT rule, "table", checked, failed FROM ({MISSES}) m')
def ld_lookup_dq(spark, folder):
    return _misses(spark, folder)


@query("dq_missing_lookup", MISSES)
def dq_missing_lookup(spark, folder):
    return results(_misses(spark, folder), 3, _at(SECOND)).drop("rule_code", "checked_at")


@query("ld_lag_days", f"SELECT OrderNumber, OrderDateKey, LastShipDateKey, OrderCycleLagDays FROM {CYCLES}")
def ld_lag_days(spark, folder):
    cycles = trade_warehouse(spark, folder)["OrderCycle"].drop("OrderCycleLagDays")
    return lag_days(cycles, MODEL["OrderCycle"]).select("OrderNumber", "OrderDateKey", "LastShipDateKey", "OrderCycleLagDays")


PAIRS = f"""SELECT PartKey, SupplierKey, RowNumber, SupplyAmount FROM (
    SELECT l_partkey AS PartKey, l_suppkey AS SupplierKey, l_orderkey AS RowNumber, {dec('l_extendedprice')} AS SupplyAmount,
      row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, {dec('l_extendedprice')}) AS n FROM lineitem) x
  WHERE n = 1"""


def _pairs(spark, folder):
    return read(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("PartKey"), F.col("l_suppkey").alias("SupplierKey"), F.col("l_orderkey").alias("RowNumber"),
        money("l_extendedprice").alias("SupplyAmount"),
    )


@query("ld_bridge_unique", PAIRS)
def ld_bridge_unique(spark, folder):
    return unique_members(_pairs(spark, folder), ["PartKey", "SupplierKey"])


@query("ld_bridge", f"""WITH firsts AS (SELECT l_partkey, s.SupplierKey AS k, min(l_orderkey) AS row_number
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN ({SUPPLIERS_AT(SHIP_FIRST)}) s ON s.SupplierNumber = s_name
    GROUP BY l_partkey, s.SupplierKey)
  SELECT row_number AS PartSupplierKey, l_partkey AS PartKey, CAST(coalesce(k, -1) AS BIGINT) AS SupplierKey,
    CAST(1 AS BIGINT) AS SupplyCount, CAST(4 AS BIGINT) AS BatchId FROM firsts""")
def ld_bridge(spark, folder):
    wh = trade_warehouse(spark, folder)
    parts = wh["Part"].select("PartKey", "PartNumber")
    suppliers = wh["Supplier"].select("SupplierKey", "SupplierNumber")
    stage = _named(_pairs(spark, folder).drop("SupplyAmount"), parts, suppliers)
    # Suppliers who had not shipped by the first day are unknown to the dimension.
    dims = {"Part": wh["Part"], "Supplier": supplier_dim(spark, folder)}
    loaded = load_bridge(MODEL, "PartSupplier", stage, dims, 4, _at(SECOND))
    return loaded.select("PartSupplierKey", "PartKey", "SupplierKey", "SupplyCount", "BatchId")


def _named(pairs: DataFrame, parts: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Part and supplier keys as the numbers a staged bridge carries."""
    named = sized_join(pairs, parts, {"PartKey": "PartKey"})
    named = sized_join(named, suppliers, {"SupplierKey": "SupplierKey"})
    return named.select(
        F.col("PartNumber").alias("PartPartNumber"), F.col("SupplierNumber").alias("SupplierSupplierNumber"),
        F.lit(1).cast("bigint").alias("SupplyCount"), F.lit(4).cast("bigint").alias("BatchId"), "RowNumber",
    )


# --- rejects and received files ----------------------------------------------------------

ORDER_LANDING = TableSpec(
    "OrderHeader", "fact",
    (Column("OrderNumber", "bigint"), Column("TotalAmount", "decimal(18,4)"), Column("StatusCode", "nvarchar(10)")),
)


def _dirty_orders(spark, folder) -> str:
    """Orders as a source sends them: a pending order has no amount yet, only a word."""
    path = scratch(spark, "dirty")
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("OrderNumber"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(money("o_totalprice").cast("string")).alias("TotalAmount"),
        F.col("o_orderstatus").alias("StatusCode"), F.lit(5).alias("BatchId"), (F.col("o_orderkey") + 1).alias("RowNumber"),
    )
    # One folder per status, whichever there are: the status is a column of the file and names its folder.
    named = tables.csv_ready(orders).withColumn("status", F.col("StatusCode"))
    named.write.option("header", True).option("escape", '"').partitionBy("status").csv(path)
    return path


def _landing_schema():
    fields = [T.StructField(c.name, c.spark_type, True) for c in ORDER_LANDING.columns]
    return T.StructType([*fields, T.StructField("BatchId", T.LongType(), True), T.StructField("RowNumber", T.LongType(), True)])


@query("ct_rejects", """SELECT CAST(5 AS BIGINT) AS BatchId, 'fact' AS TargetSchemaName, 'OrderHeader' AS TargetTableName,
    o_orderkey + 1 AS SourceRowNumber, 'TotalAmount is not decimal(18,4)' AS RejectReasonText,
    o_orderkey || ',pending,P,5,' || (o_orderkey + 1) AS RejectedPayload FROM orders WHERE o_orderstatus = 'P'""")
def ct_rejects(spark, folder):
    path, schema = _dirty_orders(spark, folder), _landing_schema()
    raw = landing.read_raw(spark, f"{path}/*", schema)
    return landing.rejects(raw, schema, 5, "fact", "OrderHeader")


@query("ct_file_ingest", """SELECT 'status=' || o_orderstatus AS FolderName, count(*) AS RowsReadCount,
    CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END) AS BIGINT) AS RowsLoadedCount,
    CASE WHEN o_orderstatus = 'P' THEN 'Partial' ELSE 'Loaded' END AS IngestStatusCode FROM orders GROUP BY o_orderstatus""")
def ct_file_ingest(spark, folder):
    path = _dirty_orders(spark, folder)
    received = landing.file_ingest(spark, f"{path}/*", _landing_schema())
    by_folder = received.withColumn("FolderName", F.element_at(F.split("FilePathText", "/"), -2))
    return by_folder.groupBy("FolderName", "IngestStatusCode").agg(
        F.sum("RowsReadCount").alias("RowsReadCount"), F.sum("RowsLoadedCount").alias("RowsLoadedCount")
    )


# --- streams -----------------------------------------------------------------------------

WEEKS = ((1, "2024-01-01", "2024-01-11"), (2, "2024-01-11", "2024-01-21"), (3, "2024-01-21", "2024-02-01"))
EPOCH = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END"


def _land_events(spark, folder, root: str, week: tuple[int, str, str]) -> None:
    """One landing batch of events, by their time."""
    batch, start, end = week
    first, last = (int(d.replace("-", "")) for d in (start, end))
    staged = trade.event_stage(spark, folder, batch)
    part = staged.filter((F.col("EventDateKey") >= first) & (F.col("EventDateKey") < last))
    tables.write_extract(part, landing.landing_path(root, batch, "CustomerEvent"))


@query("st_ingest", f"SELECT EventTypeCode, EventAmount, EventDateKey, EventTimeOfDayKey, CustomerCustomerNumber, RowNumber FROM ({STAGED_EVENTS}) s")
def st_ingest(spark, folder):
    root = scratch(spark, "landing")
    for week in WEEKS:
        _land_events(spark, folder, root, week)
    stream = ingest.landing_stream(spark, f"{root}/*/stg.CustomerEvent.csv", MODEL.staging_schema("CustomerEvent"))
    checkpoint, target = scratch(spark, "checkpoint"), scratch(spark, "staged")
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(stream, checkpoint, target)
    return ingest.accepted(ingest.staged(spark, target, MODEL.staging_schema("CustomerEvent"))).select(
        "EventTypeCode", "EventAmount", "EventDateKey", "EventTimeOfDayKey", "CustomerCustomerNumber", "RowNumber"
    )


@query("st_dead_letters", """SELECT CAST(5 AS BIGINT) AS BatchId, o_orderkey + 1 AS RowNumber,
    CASE WHEN o_orderstatus = 'P' THEN 'TotalAmount is not decimal(18,4)' END AS RejectReasonText,
    CASE WHEN o_orderstatus = 'P' THEN o_orderkey || ',pending,P,5,' || (o_orderkey + 1) END AS RejectedPayload FROM orders""")
def st_dead_letters(spark, folder):
    """Every landed order once: those that fit, and those that do not with the reason and their line."""
    path, schema = _dirty_orders(spark, folder), _landing_schema()
    checkpoint, target = scratch(spark, "checkpoint"), scratch(spark, "staged")
    ingest.ingest(ingest.landing_stream(spark, f"{path}/*", schema), checkpoint, target)
    landed = ingest.staged(spark, target, schema)
    good = ingest.accepted(landed).select("BatchId", "RowNumber")
    return good.unionByName(ingest.dead_letters(landed).drop(ingest.LANDING_FILE), allowMissingColumns=True)


FIRST_SEEN = f"""SELECT c_name, epoch, row_number() OVER (ORDER BY epoch, sha256(c_name), c_name) AS k
  FROM (SELECT c_name, min({EPOCH}) AS epoch FROM events JOIN customer ON c_custkey = user_id GROUP BY c_name) f"""


@query("st_apply", f"""SELECT CAST({EPOCH} AS BIGINT) AS BatchId, {EPOCH} * 1099511627776 + event_id + 1 AS CustomerEventKey,
    event_type AS EventTypeCode, {dec('value')} AS EventAmount, {key_of('ts')} AS EventDateKey,
    CAST(hour(ts) * 3600 + minute(ts) * 60 AS INTEGER) AS EventTimeOfDayKey, CAST(f.k AS BIGINT) AS CustomerKey
  FROM events JOIN customer ON c_custkey = user_id JOIN ({FIRST_SEEN}) f ON f.c_name = customer.c_name""")
def st_apply(spark, folder):
    root, warehouse, checkpoint = (scratch(spark, part) for part in ("landing", "warehouse", "checkpoint"))
    spec = MODEL["Customer"]
    tables.write_version(spark.createDataFrame([], spec.schema_type()), f"{warehouse}/Customer", 0)
    for name, dim in (
        ("Date", date_dimension(spark, trade.CALENDAR_START, trade.CALENDAR_END, trade.AS_OF)),
        ("TimeOfDay", trade_warehouse(spark, folder)["TimeOfDay"]),
    ):
        tables.write_version(dim, f"{warehouse}/{name}", 0)

    def customers(df: DataFrame) -> dict[str, DataFrame]:
        # A customer first seen in an event is entered by number; attributes follow later.
        seen = df.filter(F.col("CustomerCustomerNumber").isNotNull())
        return {
            "Customer": seen.select(F.col("CustomerCustomerNumber").alias("CustomerNumber"), "BatchId", "RowNumber")
        }

    for week in WEEKS:  # a batch lands, the scheduled stream picks it up and stops
        _land_events(spark, folder, root, week)
        stream = ingest.landing_stream(spark, f"{root}/*/stg.CustomerEvent.csv", MODEL.staging_schema("CustomerEvent"))
        ingest.apply_stream(
            stream, checkpoint, MODEL, warehouse, "CustomerEvent", _at(SECOND), customers, lambda df: df
        )
    fact = spark.read.schema(MODEL["CustomerEvent"].schema_type()).parquet(f"{warehouse}/CustomerEvent")
    return fact.select(
        "BatchId", "CustomerEventKey", "EventTypeCode", "EventAmount", "EventDateKey", "EventTimeOfDayKey", "CustomerKey"
    )
