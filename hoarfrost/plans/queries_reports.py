"""The fixed reports over the trade tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoarfrost.operators.control import append_control, read_control
from hoarfrost.plans.check_sql import average, big, dec, quotient, share, small, total, units
from hoarfrost.plans.registry import query
from hoarfrost.plans.reports import (
    downtime_rank,
    incident_trend,
    oee_plant_month,
    quality_mix,
    run_reports,
    throughput_shift,
    timings,
    variance_line,
)
from hoarfrost.session import scratch
from hoarfrost.sources.trade import AS_OF, EVENTS_AS_OF, PRIORITIES, RETURN_FLAGS, manufacturing_warehouse

FLAG_NAMES = "(VALUES " + ", ".join(f"('{c}', '{n}', {str(m).upper()})" for c, n, m in RETURN_FLAGS) + ") AS f(code, name, counts)"
PRIORITY_NAMES = (
    "(VALUES " + ", ".join(f"('{c}', '{n}', {r}, {str(e).upper()})" for c, n, r, e in PRIORITIES) + ") AS v(code, name, rank, esc)"
)
MINUTES = f"CAST({dec('l_tax')} * 100 AS DECIMAL(18,4))"
MONEY = "CAST(l_extendedprice AS DECIMAL(19,4))"
BAND = "(CAST(floor((p_size - 1) / 10) AS INTEGER) + 1)"

OEE = f"""
SELECT n_name AS PlantCode, n_name AS PlantName,
  {small('year(l_shipdate)')} AS CalendarYearNumber, {small('month(l_shipdate)')} AS CalendarMonthNumber,
  max(strftime(l_shipdate, '%b')) AS CalendarMonthName, count(*) AS SnapshotCount,
  count(DISTINCT l_suppkey) AS DistinctMachineCount, count(DISTINCT l_partkey) AS DistinctProductCount,
  {big('sum(l_linenumber)')} AS TotalEventCount, {total(dec('l_quantity'))} AS TotalQuantityAmount,
  {total(MINUTES)} AS TotalDurationMinutes, {average(MINUTES)} AS AvgDurationMinutes,
  {total(MONEY, 'DECIMAL(29,4)')} AS TotalCostAmount
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
WHERE l_shipdate >= DATE '1999-08-01'
GROUP BY n_name, year(l_shipdate), month(l_shipdate)
"""


@query("rp_oee_plant_month", OEE)
def rp_oee_plant_month(spark, folder):
    return oee_plant_month(manufacturing_warehouse(spark, folder), AS_OF)


QUALITY = f"""
WITH g AS (
  SELECT 'BAND-' || {BAND} AS ProductFamilyCode, 'BAND-' || {BAND} AS ProductFamilyName,
    f.code AS ResultStatusCode, f.name AS ResultStatusName, count(*) AS InspectionCount,
    {total(dec('l_quantity'))} AS InspectedQuantity, {average(MINUTES)} AS AvgInspectionMinutes,
    count(DISTINCT l_partkey) AS DistinctProductCount
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN {FLAG_NAMES} ON f.code = l_returnflag
  WHERE l_shipdate >= DATE '2000-08-01'
  GROUP BY {BAND}, f.code, f.name
), t AS (SELECT ProductFamilyCode AS c, {big('sum(InspectionCount)')} AS n FROM g GROUP BY ProductFamilyCode)
SELECT g.*, t.n AS FamilyInspectionCount,
  {share('InspectionCount', 't.n')} AS PercentOfFamily
FROM g JOIN t ON t.c = g.ProductFamilyCode
"""


@query("rp_quality_mix", QUALITY)
def rp_quality_mix(spark, folder):
    return quality_mix(manufacturing_warehouse(spark, folder), AS_OF)


DOWNTIME = f"""
WITH g AS (
  SELECT n_name AS PlantCode, s_name AS MachineNumber, s_name AS MachineName,
    CASE l_linestatus WHEN 'F' THEN 'Finished' ELSE 'Open' END AS MachineStateName, f.name AS StateTypeName,
    count(*) AS StateEventCount, {total(MINUTES)} AS TotalDownMinutes, {average(MINUTES)} AS AvgDownMinutes,
    max({MINUTES}) AS LongestDownMinutes, {total(MONEY, 'DECIMAL(29,4)')} AS TotalCostAmount
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    JOIN {FLAG_NAMES} ON f.code = l_returnflag
  WHERE l_shipdate >= DATE '2001-02-01' AND l_linestatus IN ('F', 'O')
  GROUP BY n_name, s_name, l_linestatus, f.name
)
SELECT *, dense_rank() OVER (PARTITION BY PlantCode ORDER BY TotalDownMinutes DESC) AS PlantDowntimeRank
FROM g
ORDER BY TotalDownMinutes DESC, PlantCode, MachineNumber, MachineName, MachineStateName, StateTypeName
LIMIT 100
"""


@query("rp_downtime_rank", DOWNTIME)
def rp_downtime_rank(spark, folder):
    return downtime_rank(manufacturing_warehouse(spark, folder), AS_OF)


INCIDENT = f"""
WITH s AS (
  SELECT l_orderkey AS k, max(l_shipdate) AS last, count(*) AS n, sum({dec('l_quantity')}) AS q
  FROM lineitem GROUP BY l_orderkey
), o AS (
  SELECT orders.*, coalesce(n, 0) AS n, coalesce(q, 0) AS q, date_diff('day', o_orderdate, last) AS lag
  FROM orders LEFT JOIN s ON k = o_orderkey WHERE o_orderdate >= DATE '1999-08-01'
)
SELECT n_name AS PlantCode, n_name AS PlantName, {small('year(o_orderdate)')} AS CalendarYearNumber,
  {small('month(o_orderdate)')} AS CalendarMonthNumber, v.code AS SeverityCode, v.name AS SeverityName,
  max(v.rank) AS SeverityRank, count(*) AS IncidentCount, {big('sum(n)')} AS InjuredPersonCount,
  {total('CAST(q AS DECIMAL(18,4))')} AS LostWorkdayCount,
  {total('CAST(o_totalprice AS DECIMAL(19,4))', 'DECIMAL(29,4)')} AS EstimatedCostAmount,
  {average('lag', scale_in=0)} AS AvgReportingLagDays,
  {big('sum(CASE WHEN v.esc THEN 1 ELSE 0 END)')} AS EscalatedIncidentCount
FROM o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN {PRIORITY_NAMES} ON v.code = o_orderpriority
GROUP BY n_name, year(o_orderdate), month(o_orderdate), v.code, v.name
"""


@query("rp_incident_trend", INCIDENT)
def rp_incident_trend(spark, folder):
    return incident_trend(manufacturing_warehouse(spark, folder), AS_OF)


ACTUAL = f"CAST({dec('l_extendedprice')} * (1 - {dec('l_discount')}) AS DECIMAL(19,4))"
VARIANCE = f"""
WITH g AS (
  SELECT CASE WHEN p_size <= 50 THEN 'PARTS' ELSE 'OVERSIZE' END AS division,
    CASE WHEN {BAND} <= 2 THEN 'COMPACT' ELSE 'BULK' END AS line, f.code, f.name,
    {small('year(l_shipdate)')} AS y, {small('quarter(l_shipdate)')} AS q, l_partkey, s_nationkey,
    {MONEY} AS std, {ACTUAL} AS act, CAST({ACTUAL} - {dec('l_extendedprice')} AS DECIMAL(19,4)) AS var
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN {FLAG_NAMES} ON f.code = l_returnflag
  WHERE l_shipdate >= DATE '2000-02-01' AND f.counts
)
SELECT division AS ProductDivisionCode, division AS ProductDivisionName, line AS ProductLineCode, line AS ProductLineName,
  code AS VarianceTypeCode, name AS VarianceTypeName, y AS CalendarYearNumber, q AS CalendarQuarterNumber,
  count(*) AS PostingCount, count(DISTINCT l_partkey) AS DistinctProductCount, count(DISTINCT s_nationkey) AS DistinctPlantCount,
  {total('std', 'DECIMAL(29,4)')} AS StandardAmount, {total('act', 'DECIMAL(29,4)')} AS ActualAmount,
  {total('var', 'DECIMAL(29,4)')} AS VarianceAmount,
  {quotient(f"sum({units('var')})", f"sum({units('std')})", 18, 4, 100)} AS VariancePercentOfStandard
FROM g GROUP BY division, line, code, name, y, q
"""


@query("rp_variance_line", VARIANCE)
def rp_variance_line(spark, folder):
    return variance_line(manufacturing_warehouse(spark, folder), AS_OF)


SHIFT = "CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'Night' WHEN hour(ts) < 14 THEN 'Day' ELSE 'Evening' END"
THROUGHPUT = f"""
WITH e AS (
  SELECT n_name, {SHIFT} AS shift, ts, dayofweek(ts) IN (0, 6) AS weekend, event_id, user_id, value,
    {dec('value')} AS q, CAST(regexp_extract(props, '([0-9]+)', 1) AS DECIMAL(18,4)) AS m
  FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
  WHERE ts >= TIMESTAMP '2023-01-31'
)
SELECT n_name AS WorkCenterCode, n_name AS WorkCenterName, upper(shift) AS ProductionShiftCode, shift AS ProductionShiftName,
  {small('year(ts)')} AS CalendarYearNumber, {small('month(ts)')} AS CalendarMonthNumber, weekend AS IsWeekend,
  count(*) AS ConfirmationCount, count(DISTINCT event_id) AS DistinctWorkOrderCount,
  count(DISTINCT user_id) AS DistinctOperatorCount, count(*) AS TotalEventCount, {total('q')} AS TotalQuantityAmount,
  {total('m')} AS TotalDurationMinutes,
  {total('CAST(value AS DECIMAL(19,4))', 'DECIMAL(29,4)')} AS TotalCostAmount,
  {quotient(f"sum({units('q')})", f"sum({units('m')})", 18, 6)} AS QuantityPerMinute
FROM e GROUP BY n_name, shift, year(ts), month(ts), weekend
"""


@query("rp_throughput_shift", THROUGHPUT)
def rp_throughput_shift(spark, folder):
    return throughput_shift(manufacturing_warehouse(spark, folder), EVENTS_AS_OF)


_COUNTED = {
    "downtime_rank": DOWNTIME,
    "incident_trend": INCIDENT,
    "oee_plant_month": OEE,
    "quality_mix": QUALITY,
    # Looked at from the orders' day, every event is recent.
    "throughput_shift": THROUGHPUT.replace("2023-01-31", "2000-08-01"),
    "variance_line": VARIANCE,
}
RUN_ALL = " UNION ALL ".join(
    f"SELECT '{name}' AS name, (SELECT count(*) FROM ({sql}) x) AS row_count, 'Succeeded' AS status"
    for name, sql in _COUNTED.items()
)


@query("rp_run_all", RUN_ALL)
def rp_run_all(spark, folder):
    runs = run_reports(manufacturing_warehouse(spark, folder), AS_OF, list(_COUNTED))
    return runs.select("name", "row_count", "status")


@query("ct_timings", RUN_ALL.replace("'Succeeded' AS status", "'Succeeded' AS status, 1 AS batch"))
def ct_timings(spark, folder):
    root = scratch(spark, "control")
    runs = run_reports(manufacturing_warehouse(spark, folder), AS_OF, list(_COUNTED))
    append_control(spark, root, "QueryTiming", timings(runs, 1))
    kept = read_control(spark, root, "QueryTiming").filter("milliseconds >= 0 AND MeasuredAtUtc IS NOT NULL")
    return kept.select("name", "row_count", "status", F.col("BatchId").cast("int").alias("batch"))
