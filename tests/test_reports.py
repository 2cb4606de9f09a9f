"""The fixed reports on a generated warehouse of their own shape, against plain SQL."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import months_before
from hoarfrost.operators.generate import date_dimension, time_dimension
from hoarfrost.operators.keys import with_unknown
from hoarfrost.plans import reports
from hoarfrost.plans.check_sql import average, quotient, share, units
from hoarfrost.plans.manufacturing import MODEL, SEVERITIES
from hoarfrost.plans.warehouse import Warehouse
from hoarfrost.sources import tables
from tests.compare import plain
from tests.warehouse_fixture import filled

AS_OF = dt.date(2026, 8, 24)
DIMS = (
    "QualityResultStatus", "MachineStateType", "FinanceVarianceType", "ProductDivision", "ProductLine", "ProductFamily",
    "ProductSubfamily", "Plant", "Product", "WorkCenter", "Machine", "MachineState", "ProductionShift",
)
FACTS = tuple(t.name for t in MODEL.of_kind("fact"))


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    made = {
        "Date": date_dimension(spark, dt.date(2025, 1, 1), dt.date(2026, 12, 31), AS_OF),
        "TimeOfDay": time_dimension(spark),
        "Severity": spark.createDataFrame(
            [(n, c, c.title(), r, e) for n, (c, r, e) in enumerate(SEVERITIES, 1)],
            "SeverityKey int, SeverityCode string, SeverityName string, SeverityRank smallint, RequiresEscalation boolean",
        ),
    }
    sizes = {"Severity": len(SEVERITIES)}
    for n, name in enumerate((*DIMS, *FACTS)):
        spec = MODEL[name]
        size = 300 if spec.kind == "fact" else 3 + n
        df = filled(spark, spec, size, sizes, AS_OF, 600)
        sizes[name] = size
        if spec.kind == "fact":
            tables.replace_batch(df, f"{root}/{name}", 1, f"{spec.date_roles[0]}DateKey")
            made[name] = spark.read.schema(spec.schema_type()).parquet(f"{root}/{name}")
            continue
        tables.write_version(with_unknown(df, spec), f"{root}/{name}", 1)
        made[name] = tables.read_version(spark, f"{root}/{name}", schema=spec.schema_type())
    for name in ("Date", "TimeOfDay", "Severity"):
        tables.write_version(made[name], f"{root}/{name}", 1)
    con = duckdb.connect()
    for name in made:
        pattern = f"{root}/{name}/BatchId=1/*.parquet" if name in FACTS else f"{root}/{name}/v=1/*.parquet"
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM read_parquet(\'{pattern}\', hive_partitioning=false)')
    return Warehouse(spark, MODEL, made), con


SQL = {
    "oee_plant_month": (
        24,
        f"""SELECT PlantCode, PlantName, CalendarYearNumber, CalendarMonthNumber, max(CalendarMonthShortName) AS CalendarMonthName,
          count(*) AS SnapshotCount, count(DISTINCT f.MachineKey) AS DistinctMachineCount, count(DISTINCT f.ProductKey) AS DistinctProductCount,
          sum(EventCount) AS TotalEventCount, sum(QuantityAmount) AS TotalQuantityAmount, sum(DurationMinutes) AS TotalDurationMinutes,
          {average('DurationMinutes')} AS AvgDurationMinutes, sum(CostAmount) AS TotalCostAmount
        FROM OeePeriodicSnapshot f JOIN "Date" d ON DateKey = SnapshotDateKey JOIN Plant p ON p.PlantKey = f.PlantKey
        WHERE FullDate >= $since GROUP BY ALL""",
    ),
    "quality_mix": (
        12,
        f"""WITH i AS (SELECT ProductFamilyCode, ProductFamilyName, ResultStatusCode, ResultStatusName, count(*) AS InspectionCount,
            sum(QuantityAmount) AS InspectedQuantity, {average('DurationMinutes')} AS AvgInspectionMinutes, count(DISTINCT f.ProductKey) AS DistinctProductCount
          FROM QualityInspectionResult f JOIN "Date" ON DateKey = InspectionDateKey JOIN Product p ON p.ProductKey = f.ProductKey
            JOIN ProductSubfamily s ON s.ProductSubfamilyKey = p.ProductSubfamilyKey JOIN ProductFamily y ON y.ProductFamilyKey = s.ProductFamilyKey
            JOIN QualityResultStatus q ON q.QualityResultStatusKey = f.QualityResultStatusKey WHERE FullDate >= $since GROUP BY ALL),
          t AS (SELECT ProductFamilyCode AS c, CAST(sum(InspectionCount) AS BIGINT) AS n FROM i GROUP BY 1)
        SELECT i.*, n AS FamilyInspectionCount, {share('InspectionCount', 'n')} AS PercentOfFamily
        FROM i JOIN t ON c = ProductFamilyCode""",
    ),
    "downtime_rank": (
        6,
        f"""WITH g AS (SELECT PlantCode, MachineNumber, MachineName, MachineStateName, StateTypeName, count(*) AS StateEventCount,
            sum(DurationMinutes) AS TotalDownMinutes, {average('DurationMinutes')} AS AvgDownMinutes, max(DurationMinutes) AS LongestDownMinutes,
            sum(CostAmount) AS TotalCostAmount
          FROM MachineStateEvent f JOIN "Date" ON DateKey = StartDateKey JOIN Machine m ON m.MachineKey = f.MachineKey
            JOIN Plant p ON p.PlantKey = f.PlantKey JOIN MachineState s ON s.MachineStateKey = f.MachineStateKey
            JOIN MachineStateType t ON t.MachineStateTypeKey = f.MachineStateTypeKey WHERE FullDate >= $since GROUP BY ALL)
        SELECT *, dense_rank() OVER (PARTITION BY PlantCode ORDER BY TotalDownMinutes DESC) AS PlantDowntimeRank
        FROM g ORDER BY TotalDownMinutes DESC, PlantCode, MachineNumber, MachineName, MachineStateName, StateTypeName LIMIT 100""",
    ),
    "incident_trend": (
        24,
        f"""SELECT PlantCode, PlantName, CalendarYearNumber, CalendarMonthNumber, SeverityCode, SeverityName, max(SeverityRank) AS SeverityRank,
          count(*) AS IncidentCount, sum(InjuredPersonCount) AS InjuredPersonCount, sum(LostWorkdayCount) AS LostWorkdayCount,
          sum(EstimatedCostAmount) AS EstimatedCostAmount, {average('SafetyIncidentLagDays', scale_in=0)} AS AvgReportingLagDays,
          sum(CASE WHEN RequiresEscalation THEN 1 ELSE 0 END) AS EscalatedIncidentCount
        FROM SafetyIncident f JOIN "Date" ON DateKey = OccurredDateKey JOIN Plant p ON p.PlantKey = f.PlantKey
          JOIN Severity v ON v.SeverityKey = f.SeverityKey WHERE FullDate >= $since GROUP BY ALL HAVING count(*) > 0""",
    ),
    "variance_line": (
        18,
        f"""SELECT ProductDivisionCode, ProductDivisionName, ProductLineCode, ProductLineName, VarianceTypeCode, VarianceTypeName,
          CalendarYearNumber, CalendarQuarterNumber, count(*) AS PostingCount, count(DISTINCT f.ProductKey) AS DistinctProductCount,
          count(DISTINCT f.PlantKey) AS DistinctPlantCount, sum(StandardAmount) AS StandardAmount, sum(ActualAmount) AS ActualAmount,
          sum(VarianceAmount) AS VarianceAmount, {quotient(f"sum({units('VarianceAmount')})", f"sum({units('StandardAmount')})", 18, 4, 100)} AS VariancePercentOfStandard
        FROM FinanceManufacturingVariance f JOIN "Date" ON DateKey = PostingDateKey JOIN Product p ON p.ProductKey = f.ProductKey
          JOIN ProductSubfamily s ON s.ProductSubfamilyKey = p.ProductSubfamilyKey JOIN ProductFamily y ON y.ProductFamilyKey = s.ProductFamilyKey
          JOIN ProductLine l ON l.ProductLineKey = y.ProductLineKey JOIN ProductDivision x ON x.ProductDivisionKey = l.ProductDivisionKey
          JOIN FinanceVarianceType t ON t.FinanceVarianceTypeKey = f.FinanceVarianceTypeKey
        WHERE FullDate >= $since AND IsManufacturingVariance GROUP BY ALL""",
    ),
    "throughput_shift": (
        12,
        f"""SELECT WorkCenterCode, WorkCenterName, ProductionShiftCode, ProductionShiftName, CalendarYearNumber, CalendarMonthNumber, IsWeekend,
          count(*) AS ConfirmationCount, count(DISTINCT f.ProductionWorkOrderKey) AS DistinctWorkOrderCount,
          count(DISTINCT f.OperatorEmployeeKey) AS DistinctOperatorCount, sum(EventCount) AS TotalEventCount, sum(QuantityAmount) AS TotalQuantityAmount,
          sum(DurationMinutes) AS TotalDurationMinutes, sum(CostAmount) AS TotalCostAmount,
          {quotient(f"sum({units('QuantityAmount')})", f"sum({units('DurationMinutes')})", 18, 6)} AS QuantityPerMinute
        FROM ProductionOperationConfirmation f JOIN "Date" ON DateKey = ConfirmationDateKey JOIN WorkCenter w ON w.WorkCenterKey = f.WorkCenterKey
          JOIN ProductionShift h ON h.ProductionShiftKey = f.ProductionShiftKey WHERE FullDate >= $since GROUP BY ALL""",
    ),
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_report(warehouse, name):
    wh, con = warehouse
    months, sql = SQL[name]
    since = months_before(AS_OF, months)
    relation = con.execute(sql, {"since": since})
    columns = [c[0] for c in relation.description]
    got = reports.REPORTS[name](wh, AS_OF)
    assert set(got.columns) == set(columns)
    ours = sorted([str(plain(v)) for v in r] for r in got.select(*columns).collect())
    theirs = sorted([str(plain(v)) for v in r] for r in relation.fetchall())
    assert ours and ours == theirs


def test_order_of_a_report(warehouse):
    got = reports.variance_line(warehouse[0], AS_OF).select("VarianceAmount").collect()
    sizes = [abs(r[0]) for r in got]
    assert sizes == sorted(sizes, reverse=True)


def test_one_failure_does_not_stop_the_rest(warehouse):
    @reports.report("broken")
    def broken(wh, as_of):
        return wh["Date"].select(F.raise_error(F.lit("no")))

    @reports.report("tiny")
    def tiny(wh, as_of):
        return wh["Date"].limit(2)

    try:
        got = {r.name: r for r in reports.run_reports(warehouse[0], AS_OF, ["tiny", "broken", "oee_plant_month"]).collect()}
    finally:
        del reports.REPORTS["broken"], reports.REPORTS["tiny"]
    assert (got["broken"].status, got["tiny"].status, got["tiny"].row_count) == ("Failed", "Succeeded", 2)
    assert got["oee_plant_month"].row_count > 0 and got["tiny"].milliseconds > 0


def test_stored_warehouse_pushes_the_window_to_the_scan(spark, warehouse, tmp_path):
    wh, _ = warehouse
    root = str(tmp_path)
    tables.replace_batch(wh["OeePeriodicSnapshot"].drop("BatchId"), f"{root}/OeePeriodicSnapshot", 1)
    for name in ("Date", "Plant"):
        tables.write_version(wh[name], f"{root}/{name}", 1)
    stored = Warehouse.stored(spark, MODEL, root)
    plan = reports.oee_plant_month(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "SnapshotDateKey" in line)
    assert "GreaterThanOrEqual(SnapshotDateKey,20240824)" in scan
    assert "LoadedAtUtc" not in scan and "WorkCenterKey" not in scan
    assert plan.count("BroadcastHashJoin") == 2 and "CartesianProduct" not in plan and "SortAggregate" not in plan
