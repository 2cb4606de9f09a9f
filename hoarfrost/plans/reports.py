"""The fixed reports, and the registry by which users add their own.

A report is a function of a warehouse and a day. Versioned dimensions are not filtered to
their current rows: a fact row points at the version of its time, and history stays whole.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import count_where, decimal_average, months_before, ratio, wide_sum
from hoarfrost.operators.aggregates import sort_by_expression, top_ranked, with_share
from hoarfrost.operators.filters import RAW_DATE, bounded, flagged, rolling_months
from hoarfrost.operators.joins import BroadcastBudget, climb, sized_join, star_join
from hoarfrost.plans.warehouse import Warehouse

Report = Callable[[Warehouse, dt.date], DataFrame]
REPORTS: dict[str, Report] = {}


def report(name: str) -> Callable[[Report], Report]:
    """Register a report under a name."""

    def add(fn: Report) -> Report:
        REPORTS[name] = fn
        return fn

    return add


def _window(wh: Warehouse, fact: str, date_column: str, months: int, as_of: dt.date, *columns: str) -> DataFrame:
    """The fact's rows of the last months, read down to the columns the report uses."""
    df = bounded(wh, fact, date_column, int(f"{months_before(as_of, months):%Y%m%d}"), None)
    keep = [date_column, f"{date_column}{RAW_DATE}", *columns]
    return rolling_months(df.select(*[c for c in keep if c in df.columns]), date_column, months, as_of)


def _calendar(wh: Warehouse, *columns: str) -> DataFrame:
    return wh["Date"].select("DateKey", *columns)


@report("oee_plant_month")
def oee_plant_month(wh: Warehouse, as_of: dt.date) -> DataFrame:
    """Equipment effectiveness by plant and month over 24 months."""
    fact = _window(
        wh, "OeePeriodicSnapshot", "SnapshotDateKey", 24, as_of,
        "PlantKey", "MachineKey", "ProductKey", "EventCount", "QuantityAmount", "DurationMinutes", "CostAmount",
    )
    joined = star_join(
        fact,
        {
            "SnapshotDateKey": (
                _calendar(wh, "CalendarYearNumber", "CalendarMonthNumber", "CalendarMonthShortName"), "DateKey"
            ),
            "PlantKey": (wh["Plant"].select("PlantKey", "PlantCode", "PlantName"), "PlantKey"),
        },
    )
    # A month has one name, so the name is a key: a maximum over text would make Spark sort
    # all rows instead of hashing them.
    labelled = joined.withColumnRenamed("CalendarMonthShortName", "CalendarMonthName")
    grouped = labelled.groupBy(
        "PlantCode", "PlantName", "CalendarYearNumber", "CalendarMonthNumber", "CalendarMonthName"
    ).agg(
        F.count("*").alias("SnapshotCount"),
        F.countDistinct("MachineKey").alias("DistinctMachineCount"),
        F.countDistinct("ProductKey").alias("DistinctProductCount"),
        wide_sum("EventCount").alias("TotalEventCount"),
        F.sum("QuantityAmount").alias("TotalQuantityAmount"),
        F.sum("DurationMinutes").alias("TotalDurationMinutes"),
        F.avg("DurationMinutes").alias("AvgDurationMinutes"),
        F.sum("CostAmount").alias("TotalCostAmount"),
    )
    return grouped.orderBy(F.desc("CalendarYearNumber"), F.desc("CalendarMonthNumber"), "PlantCode", "PlantName")


@report("quality_mix")
def quality_mix(wh: Warehouse, as_of: dt.date) -> DataFrame:
    """Inspection results by product family, and each result's share of its family."""
    fact = _window(
        wh, "QualityInspectionResult", "InspectionDateKey", 12, as_of,
        "ProductKey", "QualityResultStatusKey", "QuantityAmount", "DurationMinutes",
    )
    family = product_branch(wh, "ProductSubfamily", "ProductFamily")
    # The product key is counted after the climb, so it is carried beside the join key.
    budget = BroadcastBudget()
    rows = sized_join(
        fact.withColumn("__product", F.col("ProductKey")), family, {"ProductKey": "ProductKey"}, size_from=wh["Product"], budget=budget
    )
    rows = sized_join(
        rows,
        wh["QualityResultStatus"].select("QualityResultStatusKey", "ResultStatusCode", "ResultStatusName"),
        {"QualityResultStatusKey": "QualityResultStatusKey"},
        skew_from=fact,
        budget=budget,
    )
    rows = sized_join(rows, _calendar(wh), {"InspectionDateKey": "DateKey"}, "left_semi", skew_from=fact)
    grouped = rows.groupBy("ProductFamilyCode", "ProductFamilyName", "ResultStatusCode", "ResultStatusName").agg(
        F.count("*").alias("InspectionCount"),
        F.sum("QuantityAmount").alias("InspectedQuantity"),
        F.avg("DurationMinutes").alias("AvgInspectionMinutes"),
        F.countDistinct("__product").alias("DistinctProductCount"),
    )
    shared = with_share(
        grouped, "InspectionCount", ["ProductFamilyCode"], "FamilyInspectionCount", "PercentOfFamily"
    )
    return shared.orderBy("ProductFamilyCode", F.desc("InspectionCount"), "ProductFamilyName", "ResultStatusCode", "ResultStatusName")


def product_branch(wh: Warehouse, *levels: str) -> DataFrame:
    """Products with the codes and names of the last levels reports group by."""
    shown = {"ProductFamily", "ProductLine", "ProductDivision"} & set(levels[-2:] if len(levels) > 2 else levels[-1:])
    chain = []
    for n, level in enumerate(levels):
        up = [f"{levels[n + 1]}Key"] if n + 1 < len(levels) else []
        labels = [f"{level}Code", f"{level}Name"] if level in shown else []
        chain.append((f"{level}Key", wh[level].select(f"{level}Key", *up, *labels), f"{level}Key"))
    products = wh["Product"].select("ProductKey", f"{levels[0]}Key")
    return climb(products, chain).drop(*[f"{level}Key" for level in levels])


@report("downtime_rank")
def downtime_rank(wh: Warehouse, as_of: dt.date) -> DataFrame:
    """The 100 machine states with most downtime in six months, ranked within their plant."""
    fact = _window(
        wh, "MachineStateEvent", "StartDateKey", 6, as_of,
        "MachineKey", "PlantKey", "MachineStateKey", "MachineStateTypeKey", "DurationMinutes", "CostAmount",
    )
    rows = sized_join(fact, _calendar(wh), {"StartDateKey": "DateKey"}, "left_semi")
    joined = star_join(
        rows,
        {
            "MachineKey": (wh["Machine"].select("MachineKey", "MachineNumber", "MachineName"), "MachineKey"),
            "PlantKey": (wh["Plant"].select("PlantKey", "PlantCode"), "PlantKey"),
            "MachineStateKey": (wh["MachineState"].select("MachineStateKey", "MachineStateName"), "MachineStateKey"),
            "MachineStateTypeKey": (
                wh["MachineStateType"].select("MachineStateTypeKey", "StateTypeName"), "MachineStateTypeKey"
            ),
        },
    )
    group = ["PlantCode", "MachineNumber", "MachineName", "MachineStateName", "StateTypeName"]
    grouped = joined.groupBy(*group).agg(
        F.count("*").alias("StateEventCount"),
        F.sum("DurationMinutes").alias("TotalDownMinutes"),
        F.avg("DurationMinutes").alias("AvgDownMinutes"),
        F.max("DurationMinutes").alias("LongestDownMinutes"),
        F.sum("CostAmount").alias("TotalCostAmount"),
    )
    ranked = top_ranked(grouped, ["PlantCode"], "TotalDownMinutes", group, 100, "PlantDowntimeRank")
    return ranked.orderBy(F.desc("TotalDownMinutes"), *group)


@report("incident_trend")
def incident_trend(wh: Warehouse, as_of: dt.date) -> DataFrame:
    """Safety incidents by plant, month and severity over 24 months."""
    fact = _window(
        wh, "SafetyIncident", "OccurredDateKey", 24, as_of,
        "PlantKey", "SeverityKey", "InjuredPersonCount", "LostWorkdayCount", "EstimatedCostAmount", "SafetyIncidentLagDays",
    )
    joined = star_join(
        fact,
        {
            "OccurredDateKey": (_calendar(wh, "CalendarYearNumber", "CalendarMonthNumber"), "DateKey"),
            "PlantKey": (wh["Plant"].select("PlantKey", "PlantCode", "PlantName"), "PlantKey"),
            "SeverityKey": (
                wh["Severity"].select("SeverityKey", "SeverityCode", "SeverityName", "SeverityRank", "RequiresEscalation"),
                "SeverityKey",
            ),
        },
    )
    group = ["PlantCode", "PlantName", "CalendarYearNumber", "CalendarMonthNumber", "SeverityCode", "SeverityName"]
    grouped = (
        joined.withColumnRenamed("SeverityRank", "__rank")
        .groupBy(*group)
        .agg(
            F.max("__rank").alias("SeverityRank"),
            F.count("*").alias("IncidentCount"),
            wide_sum("InjuredPersonCount").alias("InjuredPersonCount"),
            F.sum("LostWorkdayCount").alias("LostWorkdayCount"),
            F.sum("EstimatedCostAmount").alias("EstimatedCostAmount"),
            decimal_average("SafetyIncidentLagDays").alias("AvgReportingLagDays"),
            count_where(F.col("RequiresEscalation")).alias("EscalatedIncidentCount"),
        )
        .filter(F.col("IncidentCount") > 0)
    )
    return grouped.orderBy(
        F.desc("CalendarYearNumber"), F.desc("CalendarMonthNumber"), F.desc("SeverityRank"), "PlantCode",
        "PlantName", "SeverityCode", "SeverityName",
    )


@report("variance_line")
def variance_line(wh: Warehouse, as_of: dt.date) -> DataFrame:
    """Manufacturing cost variance by product division and line over 18 months."""
    fact = _window(
        wh, "FinanceManufacturingVariance", "PostingDateKey", 18, as_of,
        "ProductKey", "PlantKey", "FinanceVarianceTypeKey", "StandardAmount", "ActualAmount", "VarianceAmount",
    )
    kinds = flagged(
        wh["FinanceVarianceType"].select(
            "FinanceVarianceTypeKey", "VarianceTypeCode", "VarianceTypeName", "IsManufacturingVariance"
        ),
        "IsManufacturingVariance",
    ).drop("IsManufacturingVariance")
    # The flag is the most selective join, so it comes first.
    rows = sized_join(fact, kinds, {"FinanceVarianceTypeKey": "FinanceVarianceTypeKey"})
    rows = sized_join(
        rows, _calendar(wh, "CalendarYearNumber", "CalendarQuarterNumber"), {"PostingDateKey": "DateKey"}, skew_from=fact
    )
    line = product_branch(wh, "ProductSubfamily", "ProductFamily", "ProductLine", "ProductDivision")
    rows = sized_join(
        rows.withColumn("__product", F.col("ProductKey")), line, {"ProductKey": "ProductKey"},
        size_from=wh["Product"], skew_from=fact, budget=BroadcastBudget(),
    )
    group = [
        "ProductDivisionCode", "ProductDivisionName", "ProductLineCode", "ProductLineName",
        "VarianceTypeCode", "VarianceTypeName", "CalendarYearNumber", "CalendarQuarterNumber",
    ]
    grouped = rows.groupBy(*group).agg(
        F.count("*").alias("PostingCount"),
        F.countDistinct("__product").alias("DistinctProductCount"),
        F.countDistinct("PlantKey").alias("DistinctPlantCount"),
        F.sum("StandardAmount").alias("StandardAmount"),
        F.sum("ActualAmount").alias("ActualAmount"),
        F.sum("VarianceAmount").alias("VarianceAmount"),
    )
    shaped = grouped.withColumn(
        "VariancePercentOfStandard", ratio(F.col("VarianceAmount"), F.col("StandardAmount"), 18, 4, percent=True)
    )
    return sort_by_expression(shaped, F.abs("VarianceAmount"), *[F.asc(c) for c in group])


@report("throughput_shift")
def throughput_shift(wh: Warehouse, as_of: dt.date) -> DataFrame:
    """Production throughput by work center, shift, month and weekend over 12 months."""
    fact = _window(
        wh, "ProductionOperationConfirmation", "ConfirmationDateKey", 12, as_of,
        "WorkCenterKey", "ProductionShiftKey", "ProductionWorkOrderKey", "OperatorEmployeeKey",
        "EventCount", "QuantityAmount", "DurationMinutes", "CostAmount",
    )
    joined = star_join(
        fact,
        {
            "ConfirmationDateKey": (_calendar(wh, "CalendarYearNumber", "CalendarMonthNumber", "IsWeekend"), "DateKey"),
            "WorkCenterKey": (wh["WorkCenter"].select("WorkCenterKey", "WorkCenterCode", "WorkCenterName"), "WorkCenterKey"),
            "ProductionShiftKey": (
                wh["ProductionShift"].select("ProductionShiftKey", "ProductionShiftCode", "ProductionShiftName"),
                "ProductionShiftKey",
            ),
        },
    )
    group = [
        "WorkCenterCode", "WorkCenterName", "ProductionShiftCode", "ProductionShiftName",
        "CalendarYearNumber", "CalendarMonthNumber", "IsWeekend",
    ]
    grouped = joined.groupBy(*group).agg(
        F.count("*").alias("ConfirmationCount"),
        F.countDistinct("ProductionWorkOrderKey").alias("DistinctWorkOrderCount"),
        F.countDistinct("OperatorEmployeeKey").alias("DistinctOperatorCount"),
        wide_sum("EventCount").alias("TotalEventCount"),
        F.sum("QuantityAmount").alias("TotalQuantityAmount"),
        F.sum("DurationMinutes").alias("TotalDurationMinutes"),
        F.sum("CostAmount").alias("TotalCostAmount"),
    )
    shaped = grouped.withColumn(
        "QuantityPerMinute", ratio(F.col("TotalQuantityAmount"), F.col("TotalDurationMinutes"), 18, 6)
    )
    return shaped.orderBy(F.desc("CalendarYearNumber"), F.desc("CalendarMonthNumber"), F.desc("TotalQuantityAmount"), *group)


def run_reports(wh: Warehouse, as_of: dt.date, names: list[str] | None = None) -> DataFrame:
    """Run registered reports in name order and return rows, time and status of each.

    Each report is computed in full on the cluster and its rows are counted there; none is
    fetched. A report that fails is recorded, and the rest go on.
    """
    rows = []
    for name in sorted(REPORTS if names is None else names):
        started = time.perf_counter()
        try:
            seen = Observation(f"report_{name}")
            out = REPORTS[name](wh, as_of).observe(seen, F.count(F.lit(1)).alias("n"))
            out.write.format("noop").mode("overwrite").save()
            rows.append((name, int(seen.get["n"]), "Succeeded", None))
        except Exception as error:  # a broken report must not stop the others
            rows.append((name, None, "Failed", str(error)[:4000]))
        rows[-1] = (*rows[-1], (time.perf_counter() - started) * 1000)
    return wh.spark.createDataFrame(rows, "name string, row_count bigint, status string, message string, milliseconds double")


def timings(runs: DataFrame, batch_id: int) -> DataFrame:
    """Run results in the shape of the timing control table."""
    return runs.select(
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        "name",
        "row_count",
        "milliseconds",
        "status",
        F.current_timestamp().cast("timestamp_ntz").alias("MeasuredAtUtc"),
    )
