"""Model of the six report facts and the branches they climb."""

from __future__ import annotations

from hoarfrost.model import Column as C
from hoarfrost.model import ForeignKey as FK
from hoarfrost.model import TableSpec, WarehouseModel, hierarchy

# The event facts share four measures.
EVENT_MEASURES = (
    C("EventCount", "int", False, "sum"),
    C("QuantityAmount", "decimal(18,4)", True, "sum"),
    C("DurationMinutes", "decimal(18,4)", True, "sum"),
    C("CostAmount", "money", True, "sum"),
)

LOOKUPS = (
    TableSpec(
        "QualityResultStatus", "ref", (C("ResultStatusName", "nvarchar(120)"),), C("ResultStatusCode", "nvarchar(30)")
    ),
    TableSpec("MachineStateType", "ref", (C("StateTypeName", "nvarchar(120)"),), C("StateTypeCode", "nvarchar(30)")),
    TableSpec(
        "Severity",
        "ref",
        (C("SeverityName", "nvarchar(60)"), C("SeverityRank", "tinyint"), C("RequiresEscalation", "bit")),
        C("SeverityCode", "nvarchar(30)"),
    ),
    TableSpec(
        "FinanceVarianceType",
        "ref",
        (C("VarianceTypeName", "nvarchar(120)"), C("IsManufacturingVariance", "bit")),
        C("VarianceTypeCode", "nvarchar(30)"),
    ),
    TableSpec("UnitOfMeasure", "ref", (C("UomName", "nvarchar(60)"),), C("UomCode", "nvarchar(30)")),
)

# Severities by code, rank and escalation.
SEVERITIES = (("INFO", 1, False), ("LOW", 2, False), ("MEDIUM", 3, False), ("HIGH", 4, True), ("CRITICAL", 5, True))

CALENDAR = (
    TableSpec(
        "Date",
        "dim",
        (
            C("CalendarWeekKey", "int"), C("FiscalPeriodKey", "int"), C("YesNoFlagKey", "int"), C("FullDate", "date"),
            C("DayName", "nvarchar(20)"), C("DayOfWeekNumber", "tinyint"), C("IsoDayOfWeekNumber", "tinyint"),
            C("DayOfMonthNumber", "tinyint"), C("DayOfYearNumber", "smallint"), C("WeekOfYearNumber", "tinyint"),
            C("IsoWeekNumber", "tinyint"), C("CalendarMonthNumber", "tinyint"), C("CalendarMonthName", "nvarchar(20)"),
            C("CalendarMonthShortName", "nvarchar(10)"), C("CalendarQuarterNumber", "tinyint"),
            C("CalendarYearNumber", "smallint"), C("FiscalPeriodNumber", "tinyint"), C("FiscalQuarterNumber", "tinyint"),
            C("FiscalYearNumber", "smallint"), C("IsWeekend", "bit"), C("IsHoliday", "bit"), C("HolidayName", "nvarchar(80)"),
            C("JulianDayNumber", "int"), C("DaysFromToday", "int"), C("WeeksFromToday", "int"), C("MonthsFromToday", "int"),
            C("IsMonthEnd", "bit"), C("IsQuarterEnd", "bit"), C("IsYearEnd", "bit"),
        ),
        C("DateKey", "int"),
        explicit_key=True,
    ),
    TableSpec(
        "TimeOfDay",
        "dim",
        (
            C("ShiftCodeKey", "int"), C("TimeValue", "time(0)"), C("HourNumber", "tinyint"), C("MinuteNumber", "tinyint"),
            C("SecondNumber", "tinyint"), C("MinuteOfDayNumber", "smallint"), C("SecondOfDayNumber", "int"),
            C("AmPmCode", "char(2)"), C("HourBucketName", "nvarchar(40)"), C("ShiftBucketName", "nvarchar(40)"),
            C("IsBusinessHour", "bit"), C("DisplayTime", "nvarchar(20)"),
        ),
        C("TimeOfDayKey", "int"),
        explicit_key=True,
    ),
)

DIMENSIONS = (
    TableSpec(
        "Product",
        "dim",
        (
            C("ProductName", "nvarchar(200)"), C("ProductDescription", "nvarchar(500)"), C("DrawingNumber", "nvarchar(60)"),
            C("RevisionCode", "nvarchar(20)"), C("StandardCostAmount", "money"), C("ListPriceAmount", "money"),
            C("NetWeightValue", "decimal(18,4)"), C("GrossWeightValue", "decimal(18,4)"), C("ShelfLifeDays", "int"),
            C("LotTrackedFlag", "bit"), C("SerialTrackedFlag", "bit"), C("MakeBuyCode", "nvarchar(20)"),
        ),
        C("ProductNumber", "nvarchar(40)"),
        (FK("ProductSubfamily"), FK("Product", "Parent", True), FK("UnitOfMeasure")),
        scd=2,
    ),
    TableSpec("Plant", "dim", (C("PlantName", "nvarchar(160)"),), C("PlantCode", "nvarchar(40)"), scd=2),
    TableSpec(
        "WorkCenter", "dim", (C("WorkCenterName", "nvarchar(160)"), C("CapacityPerHourValue", "decimal(18,4)")),
        C("WorkCenterCode", "nvarchar(40)"), (FK("UnitOfMeasure"),), scd=2,
    ),
    TableSpec(
        "Machine", "dim", (C("MachineName", "nvarchar(200)"), C("ActiveFlag", "bit"), C("StandardValue", "decimal(18,4)")),
        C("MachineNumber", "nvarchar(40)"), (FK("WorkCenter"), FK("Plant")), scd=2,
    ),
    TableSpec(
        "MachineState", "dim", (C("MachineStateName", "nvarchar(200)"), C("ActiveFlag", "bit")),
        C("MachineStateCode", "nvarchar(40)"), (FK("MachineStateType"),),
    ),
    TableSpec(
        "ProductionShift", "dim", (C("ProductionShiftName", "nvarchar(200)"), C("ActiveFlag", "bit")),
        C("ProductionShiftCode", "nvarchar(40)"), (FK("Plant"),),
    ),
    TableSpec("Employee", "dim", (C("EmployeeName", "nvarchar(200)"),), C("EmployeeNumber", "nvarchar(40)"), scd=2),
    TableSpec(
        "ProductionWorkOrder", "dim", (C("WorkOrderName", "nvarchar(200)"),), C("WorkOrderNumber", "nvarchar(40)"),
        (FK("Product"), FK("Plant")), scd=2,
    ),
)

FACTS = (
    TableSpec(
        "OeePeriodicSnapshot", "fact", EVENT_MEASURES,
        foreign_keys=(
            FK("Machine"), FK("Product", nullable=True), FK("ProductionShift", nullable=True), FK("WorkCenter"),
            FK("Plant"), FK("UnitOfMeasure"),
        ),
        fact_kind="periodic", date_roles=("Snapshot",),
    ),
    TableSpec(
        "QualityInspectionResult", "fact",
        (C("SampleNumber", "nvarchar(40)"), C("ResultSequenceNumber", "int"), *EVENT_MEASURES),
        foreign_keys=(
            FK("Product"), FK("Plant"), FK("Employee", "Inspector", True), FK("QualityResultStatus"), FK("UnitOfMeasure"),
        ),
        date_roles=("Inspection",), time_roles=("Inspection",),
    ),
    TableSpec(
        "MachineStateEvent", "fact", (C("StateEventNumber", "nvarchar(40)"), *EVENT_MEASURES),
        foreign_keys=(
            FK("Machine"), FK("MachineState"), FK("WorkCenter"), FK("Plant"), FK("ProductionShift", nullable=True),
            FK("MachineStateType"),
        ),
        date_roles=("Start", "End"), time_roles=("Start", "End"),
    ),
    TableSpec(
        "SafetyIncident", "fact",
        (
            C("SafetyIncidentNumber", "nvarchar(40)"), C("InjuredPersonCount", "int", False, "sum"),
            C("LostWorkdayCount", "decimal(18,4)", False, "sum"), C("EstimatedCostAmount", "money", True, "sum"),
        ),
        foreign_keys=(
            FK("Plant"), FK("WorkCenter", nullable=True), FK("Employee", "Injured", True),
            FK("Employee", "Supervisor", True), FK("Severity"),
        ),
        fact_kind="accumulating", date_roles=("Occurred", "Reported", "Closed"), time_roles=("Occurred", "Reported"),
    ),
    TableSpec(
        "FinanceManufacturingVariance", "fact",
        (
            C("ProductionOrderNumber", "nvarchar(50)"), C("OperationSequenceNumber", "int"),
            C("StandardAmount", "money", False, "sum"), C("ActualAmount", "money", False, "sum"),
            C("VarianceAmount", "money", False, "sum"), C("VarianceQuantity", "decimal(18,4)", True, "sum"),
        ),
        foreign_keys=(FK("Product"), FK("Plant"), FK("WorkCenter", nullable=True), FK("FinanceVarianceType")),
        date_roles=("Posting", "Production"),
    ),
    TableSpec(
        "ProductionOperationConfirmation", "fact", (C("ConfirmationNumber", "nvarchar(40)"), *EVENT_MEASURES),
        foreign_keys=(
            FK("ProductionWorkOrder"), FK("Product"), FK("WorkCenter"), FK("Employee", "Operator", True),
            FK("ProductionShift"), FK("UnitOfMeasure"),
        ),
        date_roles=("Confirmation",), time_roles=("Confirmation",),
    ),
)

MODEL = WarehouseModel.of(
    *LOOKUPS,
    *CALENDAR,
    *hierarchy("ProductDivision", "ProductLine", "ProductFamily", "ProductSubfamily"),
    *DIMENSIONS,
    *FACTS,
)
