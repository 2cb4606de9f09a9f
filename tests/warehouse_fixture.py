"""A small warehouse for tests: hierarchy, lookups, a versioned leaf, a bridge and facts."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoarfrost.functions.scalars import date_key
from hoarfrost.model import Column as C
from hoarfrost.model import ForeignKey as FK
from hoarfrost.model import TableSpec, WarehouseModel, hierarchy
from hoarfrost.plans.manufacturing import CALENDAR

MODEL = WarehouseModel.of(
    *CALENDAR,
    TableSpec("UnitOfMeasure", "ref", (C("UnitOfMeasureName", "nvarchar(60)"),), C("UnitOfMeasureCode", "nvarchar(20)")),
    TableSpec("ProductStatus", "ref", (C("StatusName", "nvarchar(60)"),), C("StatusCode", "nvarchar(20)")),
    *hierarchy("ProductDivision", "ProductLine", "ProductFamily"),
    TableSpec(
        "Product", "dim", (C("ProductName", "nvarchar(200)"),), C("ProductNumber", "nvarchar(40)"),
        (FK("ProductFamily"), FK("UnitOfMeasure"), FK("ProductStatus"), FK("Product", "Parent", True)), scd=2,
    ),
    TableSpec("Operator", "dim", (C("OperatorName", "nvarchar(60)"),), C("OperatorNumber", "nvarchar(20)")),
    TableSpec(
        "ProductSubstitute", "bridge", (C("PreferenceRank", "int"),),
        foreign_keys=(FK("Product", "Primary", member=True), FK("Product", "Substitute", member=True)),
    ),
    TableSpec(
        "ProductionOrder", "fact",
        (C("WorkOrderNumber", "nvarchar(30)"), C("OrderQuantity", "decimal(18,4)", False, "sum")),
        foreign_keys=(FK("Product"), FK("Operator", "Lead", True), FK("ProductStatus")),
        fact_kind="accumulating", date_roles=("Order", "Close"), time_roles=("Start",),
    ),
)


def filled(spark: SparkSession, spec: TableSpec, size: int, parents: dict[str, int], last: dt.date, days: int) -> DataFrame:
    """Rows of any table: keys from 1, parents among the first `parents[name]` keys (now and
    then none), dates within `days` of the last one, and values drawn by hash."""
    keys = {fk.column: fk for fk in spec.references}

    def value(c: C):
        drawn = F.pmod(F.xxhash64(F.lit(c.name), "id"), F.lit(1000))
        base = c.type.partition("(")[0]
        if c.name == spec.key:
            return F.col("id")
        if c.name in keys and keys[c.name].parent == "Date":
            return date_key(F.date_sub(F.lit(last), (drawn % days).cast("int")))
        if c.name in keys and keys[c.name].parent == "TimeOfDay":
            return drawn * 60
        if c.name in keys:
            known = parents.get(keys[c.name].parent, 0)
            return F.when(F.col("id") % 17 == 0, -1).otherwise(drawn % known + 1) if known else F.lit(-1)
        if base == "bit":
            return drawn % 5 > 0
        if base in ("nvarchar", "char"):
            return F.concat(F.lit(c.name[:4]), F.col("id").cast("string"))
        if base in ("date", "datetime2"):
            return F.lit("9999-12-31" if c.name.startswith("EffectiveTo") else last.isoformat())
        if base in ("binary", "varbinary"):
            return F.unhex(F.sha2(F.col("id").cast("string"), 256))
        return F.lit(1) if c.name == "BatchId" else drawn % 100

    return spark.range(1, size + 1).select(*[value(c).cast(c.spark_type).alias(c.name) for c in spec.all_columns()])
