import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hoarfrost.operators import facts
from hoarfrost.operators.generate import date_dimension, time_dimension
from hoarfrost.sources import tables
from tests.conftest import rows
from tests.warehouse_fixture import MODEL

def now():
    return F.lit("2024-02-01").cast("timestamp_ntz")


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "Date": date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 1, 31)),
        "TimeOfDay": time_dimension(spark),
        "Product": spark.createDataFrame(
            [(1, "P1", False), (2, "P1", True), (3, "Gone", False)], "ProductKey int, ProductNumber string, IsCurrent boolean"
        ),
        "Operator": spark.createDataFrame([(7, "O1")], "OperatorKey int, OperatorNumber string"),
        "ProductStatus": spark.createDataFrame([(4, "ON")], "ProductStatusKey int, StatusCode string"),
    }


def staged(spark, batch, *data):
    schema = MODEL.staging_schema("ProductionOrder")
    full = [(f"W{i}", Decimal(q), o, c, t, p, lead, s, batch, i) for i, (q, o, c, t, p, lead, s) in enumerate(data, 1)]
    return spark.createDataFrame(full, schema)


DATA = (
    (1, 20240101, 20240111, 60, "P1", "O1", "ON"),
    (2, 20240101, -1, 61, "Gone", None, "OFF"),
    (3, 20230101, 20240105, None, None, "O9", "ON"),
    (4, 20240120, 20240110, 0, "none", "O1", None),
)


def test_plan_knows_roles():
    names = [c.name for c in MODEL.staging_columns("ProductionOrder")]
    assert "LeadOperatorOperatorNumber" in names and "StartTimeOfDayKey" in names
    plan = {p.column: p for p in facts.lookup_plan(MODEL, "ProductionOrder", names)}
    assert plan["LeadOperatorKey"].mode == "natural" and plan["ProductKey"].current_only
    assert plan["OrderDateKey"].mode == "key"
    short = {p.column: p.mode for p in facts.lookup_plan(MODEL, "ProductionOrder", ["OrderDateKey"])}
    assert short["LeadOperatorKey"] == "unset"


def test_load_fact(spark, dims):
    got = facts.load_fact(MODEL, "ProductionOrder", staged(spark, 5, *DATA), dims, 5, now(), highest=100)
    assert [f.name for f in got.schema.fields] == [c.name for c in MODEL["ProductionOrder"].all_columns()]
    assert rows(
        got, "ProductionOrderKey", "OrderDateKey", "CloseDateKey", "StartTimeOfDayKey", "ProductKey", "LeadOperatorKey",
        "ProductStatusKey", "ProductionOrderLagDays", "BatchId", "SourceSystemKey",
    ) == [
        (101, 20240101, 20240111, 60, 2, 7, 4, 10, 5, -1),
        (102, 20240101, -1, -1, -1, -1, -1, None, 5, -1),
        (103, -1, 20240105, -1, -1, -1, 4, None, 5, -1),
        (104, 20240120, 20240110, 0, -1, 7, -1, -10, 5, -1),
    ]


def test_misses_count_what_the_load_lost(spark, dims):
    stage = staged(spark, 5, *DATA)
    flagged = facts.load_fact(MODEL, "ProductionOrder", stage, dims, 5, now(), keep_misses=True)
    plan = facts.lookup_plan(MODEL, "ProductionOrder", stage.columns)
    misses = facts.lookup_misses(flagged, plan, "ProductionOrder")
    assert rows(misses, "rule", "checked", "failed") == [
        ("Missing lookup LeadOperatorKey", 4, 1),
        ("Missing lookup ProductKey", 4, 2),
        ("Missing lookup ProductStatusKey", 4, 1),
    ]


def test_replace_batch_is_safe_to_repeat(spark, dims, tmp_path):
    path = str(tmp_path / "fact")

    def load(batch, *data):
        fact = facts.load_fact(MODEL, "ProductionOrder", staged(spark, batch, *data), dims, batch, now())
        return tables.replace_batch(fact, path, batch, "OrderDateKey")

    schema = MODEL["ProductionOrder"].schema_type()
    table = lambda: rows(spark.read.schema(schema).parquet(path), "BatchId", "WorkOrderNumber", "OrderQuantity")
    assert load(1, *DATA) == 4 and load(2, *DATA[:2]) == 2
    once = table()
    assert load(1, *DATA) == 4 and table() == once
    assert load(1) == 0
    assert {r[0] for r in table()} == {2}


def test_bridge(spark, dims):
    schema = MODEL.staging_schema("ProductSubstitute")
    data = [(3, "P1", "none", 1, 3), (1, "P1", "none", 1, 1), (2, "P1", "P1", 1, 2), (9, None, "Gone", 1, 4)]
    got = facts.load_bridge(MODEL, "ProductSubstitute", spark.createDataFrame(data, schema), dims, 1, now())
    assert rows(got, "ProductSubstituteKey", "PrimaryProductKey", "SubstituteProductKey", "PreferenceRank") == [
        (1, 2, -1, 1), (2, 2, 2, 2), (4, -1, -1, 9)
    ]
