import datetime as dt
import random
from decimal import Decimal

import pytest

from hoarfrost.model import Column as C
from hoarfrost.model import ForeignKey as FK
from hoarfrost.model import TableSpec, WarehouseModel
from hoarfrost.operators import flatten as fl
from hoarfrost.operators import joins as jn
from hoarfrost.operators import rollup as ru
from tests.conftest import rows
from tests.warehouse_fixture import MODEL


@pytest.fixture(scope="module")
def tables(spark):
    mk = spark.createDataFrame
    return {
        "Product": mk(
            [(1, "P1", 10, 1, 1, None), (2, "P2", 11, 1, 2, 1), (3, "P3", 99, 2, 1, 1)],
            "ProductKey int, ProductNumber string, ProductFamilyKey int, UnitOfMeasureKey int, ProductStatusKey int, ParentProductKey int",
        ),
        "ProductFamily": mk([(10, "F10", "Fam10", 20), (11, "F11", "Fam11", 21)],
                            "ProductFamilyKey int, ProductFamilyCode string, ProductFamilyName string, ProductLineKey int"),
        "ProductLine": mk([(20, "L20", "Line20", 30), (21, "L21", "Line21", 30)],
                          "ProductLineKey int, ProductLineCode string, ProductLineName string, ProductDivisionKey int"),
        "ProductDivision": mk([(30, "D30", "Div30")], "ProductDivisionKey int, ProductDivisionCode string, ProductDivisionName string"),
        "UnitOfMeasure": mk([(1, "EA", "Each"), (2, "KG", "Kilo")], "UnitOfMeasureKey int, UnitOfMeasureCode string, UnitOfMeasureName string"),
        "ProductStatus": mk([(1, "ON", "On"), (2, "OFF", "Off")], "ProductStatusKey int, StatusCode string, StatusName string"),
        "ProductionOrder": mk(
            [(1, 20240105, 1, Decimal(5)), (1, 20240106, 1, Decimal(7)), (2, 20240107, 2, Decimal(1)), (2, 20200101, 3, Decimal(100)), (0, 20240101, 1, Decimal(9))],
            "BatchId long, OrderDateKey int, ProductKey int, OrderQuantity decimal(18,4)",
        ),
    }


def test_branch_order_and_names():
    found = fl.branches(MODEL, "Product")
    assert [(b.parent, b.child) for b in found] == [
        ("ProductStatus", 0), ("UnitOfMeasure", 0), ("ProductFamily", 0), ("ProductLine", 3), ("ProductDivision", 4)
    ]
    names = [n for b in found for _, n in b.outputs]
    assert names[0] == "ProductStatus_StatusCode"
    assert names[-1] == "ProductFamily_ProductLine_ProductDivision_ProductDivisionName"


def test_flatten_keeps_leaf_rows(tables):
    got = fl.flatten(MODEL, tables, "Product")
    assert got.columns[:6] == tables["Product"].columns and len(got.columns) == 6 + 10
    assert rows(got, "ProductNumber", "ProductFamily_ProductLine_ProductDivision_ProductDivisionCode", "UnitOfMeasure_UnitOfMeasureCode") == [
        ("P1", "D30", "EA"), ("P2", "D30", "EA"), ("P3", None, "KG")
    ]


def test_flatten_joins_only_what_is_asked_for(tables, monkeypatch):
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", 2**80)
    assert joins(fl.flatten(MODEL, tables, "Product", ["ProductNumber"])) == 0
    one = fl.flatten(MODEL, tables, "Product", ["ProductNumber", "ProductFamily_ProductLine_ProductLineName"])
    assert joins(one) == 2 and one.columns == ["ProductNumber", "ProductFamily_ProductLine_ProductLineName"]
    assert {b.parent for b in fl._needed(fl.branches(MODEL, "Product"), set(one.columns))} == {"ProductFamily", "ProductLine"}


def test_names_are_cut_and_unique():
    used: set[str] = set()
    long = "R" * 200
    first, second = fl.role_alias(long, "Code", used), fl.role_alias(long, "Code", used)
    assert len(first) == len(second) == 128 and first != second and second.endswith("_2")


def test_column_cap():
    capped = fl.branches(MODEL, "Product", max_columns=len(MODEL["Product"].all_columns()) + 3)
    assert sum(len(b.outputs) for b in capped) == 3


def test_views(spark, tables):
    made = fl.flatten_all(MODEL, {k: v for k, v in tables.items() if k != "ProductionOrder"}, spark)
    assert made == ["vwDimProduct"] and spark.table("vwDimProduct").count() == 3


def test_branch_path(tables):
    path = ru.branch_path(MODEL, "ProductionOrder", "ProductKey", ("ProductFamily", "ProductLine"))
    assert [(e.child, e.parent) for e in path] == [("ProductionOrder", "Product"), ("Product", "ProductFamily"), ("ProductFamily", "ProductLine")]
    for bad in (("NoKey", ()), ("ProductKey", ("ProductLine",)), ("ProductKey", ("Product",)),
                ("ProductKey", ("ProductFamily", "ProductLine", "ProductDivision", "ProductDivision"))):
        with pytest.raises(ValueError):
            ru.branch_path(MODEL, "ProductionOrder", *bad)


LINE = ru.Attribute("ProductKey", "ProductLineName", ("ProductFamily", "ProductLine"))


def test_rollup_shapes(tables):
    got = ru.rollup(MODEL, tables, "ProductionOrder", [LINE], [("sum", "OrderQuantity"), ("avg", "OrderQuantity")])
    assert [tuple(r) for r in got.collect()] == [("Line20", 2, Decimal(12), Decimal(6)), ("Line21", 1, Decimal(1), Decimal(1))]
    more = ru.rollup(MODEL, tables, "ProductionOrder", [LINE], [("sum", "OrderQuantity")], having_min=1)
    assert [r.ProductLine_ProductLineName for r in more.collect()] == ["Line20"]
    number = ru.Attribute("ProductKey", "ProductNumber")
    top = ru.top_by_measure(MODEL, tables, "ProductionOrder", [number], [("sum", "OrderQuantity")], 2)
    assert [r.Product_ProductNumber for r in top.collect()] == ["P3", "P1"]
    window = ru.DateWindow("OrderDateKey", 1, dt.date(2024, 6, 1))
    recent = ru.distinct_profile(MODEL, tables, "ProductionOrder", [number], window=window, distinct_of=["OrderDateKey"])
    assert [tuple(r) for r in recent.collect()] == [("P1", 2, 1, 2), ("P2", 1, 1, 1)]


def test_random_branches_climb_without_loops():
    """Any walk up a model with a loop back to itself ends, and revisits no table."""
    model = WarehouseModel.of(
        TableSpec("A", "dim", (), C("ACode", "nvarchar(9)"), (FK("B"), FK("A", "Up", True))),
        TableSpec("B", "dim", (), C("BCode", "nvarchar(9)"), (FK("Cc"),)),
        TableSpec("Cc", "dim", (), C("CcCode", "nvarchar(9)"), (FK("A", "Back", True),)),
        TableSpec("F", "fact", (), foreign_keys=(FK("A"), FK("B"))),
    )
    assert [b.parent for b in fl.branches(model, "A")] == ["B", "Cc"]
    rng = random.Random(1)
    for _ in range(40):
        key = rng.choice(["AKey", "BKey"])
        parents: tuple[str, ...] = ()
        while True:
            try:
                path = ru.branch_path(model, "F", key, parents)
            except ValueError:
                break
            seen = ["F", *[e.parent for e in path]]
            assert len(seen) == len(set(seen))
            parents += (rng.choice(["A", "B", "Cc"]),)
