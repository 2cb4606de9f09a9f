import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hoarfrost.model import Column as C
from hoarfrost.model import TableSpec
from hoarfrost.operators import scd
from tests.conftest import rows
from tests.warehouse_fixture import MODEL

SPEC = TableSpec("Item", "dim", (C("ItemName", "nvarchar(50)"), C("Price", "decimal(9,2)")), C("ItemNumber", "nvarchar(20)"), scd=2)
FLAT = TableSpec("Item", "dim", SPEC.columns, SPEC.business_key)
STAGE = "ItemNumber string, ItemName string, Price decimal(9,2), BatchId long, RowNumber long"


def at(day):
    return F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz")


def stage(spark, batch, *items):
    data = [(k, n, None if p is None else Decimal(p), batch, i) for i, (k, n, p) in enumerate(items, 1)]
    return spark.createDataFrame(data, STAGE)


def empty(spark, spec):
    return spark.createDataFrame([], spec.schema_type())


def stored(merge):
    """Keep a merged table, as writing it would."""
    return merge.table.cache()


def test_scd2_cases(spark):
    first = stage(spark, 1, ("A", "a", 1), ("B", "b", 2), ("C", None, 3))
    one = stored(scd.scd2_merge(empty(spark, SPEC), first, SPEC, 1, at(1)))
    assert one.count() == 3 and one.filter("IsCurrent").count() == 3

    # A unchanged, B changed (staged twice, the last row counts), C NULL against empty, D new.
    second = stage(spark, 2, ("A", "a", 1), ("B", "stale", 9), ("B", "b2", 2), ("C", "", 3), ("D", "d", 4))
    merge = scd.scd2_merge(one, second, SPEC, 2, at(2))
    two = stored(merge)
    actions = {r.BusinessKeyValue: r.action for r in merge.changes.collect()}
    assert actions == {"A": "unchanged", "B": "update", "C": "unchanged", "D": "insert"}
    versions = rows(two.filter("ItemNumber = 'B'"), "ItemName", "EffectiveFromUtc", "EffectiveToUtc", "IsCurrent", "BatchId")
    assert versions == [
        ("b", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), False, 1),
        ("b2", dt.datetime(2024, 1, 2), dt.datetime(9999, 12, 31), True, 2),
    ]
    assert two.count() == 5 and two.select("ItemKey").distinct().count() == 5

    # The same batch again changes nothing; neither does an empty one.
    again = scd.scd2_merge(two, second, SPEC, 2, at(3))
    assert rows(again.table) == rows(two)
    assert rows(scd.scd2_merge(two, second, SPEC, 99, at(3)).table) == rows(two)

    # What was missing from the batch stays current.
    third = scd.scd2_merge(two, stage(spark, 3, ("A", "x", 1)), SPEC, 3, at(4)).table
    assert third.filter("IsCurrent").count() == 4

    log = scd.change_log(merge.changes, "Item", 2)
    assert rows(log, "BusinessKeyValue", "ChangeTypeCode") == [("B", "update"), ("D", "insert")]
    assert log.filter("ChangeTypeCode = 'update' AND PreviousRowHash IS NOT NULL AND NewRowHash <> PreviousRowHash").count() == 1
    audit = scd.load_audit(merge.changes, "dim", "Item", 2).first()
    assert (audit.SourceRowCount, audit.InsertedRowCount, audit.UpdatedRowCount, audit.MatchedRowCount) == (4, 1, 1, 3)


def test_staged_hash_wins(spark):
    one = stored(scd.scd2_merge(empty(spark, SPEC), stage(spark, 1, ("A", "a", 1)).withColumn("RowHash", F.lit(b"1")), SPEC, 1, at(1)))
    same = stage(spark, 2, ("A", "other", 1)).withColumn("RowHash", F.lit(b"1"))
    assert [r.action for r in scd.scd2_merge(one, same, SPEC, 2, at(2)).changes.collect()] == ["unchanged"]


def test_random_batches_keep_the_invariants(spark):
    rng = random.Random(7)
    dim, history = empty(spark, SPEC), {}
    for batch in range(1, 5):
        items = [(f"K{rng.randrange(12)}", rng.choice("xyz"), rng.randrange(3)) for _ in range(10)]
        for k in {i[0] for i in items}:
            final = [(n, p) for kk, n, p in items if kk == k][-1]
            if not history.get(k) or history[k][-1] != final:
                history.setdefault(k, []).append(final)
        dim = stored(scd.scd2_merge(dim, stage(spark, batch, *items), SPEC, batch, at(batch)))
    got = {}
    for r in dim.orderBy("ItemNumber", "EffectiveFromUtc").collect():
        got.setdefault(r.ItemNumber, []).append(r)
    assert {k: [(r.ItemName, int(r.Price)) for r in v] for k, v in got.items()} == history
    for versions in got.values():
        assert [v.IsCurrent for v in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a.EffectiveToUtc == b.EffectiveFromUtc for a, b in zip(versions, versions[1:]))


def test_scd1(spark):
    one = stored(scd.scd1_merge(empty(spark, FLAT), stage(spark, 1, ("A", "a", 1), ("B", "b", 2)), FLAT, 1, at(1)))
    merge = scd.scd1_merge(one, stage(spark, 2, ("B", None, 5), ("C", "c", 3)), FLAT, 2, at(2))
    got = rows(merge.table, "ItemNumber", "ItemName", "Price", "BatchId", "SourceSystemKey")
    assert got == [
        ("A", "a", Decimal("1.00"), 1, -1), ("B", None, Decimal("5.00"), 1, -1), ("C", "c", Decimal("3.00"), 2, -1)
    ]
    assert merge.table.select("ItemKey").distinct().count() == 3


@pytest.fixture(scope="module")
def dims(spark):
    family = spark.createDataFrame([(5, "F1"), (6, "F2")], "ProductFamilyKey int, ProductFamilyCode string")
    unit = spark.createDataFrame([(1, "EA")], "UnitOfMeasureKey int, UnitOfMeasureCode string")
    status = spark.createDataFrame([(1, "ON")], "ProductStatusKey int, StatusCode string")
    return {"ProductFamily": family, "UnitOfMeasure": unit, "ProductStatus": status}


def product_stage(spark, batch, *data):
    columns = MODEL.staging_schema("Product")
    return spark.createDataFrame([(*d, batch, i) for i, d in enumerate(data, 1)], columns)


def test_parents_are_resolved_and_hashed_by_natural_key(spark, dims):
    names = [c.name for c in MODEL.staging_columns("Product")]
    assert names[2:6] == [
        "ProductFamilyProductFamilyCode", "UnitOfMeasureUnitOfMeasureCode", "ProductStatusStatusCode", "ParentProductProductNumber"
    ]
    given = {"Product": empty(spark, MODEL["Product"]), **dims}
    first = product_stage(spark, 1, ("P1", "one", "F1", "EA", "ON", None), ("P2", "two", "nope", "EA", "ON", "P1"))
    one = scd.merge_dimensions(MODEL, given, {"Product": first}, 1, at(1))["Product"].table.cache()
    assert rows(one, "ProductNumber", "ProductFamilyKey", "UnitOfMeasureKey", "ParentProductKey") == [
        ("P1", 5, 1, -1), ("P2", -1, 1, -1)
    ]
    # Only the parent moved: that is a change. The parent product has a key by now.
    second = product_stage(spark, 2, ("P1", "one", "F2", "EA", "ON", None), ("P2", "two", "nope", "EA", "ON", "P1"))
    merge = scd.merge_dimensions(MODEL, {**given, "Product": one}, {"Product": second}, 2, at(2))["Product"]
    assert {r.BusinessKeyValue: r.action for r in merge.changes.collect()} == {"P1": "update", "P2": "unchanged"}
    assert rows(merge.table.filter("IsCurrent AND ProductNumber = 'P1'"), "ProductFamilyKey") == [(6,)]


def test_merge_order_and_switches(spark, dims):
    assert scd.merge_order(MODEL, ["Product", "ProductFamily", "ProductDivision", "ProductLine", "ProductionOrder", "x"]) == [
        "ProductDivision", "ProductLine", "ProductFamily", "Product"
    ]
    staged = {"Product": product_stage(spark, 1, ("P1", "one", "F1", "EA", "ON", None))}
    assert scd.merge_dimensions(MODEL, {"Product": empty(spark, MODEL["Product"]), **dims}, staged, 1, at(1), enabled=set()) == {}
