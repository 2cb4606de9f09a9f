import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hoarfrost.model import WarehouseModel
from hoarfrost.operators.generate import date_dimension, time_dimension
from hoarfrost.sources import landing, tables
from hoarfrost.streaming import ingest
from tests.conftest import rows
from tests.warehouse_fixture import MODEL

SCHEMA = "WorkOrderNumber,OrderQuantity,OrderDateKey,CloseDateKey,StartTimeOfDayKey,ProductProductNumber,LeadOperatorOperatorNumber,ProductStatusStatusCode,BatchId,RowNumber"


def land(root, batch, *orders):
    path = landing.landing_path(root, batch, "ProductionOrder")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(SCHEMA + "\n")
        for n, (operator, quantity) in enumerate(orders, 1):
            f.write(f"W{n},{quantity},20240102,20240105,60,,{operator},,{batch},{n}\n")


def operators(df):
    seen = df.filter(F.col("LeadOperatorOperatorNumber").isNotNull())
    return {"Operator": seen.select(F.col("LeadOperatorOperatorNumber").alias("OperatorNumber"), "BatchId", "RowNumber")}


def prepare(spark, warehouse):
    empty = lambda name: spark.createDataFrame([], MODEL[name].schema_type())
    for name in ("Operator", "Product", "ProductStatus"):
        tables.write_version(empty(name), f"{warehouse}/{name}", 0)
    tables.write_version(date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), f"{warehouse}/Date", 0)
    tables.write_version(time_dimension(spark), f"{warehouse}/TimeOfDay", 0)


def run(spark, root, warehouse, checkpoint):
    stream = ingest.landing_stream(spark, f"{root}/*/stg.ProductionOrder.csv", MODEL.staging_schema("ProductionOrder"))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    ingest.apply_stream(stream, checkpoint, MODEL, warehouse, "ProductionOrder", now, operators, lambda df: df)


def state(spark, warehouse):
    fact = spark.read.schema(MODEL["ProductionOrder"].schema_type()).parquet(f"{warehouse}/ProductionOrder")
    dim = tables.read_version(spark, f"{warehouse}/Operator")
    named = fact.join(dim, fact.LeadOperatorKey == dim.OperatorKey)
    return rows(named.select(fact.BatchId, "OperatorNumber", F.col("OrderQuantity").cast("int"), "ProductionOrderLagDays"))


def test_batches_apply_once_and_repeat_safely(spark, tmp_path):
    root, warehouse, checkpoint = (str(tmp_path / p) for p in ("landing", "warehouse", "checkpoint"))
    prepare(spark, warehouse)
    land(root, 1, ("O1", 5), ("O2", 6), ("O1", 7))
    run(spark, root, warehouse, checkpoint)
    assert state(spark, warehouse) == [(1, "O1", 5, 3), (1, "O1", 7, 3), (1, "O2", 6, 3)]
    run(spark, root, warehouse, checkpoint)  # nothing new
    land(root, 2, ("O2", 8), ("O3", 9))
    run(spark, root, warehouse, checkpoint)
    after = state(spark, warehouse)
    assert len(after) == 5 and after[3:] == [(2, "O2", 8, 3), (2, "O3", 9, 3)]
    assert tables.read_version(spark, f"{warehouse}/Operator").select("OperatorKey").distinct().count() == 3

    # A stream that lost its progress brings all files again: each batch replaces itself.
    land(root, 1, ("O1", 5))
    run(spark, root, warehouse, str(tmp_path / "checkpoint-new"))
    assert state(spark, warehouse) == [(1, "O1", 5, 3), (2, "O2", 8, 3), (2, "O3", 9, 3)]


def keys(spark, warehouse):
    return rows(spark.read.schema(MODEL["ProductionOrder"].schema_type()).parquet(f"{warehouse}/ProductionOrder"), "BatchId", "ProductionOrderKey")


def test_batches_that_share_a_trigger_keep_their_ids(spark, tmp_path):
    root, warehouse, checkpoint = (str(tmp_path / p) for p in ("landing", "warehouse", "checkpoint"))
    prepare(spark, warehouse)
    land(root, 2, ("O1", 5), ("O2", 6))
    land(root, 3, ("O1", 7), ("O3", 8))
    run(spark, root, warehouse, checkpoint)
    assert state(spark, warehouse) == [(2, "O1", 5, 3), (2, "O2", 6, 3), (3, "O1", 7, 3), (3, "O3", 8, 3)]
    assert keys(spark, warehouse) == [(b, b * 2**40 + n) for b in (2, 3) for n in (1, 2)]
    # A late batch comes before the others: they are loaded again on top of it.
    land(root, 1, ("O4", 1))
    run(spark, root, warehouse, checkpoint)
    assert len(state(spark, warehouse)) == 5 and len(keys(spark, warehouse)) == 5
    names = rows(tables.read_version(spark, f"{warehouse}/Operator"), "OperatorNumber")
    assert names == [("O1",), ("O2",), ("O3",), ("O4",)]

    # The files of old batches are gone and the progress too: what was loaded stays.
    os.remove(landing.landing_path(root, 1, "ProductionOrder"))
    os.remove(landing.landing_path(root, 2, "ProductionOrder"))
    before = state(spark, warehouse)
    run(spark, root, warehouse, str(tmp_path / "checkpoint-new"))
    assert state(spark, warehouse) == before


def test_ingest_takes_each_file_once(spark, tmp_path):
    root, target, checkpoint = (str(tmp_path / p) for p in ("landing", "staged", "checkpoint"))
    land(root, 1, ("O1", 5))
    for batch in (2, 3):
        stream = ingest.landing_stream(spark, f"{root}/*/stg.ProductionOrder.csv", MODEL.staging_schema("ProductionOrder"))
        ingest.ingest(stream, checkpoint, target)
        land(root, batch, ("O1", batch), ("O2", batch))
    ingest.ingest(stream, checkpoint, target)
    landed = ingest.staged(spark, target, MODEL.staging_schema("ProductionOrder"))
    assert rows(ingest.accepted(landed), "BatchId", "RowNumber") == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2)]


def spoil(root, batch, *lines):
    with open(landing.landing_path(root, batch, "ProductionOrder"), "a") as f:
        f.writelines(line + "\n" for line in lines)


def test_good_rows_and_dead_letters_add_up(spark, tmp_path):
    root, target, checkpoint = (str(tmp_path / p) for p in ("landing", "staged", "checkpoint"))
    schema = MODEL.staging_schema("ProductionOrder")
    land(root, 1, ("O1", 5), ("O2", "many"))
    spoil(root, 1, "W9,1,2", ",,,,,,,,,")
    land(root, 2, ("O3", "few"))
    stream = ingest.landing_stream(spark, f"{root}/*/stg.ProductionOrder.csv", schema, files_per_batch=1)
    ingest.ingest(stream, checkpoint, target)
    landed = ingest.staged(spark, target, schema)
    good, dead = ingest.accepted(landed), ingest.dead_letters(landed)
    assert good.columns == [*schema.names, ingest.LANDING_FILE] and rows(good, "BatchId", "LeadOperatorOperatorNumber") == [(1, "O1"), (1, None)]
    assert rows(dead, "BatchId", "RowNumber", "RejectReasonText", "RejectedPayload") == [
        (1, 2, "OrderQuantity is not decimal(18,4)", "W2,many,20240102,20240105,60,,O2,,1,2"),
        (1, None, "wrong number of fields", "W9,1,2"),
        (2, 1, "OrderQuantity is not decimal(18,4)", "W1,few,20240102,20240105,60,,O3,,2,1"),
    ]
    assert good.count() + dead.count() == landed.count() == 5
    # A micro-batch that is repeated replaces its rows and its dead letters.
    epoch = landed.filter("BatchId = 1").select("epoch").first()[0]
    ingest._stage_epoch(spark.createDataFrame(landed.filter(f"epoch = {epoch}").drop("epoch", "Landed").collect(), landed.drop("epoch", "Landed").schema), target, epoch)
    assert ingest.staged(spark, target, schema).count() == 5


def test_the_applied_stream_keeps_what_does_not_fit(spark, tmp_path):
    root, warehouse, checkpoint = (str(tmp_path / p) for p in ("landing", "warehouse", "checkpoint"))
    prepare(spark, warehouse)
    land(root, 1, ("O1", 5), ("O2", "many"))
    run(spark, root, warehouse, checkpoint)
    assert state(spark, warehouse) == [(1, "O1", 5, 3)]
    landed = lambda: spark.read.parquet(f"{warehouse}/landed/ProductionOrder")
    assert rows(ingest.dead_letters(landed()), "BatchId", "RowNumber") == [(1, 2)]
    land(root, 1, ("O1", 5), ("O2", 6))  # the file comes again, in order
    run(spark, root, warehouse, str(tmp_path / "checkpoint-new"))
    assert ingest.dead_letters(landed()).isEmpty() and len(state(spark, warehouse)) == 2


VERSIONED = WarehouseModel.of(*[replace(t, scd=2) if t.name == "Operator" else t for t in MODEL.tables.values()])
# Per batch, operator and what is known of it then: versions that go on, return, move or come first.
TOLD = {
    1: (("A", 1), ("B", 1), ("C", 1), ("G", 1)),
    2: (("A", 2), ("B", 2), ("C", 1), ("D", 1), ("E", 5), ("F", 3), ("", 9)),
    3: (("A", 1), ("B", 2), ("E", 6), ("C", 4)),
    4: (("A", 1), ("F", 3), ("D", 1), ("G", 2)),
    5: (("A", 2), ("B", 1), ("E", 5)),
}


def versioned(df):
    seen = df.filter(F.col("LeadOperatorOperatorNumber").isNotNull())
    return {"Operator": seen.select(F.col("LeadOperatorOperatorNumber").alias("OperatorNumber"), F.col("OrderQuantity").cast("int").cast("string").alias("OperatorName"), "BatchId", "RowNumber")}


def apply(spark, folder, model, *batches):
    """Batches land together, and a stream takes what has landed, as of a day of its own."""
    for batch in batches:
        land(f"{folder}/landing", batch, *TOLD[batch])
    stream = ingest.landing_stream(spark, f"{folder}/landing/*/stg.ProductionOrder.csv", model.staging_schema("ProductionOrder"))
    now = F.lit(f"2024-02-{10 + len(os.listdir(f'{folder}/landing')):02d}").cast("timestamp_ntz")
    ingest.apply_stream(stream, f"{folder}/checkpoint", model, f"{folder}/warehouse", "ProductionOrder", now, versioned, lambda df: df)


def begin(spark, folder, model):
    prepare(spark, f"{folder}/warehouse")
    tables.write_version(spark.createDataFrame([], model["Operator"].schema_type()), f"{folder}/warehouse/Operator", 0)


def in_order(batches, keeps_versions):
    """What batches loaded in order leave, row by row: versions and facts, by what they say."""
    dim, facts = [], []
    for batch in sorted(batches):
        for name, value in TOLD[batch]:
            mine = [r for r in dim if r[0] == name]
            if name and (not mine or keeps_versions and mine[-1][1] != str(value)):
                dim.append([name, str(value), batch])
            elif name and not keeps_versions:
                mine[-1][1] = str(value)
        for n, (name, _) in enumerate(TOLD[batch], 1):
            last = next((r for r in reversed(dim) if r[0] == name), [None] * 3)
            facts.append((batch, batch * 2**40 + n, last))
    return sorted(map(tuple, dim), key=lambda r: (r[0], r[2])), [(b, k, *r) for b, k, r in facts]


def histories(spark, warehouse, model):
    """The same from the tables; and surrogate keys are unique, and the intervals of a key meet."""
    dim = tables.read_version(spark, f"{warehouse}/Operator").orderBy("OperatorNumber", "BatchId").collect()
    assert len({r.OperatorKey for r in dim}) == len(dim)
    for a, b in zip(dim, [*dim[1:], None]) if model["Operator"].is_scd2 else ():
        last = b is None or b.OperatorNumber != a.OperatorNumber
        assert a.IsCurrent == last and a.EffectiveFromUtc <= a.EffectiveToUtc
        assert a.EffectiveToUtc == (dt.datetime(9999, 12, 31) if last else b.EffectiveFromUtc)
    fact = spark.read.schema(model["ProductionOrder"].schema_type()).parquet(f"{warehouse}/ProductionOrder")
    named = {r.OperatorKey: (r.OperatorNumber, r.OperatorName, r.BatchId) for r in dim}
    found = sorted((r.BatchId, r.ProductionOrderKey, r.LeadOperatorKey) for r in fact.collect())
    return [(r.OperatorNumber, r.OperatorName, r.BatchId) for r in dim], [(b, k, *named.get(o, (None,) * 3)) for b, k, o in found]


@pytest.mark.parametrize("model", [VERSIONED, MODEL], ids=["versions", "no-versions"])
def test_late_batches_are_put_into_the_histories_of_their_keys(spark, tmp_path, model):
    folder = str(tmp_path)
    begin(spark, folder, model)
    apply(spark, folder, model, 1, 5)
    apply(spark, folder, model, 3)
    assert histories(spark, f"{folder}/warehouse", model) == in_order((1, 3, 5), model is VERSIONED)
    apply(spark, folder, model, 2, 4)
    assert histories(spark, f"{folder}/warehouse", model) == in_order((1, 2, 3, 4, 5), model is VERSIONED)
    # Nothing was loaded again: batches that came late have no version of their own.
    assert tables.versions(spark, f"{folder}/warehouse/Operator") == [0, 1, 5]


def test_a_late_load_that_was_cut_is_made_up_for(spark, tmp_path, monkeypatch):
    folder, whole = str(tmp_path), tables.replace_batch
    begin(spark, folder, VERSIONED)
    apply(spark, folder, VERSIONED, 1, 3)

    def stop(df, path, *args):
        if path.endswith("/ProductionOrder"):
            raise RuntimeError("cut")
        return whole(df, path, *args)

    monkeypatch.setattr(tables, "replace_batch", stop)
    with pytest.raises(Exception, match="cut"):
        apply(spark, folder, VERSIONED, 2)
    monkeypatch.undo()
    apply(spark, folder, VERSIONED)
    assert histories(spark, f"{folder}/warehouse", VERSIONED) == in_order((1, 2, 3), True)
