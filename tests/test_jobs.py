import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hoarfrost.operators.control import (
    CONTROL_TABLES,
    base_of,
    batch_loads,
    key_ranges,
    latest_runs,
    load_increment,
    read_control,
    replace_control,
    stale_batches,
)
from hoarfrost.operators.generate import date_dimension, time_dimension
from hoarfrost.operators.scd import scd1_merge, scd2_merge
from hoarfrost.plans import jobs, reports
from hoarfrost.sources import buckets, landing, tables
from tests.conftest import rows
from tests.warehouse_fixture import MODEL, filled


def land(root, batch, table, *data):
    names = [c.name for c in MODEL.staging_columns(table)]
    path = landing.landing_path(root, batch, table)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        for n, row in enumerate(data, 1):
            f.write(",".join("" if v is None else str(v) for v in (*row, batch, n)) + "\n")


def at(day):
    return F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz")


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    landing_root, root = (str(tmp_path_factory.mktemp(n)) for n in ("landing", "warehouse"))
    tables.write_version(date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), f"{root}/Date", 0)
    tables.write_version(time_dimension(spark), f"{root}/TimeOfDay", 0)
    land(landing_root, 1, "ProductStatus", ("ON", "On"), ("OFF", "Off"))
    land(landing_root, 1, "UnitOfMeasure", ("EA", "Each"))
    land(landing_root, 1, "ProductFamily", ("F1", "Family", None))
    land(landing_root, 1, "Operator", ("O1", "Ann"))
    land(landing_root, 1, "Product", ("P1", "one", "F1", "EA", "ON", None), ("P2", "two", "F1", "EA", "ON", None))
    land(landing_root, 1, "ProductSubstitute", (1, "P1", "P2"), (2, "P1", "P2"))
    land(landing_root, 1, "ProductionOrder", ("W1", 5, 20240102, 20240104, 60, "P1", "O1", "ON"), ("W2", 6, 20240102, 20240104, 60, "P9", None, "ON"))
    land(landing_root, 2, "Product", ("P1", "one", "F1", "EA", "ON", None), ("P2", "new", "F1", "EA", "OFF", None))
    land(landing_root, 2, "ProductSubstitute", (9, "P1", "P2"), (1, "P1", "P1"))
    land(landing_root, 2, "ProductionOrder", ("W3", 7, 20240105, 20240106, 0, "P2", "O1", "ON"))
    return landing_root, root


def contents(spark, root):
    out = {}
    for spec in MODEL.of_kind("ref", "dim"):
        if spec.name not in ("Date", "TimeOfDay") and tables.versions(spark, f"{root}/{spec.name}"):
            out[spec.name] = rows(tables.read_version(spark, f"{root}/{spec.name}", schema=spec.schema_type()))
    for name in ("ProductionOrder", "ProductSubstitute"):
        out[name] = rows(spark.read.schema(MODEL[name].schema_type()).parquet(f"{root}/{name}"))
    return out


def test_load_cycle(spark, roots):
    landing_root, root = roots
    assert jobs.load_batch(spark, MODEL, landing_root, root, 1, at(10)) == {"ProductionOrder": 2}
    assert jobs.load_batch(spark, MODEL, landing_root, root, 2, at(11)) == {"ProductionOrder": 1}
    once = contents(spark, root)
    # P2 has a second version by now, so its pair with P1 is a new combination.
    assert len(once["Product"]) == 3 and len(once["ProductSubstitute"]) == 3
    assert jobs.load_batch(spark, MODEL, landing_root, root, 2, at(11)) == {"ProductionOrder": 1}
    assert contents(spark, root) == once

    fact = spark.read.schema(MODEL["ProductionOrder"].schema_type()).parquet(f"{root}/ProductionOrder")
    product = tables.read_version(spark, f"{root}/Product", schema=MODEL["Product"].schema_type())
    named = fact.join(product, "ProductKey", "left").select("WorkOrderNumber", "ProductNumber", "ProductName", "ProductionOrderLagDays")
    assert rows(named) == [("W1", "P1", "one", 2), ("W2", None, None, 2), ("W3", "P2", "new", 1)]

    control = f"{root}/control"
    states = rows(latest_runs(read_control(spark, control, "BatchRun")), "BatchId", "BatchStatusCode")
    assert states == [(1, "Succeeded"), (2, "Succeeded")]
    log = rows(read_control(spark, control, "ScdChangeLog").filter("BatchId = 1"), "BusinessKeyValue", "ChangeTypeCode")
    assert log == [("P1", "insert"), ("P2", "insert")]
    lost = rows(read_control(spark, control, "DqResult"), "batch_id", "rule", "failed")
    assert lost == [(1, "Missing lookup ProductKey", 1)]
    assert jobs.load_batch(spark, MODEL, landing_root, root, 3, at(12)) == {}


def test_quality_and_housekeeping(spark, roots):
    landing_root, root = roots
    checked = jobs.check_quality(spark, MODEL, root, 9, at(20))
    assert checked.filter("rule = 'Row count' AND `table` = 'fact.ProductionOrder'").first().checked == 3
    assert checked.filter("rule LIKE 'Orphan%' AND status = 'Fail'").isEmpty()
    os.utime(f"{landing_root}/1", (0, 0))
    done = jobs.keep_house(spark, landing_root, root, dt.datetime(2024, 1, 26))
    assert done["landing"] == 1
    kept = rows(read_control(spark, f"{root}/control", "ScdChangeLog").select("BatchId").distinct())
    assert kept == []  # merged on the 10th and 11th, more than 14 days ago
    assert read_control(spark, f"{root}/control", "DqResult").filter("batch_id = 9").count() == checked.count()


def test_a_failed_load_is_recorded_and_changes_nothing(spark, roots, monkeypatch):
    landing_root, root = roots
    land(landing_root, 7, "Product", ("P3", "three", "F1", "EA", "ON", None))
    before = contents(spark, root)

    def stop(*args, **kwargs):
        raise RuntimeError("disk full")

    monkeypatch.setattr(jobs, "merge_dimensions", stop)
    with pytest.raises(RuntimeError):
        jobs.load_batch(spark, MODEL, landing_root, root, 7, at(28))
    assert contents(spark, root) == before
    errors = read_control(spark, f"{root}/control", "LoadError").filter("BatchId = 7")
    assert [r.ErrorMessage for r in errors.collect()] == ["disk full"]


def test_rows_that_do_not_fit_are_recorded_once(spark, tmp_path):
    landing_root, root = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land(landing_root, 1, "Operator", ("O1", "Ann"), (None, "Bob"))
    with open(landing.landing_path(landing_root, 1, "Operator"), "a") as f:
        f.write("O3,Cy,1,three\n")
    control = f"{root}/control"
    for _ in range(2):  # a rerun replaces what it noted
        jobs.load_batch(spark, MODEL, landing_root, root, 1, at(10))
        lost = read_control(spark, control, "RejectedRow")
        assert rows(lost, "BatchId", "TargetTableName", "RejectReasonText") == [(1, "Operator", "RowNumber is not bigint")]
        assert rows(read_control(spark, control, "LandingFile"), "TableName", "RowsReadCount", "RowsLoadedCount", "IngestStatusCode") == [("Operator", 3, 2, "Partial")]
        audit = read_control(spark, control, "LoadAudit")
        assert rows(audit, "TableName", "InsertedRowCount", "RejectedRowCount") == [("Operator", 1, 1)]


def test_a_rerun_does_not_repeat_its_control_rows(spark, tmp_path):
    landing_root, root = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land(landing_root, 1, "Product", ("P1", "one", "F1", "EA", "ON", None))
    control = f"{root}/control"
    for _ in range(2):
        jobs.load_batch(spark, MODEL, landing_root, root, 1, at(10))
        checked = jobs.check_quality(spark, MODEL, root, 1, at(11))
        assert read_control(spark, control, "ScdChangeLog").count() == 1
        assert read_control(spark, control, "DqResult").count() == checked.count()
        rules = read_control(spark, control, "DqRule")
        assert rules.count() == rules.select("RuleCode").distinct().count() == checked.select("rule", "table").distinct().count()
    os.utime(f"{control}/LoadAudit/BatchId=1", (0, 0))
    jobs.keep_house(spark, landing_root, root, dt.datetime(2024, 2, 20))
    assert read_control(spark, control, "LoadAudit").isEmpty() and read_control(spark, control, "ScdChangeLog").isEmpty()


def test_keys_past_two_billion(spark):
    from hoarfrost.model import Column, ForeignKey, TableSpec, WarehouseModel
    from hoarfrost.operators.facts import load_fact

    model = WarehouseModel.of(
        TableSpec("Customer", "dim", (), Column("Number", "nvarchar(9)"), key_type="bigint"),
        TableSpec("Order", "fact", (Column("Amount", "int"),), foreign_keys=(ForeignKey("Customer"),)),
    )
    dim = spark.createDataFrame([(3_000_000_000, "C1")], "CustomerKey bigint, Number string")
    stage = spark.createDataFrame([(5, "C1", 1, 1)], "Amount int, CustomerNumber string, BatchId bigint, RowNumber bigint")
    loaded = load_fact(model, "Order", stage, {"Customer": dim}, 1, at(10))
    assert loaded.first().CustomerKey == 3_000_000_000


def data_files(root):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("table", ["Product", "Operator"])
def test_a_batch_rewrites_the_buckets_it_changes(spark, tmp_path, table):
    """Type 2 (Product) and type 1 (Operator): files of other buckets keep name and time."""
    spec, path = MODEL[table], str(tmp_path / table)
    key, other = spec.business_key.name, spec.columns[0].name
    empty = {n: spark.createDataFrame([], MODEL[n].schema_type()) for n in ("ProductFamily", "UnitOfMeasure", "ProductStatus", "Product")}

    def load(batch, *data):
        stage = spark.createDataFrame([(k, v, batch, n) for n, (k, v) in enumerate(data, 1)], f"{key} string, {other} string, BatchId bigint, RowNumber bigint")
        how = scd2_merge if spec.is_scd2 else scd1_merge
        merge = lambda part, highest=None: how(part, stage, spec, batch, at(batch), MODEL, empty, highest)
        tables.merge_version(spark, path, batch, spec, stage, merge, bucket_rows=20)
        return tables.read_version(spark, path, schema=spec.schema_type())

    first = load(1, *((f"K{i}", "a") for i in range(200)))
    made = tables.bucketed(spark, path)
    assert first.count() == 200 and made.buckets == 16 and made.built_from is None and made.highest == 200
    before = data_files(path)
    second = load(2, ("K3", "b"), ("K4", "a"), ("new", "c"), (None, "x"))
    after = data_files(path)
    assert before.items() <= after.items()  # nothing was written in place
    made = tables.bucketed(spark, path)
    wrote = {b for b, place in made.places.items() if place.startswith("data/2-")}
    assert made.built_from == 1 and made.highest == (202 if spec.is_scd2 else 201)
    assert wrote == {r[0] for r in spark.createDataFrame([("K3",), ("new",)], "k string").select(buckets.bucket_of(F.col("k"), 16)).collect()}
    assert second.count() == (202 if spec.is_scd2 else 201) and second.filter(f"{key} = 'K3' AND {other} = 'b'").count() == 1
    assert second.select(spec.key).distinct().count() == second.count()
    # The same rows again change nothing, and no bucket is written; the older version is still there.
    third = load(3, ("K3", "b"), ("new", "c"))
    assert data_files(path) == after and rows(third) == rows(second)
    assert rows(tables.read_version(spark, path, 2, spec.schema_type())) == rows(first)
    # A rerun of a batch starts from the version before it.
    assert rows(load(2, ("K3", "b"), ("K4", "a"), ("new", "c"))) == rows(second)
    # Buckets that are outgrown are dealt anew, with the same rows and keys.
    fourth = load(4, *((f"N{i}", "d") for i in range(600)))
    assert tables.bucketed(spark, path).buckets == 64 and fourth.count() == second.count() + 600
    assert rows(fourth.filter("BatchId < 4")) == rows(second)
    assert tables.drop_old_versions(spark, path, keep=1) == [1, 2, 3]
    assert all("/data/4-" in f for f in data_files(path)) and rows(tables.read_version(spark, path)) == rows(fourth)


def test_keys_of_a_batch_are_its_own(spark, tmp_path):
    root = str(tmp_path)
    asked = []
    ask = lambda: asked.append(1) or 50
    assert key_ranges(spark, root, "F", 2, 10, ask) == [(50, 10)]
    assert key_ranges(spark, root, "F", 1, 5, ask) == [(60, 5)]
    assert key_ranges(spark, root, "F", 2, 8, ask) == [(50, 10)]
    assert key_ranges(spark, root, "F", 2, 13, ask) == [(50, 10), (65, 3)] == key_ranges(spark, root, "F", 2, 13, ask)
    assert key_ranges(spark, root, "G", 2, 1, ask) == [(50, 1)] and len(asked) == 2
    keys = spark.range(1, 14).select((base_of([(50, 10), (65, 3)], "id") + F.col("id")).alias("k"))
    assert [r.k for r in keys.collect()] == [*range(51, 61), 66, 67, 68]


def calendars(spark, *roots):
    for root in roots:
        tables.write_version(date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), f"{root}/Date", 0)
        tables.write_version(time_dimension(spark), f"{root}/TimeOfDay", 0)
        tables.write_version(spark.createDataFrame([], MODEL["ProductStatus"].schema_type()), f"{root}/ProductStatus", 0)


def land_two(landing_root):
    land(landing_root, 1, "Operator", ("O1", "Ann"))
    land(landing_root, 1, "Product", ("P1", "one", None, None, None, None))
    land(landing_root, 1, "ProductionOrder", ("W1", 5, 20240102, 20240104, 60, "P1", "O1", None), ("W2", 6, 20240102, 20240104, 60, "P1", None, None))
    land(landing_root, 2, "Product", ("P1", "two", None, None, None, None), ("P2", "two", None, None, None, None))
    land(landing_root, 2, "ProductSubstitute", (9, "P1", "P2"))
    land(landing_root, 2, "ProductionOrder", ("W3", 7, 20240105, 20240106, 0, "P2", "O1", None))


def named_contents(spark, root):
    """What the tables say, with surrogate keys of dimensions and facts."""
    product = tables.read_version(spark, f"{root}/Product", schema=MODEL["Product"].schema_type())
    fact = spark.read.schema(MODEL["ProductionOrder"].schema_type()).parquet(f"{root}/ProductionOrder")
    bridge = spark.read.schema(MODEL["ProductSubstitute"].schema_type()).parquet(f"{root}/ProductSubstitute")
    return (
        rows(product, "ProductKey", "ProductNumber", "ProductName", "BatchId", "EffectiveFromUtc", "EffectiveToUtc", "IsCurrent"),
        rows(fact, "ProductionOrderKey", "WorkOrderNumber", "ProductKey", "LeadOperatorKey", "BatchId"), rows(bridge),
    )


def test_late_repeated_and_interrupted_batches_end_like_one_ordered_run(spark, tmp_path, monkeypatch):
    landing_root, root, ordered = (str(tmp_path / n) for n in ("landing", "late", "ordered"))
    land_two(landing_root)
    calendars(spark, root, ordered)
    control = f"{root}/control"
    load = lambda where, batch, **how: jobs.load_batch(spark, MODEL, landing_root, where, batch, at(batch), **how)
    for where, order in ((ordered, (1, 2)), (root, (2, 1))):  # a late first batch, on top of which the second is made again
        for batch in order:
            load(where, batch)
    want, got = named_contents(spark, ordered), named_contents(spark, root)
    assert got[0] == want[0] and sorted(r[1:] for r in got[1]) == sorted(r[1:] for r in want[1])
    # Facts have the keys that their batch got first, whatever came after.
    assert sorted((r[4], r[0]) for r in got[1]) == [(1, 2), (1, 3), (2, 1)]
    loads = batch_loads(spark, control)
    assert [loads[b].BuiltOnToken for b in (1, 2)] == [None, loads[1].LoadToken] and stale_batches(loads) == []
    assert tables.bucketed(spark, f"{root}/Product").built_from == 1
    with pytest.raises(ValueError, match="not asked for"):
        load(root, 1, later="refuse")

    # A changed first batch, whose load is lost before the later ones are made again.
    land(landing_root, 1, "Product", ("P1", "two", None, None, None, None))
    real = jobs._load_one
    monkeypatch.setattr(jobs, "_load_one", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")) if a[4] == 2 else real(*a))
    with pytest.raises(RuntimeError):
        load(root, 1)
    assert stale_batches(batch_loads(spark, control)) == [2]
    monkeypatch.undo()
    assert load(root, 3) == {}  # nothing landed, but it brings the second up first
    assert stale_batches(batch_loads(spark, control)) == []
    product = tables.read_version(spark, f"{root}/Product", schema=MODEL["Product"].schema_type())
    assert rows(product, "ProductNumber", "ProductName", "BatchId", "IsCurrent") == [("P1", "two", 1, True), ("P2", "two", 2, True)]
    assert [r[0] for r in named_contents(spark, root)[1]] == [1, 2, 3]

    for name in os.listdir(f"{landing_root}/2"):
        os.remove(f"{landing_root}/2/{name}")
    before = named_contents(spark, root)
    with pytest.raises(ValueError, match=r"files of \[2\] are gone"):
        load(root, 1)
    assert named_contents(spark, root) == before


def test_a_fact_load_does_not_read_the_fact(spark, tmp_path):
    root = str(tmp_path)
    staged = spark.createDataFrame([(1,), (4,)], "RowNumber bigint")
    spec, path, control = MODEL["ProductionOrder"], f"{root}/fact", f"{root}/control"
    with open(path, "w") as f:
        f.write("no Parquet")
    assert [key_ranges(spark, control, spec.name, b, 2, lambda: 0) for b in (1, 2)] == [[(0, 2)], [(2, 2)]]
    for batch, first in ((9, 4), (9, 4), (8, 8)):
        base = jobs.fact_keys(spark, control, spec, staged, path, batch)
        assert [r[0] for r in staged.select(base + F.col("RowNumber")).collect()] == [first + 1, first + 4]


def test_a_switched_off_table_is_skipped_and_listed(spark, tmp_path):
    landing_root, root = str(tmp_path / "landing"), str(tmp_path / "w")
    land(landing_root, 1, "Operator", ("O1", "Ann"))
    land(landing_root, 1, "UnitOfMeasure", ("EA", "Each"))
    settings = spark.createDataFrame([("ref", "UnitOfMeasure", False), ("dim", "Operator", None)], CONTROL_TABLES["LoadConfig"])
    replace_control(spark, f"{root}/control", "LoadConfig", settings, "settings")
    jobs.load_batch(spark, MODEL, landing_root, root, 1, at(10))
    assert tables.versions(spark, f"{root}/Operator") == [1] and tables.versions(spark, f"{root}/UnitOfMeasure") == []
    jobs.keep_house(spark, landing_root, root, dt.datetime(2024, 1, 12), model=MODEL)
    listed = {r.TableName: r for r in read_control(spark, f"{root}/control", "TableCatalog").collect()}
    assert set(listed) == {t.name for t in MODEL.of_kind("ref", "dim", "bridge", "fact")}
    assert [n for n, r in listed.items() if not r.IsEnabled] == ["UnitOfMeasure"] and listed["Operator"].VersionCount == 1
    assert listed["Operator"].FileCount > 0 and listed["Operator"].TableKind == "dim" and listed["Product"].SizeBytes == 0


def test_increments_lose_and_repeat_nothing(spark, tmp_path):
    root, seen = str(tmp_path), {}
    source = lambda n: spark.range(n).select("id", F.expr("IF(id % 7 = 6, NULL, id DIV 2)").alias("at"))

    def load(batch, fail=False):
        def run(df):
            seen[batch] = sorted(r.id for r in df.collect())
            if fail:
                raise RuntimeError("lost")

        return run

    step = lambda n, batch, **how: load_increment(spark, root, source(n), "T", "at", batch, load(batch, **how))
    assert step(10, 1) == (None, "4") and seen[1] == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert step(10, 2) == ("4", "4") and 2 not in seen
    with pytest.raises(RuntimeError):
        step(20, 2, fail=True)
    first = seen.pop(2)
    with pytest.raises(ValueError, match="batch 2"):
        step(30, 3)
    assert step(40, 2) == ("4", "9") and seen[2] == first  # what came meanwhile is left for the next one
    step(40, 3)
    assert step(40, 1) == (None, "4") and step(40, 4) == ("19", "19")  # an old batch again moves no mark
    dated = {r.id for r in source(40).filter("at IS NOT NULL").collect()}
    assert sorted(x for b in seen.values() for x in b) == sorted(dated)
    with pytest.raises(ValueError, match="would come before"):
        step(60, 0)


def test_an_increment_lands_and_loads(spark, tmp_path):
    landing_root, root = str(tmp_path / "landing"), str(tmp_path / "w")
    source = spark.createDataFrame([("O1", "Ann", 5), ("O2", "Bob", 6)], "OperatorNumber string, OperatorName string, changed int")
    assert jobs.land_increment(spark, MODEL, source.limit(1), "Operator", "changed", landing_root, root, 1) == (None, "5")
    assert jobs.land_increment(spark, MODEL, source, "Operator", "changed", landing_root, root, 2) == ("5", "6")
    staged = [rows(landing.read_landing(spark, landing_root, b, "Operator", MODEL.staging_schema("Operator"))) for b in (1, 2)]
    assert staged == [[("O1", "Ann", 1, 1)], [("O2", "Bob", 2, 1)]]


def test_facts_are_clustered_by_their_main_date(spark, tmp_path):
    root, spec = str(tmp_path), MODEL["ProductionOrder"]
    path = f"{root}/ProductionOrder"
    fact = filled(spark, spec, 400, {}, dt.date(2024, 1, 31), 30)
    fact.repartition(2, "ProductionOrderKey").write.partitionBy("BatchId").parquet(path)  # two files, both over all days
    before = rows(spark.read.schema(spec.schema_type()).parquet(path))
    assert jobs.cluster_facts(spark, MODEL, root, target_bytes=3000) == {"ProductionOrder": [1]}
    kept = spark.read.schema(spec.schema_type()).parquet(path)
    assert rows(kept) == before and kept.select("_metadata.file_path").distinct().count() > 2
    by_file = kept.groupBy("_metadata.file_path").agg(F.min("OrderDateKey").alias("low"), F.max("OrderDateKey").alias("high"))
    assert tables.overlapping([(r.low, r.high) for r in by_file.collect()]) == 0
    stats = {r.ColumnName: r for r in read_control(spark, f"{root}/control", "ColumnStatistic").collect()}
    assert stats["OrderDateKey"].TotalRowCount == 400 and stats["OrderDateKey"].HighValue == "20240131"
    assert jobs.cluster_facts(spark, MODEL, root, target_bytes=3000) == {"ProductionOrder": []}
    tables.replace_batch(kept.limit(5), path, 1)
    assert spark.read.schema(spec.schema_type()).parquet(path).count() == 5


def test_reports_run_as_a_job_with_kept_timings(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.write_version(date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), f"{root}/Date", 0)
    monkeypatch.setattr(reports, "REPORTS", {"days": lambda wh, as_of: wh["Date"], "broken": lambda wh, as_of: wh["Product"]})
    for batch in (1, 2, 2):  # a rerun replaces its rows
        jobs.run_analytics(spark, MODEL, root, batch, dt.date(2024, 1, 31))
    kept = read_control(spark, f"{root}/control", "QueryTiming")
    assert rows(kept, "BatchId", "name", "status", "row_count") == [
        (1, "broken", "Failed", None), (1, "days", "Succeeded", 31), (2, "broken", "Failed", None), (2, "days", "Succeeded", 31)
    ]
    assert rows(read_control(spark, f"{root}/control", "LoadError").filter("BatchId = 1"), "SchemaName", "TableName") == [("report", "broken")]
    assert rows(latest_runs(read_control(spark, f"{root}/control", "BatchRun")), "BatchId", "BatchStatusCode") == [(1, "Succeeded"), (2, "Succeeded")]
    slow = kept.filter("name = 'days' AND BatchId = 1").withColumns({"BatchId": F.lit(3), "milliseconds": F.lit(1e7)})
    replace_control(spark, f"{root}/control", "QueryTiming", slow, "analytics-3")
    assert rows(jobs.slower_reports(spark, root, 3), "name", "row_count", "run_count") == [("days", 31, 2)]
    assert jobs.slower_reports(spark, root, 1).isEmpty()
