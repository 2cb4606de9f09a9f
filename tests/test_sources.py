import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hoarfrost.operators import control as ct
from hoarfrost.session import scratch, shared_folder
from hoarfrost.sources import landing, tables
from tests.conftest import rows
from tests.warehouse_fixture import MODEL


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_landing(spark, tmp_path):
    root, schema = str(tmp_path), MODEL.staging_schema("Operator")
    header = "OperatorNumber,OperatorName,BatchId,RowNumber\n"
    put(f"{root}/3/stg.Operator.csv", header + 'O1,"Smith, ""Al""",3,1\nO2,,3,2\nO3,x,3,bad\nO4\n')
    put(f"{root}/3/stg.Nothing.csv", "a\n1\n")
    assert landing.landed_tables(spark, root, 3, MODEL) == ["Operator"]
    got = landing.read_landing(spark, root, 3, "Operator", schema)
    assert rows(got) == [("O1", 'Smith, "Al"', 3, 1), ("O2", None, 3, 2)]
    assert landing.read_landing(spark, root, 4, "Operator", schema).isEmpty()
    raw = landing.read_raw(spark, landing.landing_path(root, 3, "Operator"), schema)
    lost = landing.rejects(raw, schema, 3, "dim", "Operator")
    assert rows(lost, "RejectReasonText") == [("RowNumber is not bigint",), ("wrong number of fields",)]
    log = landing.file_ingest(spark, landing.landing_path(root, 3, "Operator"), schema).first()
    assert (log.FileName, log.RowsReadCount, log.RowsLoadedCount, log.IngestStatusCode) == ("stg.Operator.csv", 4, 2, "Partial")


def test_seed_round_trip(spark, tmp_path):
    schema = MODEL["Product"].schema_type()
    product = spark.range(1).select(
        *[
            {
                "ProductNumber": F.lit('P,"1'), "IsCurrent": F.lit(True), "RowHash": F.unhex(F.lit("ab" * 32)),
                "EffectiveToUtc": F.lit("9999-12-31 00:00:00.123"), "ProductKey": F.lit(-1),
            }.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    tables.write_extract(product, str(tmp_path / "dim" / "Product.csv"))
    assert rows(landing.read_seed(spark, str(tmp_path), "dim", "Product", schema)) == rows(product)


def test_load_if_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(3)
    assert tables.load_if_empty(first.limit(0), path)
    assert tables.load_if_empty(first, path)
    assert not tables.load_if_empty(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_versions_ignore_what_was_not_committed(spark, tmp_path):
    path = str(tmp_path / "dim")
    tables.write_version(spark.range(1), path, 1)
    tables.write_version(spark.range(2), path, 2)
    os.makedirs(f"{path}/v=3")
    assert tables.versions(spark, path) == [1, 2]
    assert tables.read_version(spark, path).count() == 2
    assert tables.read_version(spark, path, before=2).count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, path, before=1)
    failing = spark.range(5).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception):
        tables.write_version(failing, path, 4)
    assert tables.read_version(spark, path).count() == 2
    tables.write_version(spark.range(7), path, 5)
    assert tables.drop_old_versions(spark, path, keep=1) == [1, 2]
    assert tables.versions(spark, path) == [5]


def test_compact(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(1000).repartition(20).write.parquet(source)
    assert tables.compact(spark, source, target) == 1
    files = [f for f in os.listdir(target) if f.endswith(".parquet")]
    assert len(files) == 1 and spark.read.parquet(target).agg(F.sum("id")).first()[0] == 499500


def test_compact_keeps_partition_folders(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    df = spark.range(1000).select("id", F.format_string("%03d", F.col("id") % 3).alias("code"))
    df.repartition(20).write.partitionBy("code").parquet(source)
    tables.compact(spark, source, target)
    folders = sorted(f for f in os.listdir(target) if "=" in f)
    assert folders == ["code=000", "code=001", "code=002"]
    assert all(len([f for f in os.listdir(f"{target}/{d}") if f.endswith(".parquet")]) == 1 for d in folders)
    assert spark.read.parquet(target).agg(F.sum("id")).first()[0] == 499500


def test_compacted_batches_can_be_replaced(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.range(100).select(F.col("id").alias("K"), F.lit(1).cast("bigint").alias("BatchId"))
    schema = df.schema
    for batch in (1, 2):
        tables.replace_batch(df.repartition(10), path, batch)
    whole = sorted(os.listdir(f"{path}/BatchId=2"))
    tables.replace_batch(df.coalesce(1), path, 3)
    before = rows(spark.read.schema(schema).parquet(path))
    assert tables.compact_batches(spark, path, schema, "K") == [1, 2]
    assert sorted(os.listdir(f"{path}/BatchId=2")) != whole
    assert len([f for f in os.listdir(f"{path}/BatchId=1") if f.endswith(".parquet")]) == 1
    assert rows(spark.read.schema(schema).parquet(path)) == before
    tables.replace_batch(df.limit(5), path, 1)
    assert spark.read.schema(schema).parquet(path).filter("BatchId = 1").count() == 5
    assert tables.compact_batches(spark, path, schema, "K") == []


def test_line_breaks_in_quotes_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, 'say "x",\r\ny'), (3, "plain"), (4, None)], "k int, t string")
    path = str(tmp_path / "x")
    tables.write_extract(df, path)
    raw = landing.read_raw(spark, path, df.schema)
    assert landing.rejects(raw, df.schema, 1, "s", "t").isEmpty()
    got = {r.k: r.t for r in landing.typed_rows(raw, df.schema).collect()}
    assert got[1] == "a\nb" and got[3] == "plain" and got[4] is None
    assert got[2].replace("\r\n", "\n") == 'say "x",\ny'


def test_statistics(spark):
    spark.sql("CREATE TABLE analyzed USING parquet AS SELECT id FROM range(10)")
    try:
        tables.analyze(spark, "analyzed")
        detail = spark.sql("DESCRIBE EXTENDED analyzed").filter("col_name = 'Statistics'").first()
        assert "10 rows" in detail.data_type
    finally:
        spark.sql("DROP TABLE analyzed")


def test_batch_run_records_success_and_failure(spark, tmp_path):
    root = str(tmp_path)
    times = iter(dt.datetime(2024, 1, 1, 0, m) for m in range(60))
    clock = lambda: next(times)
    with ct.batch_run(spark, root, 1, "load", clock):
        ct.record_step(spark, root, 1, "merge", "Succeeded", clock(), clock())
    with pytest.raises(RuntimeError):
        with ct.batch_run(spark, root, 2, "load", clock):
            raise RuntimeError("x" * 5000)
    state = ct.latest_runs(ct.read_control(spark, root, "BatchRun"))
    assert rows(state, "BatchId", "BatchStatusCode") == [(1, "Succeeded"), (2, "Failed")]
    error = ct.read_control(spark, root, "LoadError").first()
    assert error.BatchId == 2 and len(error.ErrorMessage) == 4000
    assert ct.read_control(spark, root, "BatchRunStep").count() == 1


def test_watermarks(spark):
    schema = ct.CONTROL_TABLES["LoadWatermark"]
    row = lambda b, t, v: (b, "LOADER", "fact", t, "LoadedAtUtc", v)
    marks = spark.createDataFrame([row(1, "A", "10"), row(1, "B", "11")], schema)
    new = spark.createDataFrame([row(2, "A", "20"), row(2, "C", "5")], schema)
    assert rows(ct.upsert_watermarks(marks, new), "TableName", "WatermarkValue", "BatchId") == [("A", "20", 2), ("B", "11", 1), ("C", "5", 2)]
    df = spark.range(5)
    assert ct.above_watermark(df, "id", F.lit(2)).count() == 2
    assert ct.above_watermark(df, "id", F.lit(None).cast("long")).count() == 5


def test_purge_and_settings(spark, tmp_path):
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    log = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 20)), (3, None)], "BatchId long, OccurredAtUtc timestamp_ntz")
    assert rows(ct.purge(log, "LoadError", now), "BatchId") == [(2,), (3,)]
    assert rows(ct.expired(log, "OccurredAtUtc", now), "BatchId") == [(1,)]
    config = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "TargetTableName string, IsEnabled boolean")
    assert rows(ct.load_config(config), "TargetTableName") == [("a",), ("c",)]
    put(f"{tmp_path}/1/f.csv", "x")
    put(f"{tmp_path}/2/f.csv", "x")
    os.utime(f"{tmp_path}/1", (1000, 1000))
    assert landing.expired_batches(spark, str(tmp_path), 2_000_000) == ["1"]
    assert landing.purge_landing(spark, str(tmp_path), 2_000_000) == 1 and os.listdir(tmp_path) == ["2"]


def test_shared_folder_is_the_one_named(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_decimal_and_flag_text(spark, tmp_path):
    df = spark.createDataFrame([(Decimal("1.5000"), True), (None, None)], "a decimal(18,4), b boolean")
    tables.write_extract(df, str(tmp_path / "x"))
    text = "".join(open(tmp_path / "x" / f).read() for f in os.listdir(tmp_path / "x") if f.endswith(".csv"))
    assert "1.5000,1" in text and "True" not in text


def test_a_batch_of_many_rows_in_small_files_is_sorted_by_several_tasks(spark, tmp_path, monkeypatch):
    """Files that compress well say little of the rows that a task sorts: it is given no more than its share."""
    path = str(tmp_path / "fact")
    rows = spark.range(20_000).select(F.lit(1).cast("bigint").alias("BatchId"), (F.col("id") % 100).cast("int").alias("day"))
    rows.repartition(4).write.partitionBy("BatchId").parquet(path)
    monkeypatch.setattr(tables, "SORT_BYTES", 100_000)  # 5,000 rows of 20 bytes
    assert tables.compact_batches(spark, path, rows.schema, "day") == [1]
    stored = spark.read.schema(rows.schema).parquet(path).withColumn("f", F.col("_metadata.file_path"))
    files = stored.groupBy("f").agg(F.min("day").alias("low"), F.max("day").alias("high"), F.count("*").alias("n")).orderBy("low").collect()
    assert len(files) > 1 and max(r.n for r in files) < 10_000 and sum(r.n for r in files) == 20_000
    assert all(a.high < b.low for a, b in zip(files, files[1:], strict=False))
    assert tables.compact_batches(spark, path, rows.schema, "day") == []
