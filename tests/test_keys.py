import datetime as dt

import pytest
from pyspark.sql import functions as F

from hoarfrost.operators import keys
from tests.conftest import rows
from tests.warehouse_fixture import MODEL


def test_numbers_are_dense_and_repeatable(spark):
    names = spark.range(1000).select(F.concat(F.lit("n"), F.col("id")).alias("name"))
    first = rows(keys.numbered(names, ["name"], "n"))
    again = rows(keys.numbered(names.repartition(7), ["name"], "n"))
    assert first == again
    assert sorted(n for _, n in first) == list(range(1, 1001))


def test_numbers_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    names = spark.range(500).select(F.concat(F.lit("n"), F.col("id")).alias("name"))
    want = rows(keys.numbered(names, ["name"], "n"))
    for aimed_at, digits in ((40, 1), (5, 2), (0.5, 3), (0.01, 4)):
        monkeypatch.setattr(keys, "BUCKET_ROWS", aimed_at)
        assert keys.bucket_digits(names) == digits
        assert rows(keys.numbered(names, ["name"], "n")) == want


def test_numbers_within_a_hot_group(spark):
    df = spark.range(600).select(F.when(F.col("id") < 400, "hot").when(F.col("id") < 500, F.lit(None)).otherwise("cold").alias("g"), "id")
    got = keys.numbered(df, ["id"], "n", within=["g"]).groupBy("g").agg(F.sort_array(F.collect_list("n")).alias("n"))
    assert {r["g"]: r["n"] for r in got.collect()} == {
        "hot": list(range(1, 401)), None: list(range(1, 101)), "cold": list(range(1, 101))
    }


def test_assign_keys_continues_after_the_highest(spark):
    dim = spark.createDataFrame([(-1,), (41,)], "K int")
    got = keys.assign_keys(spark.createDataFrame([("a",), ("b",)], "bk string"), ["bk"], "K", keys.highest_key(dim, "K"))
    assert sorted(r["K"] for r in got.collect()) == [42, 43]
    empty = spark.createDataFrame([(-1,)], "K int")
    got = keys.assign_keys(spark.createDataFrame([("a",)], "bk string"), ["bk"], "K", keys.highest_key(empty, "K"))
    assert [r["K"] for r in got.collect()] == [1]


def test_unknown_member(spark):
    spec = MODEL["Product"]
    dim = spark.createDataFrame([], spec.schema_type())
    once = keys.with_unknown(dim, spec)
    assert keys.with_unknown(once, spec).count() == 1
    row = once.first()
    assert (row.ProductKey, row.ProductFamilyKey, row.ProductNumber, row.ProductName) == (-1, -1, "UNKNOWN", "Unknown")
    assert (row.BatchId, row.IsCurrent, row.EffectiveFromUtc) == (0, False, dt.datetime(1900, 1, 1))
    assert bytes(row.RowHash) == bytes(32)


def test_dedupe_business_key(spark):
    df = spark.createDataFrame(
        [(1, "AAAA"), (2, "AAAA"), (3, "AAAA"), (4, "AA-2"), (5, "B"), (6, None), (7, None)], "id int, bk string"
    )
    got = {r["id"]: r["bk"] for r in keys.dedupe_business_key(df, "bk", ["id"], limit=4).collect()}
    present = [v for v in got.values() if v is not None]
    assert len(set(present)) == 5 and all(len(v) <= 4 for v in present)
    assert got[5] == "B" and got[6] is None and got[7] is None
    # The key that was there before a made one met it is still in use.
    assert {"AAAA", "AA-2"} <= set(present)


def test_made_keys_may_meet_many_that_were_there(spark):
    there = [f"A-{n}" for n in range(2, 40)]
    df = spark.createDataFrame(list(enumerate(["A", "A", *there])), "id int, bk string")
    for limit in (4, 24):
        got = [r["bk"] for r in keys.dedupe_business_key(df, "bk", ["id"], limit=limit).collect()]
        assert len(set(got)) == len(got) == 40 and {"A", *there} <= set(got) and max(map(len, got)) <= limit
    with pytest.raises(ValueError, match="cannot be made unique"):
        keys.dedupe_business_key(spark.createDataFrame([(i, "A") for i in range(12)], "id int, bk string"), "bk", ["id"], limit=1)
