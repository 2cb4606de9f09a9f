import pytest
from pyspark.sql import functions as F

from hoarfrost.operators import joins as jn
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    # Key 1 holds most of the rows, one key is NULL, key 9 has no parent.
    left = spark.createDataFrame(
        [(1, n) for n in range(40)] + [(2, 100), (None, 101), (None, 102), (9, 103), (-1, 104)], "k int, n int"
    )
    right = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three"), (-1, "unknown")], "key int, name string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_right_side_gives_the_same_rows(sides, how):
    left, right = sides
    small = jn.sized_join(left, right, {"k": "key"}, how, limit=2**60)
    plain = jn.sized_join(left, right, {"k": "key"}, how, limit=0, heavy_rows=None)
    split = jn.sized_join(left, right, {"k": "key"}, how, limit=0, heavy_rows=5)
    assert rows(small) == rows(plain) == rows(split)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_heavy_keys_are_cut_by_their_size(spark, sides):
    left, _ = sides
    heavy = jn.heavy_keys(left, ["k"], 5).collect()
    assert [r["__cut"] for r in heavy] == [8]


def test_heavy_key_is_spread_over_salts(sides):
    left, right = sides
    heavy = jn.heavy_keys(left, ["k"], 5)
    marked = jn._mark(left, ["k"], heavy).withColumn("s", F.pmod(F.xxhash64("k", "n"), F.col("__pieces")))
    assert marked.filter("k = 1").select("s").distinct().count() > 4
    assert marked.filter("k <> 1 or k is null").select("s").distinct().count() == 1


def test_null_safe(sides, spark):
    left, _ = sides
    right = spark.createDataFrame([(None, "none"), (2, "two")], "key int, name string")
    for limit in (0, 2**60):
        got = jn.sized_join(left, right, {"k": "key"}, null_safe=True, limit=limit, heavy_rows=1)
        assert rows(got) == [(2, 100, "two"), (None, 101, "none"), (None, 102, "none")]


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [(1, "A", False), (2, "A", True), (3, "B", True), (4, "Closed", False)], "Key int, Code string, IsCurrent boolean"
    )


def test_resolve_key(spark, dim):
    stage = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Closed"), (4, "Missing"), (5, None), (6, "b")], "n int, code string")
    got = jn.resolve_key(stage, dim, "code", "Code", "Key", "Out", current_only=True, miss="Miss")
    assert rows(got, "n", "Out", "Miss") == [
        (1, 2, False), (2, 3, False), (3, -1, True), (4, -1, True), (5, -1, False), (6, -1, True)
    ]
    folded = jn.resolve_key(stage, dim, "code", "Code", "Key", "Out", current_only=True, ci_keys=True)
    assert rows(folded, "n", "Out")[5] == (6, 3)


def test_check_key(spark, dim):
    stage = spark.createDataFrame([(1, 3), (2, 99), (3, None), (4, -1)], "n int, Key int")
    assert rows(jn.check_key(stage, dim, "Key", "Key"), "n", "Key") == [(1, 3), (2, -1), (3, -1), (4, -1)]


def test_orphans_count_rows_per_key(spark, dim):
    fact = spark.createDataFrame([(1,), (7,), (7,), (8,), (-1,), (None,)], "fk int")
    assert rows(jn.orphans(fact, dim, "fk", "Key")) == [(7, 2), (8, 1)]
    assert rows(jn.orphans(fact, dim, "fk", "Key", exempt_unknown=False)) == [(-1, 1), (7, 2), (8, 1)]


def test_via_bridge_fans_out(spark):
    parts = spark.createDataFrame([(1, "p1"), (2, "p2")], "Part int, name string")
    bridge = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 11)], "Part int, Supplier int")
    suppliers = spark.createDataFrame([(10, "s10"), (11, "s11")], "Id int, supplier_name string")
    got = jn.via_bridge(parts, bridge, "Part", suppliers, "Supplier", "Id")
    assert rows(got, "Part", "name", "supplier_name") == [(1, "p1", "s10"), (1, "p1", "s11"), (2, "p2", "s10")]
