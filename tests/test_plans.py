"""What the plans of registered queries must and must not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hoarfrost.operators import aggregates, filters
from hoarfrost.model import Origin
from hoarfrost.operators import joins as jn
from hoarfrost.plans import catalog, reports
from hoarfrost.sources.trade import AS_OF, MODEL, manufacturing_warehouse, trade_warehouse

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    n for n in entry.queries()
    if n.startswith(("rp_", "ah_", "jn_", "ag_", "flt_", "fn_", "sl_", "so_d", "so_union", "prj_", "wn_share", "dq_"))
    and n not in ("rp_run_all", "flt_current", "dq_bk_unique", "dq_missing_lookup", "dq_snowflake_depth", "so_union_all_recursive")
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in text


def test_windows_reach_the_raw_scan(spark):
    for name, column in (("rp_oee_plant_month", "l_shipdate"), ("rp_incident_trend", "o_orderdate")):
        text = plan(entry.queries()[name](spark, FOLDER))
        scan = next(x for x in text.splitlines() if "FileScan" in x and column in x and "GreaterThanOrEqual" in x)
        assert f"GreaterThanOrEqual({column}" in scan


def pushed(df, column):
    return [x for x in plan(df).splitlines() if "FileScan" in x and f"GreaterThanOrEqual({column}" in x and f"LessThan({column}" in x]


def test_key_bounds_reach_the_raw_date_of_the_scan(spark):
    for name, column in (("flt_batch", "l_shipdate"), ("flt_datekey_years", "o_orderdate"), ("ah_rollup", "l_shipdate")):
        assert pushed(entry.queries()[name](spark, FOLDER), column), name
    text = plan(entry.queries()["flt_rolling_months"](spark, FOLDER))
    assert any("FileScan" in x and "GreaterThanOrEqual(l_shipdate" in x for x in text.splitlines())
    # Lines of other years' orders are not put together.
    assert "LeftSemi" in plan(entry.queries()["flt_datekey_years"](spark, FOLDER))


@pytest.mark.parametrize(("key", "grain", "first"), [
    (19990601, "day", "1999-06-01"), (19990631, "day", "1999-07-01"), (19991232, "day", "2000-01-01"), (19991301, "day", "2000-01-01"), (20000000, "day", "2000-01-01"),
    (20000229, "day", "2000-02-29"), (20010229, "day", "2001-03-01"), (199906, "month", "1999-06-01"), (199913, "month", "2000-01-01"), (199900, "month", "1999-01-01"),
])
def test_first_day_of_a_key(key, grain, first):
    assert Origin("t", "d", grain).first_day(key) == dt.date.fromisoformat(first)


def test_bounded_tables_lose_no_row(spark):
    wh = trade_warehouse(spark, FOLDER)
    for name, column, low, high in (("OrderLine", "ShipDateKey", 19960315, 19970299), ("OrderLine", "BatchId", 199603, 199612), ("OrderCycle", "OrderDateKey", None, 19960229), ("CustomerEvent", "EventDateKey", 20240103, None)):
        between = F.lit(True) if low is None else F.col(column) >= low
        between = between if high is None else between & (F.col(column) <= high)
        small, whole = wh.bounded(name, column, low, high), wh[name]
        assert sorted(map(str, small.filter(between).collect())) == sorted(map(str, whole.filter(between).collect()))
        assert 0 < small.count() < whole.count()
    assert wh.bounded("OrderLine", "PartKey", 1, 2) is wh["OrderLine"]


def wide(spark, n, columns, key):
    return spark.range(n).select(F.col("id").alias(key), *[F.lit("x").alias(f"{key}{i}") for i in range(columns)])


def test_a_wide_ancestor_is_not_broadcast_for_its_narrow_child(spark, monkeypatch):
    """A small child with a wide ancestor: what is broadcast is as wide as both."""
    fact = spark.range(50).select((F.col("id") % 5).alias("child"))
    child = wide(spark, 100_000, 0, "c").withColumn("up", F.col("c") % 10)
    for columns, how in ((1, True), (80, False)):
        levels = [("child", child, "c"), ("up", wide(spark, 10, columns, "p"), "p")]
        monkeypatch.setattr(jn, "BROADCAST_LIMIT", 40_000_000)
        # Aggregated, so that no broadcast is the planner's own choice.
        text = jn.climb(fact, levels)._jdf.queryExecution().analyzed().toString()
        assert (text.count("strategy=broadcast") == 2) is how, columns


def test_a_fact_with_fifty_parents_keeps_to_its_budget(spark, monkeypatch):
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", jn.EXPANSION * 8 * 1000)  # a parent of 1,000 keys
    monkeypatch.setattr(jn, "BROADCAST_SIDES", 10)
    fact = spark.range(100).select(*[(F.col("id") % 10).alias(f"k{i}") for i in range(50)])
    dims = {f"k{i}": (spark.range(1000).select(F.col("id").alias(f"d{i}")), f"d{i}") for i in range(50)}
    joined = jn.star_join(fact, dims)
    hinted = joined._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")
    # Ten parents, and the (empty) lists of heavy keys of the others, two each.
    assert hinted == 10 + 2 * 40


def test_batch_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(10).selectExpr("id", "id % 3 AS BatchId").write.partitionBy("BatchId").parquet(path)
    text = plan(filters.batch(spark.read.parquet(path), 1))
    assert "PartitionFilters: [isnotnull(BatchId" in text


def test_large_dimension_is_shuffled_not_broadcast(spark, monkeypatch):
    wh = trade_warehouse(spark, FOLDER)
    lines = wh["OrderLine"].select("SupplierKey", "QuantityAmount")
    suppliers = wh["Supplier"].select("SupplierKey", "SupplierNumber")
    expected = sorted(map(str, jn.sized_join(lines, suppliers, {"SupplierKey": "SupplierKey"}).collect()))
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", 0)
    monkeypatch.setattr(jn, "HEAVY_ROWS", 50)
    big = jn.sized_join(lines, suppliers, {"SupplierKey": "SupplierKey"}, heavy_rows=50)
    assert "__salt" in plan(big)
    assert sorted(map(str, big.collect())) == expected


@pytest.mark.parametrize("name", ["oee_plant_month", "quality_mix", "variance_line", "incident_trend"])
def test_reports_hold_beyond_the_broadcast_limit(spark, monkeypatch, name):
    run = lambda: sorted(map(str, reports.REPORTS[name](manufacturing_warehouse(spark, FOLDER), AS_OF).collect()))
    expected = run()
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", 0)
    assert run() == expected


def test_top_ranked_ranks_before_no_more_than_the_top(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.pmod(F.col("id") * 37, F.lit(100)).alias("m"), "id")
    from pyspark.sql import Window

    full = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("m"))).cast("bigint"))
    expected = full.orderBy(F.desc("m"), "id").limit(40).collect()
    got = aggregates.top_ranked(df, ["g"], "m", ["id"], 40, "r").orderBy(F.desc("m"), "id").collect()
    assert got == expected
    assert "TakeOrderedAndProject" in plan(aggregates.top_ranked(df, ["g"], "m", ["id"], 40, "r"))


def test_dense_rank_by_bands(spark):
    from pyspark.sql import Window

    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"),
        F.when(F.col("id") % 50 != 0, F.pmod(F.col("id") * 7919, F.lit(301)).cast("decimal(18,4)")).alias("m"),
        "id",
    )
    window = Window.partitionBy("g").orderBy(F.desc("m"))
    expected = sorted(map(str, df.withColumn("r", F.dense_rank().over(window).cast("bigint")).collect()))
    got = aggregates.with_dense_rank(df, ["g"], "m", "r", bands=8)
    assert sorted(map(str, got.collect())) == expected


def test_share_both_ways(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 0), (None, 5)], "g string, n long")
    one = aggregates.with_share(df, "n", ["g"], "t", "p")
    two = aggregates.with_share_of_totals(df, "n", ["g"], "t", "p")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert one.filter("g = 'b'").first().p is None


def test_window_months(spark):
    from hoarfrost.functions.scalars import months_before

    for day, months in ((dt.date(2024, 3, 31), 1), (dt.date(2024, 1, 15), 24), (dt.date(2023, 12, 31), 1), (dt.date(2024, 8, 31), 6)):
        expected = spark.range(1).select(F.add_months(F.lit(day.isoformat()).cast("date"), -months)).first()[0]
        assert months_before(day, months) == expected


def test_every_query_has_sql_and_the_model_is_sound():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    for spec in MODEL.tables.values():
        for fk in spec.references:
            assert fk.parent in MODEL


def test_a_side_whose_files_are_small_for_its_rows_is_not_broadcast(spark, tmp_path):
    """Files of some 11 MB that hold three million rows: as a hash table they would take some 200 MB of the driver."""
    path = str(tmp_path / "orders")
    spark.range(3_000_000).select("id", (F.col("id") % 1000).alias("c"), (F.col("id") % 500).cast("int").alias("d")).coalesce(1).write.parquet(path)
    orders = spark.read.schema("id bigint, c bigint, d int").parquet(path)
    assert 8_000_000 < jn.plan_bytes(orders) < 30_000_000
    fact = spark.range(10).select(F.col("id").alias("k"))
    for heavy in (None, 50):
        joined = jn.sized_join(fact, orders, {"k": "id"}, "left", heavy_rows=heavy)
        # The only broadcasts are the two (empty) lists of heavy keys.
        assert joined._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == (0 if heavy is None else 2)
        assert joined.count() == 10


def test_a_side_over_the_limit_is_not_broadcast_by_the_planner_either(spark, tmp_path):
    """Files of some 5 MB that hold over a million rows: under the ten megabytes up to which the planner
    broadcasts by itself, and over a megabyte, which may take 55 MB of the driver."""
    path = str(tmp_path / "customers")
    spark.range(1_200_000).select("id", (F.col("id") % 25).cast("int").alias("n")).coalesce(1).write.parquet(path)
    customers = spark.read.schema("id bigint, n int").parquet(path)
    assert 2_000_000 < jn.plan_bytes(customers) < 10_000_000
    fact = spark.range(10).select(F.col("id").alias("k"))
    for how in ("left", "inner"):
        joined = jn.sized_join(fact, customers, {"k": "id"}, how, heavy_rows=50)
        # The only broadcasts are the two (empty) lists of heavy keys, also when its stages are known.
        assert joined.count() == 10
        joined.collect()
        assert plan(joined).count("BroadcastExchange") == 2


@pytest.mark.parametrize("name", ["ah_rollup", "ah_top_measure", "ah_distinct", "jn_star", "dq_fk_revalidate"])
def test_queries_hold_beyond_the_broadcast_limit(spark, monkeypatch, name):
    run = lambda: sorted(map(str, entry.queries()[name](spark, FOLDER).collect()))
    expected = run()
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", 0)
    assert run() == expected
