from pyspark.sql import functions as F

from hoarfrost.operators import joins as jn
from hoarfrost.operators import quality as dq
from hoarfrost.sources import trade
from tests.conftest import rows
from tests.warehouse_fixture import MODEL


def test_small_and_large_parents_find_the_same_orphans(spark, monkeypatch):
    fact = spark.createDataFrame([(1, 5), (2, 6), (2, 7), (-1, 5), (None, -1)], "AKey int, BKey int")
    parents = {
        "AKey": (spark.createDataFrame([(1,)], "AKey int"), "AKey"),
        "BKey": (spark.createDataFrame([(5,), (6,)], "BKey int"), "BKey"),
    }
    expected = [("Orphan FK AKey", "fact.T", 5, 2), ("Orphan FK BKey", "fact.T", 5, 1)]
    for small in (True, False):
        monkeypatch.setattr(dq, "fits_broadcast", lambda df: small)
        assert rows(dq.orphan_checks(fact, "fact.T", parents)) == expected
    assert rows(dq.orphan_checks(fact, "fact.T", parents, exempt_unknown=False), "rule", "failed") == [
        ("Orphan FK AKey", 3), ("Orphan FK BKey", 2)
    ]


def test_large_parents_are_counted_in_one_pass_and_not_broadcast(spark, monkeypatch):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (-1, "a"), (None, None)], "AKey int, BKey string")
    parents = {
        "AKey": (spark.createDataFrame([(1,), (1,), (None,)], "AKey bigint"), "AKey"),  # a key that repeats
        "BKey": (spark.createDataFrame([("a",), ("b",)], "BKey string"), "BKey"),
    }
    none = spark.createDataFrame([], "AKey int, BKey string")
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", 0)
    for exempt, lost in ((True, 1), (False, 2)):
        checks = dq.orphan_checks(fact, "fact.T", parents, exempt)
        assert rows(checks) == [("Orphan FK AKey", "fact.T", 5, lost), ("Orphan FK BKey", "fact.T", 5, 1)]
    assert "Join" not in checks._jdf.queryExecution().optimizedPlan().toString()
    empty = {fk: (parent.limit(0), key) for fk, (parent, key) in parents.items()}
    assert rows(dq.orphan_checks(none, "fact.T", empty)) == [("Orphan FK AKey", "fact.T", 0, 0), ("Orphan FK BKey", "fact.T", 0, 0)]


def test_the_checks_of_all_tables_share_one_budget(spark, monkeypatch):
    """Two tables with a parent each, where one plan may broadcast one such parent."""
    wh = trade.trade_warehouse(spark, "/root/testdata/sf0.001")
    tables = {name: wh[name] for name in ("Nation", "Customer", "Supplier")}
    expected = rows(dq.foreign_key_checks(trade.MODEL, tables, ("dim",), True))
    one = jn.broadcast_bytes(tables["Nation"].select("NationKey"))
    monkeypatch.setattr(jn, "BROADCAST_LIMIT", 1.5 * one)
    monkeypatch.setattr(jn, "BROADCAST_SIDES", 1)
    checks = dq.foreign_key_checks(trade.MODEL, tables, ("dim",), True)
    assert checks._jdf.queryExecution().analyzed().toString().count("strategy=broadcast") == 1
    assert rows(checks) == expected


def test_profile_is_one_aggregate(spark):
    spec = MODEL["ProductionOrder"]
    df = spark.createDataFrame([], spec.schema_type())
    checks = dq.profile(df, spec, [dq.Rule("Too many", "fact.ProductionOrder", "OrderQuantity > 9")])
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    found = rows(checks, "rule", "checked", "failed")
    assert ("Too many", 0, 0) in found and ("Null key ProductKey", 0, 0) in found
    assert ("Negative measure OrderQuantity", 0, 0) in found


def test_results(spark):
    checks = spark.createDataFrame([("R one", "fact.T", 10, 0), ("R two", "fact.T", 10, 3), ("R three", "t", 0, None)],
                                   "rule string, `table` string, checked long, failed long")
    got = dq.results(checks, 4, F.lit("2024-01-01"))
    assert rows(got, "rule_code", "failed", "status", "batch_id") == [
        ("R_ONE_FACT_T", 0, "Pass", 4), ("R_THREE_T", 0, "Pass", 4), ("R_TWO_FACT_T", 3, "Fail", 4)
    ]


def test_long_rule_codes_do_not_meet(spark):
    names = [(f"Null key {'Long' * 15}{c}", "fact.T", 1, 0) for c in "ab"]
    checks = spark.createDataFrame(names, "rule string, `table` string, checked long, failed long")
    codes = [r.RuleCode for r in dq.new_rules(spark.createDataFrame([], "RuleCode string"), checks).collect()]
    assert len(set(codes)) == 2 and all(len(c) == 50 for c in codes)
    known = spark.createDataFrame([(codes[0],)], "RuleCode string")
    assert [r.RuleCode for r in dq.new_rules(known, checks).collect()] == [codes[1]]


def test_uniqueness(spark):
    spec = MODEL["Product"]
    df = spark.createDataFrame(
        [(1, "A", False), (2, "A", True), (3, "B", True), (3, "B", True), (None, None, True)],
        "ProductKey int, ProductNumber string, IsCurrent boolean",
    )
    assert rows(dq.primary_key_unique(df, spec), "checked", "failed") == [(5, 2)]
    assert rows(dq.business_key_unique(df, spec), "checked", "failed") == [(4, 2)]
    pairs = spark.createDataFrame([(1, 2), (1, 2), (1, 2), (2, 1)], "PrimaryProductKey int, SubstituteProductKey int")
    assert rows(dq.members_unique(pairs, MODEL["ProductSubstitute"]), "checked", "failed") == [(4, 2)]
    assert rows(dq.unknown_member_present(df, spec), "failed") == [(1,)]


def test_closure_takes_the_longest_way_and_survives_a_circle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "b"), ("x", "x")], "child string, parent string")
    got = {(r.child, r.ancestor): r.depth for r in dq.climb_closure(edges).collect()}
    assert got[("a", "c")] == 2 and got[("a", "d")] == 3 and ("x", "x") not in got
    assert got[("d", "c")] == 2 and ("a", "a") not in got


def test_depth_of_the_fixture(spark):
    depth = dq.snowflake_depth(dq.catalog_edges(spark, MODEL)).collect()
    assert [tuple(r) for r in depth] == [("Product", 3), ("ProductFamily", 2), ("ProductLine", 1)]
    columns = dq.catalog_columns(spark, MODEL)
    assert columns.filter("table_name = 'Product' AND column_name = 'RowHash'").count() == 1


def test_duplicate_keys_are_counted_by_as_many_tasks_as_the_files_ask_for(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bridge")
    keys = [(i % 50, None if i % 10 == 0 else i) for i in range(200)] + [(1, 1)] * 3
    spark.createDataFrame(keys, "PartKey bigint, SupplierKey bigint").write.parquet(path)
    pairs = spark.read.schema("PartKey bigint, SupplierKey bigint").parquet(path)
    monkeypatch.setattr(jn.pieces_of, "__defaults__", (100,))
    spec = trade.MODEL["PartSupplier"]
    found = dq.members_unique(pairs, spec)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One map of keys in a task, dealt by number, so that small tasks are not put together again.
    assert "REPARTITION_BY_NUM" in plan and jn.pieces_of(pairs) > 10
    assert [(r.checked, r.failed) for r in found.collect()] == [(203, 3)]
    assert [(r.checked, r.failed) for r in dq._duplicate_rows(pairs, ["PartKey", "SupplierKey"], "t", "r", True).collect()] == [(203, 23)]
    unknown = spark.createDataFrame(keys, "PartKey bigint, SupplierKey bigint")
    assert [(r.checked, r.failed) for r in dq.members_unique(unknown, spec).collect()] == [(203, 3)]
