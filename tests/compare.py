"""Run registered queries and their SQL side by side and compare names, types and values.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "binary": "BLOB",
}


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What is unlike between a Spark result and the SQL's; empty when they agree."""
    found = []
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    relation = con.sql(sql)
    sql_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if set(spark_types) != set(sql_types):
        return [f"columns: only in query {set(spark_types) - set(sql_types)}, only in SQL {set(sql_types) - set(spark_types)}"]
    for name, t in spark_types.items():
        expected = t.upper() if t.startswith("decimal") else TYPES.get(t, t)
        if expected.replace(" ", "") != sql_types[name].replace(" ", ""):
            found.append(f"type of {name}: query {t}, SQL {sql_types[name]}")
    names = sorted(spark_types)
    ours = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    order = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        found.append(
            f"rows: {sum(ours.values())} against {sum(theirs.values())}, unlike {sum(only_ours.values())}; "
            f"{names}; query has {list(only_ours)[:2]}; SQL has {list(only_theirs)[:2]}"
        )
    return found


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from hoarfrost.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.log.level": "ERROR",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    con, bad = duck(folder), 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            problems = differences(df, con, oracle[name]) if name in oracle else [f"no SQL, {df.count()} rows"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems) and name in oracle
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - started:.2f}s", *problems, sep="\n    " if problems else " ", flush=True)
    print(f"{bad} bad of {len(sys.argv[2:] or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
