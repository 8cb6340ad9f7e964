"""The raw sales against their SQL, and how many rows meet in their joins."""

import datetime

import duckdb
import pytest

from workload import raw

DAY = datetime.datetime(1995, 3, 17)
LINES = [
    (order, 10 + i, i % 3, line, 1000.0 + 37 * i, 0.05 * line, returned, status, DAY)
    for i, order in enumerate((1, 2, 3, 13, None, 99))
    for line, (returned, status) in enumerate([("A", "F"), ("R", "F"), ("A", None), (None, "F"), ("A", "O")])
]
TABLES = {
    # A line twice, orders without a customer and a customer twice.
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [*LINES, LINES[0]],
    ),
    "orders": ("o_orderkey long, o_custkey long", [(1, 19), (2, 23), (3, 7), (13, 19), (13, 404), (99, None)]),
    "customer": (
        "c_custkey long, c_name string, c_mktsegment string",
        [(19, "Customer#19", "BUILDING"), (23, "Customer#23", None), (7, "Customer#7", "MACHINERY"), (7, "Customer#7b", "HOUSEHOLD"), (None, "none", "BUILDING")],
    ),
    "supplier": ("s_suppkey long, s_name string", [(0, "Supplier#0"), (1, "Supplier#1"), (2, None)]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("raw")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["bronze_erp", "defeitos_erp"])
def test_sales_are_those_of_the_sql_and_lines_are_exchanged_once(spark, folder, name):
    text, columns = raw.RAW[name]
    known = duckdb.connect()
    for table in TABLES:
        known.sql(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet/*.parquet'")
    expected = known.sql(f"SELECT {', '.join(columns)} FROM ({raw.plain_sql(text)})").fetchall()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        derived = raw.derive(spark, folder, text, columns)
        plan = derived._jdf.queryExecution().executedPlan().toString()
        got = [tuple(r) for r in derived.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert expected and sorted(got, key=str) == sorted(expected, key=str)
    # By order, and orders and customers by customer; lines meet no other exchange before the one for their supplier.
    assert "RoundRobin" not in plan and "Union" not in plan
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and plan.count("Exchange hashpartitioning(l_") == 2
