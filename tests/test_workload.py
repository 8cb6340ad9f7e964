"""Registered queries against their SQL on the smallest tables, and the shape of their plans."""

import os
import subprocess
import sys
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from workload import ALL, failing
from workload.check import compare, connect, normal

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver tables are not here")
SLOW = (
    "dealership_", "dashboard_", "silver_", "identity_", "dimension_keys", "client_dimension", "product_mapping",
    "broken_", "proof_failures", "proofs_report",
)
LAYERS = [
    "silver_sales", "silver_parts", "identity_quarantine", "dealership_sales_fact", "dashboard_sales_dataset",
    "dashboard_sellers_order", "dashboard_stages_order", "proofs_report", "broken_fact_contracts", "proof_failures",
    "broken_dimension_keys", "broken_silver_contracts",
]


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


def check(spark, sql, query):
    df = contract.queries()[query.name](spark, SF)
    res = sql.execute(query.sql)
    problem = compare(normal(df.columns, df.collect()), normal([d[0] for d in res.description], res.fetchall()))
    assert problem is None, problem
    return df


def assert_joins_by_key(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonMapInArrow"):
        assert bad not in plan, bad


@pytest.mark.parametrize("query", [q for q in ALL if not q.name.startswith(SLOW)], ids=lambda q: q.name)
def test_operator_query(spark, sql, query):
    check(spark, sql, query)


@pytest.mark.parametrize("name", LAYERS)
def test_dealership_query(spark, sql, name):
    query = next(q for q in ALL if q.name == name)
    df = check(spark, sql, query)
    assert_joins_by_key(df)


def test_contract_is_complete(spark):
    # Other modules may add queries of their own.
    names = {q.name for q in ALL}
    assert names <= contract.queries().keys() and names <= contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("query", [q for q in ALL if not q.name.startswith(SLOW)], ids=lambda q: q.name)
def test_plans_have_no_cartesian_product_and_no_python(spark, query):
    assert_joins_by_key(contract.queries()[query.name](spark, SF))


def test_entry_stands_without_the_other_operators(tmp_path):
    """With an empty folder in place of the subpackage, or without what it imports, the other queries load."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys\n"
        "class Missing:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('garimpo.llm.') or name == 'public_tokenizers':\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Missing())\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(ALL)), "False"], done.stderr[-800:]


@pytest.mark.parametrize("name", ["dashboard_kpis", "dashboard_choices"])
def test_figures_without_clients_leave_the_client_dimension_alone(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SK_PRODUTO" in plan and "SK_CLIENTE" not in plan


def test_damaged_facts_are_written_once(spark, tmp_path):
    """Every contract and proof reads them again: as files, with a row told twice on one path."""
    ids = [f"CLI{i}-{1 + i % 3}" for i in range(400)] + [None]
    fact = spark.createDataFrame([(x, 1, 2, 3, "c", Decimal(10)) for x in ids], "ID_REGISTRO string, SK_PRODUTO long, SK_CLIENTE long, SK_VENDEDOR long, ID_CLIENTE_ORIGEM string, VALOR_FATURAMENTO decimal(18,2)")
    months = spark.createDataFrame([(f"2024-{1 + i % 12:02}-VW{i}", i) for i in range(60)], "ID_REGISTRO string, SK_PRODUTO long")

    class Small(dict):
        out = str(tmp_path)

    lake = Small(fato_vendas=fact, fato_oportunidade=fact.withColumn("SK_CANAL", F.lit(4).cast("bigint")), fato_estoque_mensal=months)
    got = failing.damaged_facts(lake)
    for name, df in got.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.startswith("Relation") and "Union" not in plan, plan
        assert df.columns == lake[name].columns
    number = {x: int(x[3:].split("-")[0]) + 31 * int(x.split("-")[1]) for x in ids if x}
    told = Counter()
    for x, m in number.items():
        if m % 17 != 3:
            told["X" + x if m % 23 == 7 else x] += 1 + (m % 19 == 5)
    assert Counter(r["ID_REGISTRO"] for r in got["fato_vendas"].collect()) == told == Counter(r["ID_REGISTRO"] for r in got["fato_oportunidade"].collect())
