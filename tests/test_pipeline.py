"""The whole load over small raw files, and what stops it."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from garimpo.operators import contracts, versions
from garimpo.operators.contracts import ContractBroken
from garimpo.plans import gold, pipeline, spec
from garimpo.sources import control, raw, tables
from tests.test_silver import lead, position, sale, split_amount
from workload import lake

LEADS = [
    lead(id_cliente="CLI500001", etapa="Negociacao"),
    lead(id_cliente="CLI500001", etapa="Negociacao"),
    lead(id_cliente="CLI500002", cliente="Noa Dias", contato=None, fonte="OLX", data_interesse="15/12/2023"),
]
SALES = [
    sale(), sale(), sale(valor_padrao="75400.20"),
    split_amount(sale(id_cliente="CLI500008"), "custo", "70.011", "99"),
]
POSITIONS = [position(estoque_atual="1"), position(estoque_atual="2"), position(mes_referencia="12/2023", estoque_atual="3")]


def write(root, leads=LEADS, sales=SALES, positions=None):
    positions = positions or [position(cod_produto="VW-NIV", produto="Nivus", estoque_atual="7"), *POSITIONS]
    content = {"crm": (spec.LEAD_COLUMNS, leads), "erp": (spec.SALE_COLUMNS, sales), "estoque": (spec.POSITION_COLUMNS, positions)}
    for s in spec.SOURCES:
        path = s.path(str(root))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        columns, rows = content[s.table]
        with open(path, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(columns)
            out.writerows([["" if v is None else v for v in r] for r in rows])
    return str(root)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    # One sale shares its client with two leads and another name, so that client is held.
    sales = [*SALES, sale(id_cliente="CLI500001", nome_cliente="Outra Pessoa")]
    return pipeline.run(spark, write(root, sales=sales), str(tmp_path_factory.mktemp("lake")), "t", prefix="t_")


def test_all_tables_are_there_and_named(spark, loaded):
    names = {
        "quarentena_cliente_identidade", "quarentena_estoque_mensal", "dim_cliente", "dim_produto", "dim_vendedor",
        "dim_pagamento", "dim_canal", "dim_calendario", "fato_vendas", "fato_oportunidade", "fato_estoque_mensal",
        "mart_vendas_por_vendedor", "mart_produto_performance", "mart_financeiro", "mart_funil_comercial", "_gold_testes",
    }
    assert names <= loaded.keys()
    assert spark.table("t__gold_testes").filter("PASSOU").count() == 9


def test_held_client_keeps_its_source_id_and_gets_a_label(loaded):
    held = {r["ID_CLIENTE"]: r for r in loaded["quarentena_cliente_identidade"].collect()}
    assert held.keys() == {"CLI500001"}
    assert held["CLI500001"]["NOMES"] == ["Davi Prado", "Outra Pessoa"] and held["CLI500001"]["CONTATOS"] == ["(47) 3322-1100"]
    sale = loaded["fato_vendas"].filter("ID_CLIENTE_ORIGEM = 'CLI500001'").collect()
    assert len(sale) == 1 and sale[0]["SK_CLIENTE"] is None
    dataset = gold.sales_dataset(loaded).filter("id_cliente_origem = 'CLI500001'").first()
    assert dataset["cliente"] == "ID em quarentena: CLI500001"
    assert loaded["dim_cliente"].filter("ID_CLIENTE = 'CLI500001'").count() == 0


def test_conflicting_stock_is_held_whole(loaded):
    assert loaded["quarentena_estoque_mensal"].count() == 3
    fact = loaded["fato_estoque_mensal"].collect()
    assert [(r["SK_DATA_REFERENCIA"], r["QUANTIDADE_ESTOQUE"]) for r in fact] == [(20231201, 7)]


def test_product_mart_joins_sales_and_stock(loaded):
    rows = {r["SK_MES"]: r for r in loaded["mart_produto_performance"].collect()}
    month = rows[20231201]
    assert month["REGISTROS_VENDA"] == 4 and month["CURVA_ABC"] == "C" and month["QUANTIDADE_ESTOQUE"] == 7
    summary = {r["tabela"]: r for r in loaded["resumo_silver"].collect()}
    assert summary["erp"]["duplicatas_exatas_removidas"] == 1


def test_facts_are_keyed_like_their_dimensions(loaded):
    f = loaded["fato_vendas"].filter("SK_CLIENTE IS NOT NULL")
    joined = f.join(loaded["dim_cliente"], "SK_CLIENTE")
    assert joined.filter(F.col("ID_CLIENTE") == F.col("ID_CLIENTE_ORIGEM")).count() == f.count() > 0


def test_broken_proof_stops_and_names_it(spark, loaded):
    fewer = dict(loaded) | {"fato_vendas": loaded["fato_vendas"].limit(2)}
    silver_tables = {n: loaded[f"silver_{n}"] for n in ("crm", "erp", "estoque")}
    failed = {r["TESTE"] for r in gold.proofs(silver_tables, fewer).filter("NOT PASSOU").collect()}
    assert {"financeiro_fato_vs_erp", "rastreabilidade_fato_vendas", "mart_financeiro_vs_fato"} <= failed
    assert "mart_funil_comercial_vs_fato" not in failed


def test_raw_errors_are_gathered(spark, tmp_path):
    root = write(tmp_path, leads=[])
    os.truncate(spec.SOURCES[1].path(root), 0)
    os.rename(spec.SOURCES[2].path(root), spec.SOURCES[2].path(root) + ".old")
    with pytest.raises(ContractBroken) as e:
        raw.manifest(spark, root, spec.SOURCES)
    text = str(e.value)
    assert "crm sem registros" in text and "erp sem registros" in text and "estoque nao encontrado" in text


def test_manifest_counts_lines_but_the_header(spark, tmp_path):
    root = write(tmp_path)
    got = {r["sistema"]: r for r in raw.manifest(spark, root, spec.SOURCES).collect()}
    assert (got["crm"]["linhas"], got["erp"]["linhas"]) == (len(LEADS), len(SALES))
    assert got["crm"]["bytes"] == os.path.getsize(spec.SOURCES[0].path(root))


def test_unreadable_values_stop_before_anything_is_exposed(spark, tmp_path):
    bad = [LEADS[0][:3] + ["abc"] + LEADS[0][4:]]
    with pytest.raises(ContractBroken, match="IDADE"):
        pipeline.run(spark, write(tmp_path / "raw", leads=bad), str(tmp_path / "lake"), "bad", prefix="bad_")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bad_")]
    assert tables.current_schema(spark, "bad") is None
    # The refused row and its reason are in the failed load's own schema, until that is dropped.
    (failed,) = [d.name for d in spark.catalog.listDatabases("bad_*")]
    refused = spark.table(f"{failed}.recusadas_crm").collect()
    assert len(refused) == 1 and "IDADE" in refused[0]["_problema"] and spark.table(f"{failed}.silver_crm").count() == 0
    assert tables.retire(spark, "bad") == [failed]


def test_reserved_and_typed_columns_are_refused(spark):
    with pytest.raises(ContractBroken, match="f._ingerido_em"):
        raw.guard_columns(spark.createDataFrame([("x",)], "_ingerido_em string"), "f")
    with pytest.raises(ContractBroken, match="f.a"):
        raw.guard_columns(spark.createDataFrame([(1,)], "a int"), "f")
    landed = raw.with_lineage(spark.createDataFrame([("x",)], "a string"), "/p/f.csv").first()
    assert landed["_arquivo_origem"] == "/p/f.csv" and landed["_ingerido_em"] is not None


def test_control_must_hold_each_source_once(spark):
    rows = [("crm", spec.SOURCES[0].file, 5), ("erp", spec.SOURCES[1].file, 1), ("erp", spec.SOURCES[1].file, 1), ("x", "y", 9)]
    df = spark.createDataFrame(rows, "sistema string, arquivo string, linhas bigint")
    with pytest.raises(control.ControlInvalid) as e:
        control.require_counts(control.expected_counts(df, spec.SOURCES))
    told = str(e.value)
    assert f"o controle nao traz estoque/{spec.SOURCES[2].file}" in told and f"o controle traz erp/{spec.SOURCES[1].file} 2 vezes" in told


def test_counts_are_compared_for_all_tables_before_failing(spark):
    actual = spark.createDataFrame([("crm", 9), ("erp", 3)], "tabela string, linhas_tabela bigint")
    expected = spark.createDataFrame([("crm", 9), ("erp", 4)], "tabela string, linhas_esperadas bigint")
    reconciled = control.reconcile_counts(actual, expected)
    assert {r["tabela"]: r["status"] for r in reconciled.collect()} == {"crm": "OK", "erp": "DIVERGENTE"}
    with pytest.raises(control.CountsDiffer, match="erp tem 3 linhas e o controle diz 4"):
        control.require_equal(reconciled)


def test_a_failure_between_two_tables_leaves_the_last_load_readable(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "lake")
    first = pipeline.run(spark, write(tmp_path / "raw"), folder, "lasting")
    before = {n: sorted(map(repr, df.collect())) for n, df in first.items()}
    schema = tables.current_schema(spark, "lasting")

    def broken(fact):
        raise RuntimeError("planted")

    more = [*SALES, sale(id_cliente="CLI500077")]
    with monkeypatch.context() as planted:
        planted.setattr(gold, "finance_mart", broken)
        with pytest.raises(RuntimeError, match="planted"):
            pipeline.run(spark, write(tmp_path / "more", sales=more), folder, "lasting")
    assert tables.current_schema(spark, "lasting") == schema
    assert {n: sorted(map(repr, df.collect())) for n, df in tables.current(spark, "lasting").items()} == before

    second = pipeline.run(spark, write(tmp_path / "again", sales=more), folder, "lasting")
    assert second["fato_vendas"].count() == first["fato_vendas"].count() + 1
    # Who opened the first load goes on reading it until it is retired; the current one stays.
    tables.use_current(spark, "lasting")
    try:
        assert spark.sql("SELECT * FROM fato_vendas").count() == second["fato_vendas"].count()
    finally:
        spark.catalog.setCurrentDatabase("default")
    gone = tables.retire(spark, "lasting")
    assert schema in gone and len(gone) == 2 and not os.path.exists(os.path.join(folder, schema))
    assert tables.current(spark, "lasting")["fato_vendas"].count() == second["fato_vendas"].count()


def test_counts_come_from_the_writes(spark, tmp_path, monkeypatch):
    """Row contracts, lineage and the summary agree with separate passes over the written tables."""
    loads = []
    plain_load = pipeline.load_silver

    def spy(release, bronze):
        loads.append((release, bronze))
        return plain_load(release, bronze)

    monkeypatch.setattr(pipeline, "load_silver", spy)
    t = pipeline.run(spark, write(tmp_path / "raw"), str(tmp_path / "lake"), "counts")
    (release, bronze) = loads[0]
    assert {n: w.counts["linhas"] for n, w in bronze.items()} == {"crm": len(LEADS), "erp": len(SALES), "estoque": 4}
    for name, (_, contract_list) in pipeline.CLEANERS.items():
        df = t[f"silver_{name}"]
        counts = df.agg(*[c.alias(n) for n, c in contracts.row_counts(contract_list()).items()]).first().asDict()
        assert sorted(contracts.checked_rows(spark, counts, contract_list()).collect()) == sorted(contracts.check_rows(df, contract_list()).collect())
    summary = versions.load_summary("erp", t["silver_erp"]).first()
    assert summary in t["resumo_silver"].collect()


def test_counts_of_an_empty_write(spark, tmp_path):
    empty = spark.createDataFrame([], "a int").where("a > 1")
    written = tables.publish(empty, str(tmp_path / "e"), {"n": F.count(F.lit(1)), "s": F.sum("a")})
    assert written.counts == {"n": 0, "s": None} and written.table.count() == 0


def test_an_outlying_date_stops_the_load_with_its_reason(spark, tmp_path):
    far = [lead(id_cliente="CLI500001", data_interesse="31/12/9999")]
    with pytest.raises(ContractBroken, match="dim_calendario: datas fora do intervalo.*9999-12-31"):
        pipeline.run(spark, write(tmp_path / "raw", leads=far), str(tmp_path / "lake"), "far")
    assert tables.current_schema(spark, "far") is None


def test_part_files_of_a_source_are_one_source(spark, tmp_path):
    root = write(tmp_path)
    path = spec.SOURCES[0].path(root)
    with open(path, encoding="utf-8") as f:
        header, *lines = f.readlines()
    os.rename(path, path + ".whole")
    os.makedirs(path)
    for i, line in enumerate(lines):
        with open(f"{path}/part-{i}.csv", "w", encoding="utf-8") as f:
            f.writelines([header, line])
    got = {r["sistema"]: r for r in raw.inspect(spark, root, spec.SOURCES).collect()}
    assert got["crm"]["linhas"] == len(LEADS) and got["crm"]["erro"] is None
    assert raw.inspect(spark, str(tmp_path / "nowhere"), spec.SOURCES).where("erro LIKE 'nao encontrado%'").count() == 3


def test_tables_are_replaced_with_rows_schema_and_comments(spark, tmp_path):
    folder = str(tmp_path)
    path = f"{folder}/t"
    tables.publish(spark.createDataFrame([(1,)], "a int"), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.publish(spark.createDataFrame([(2,)], "a int"), path)
    old = tables.replace_table(spark.createDataFrame([(1,)], "a int"), "published_t", folder, "it's a table")
    assert [tuple(r) for r in old.collect()] == [(1,)]
    again = tables.replace_table(
        spark.createDataFrame([("x", 2)], "b string, c int"), "published_t", folder, "another", {"b": "a label"}
    )
    assert again.columns == ["b", "c"] and again.schema["b"].metadata["comment"] == "a label"
    assert [tuple(r) for r in spark.table("published_t").collect()] == [("x", 2)] and old.columns == ["a"]
    told = {r["col_name"]: r for r in spark.sql("DESCRIBE TABLE EXTENDED published_t").collect()}
    assert told["b"]["comment"] == "a label" and told["Comment"]["data_type"] == "another"
    spark.sql("DROP VIEW published_t")


def test_landing_files_are_compressed_and_kept_once(spark, monkeypatch):
    """The files of a load are read back whole, take no plain text on disk and leave no second copy as tables."""
    derived = lambda spark, sf_dir, text, columns: spark.createDataFrame([(f" {c}",) * len(columns) for c in "ab"], ", ".join(f"`{c}` string" for c in columns))
    monkeypatch.setattr(lake, "_landed", {})
    monkeypatch.setattr(lake.raw, "derive", derived)
    root = lake.raw_files(spark, "none")
    assert not lake._landed
    for s in spec.SOURCES:
        back = spark.read.csv(s.path(root), header=True)
        assert all(name.endswith(".csv.gz") for name in back.inputFiles())
        assert sorted(r[0] for r in back.collect()) == [" a", " b"]
