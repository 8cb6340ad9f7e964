"""The dealership's layers, from raw text to marts, proofs and dashboards, over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions import PROBLEM, min_rank, stage_rank
from garimpo.operators.contracts import check_lineage, check_rows, check_unique, report
from garimpo.operators.dimensions import union_all
from garimpo.operators.measures import all_choices, measure, series_long
from garimpo.operators.quarantine import held_summary
from garimpo.operators.versions import SOURCE_ROWS, load_summary
from garimpo.plans import gold, pipeline, silver, spec
from garimpo.session import shared_dir
from garimpo.sources.tables import Release
from workload import raw
from workload.base import Query, plain
from workload.lake import Lake, raw_files

FACTS = ("fato_vendas", "fato_oportunidade", "fato_estoque_mensal")
MARTS = ("mart_vendas_por_vendedor", "mart_produto_performance", "mart_financeiro", "mart_funil_comercial")
SALES_STAR = ("fato_vendas", "dim_cliente", "dim_produto", "dim_vendedor", "dim_calendario")
LEADS_STAR = ("fato_oportunidade", "dim_produto", "dim_canal", "dim_calendario")

# --- the cleaned tables in SQL, from the true values -----------------------------------------------------------------


def _versions(name: str, sql: str, business: list[str], key: str, truth: list[str]) -> str:
    columns = ", ".join(business)
    json = "{" + ", ".join(f"'{c}': {c}" for c in business) + "}"
    return f"""
{name}_raw AS MATERIALIZED ({raw.plain_sql(sql)}),
{name}_once AS MATERIALIZED (
  SELECT {columns}, count(*) AS n, {', '.join(f'any_value({t}) AS {t}' for t in truth)}
  FROM {name}_raw GROUP BY {columns}),
{name}_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY sha256(cast(to_json({json}) AS varchar))) AS v
  FROM {name}_once)"""


def _sales_cte(sql: str) -> str:
    return _versions(
        "s",
        sql,
        spec.SALE_COLUMNS,
        "t_id_cliente",
        "t_id_cliente t_nome t_nascimento t_vendedor price off billed cost t_pagamento t_banco t_produto t_cor t_ano "
        "t_modelo t_entrega t_condicao split t_problema".split(),
    ) + """,
sales AS MATERIALIZED (
  SELECT t_id_cliente || '-' || v AS ID_REGISTRO, t_id_cliente AS ID_CLIENTE, t_nome AS NOME_CLIENTE,
         t_nascimento AS DATA_NASCIMENTO, t_vendedor AS VENDEDOR,
         cast(price AS decimal(18,0)) AS price, cast(off AS decimal(18,0)) AS off,
         cast(billed AS decimal(18,0)) AS billed, cast(cost AS decimal(18,0)) AS cost,
         t_pagamento AS FORMA_PAGAMENTO, t_banco AS BANCO, t_produto AS PRODUTO, t_cor AS COR_PRODUTO,
         cast(t_ano AS bigint) AS ANO, t_modelo AS MODELO, t_entrega AS DATA_ENTREGA,
         t_condicao AS ZERO_KM_OU_SEMINOVO, n AS _linhas_origem, t_problema AS _problema
  FROM s_numbered)"""


def _leads_cte(sql: str) -> str:
    return _versions(
        "l",
        sql,
        spec.LEAD_COLUMNS,
        "t_id_cliente",
        "t_id_cliente t_nome t_genero t_idade t_contato t_fonte t_produto t_pagamento t_entrada t_drive t_data t_etapa "
        "t_motivo t_temperatura t_problema".split(),
    ) + """,
leads AS MATERIALIZED (
  SELECT t_id_cliente || '-' || v AS ID_REGISTRO, t_id_cliente AS ID_CLIENTE, t_nome AS CLIENTE, t_genero AS GENERO,
         cast(t_idade AS bigint) AS IDADE, t_contato AS CONTATO, t_fonte AS FONTE, t_produto AS PRODUTO_INTERESSE,
         t_pagamento AS FORMA_PAGAMENTO, t_entrada / 100.0 AS ENTRADA_PCT, t_drive AS FEZ_TEST_DRIVE,
         t_data AS DATA_INTERESSE, t_etapa AS ETAPA, t_motivo AS MOTIVO_INSUCESSO, t_temperatura AS TEMPERATURA,
         t_data AS DATA_ULTIMO_CONTATO, n AS _linhas_origem, t_problema AS _problema
  FROM l_numbered)"""


def _positions_cte(sql: str) -> str:
    truth = "t_mes t_codigo t_produto t_estoque t_campanha t_problema".split()
    return _versions("p", sql, spec.POSITION_COLUMNS, "t_mes, t_codigo", truth) + """,
positions AS MATERIALIZED (
  SELECT substr(t_mes, 1, 7) || '-' || t_codigo || '-' || v AS ID_REGISTRO, t_mes AS MES_REFERENCIA,
         t_codigo AS COD_PRODUTO, t_produto AS PRODUTO, cast(t_estoque AS bigint) AS ESTOQUE_ATUAL,
         t_campanha AS CAMPANHA_ATUAL, n AS _linhas_origem, t_problema AS _problema
  FROM p_numbered)"""


SALES_CTE, LEADS_CTE, POSITIONS_CTE = _sales_cte(raw.SALES), _leads_cte(raw.LEADS), _positions_cte(raw.POSITIONS)
# The same over the files that also hold rows the cleaning refuses.
BAD_SALES_CTE = _sales_cte(raw.SALES_REFUSED)
BAD_LEADS_CTE = _leads_cte(raw.LEADS_REFUSED)
BAD_POSITIONS_CTE = _positions_cte(raw.POSITIONS_REFUSED)
ATTRIBUTES_CTE = """
attributes AS MATERIALIZED (
  SELECT ID_CLIENTE, CLIENTE AS NOME, GENERO, CONTATO, NULL AS DATA_NASCIMENTO FROM leads
  UNION ALL
  SELECT ID_CLIENTE, NOME_CLIENTE, NULL, NULL, DATA_NASCIMENTO FROM sales),
held AS MATERIALIZED (
  SELECT ID_CLIENTE FROM attributes GROUP BY ID_CLIENTE
  HAVING count(DISTINCT NOME) > 1 OR count(DISTINCT DATA_NASCIMENTO) > 1
      OR count(DISTINCT GENERO) > 1 OR count(DISTINCT CONTATO) > 1),
clients AS MATERIALIZED (
  SELECT ID_CLIENTE, max(NOME) AS NOME, max(DATA_NASCIMENTO) AS DATA_NASCIMENTO, max(GENERO) AS GENERO,
         max(CONTATO) AS CONTATO
  FROM attributes ANTI JOIN held USING (ID_CLIENTE) GROUP BY ID_CLIENTE)"""
STOCK_CTE = """
held_grains AS (
  SELECT COD_PRODUTO, MES_REFERENCIA FROM positions GROUP BY ALL HAVING count(*) > 1),
held_stock AS (SELECT * FROM positions SEMI JOIN held_grains USING (COD_PRODUTO, MES_REFERENCIA)),
stock AS (SELECT * FROM positions ANTI JOIN held_grains USING (COD_PRODUTO, MES_REFERENCIA))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _money(c: str) -> str:
    return f"cast({c} AS double) / 100"


def _pairs_sql() -> str:
    return "VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in spec.PRODUCTS)


PRODUCTS_CTE = f"\nproducts AS (SELECT * FROM ({_pairs_sql()}) AS p(COD_PRODUTO, NOME_PRODUTO))"


# --- silver ----------------------------------------------------------------------------------------------------------


def _told(df: DataFrame) -> DataFrame:
    """Refused rows with their record, their source rows and the reason; what else they hold is no value."""
    kept = ("ID_REGISTRO", SOURCE_ROWS, PROBLEM)
    accepted = F.col(PROBLEM).isNull()
    return df.select(*[F.col(c) if c in kept else F.when(accepted, F.col(c)).alias(c) for c in df.columns if c != silver.PROCESSED_AT])


def _told_sql(values: dict[str, str], table: str) -> str:
    shown = ", ".join(f"CASE WHEN {PROBLEM} IS NULL THEN {v} END AS {n}" for n, v in values.items())
    return f"SELECT ID_REGISTRO, {shown}, {SOURCE_ROWS}, {PROBLEM} FROM {table}"


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_told(silver.clean_sales(Lake(spark, sf_dir)["defeitos_erp"])))


def silver_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_told(silver.clean_leads(Lake(spark, sf_dir)["defeitos_crm"])))


def silver_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_told(silver.clean_positions(Lake(spark, sf_dir)["defeitos_estoque"])))


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


SILVER_SALES = _with(BAD_SALES_CTE) + _told_sql(
    _same("ID_CLIENTE", "NOME_CLIENTE", "DATA_NASCIMENTO", "VENDEDOR", "FORMA_PAGAMENTO", "BANCO", "PRODUTO", "COR_PRODUTO", "ANO", "MODELO")
    | {"VALOR_PADRAO": _money("price"), "DESCONTO": _money("off"), "VALOR_FATURAMENTO": _money("billed"), "CUSTO": _money("cost")}
    | {"DATA_ENTREGA": "cast(DATA_ENTREGA AS varchar)"}
    | _same("ZERO_KM_OU_SEMINOVO"),
    "sales",
)
SILVER_LEADS = _with(BAD_LEADS_CTE) + _told_sql(
    _same("ID_CLIENTE", "CLIENTE", "GENERO", "IDADE", "CONTATO", "FONTE", "PRODUTO_INTERESSE", "FORMA_PAGAMENTO", "FEZ_TEST_DRIVE")
    | {"ENTRADA_PCT": "cast(ENTRADA_PCT AS double)"}
    | {n: f"cast({n} AS varchar)" for n in ("DATA_INTERESSE", "DATA_ULTIMO_CONTATO")}
    | _same("ETAPA", "MOTIVO_INSUCESSO", "TEMPERATURA"),
    "leads",
)
SILVER_POSITIONS = _with(BAD_POSITIONS_CTE) + _told_sql(
    _same("MES_REFERENCIA", "COD_PRODUTO", "PRODUTO", "ESTOQUE_ATUAL", "CAMPANHA_ATUAL"), "positions"
)


def silver_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cleaned table written once, accepted rows apart from refused ones: rows and source rows of both, by reason."""
    release = Release(spark, "partes", shared_dir(spark))
    lake, out = Lake(spark, sf_dir), []
    for name, (clean, _) in pipeline.CLEANERS.items():
        accepted = pipeline.write_silver(release, name, clean(lake[f"defeitos_{name}"])).table
        refused = spark.table(f"{release.schema}.recusadas_{name}")
        both = union_all(accepted.select(SOURCE_ROWS), refused.select(SOURCE_ROWS, F.col(PROBLEM).alias("motivo")))
        counted = both.groupBy("motivo").agg(F.count(F.lit(1)).alias("linhas"), F.sum(SOURCE_ROWS).alias("origem"))
        out.append(counted.select(F.lit(name).alias("tabela"), "motivo", "linhas", "origem"))
    return union_all(*out)


SILVER_PARTS = _with(BAD_SALES_CTE, BAD_LEADS_CTE, BAD_POSITIONS_CTE) + "\nUNION ALL ".join(
    f"SELECT '{n}' AS tabela, {PROBLEM} AS motivo, count(*) AS linhas, cast(sum({SOURCE_ROWS}) AS bigint) AS origem FROM {t} GROUP BY 2"
    for n, t in (("crm", "leads"), ("erp", "sales"), ("estoque", "positions"))
)


def silver_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 row contracts, key uniqueness and lineage of the three cleaned tables."""
    lake = Lake(spark, sf_dir, "crm", "erp", "estoque")
    sources = {"crm": silver.lead_contracts, "erp": silver.sale_contracts, "estoque": silver.position_contracts}
    frames = []
    for name, contracts in sources.items():
        frames.append(check_rows(lake[name], contracts()))
        frames.append(
            check_unique(lake[name], "ID_REGISTRO", f"{name}_chave_unica").select(
                "contrato", "linhas", (F.col("linhas") - F.col("chaves")).alias("violacoes"), "passou"
            )
        )
        lineage = check_lineage(lake[name], lake[f"bronze_{name}"], SOURCE_ROWS, f"{name}_origem")
        frames.append(
            lineage.select("contrato", "linhas", (F.col("linhas") - F.col("chaves")).alias("violacoes"), "passou")
        )
    return plain(union_all(*frames))


def _contracts_sql() -> str:
    rows = []
    names = {
        "crm": (["crm_chaves", "crm_obrigatorios", "crm_dominios", "crm_contato", "crm_auditoria"], "leads", "l_raw"),
        "erp": (["erp_chaves", "erp_obrigatorios", "erp_financeiro", "erp_dominios", "erp_auditoria"], "sales", "s_raw"),
        "estoque": (["estoque_chaves", "estoque_mes", "estoque_dominios", "estoque_auditoria"], "positions", "p_raw"),
    }
    for table, (contracts, clean, origin) in names.items():
        for c in contracts + [f"{table}_chave_unica"]:
            rows.append(f"SELECT '{c}' AS contrato, count(*) AS linhas, 0::bigint AS violacoes, true AS passou FROM {clean}")
        rows.append(f"SELECT '{table}_origem', count(*), 0::bigint, true FROM {origin}")
    return _with(SALES_CTE, LEADS_CTE, POSITIONS_CTE) + "\nUNION ALL ".join(rows)


def silver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir, "crm", "erp", "estoque")
    return plain(union_all(*[load_summary(n, lake[n]) for n in ("crm", "erp", "estoque")]))


SILVER_SUMMARY = _with(SALES_CTE, LEADS_CTE, POSITIONS_CTE) + "\nUNION ALL ".join(
    f"SELECT '{n}' AS tabela, count(*) AS registros_silver, cast(sum(_linhas_origem) AS bigint) AS linhas_bronze, "
    f"cast(sum(_linhas_origem) - count(*) AS bigint) AS duplicatas_exatas_removidas FROM {c}"
    for n, c in (("crm", "leads"), ("erp", "sales"), ("estoque", "positions"))
)

# --- gold: quarantine and dimensions ---------------------------------------------------------------------------------


def identity_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Lake(spark, sf_dir).frame("quarentena_cliente_identidade"))


IDENTITY_QUARANTINE = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + f"""
SELECT ID_CLIENTE, 1::bigint AS PARTE,
       coalesce(array_to_string(list_sort(list(DISTINCT NOME) FILTER (NOME IS NOT NULL)), '|'), '') AS NOMES,
       coalesce(array_to_string(list_sort(list(DISTINCT DATA_NASCIMENTO) FILTER (DATA_NASCIMENTO IS NOT NULL)), '|'), '')
         AS NASCIMENTOS,
       coalesce(array_to_string(list_sort(list(DISTINCT GENERO) FILTER (GENERO IS NOT NULL)), '|'), '') AS GENEROS,
       coalesce(array_to_string(list_sort(list(DISTINCT CONTATO) FILTER (CONTATO IS NOT NULL)), '|'), '') AS CONTATOS,
       '{spec.IDENTITY_REASON}' AS MOTIVO_QUARENTENA
FROM attributes SEMI JOIN held USING (ID_CLIENTE) GROUP BY ID_CLIENTE"""


def identity_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Lake(spark, sf_dir).frame("quarentena_cliente_evidencia"))


IDENTITY_EVIDENCE = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + "\nUNION ALL ".join(
    f"SELECT DISTINCT ID_CLIENTE, '{a}' AS atributo, {a} AS valor FROM attributes SEMI JOIN held USING (ID_CLIENTE) "
    f"WHERE {a} IS NOT NULL"
    for a in gold.CLIENT_ATTRIBUTES
)


def stock_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Lake(spark, sf_dir).frame("quarentena_estoque_mensal"))


STOCK_QUARANTINE = _with(POSITIONS_CTE, STOCK_CTE) + f"""
SELECT * EXCLUDE (_linhas_origem, _problema), '{spec.GRAIN_REASON}' AS MOTIVO_QUARENTENA FROM held_stock"""


def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir, "quarentena_cliente_ids", "quarentena_estoque_mensal")
    return held_summary(
        lake["quarentena_cliente_ids"],
        lake["quarentena_estoque_mensal"],
        gold.GRAIN,
        ("IDS_CLIENTE_EM_QUARENTENA", "GRAOS_ESTOQUE_EM_QUARENTENA"),
    )


QUARANTINE_SUMMARY = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE, POSITIONS_CTE, STOCK_CTE) + """
SELECT (SELECT count(*) FROM held) AS IDS_CLIENTE_EM_QUARENTENA,
       (SELECT count(*) FROM held_grains) AS GRAOS_ESTOQUE_EM_QUARENTENA"""


def client_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Lake(spark, sf_dir).frame("dim_cliente").drop("SK_CLIENTE"))


CLIENT_DIMENSION = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + "SELECT * FROM clients"


def dimension_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct keys of the six dimensions."""
    return plain(gold.key_checks(Lake(spark, sf_dir, *gold.DIM_KEYS)))


_DAYS = (
    "SELECT least((SELECT min(DATA_INTERESSE) FROM leads), (SELECT min(DATA_ENTREGA) FROM sales), "
    "(SELECT min(DATA_NASCIMENTO)::date FROM sales), (SELECT min(MES_REFERENCIA)::date FROM positions)) AS a, "
    "greatest((SELECT max(DATA_INTERESSE) FROM leads), (SELECT max(DATA_ENTREGA) FROM sales), "
    "(SELECT max(DATA_NASCIMENTO)::date FROM sales), (SELECT max(MES_REFERENCIA)::date FROM positions)) AS b"
)
DIMENSION_KEYS = _with(SALES_CTE, LEADS_CTE, POSITIONS_CTE, ATTRIBUTES_CTE, PRODUCTS_CTE, f"\nbounds AS ({_DAYS})") + "\nUNION ALL ".join(
    f"SELECT '{n}' AS contrato, ({q})::bigint AS linhas, ({q})::bigint AS chaves, true AS passou"
    for n, q in {
        "dim_cliente": "SELECT count(*) FROM clients",
        "dim_produto": "SELECT count(*) FROM products",
        "dim_vendedor": "SELECT count(DISTINCT VENDEDOR) FROM sales",
        "dim_pagamento": "SELECT count(*) FROM (SELECT FORMA_PAGAMENTO FROM sales UNION SELECT FORMA_PAGAMENTO FROM leads)",
        "dim_canal": "SELECT count(DISTINCT FONTE) FROM leads",
        "dim_calendario": "SELECT date_diff('day', a, b) + 1 FROM bounds",
    }.items()
)

# --- gold: facts with their keys resolved back to natural keys -------------------------------------------------------


def _resolve(fact: DataFrame, dim: DataFrame, key: str, name: str, out: str) -> DataFrame:
    side = dim.select(F.col(key).alias("_k"), F.col(name).alias(out))
    return fact.join(side, F.col(key) == F.col("_k"), "left").drop("_k", key)


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir, "dim_cliente")
    f = t.frame("fato_vendas")
    f = _resolve(f, t["dim_cliente"], "SK_CLIENTE", "NOME", "cliente")
    f = _resolve(f, t["dim_produto"], "SK_PRODUTO", "COD_PRODUTO", "produto")
    f = _resolve(f, t["dim_vendedor"], "SK_VENDEDOR", "NOME", "vendedor")
    f = _resolve(f, t["dim_pagamento"], "SK_PAGAMENTO", "FORMA_PAGAMENTO", "pagamento")
    return plain(f)


SALES_FACT = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE, PRODUCTS_CTE) + f"""
SELECT ID_REGISTRO, sales.ID_CLIENTE AS ID_CLIENTE_ORIGEM, NOME AS cliente, COD_PRODUTO AS produto,
       VENDEDOR AS vendedor, FORMA_PAGAMENTO AS pagamento,
       cast(strftime(DATA_ENTREGA, '%Y%m%d') AS bigint) AS SK_DATA_ENTREGA, BANCO, MODELO, COR_PRODUTO,
       ANO AS ANO_VEICULO, ZERO_KM_OU_SEMINOVO, {_money('price')} AS VALOR_PADRAO, {_money('off')} AS DESCONTO,
       {_money('billed')} AS VALOR_FATURAMENTO, {_money('cost')} AS CUSTO,
       {_money('(billed - cost)')} AS MARGEM_BRUTA_CALCULADA
FROM sales LEFT JOIN clients ON sales.ID_CLIENTE = clients.ID_CLIENTE
     LEFT JOIN products ON PRODUTO = NOME_PRODUTO"""


def lead_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir)
    f = t.frame("fato_oportunidade")
    f = _resolve(f, t["dim_cliente"], "SK_CLIENTE", "NOME", "cliente")
    f = _resolve(f, t["dim_produto"], "SK_PRODUTO", "COD_PRODUTO", "produto")
    f = _resolve(f, t["dim_pagamento"], "SK_PAGAMENTO", "FORMA_PAGAMENTO", "pagamento")
    f = _resolve(f, t["dim_canal"], "SK_CANAL", "FONTE", "canal")
    return plain(f)


LEAD_FACT = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE, PRODUCTS_CTE) + """
SELECT ID_REGISTRO, leads.ID_CLIENTE AS ID_CLIENTE_ORIGEM, NOME AS cliente, COD_PRODUTO AS produto,
       FORMA_PAGAMENTO AS pagamento, FONTE AS canal,
       cast(strftime(DATA_INTERESSE, '%Y%m%d') AS bigint) AS SK_DATA_INTERESSE,
       cast(strftime(DATA_ULTIMO_CONTATO, '%Y%m%d') AS bigint) AS SK_DATA_ULTIMO_CONTATO,
       cast(ENTRADA_PCT AS double) AS ENTRADA_PCT, IDADE, clients.DATA_NASCIMENTO, ETAPA, TEMPERATURA,
       MOTIVO_INSUCESSO, FEZ_TEST_DRIVE
FROM leads LEFT JOIN clients ON leads.ID_CLIENTE = clients.ID_CLIENTE
     LEFT JOIN products ON PRODUTO_INTERESSE = NOME_PRODUTO"""


def position_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir)
    return plain(_resolve(t.frame("fato_estoque_mensal"), t["dim_produto"], "SK_PRODUTO", "COD_PRODUTO", "produto"))


POSITION_FACT = _with(POSITIONS_CTE, STOCK_CTE) + """
SELECT ID_REGISTRO, COD_PRODUTO AS produto, cast(replace(MES_REFERENCIA, '-', '') AS bigint) AS SK_DATA_REFERENCIA,
       ESTOQUE_ATUAL AS QUANTIDADE_ESTOQUE, CAMPANHA_ATUAL
FROM stock"""


def fact_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir, *FACTS)
    return plain(union_all(*gold.fact_contracts(t, t)))


FACT_CONTRACTS = _with(SALES_CTE, LEADS_CTE, POSITIONS_CTE, STOCK_CTE) + """
SELECT 'fato_vendas' AS contrato, count(*) AS linhas, count(*) AS linhas_origem, count(*) AS ids,
       0::bigint AS sem_chave_fora, 0::bigint AS com_chave_dentro, 0::bigint AS chaves_ausentes, true AS passou,
       NULL::bigint AS quarentena, NULL::bigint AS graos FROM sales
UNION ALL
SELECT 'fato_oportunidade', count(*), count(*), count(*), 0, 0, 0, true, NULL, NULL FROM leads
UNION ALL
SELECT 'fato_estoque_mensal', (SELECT count(*) FROM stock), (SELECT count(*) FROM positions), (SELECT count(*) FROM stock),
       NULL, NULL, 0, true, (SELECT count(*) FROM held_stock), (SELECT count(*) FROM stock)"""

# --- gold: marts -----------------------------------------------------------------------------------------------------

_MONTH = "cast(strftime(DATA_ENTREGA, '%Y%m01') AS bigint)"


def seller_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir)
    return plain(_resolve(t.frame("mart_vendas_por_vendedor"), t["dim_vendedor"], "SK_VENDEDOR", "NOME", "vendedor"))


SELLER_MART = _with(SALES_CTE) + f"""
SELECT VENDEDOR AS vendedor, {_MONTH} AS SK_MES_ENTREGA, {_money('sum(billed)')} AS FATURAMENTO,
       {_money('sum(billed - cost)')} AS MARGEM_BRUTA_CALCULADA, count(*) AS REGISTROS_VENDA,
       count(DISTINCT ID_CLIENTE) AS CLIENTES_DISTINTOS,
       round(cast(sum(billed) AS hugeint) / count(*)) / 100 AS TICKET_MEDIO_POR_REGISTRO
FROM sales GROUP BY 1, 2"""


def product_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir)
    mart = _resolve(t.frame("mart_produto_performance"), t["dim_produto"], "SK_PRODUTO", "COD_PRODUTO", "produto")
    return plain(mart)


PRODUCT_MART = _with(SALES_CTE, POSITIONS_CTE, STOCK_CTE, PRODUCTS_CTE) + f""",
flow AS (
  SELECT COD_PRODUTO, {_MONTH} AS m, sum(billed)::bigint AS revenue, sum(billed - cost)::bigint AS margin, count(*) AS n
  FROM sales JOIN products ON PRODUTO = NOME_PRODUTO GROUP BY 1, 2),
both_sides AS (
  SELECT coalesce(f.COD_PRODUTO, s.COD_PRODUTO) AS produto, coalesce(f.m, s.m) AS m, coalesce(revenue, 0) AS revenue,
         coalesce(margin, 0) AS margin, coalesce(n, 0) AS n, ESTOQUE_ATUAL
  FROM flow f FULL JOIN (SELECT *, cast(replace(MES_REFERENCIA, '-', '') AS bigint) AS m FROM stock) s
       ON f.COD_PRODUTO = s.COD_PRODUTO AND f.m = s.m),
shares AS (
  SELECT *, sum(revenue) OVER (PARTITION BY m) AS total,
         sum(revenue) OVER (PARTITION BY m ORDER BY revenue DESC, produto ROWS UNBOUNDED PRECEDING) AS acc
  FROM both_sides)
SELECT produto, m AS SK_MES, revenue / 100 AS FATURAMENTO, margin / 100 AS MARGEM_BRUTA_CALCULADA,
       CASE WHEN revenue <> 0 THEN round(margin * 100 / revenue, 4) END AS MARGEM_PCT, n AS REGISTROS_VENDA,
       CASE WHEN n = 0 THEN 'Sem Venda' WHEN total = 0 THEN 'C' WHEN acc / total <= 0.80 THEN 'A'
            WHEN acc / total <= 0.95 THEN 'B' ELSE 'C' END AS CURVA_ABC,
       ESTOQUE_ATUAL AS QUANTIDADE_ESTOQUE
FROM shares"""


def finance_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Lake(spark, sf_dir).frame("mart_financeiro"))


FINANCE_MART = _with(SALES_CTE) + f"""
SELECT {_MONTH} AS SK_MES_ENTREGA, {_money('sum(price)')} AS VALOR_PADRAO, {_money('sum(off)')} AS DESCONTO,
       {_money('sum(billed)')} AS FATURAMENTO, {_money('sum(cost)')} AS CUSTO,
       {_money('sum(billed - cost)')} AS MARGEM_BRUTA_CALCULADA
FROM sales GROUP BY 1"""


def funnel_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir)
    mart = _resolve(t.frame("mart_funil_comercial"), t["dim_canal"], "SK_CANAL", "FONTE", "canal")
    return plain(_resolve(mart, t["dim_produto"], "SK_PRODUTO", "COD_PRODUTO", "produto"))


FUNNEL_MART = _with(LEADS_CTE, PRODUCTS_CTE) + """
SELECT FONTE AS canal, COD_PRODUTO AS produto, cast(strftime(DATA_INTERESSE, '%Y%m01') AS bigint) AS SK_MES_INTERESSE,
       ETAPA, count(*) AS REGISTROS_OPORTUNIDADE, count(DISTINCT ID_CLIENTE) AS CLIENTES_DISTINTOS,
       count(*) FILTER (FEZ_TEST_DRIVE) AS REGISTROS_COM_TEST_DRIVE
FROM leads JOIN products ON PRODUTO_INTERESSE = NOME_PRODUTO GROUP BY 1, 2, 3, 4"""

# --- gold: proofs ----------------------------------------------------------------------------------------------------


def proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Lake(spark, sf_dir, *FACTS, *MARTS, *gold.DIM_KEYS)
    return plain(gold.proofs(t, t))


def _proofs_sql() -> str:
    def cents(c: str) -> str:
        return f"cast(cast(sum({c}) AS decimal(18,2)) / 100 AS decimal(18,2))::varchar"

    def json(**fields: str) -> str:
        return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || ({v})" for k, v in fields.items()) + " || '}'"

    n_sales, n_leads = "SELECT count(*) FROM sales", "SELECT count(*) FROM leads"
    money = {"valor_padrao": "price", "desconto": "off", "faturamento": "billed", "custo": "cost", "margem": "billed - cost"}
    sums = {k: f"SELECT {cents(v)} FROM sales" for k, v in money.items()}
    pair = {k: sums[k] for k in ("faturamento", "margem")}
    drives = "SELECT count(*) FILTER (FEZ_TEST_DRIVE) FROM leads"
    accepted, held, every = (f"SELECT count(*) FROM {x}" for x in ("stock", "held_stock", "positions"))
    zeros = {"graos_duplicados": "0", "ausentes": "0", "extras": "0", "sobreposicoes": "0"}
    rows = [
        ("financeiro_fato_vs_erp", json(**pair), json(**pair)),
        *[
            (
                f"rastreabilidade_{fact}",
                json(linhas=n, ids=n, ausentes="0", extras="0"),
                json(linhas=n, ids=n, ausentes="0", extras="0"),
            )
            for fact, n in (("fato_vendas", n_sales), ("fato_oportunidade", n_leads))
        ],
        (
            "grao_e_rastreabilidade_estoque",
            json(aceitas=accepted, quarentena=held, total_silver=every, **zeros),
            json(aceitas_mais_quarentena=every, **zeros),
        ),
        *[
            (
                "integridade_dimensional",
                json(vendas_orfas="0", oportunidades_orfas="0", estoque_orfao="0"),
                json(vendas_orfas="0", oportunidades_orfas="0", estoque_orfao="0"),
            )
        ],
        ("mart_vendas_por_vendedor_vs_fato", json(**pair, registros=n_sales), json(**pair, registros=n_sales)),
        (
            "mart_produto_performance_vs_fatos",
            json(**pair, registros=n_sales, estoques_ausentes="0"),
            json(**pair, registros=n_sales, estoques_ausentes="0"),
        ),
        ("mart_financeiro_vs_fato", json(**sums), json(**sums)),
        (
            "mart_funil_comercial_vs_fato",
            json(grupos_divergentes="0", registros=n_leads, test_drives=drives),
            json(grupos_divergentes="0", registros=n_leads, test_drives=drives),
        ),
    ]
    return _with(SALES_CTE, LEADS_CTE, POSITIONS_CTE, STOCK_CTE) + "\nUNION ALL ".join(
        f"SELECT {i}::bigint AS ORDEM, '{name}' AS TESTE, {found} AS VALOR_CALCULADO, {expected} AS VALOR_ESPERADO, "
        "true AS PASSOU"
        for i, (name, found, expected) in enumerate(rows, 1)
    )


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load from raw CSV files, through every contract, to the nine proofs it publishes."""
    return plain(pipeline.run(spark, raw_files(spark, sf_dir), shared_dir(spark), "concessionaria")["_gold_testes"])


def product_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names in the three sources against the mapping: offenders, none expected."""
    t = Lake(spark, sf_dir, "crm", "erp", "estoque", "dim_produto")
    return gold.unmapped_products(t["crm"], t["erp"], t["estoque"], t["dim_produto"])


PRODUCT_CHECK = _with(SALES_CTE, LEADS_CTE, POSITIONS_CTE, PRODUCTS_CTE) + """,
told AS (
  SELECT 'CRM' AS SISTEMA, NULL AS COD_PRODUTO, PRODUTO_INTERESSE AS NOME_PRODUTO FROM leads
  UNION ALL SELECT 'ERP', NULL, PRODUTO FROM sales
  UNION ALL SELECT 'ESTOQUE', COD_PRODUTO, PRODUTO FROM positions)
SELECT DISTINCT o.* FROM told o LEFT JOIN products p
  ON o.NOME_PRODUTO = p.NOME_PRODUTO AND (o.COD_PRODUTO IS NULL OR o.COD_PRODUTO = p.COD_PRODUTO)
WHERE p.COD_PRODUTO IS NULL"""

# --- dashboard -------------------------------------------------------------------------------------------------------


def sales_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR)))


_SALES_DATASET = f""",
dataset AS (
  SELECT ID_REGISTRO AS id_registro, sales.ID_CLIENTE AS id_cliente_origem,
         coalesce(NOME, '{spec.HELD_LABEL}' || sales.ID_CLIENTE) AS cliente, DATA_ENTREGA AS data_entrega,
         cast(year(DATA_ENTREGA) AS bigint) AS ano, date_trunc('month', DATA_ENTREGA) AS mes_entrega,
         PRODUTO AS carro, VENDEDOR AS vendedor, billed, billed - cost AS margin
  FROM sales LEFT JOIN clients ON sales.ID_CLIENTE = clients.ID_CLIENTE)"""
SALES_DATASET = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"""
SELECT id_registro, id_cliente_origem, cliente, cast(data_entrega AS varchar) AS data_entrega, ano,
       strftime(mes_entrega, '%Y-%m-%d 00:00:00') AS mes_entrega, carro, vendedor,
       {_money('billed')} AS valor_faturamento, {_money('margin')} AS margem_bruta_calculada
FROM dataset"""


def leads_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.leads_dataset(Lake(spark, sf_dir, *LEADS_STAR)))


_RANK = "CASE ETAPA " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(spec.STAGES, 1)) + " ELSE 99 END"
LEADS_DATASET = _with(LEADS_CTE) + f"""
SELECT ID_REGISTRO AS id_registro, ID_CLIENTE AS id_cliente_origem, cast(DATA_INTERESSE AS varchar) AS data_interesse,
       cast(year(DATA_INTERESSE) AS bigint) AS ano,
       strftime(date_trunc('month', DATA_INTERESSE), '%Y-%m-%d 00:00:00') AS mes_interesse,
       PRODUTO_INTERESSE AS carro, FONTE AS canal, ETAPA AS etapa, cast({_RANK} AS bigint) AS etapa_ordem
FROM leads"""

SALES_NAMES = [gold.REVENUE, gold.MARGIN, gold.RECORDS, gold.TICKET, gold.MARGIN_SHARE]
_MEASURES = f"""{_money('sum(billed)')} AS "{gold.REVENUE}", {_money('sum(margin)')} AS "{gold.MARGIN}",
       count(*) AS "{gold.RECORDS}", round(cast(sum(billed) AS double) / count(*) / 100, 4) AS "{gold.TICKET}",
       round(cast(sum(margin) AS double) / nullif(sum(billed), 0), 4) AS "{gold.MARGIN_SHARE}" """


def _rounded(df: DataFrame) -> DataFrame:
    ratios = {n: F.round(F.col(f"`{n}`"), 4) for n in (gold.TICKET, gold.MARGIN_SHARE) if n in df.columns}
    return plain(df.withColumns(ratios) if ratios else df)


def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(measure(gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False), [], SALES_NAMES, gold.sales_measures()))


DASHBOARD_KPIS = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"SELECT {_MEASURES} FROM dataset"


def dashboard_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures by month, ascending."""
    data = gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False)
    month = "mes_entrega"
    return _rounded(measure(data, [month], SALES_NAMES, gold.sales_measures(), order=[(F.col(month), False)]))


DASHBOARD_TREND = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"""
SELECT strftime(mes_entrega, '%Y-%m-%d 00:00:00') AS mes_entrega, {_MEASURES} FROM dataset GROUP BY mes_entrega"""


def dashboard_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and margin per product as one row per measure."""
    data = gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False)
    return plain(series_long(data, ["carro"], [gold.REVENUE, gold.MARGIN], gold.sales_measures(), "serie", "valor"))


DASHBOARD_PRODUCTS = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"""
SELECT carro, '{gold.REVENUE}' AS serie, {_money('sum(billed)')} AS valor FROM dataset GROUP BY 1
UNION ALL SELECT carro, '{gold.MARGIN}', {_money('sum(margin)')} FROM dataset GROUP BY 1"""


def dashboard_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and margin share per seller, for one year's sales of two products (a filter before the measures)."""
    data = gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False)
    filters = {"ano": 1998, "carro": ["Polo", "Nivus"]}
    names = [gold.REVENUE, gold.MARGIN_SHARE]
    revenue = gold.sales_measures()[gold.REVENUE]
    return _rounded(measure(data, ["vendedor"], names, gold.sales_measures(), filters, [(revenue, True)]))


DASHBOARD_SELLERS = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"""
SELECT vendedor, {_money('sum(billed)')} AS "{gold.REVENUE}",
       round(cast(sum(margin) AS double) / nullif(sum(billed), 0), 4) AS "{gold.MARGIN_SHARE}"
FROM dataset WHERE ano = 1998 AND carro IN ('Polo', 'Nivus') GROUP BY 1"""


def dashboard_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clients per channel, largest first."""
    data = gold.leads_dataset(Lake(spark, sf_dir, *LEADS_STAR))
    clients = gold.leads_measures()[gold.CLIENTS]
    return plain(measure(data, ["canal"], [gold.CLIENTS], gold.leads_measures(), order=[(clients, True)]))


DASHBOARD_CHANNELS = _with(LEADS_CTE) + f"""
SELECT FONTE AS canal, count(DISTINCT ID_CLIENTE) AS "{gold.CLIENTS}" FROM leads GROUP BY 1"""


def dashboard_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clients per stage in funnel order."""
    data = gold.leads_dataset(Lake(spark, sf_dir, *LEADS_STAR))
    order = [(F.min("etapa_ordem"), False)]
    out = measure(data, ["etapa"], [gold.CLIENTS], gold.leads_measures(), order=order)
    return plain(out.withColumn("posicao", stage_rank("etapa", spec.STAGES)))


DASHBOARD_STAGES = _with(LEADS_CTE) + f"""
SELECT ETAPA AS etapa, count(DISTINCT ID_CLIENTE) AS "{gold.CLIENTS}", cast({_RANK} AS bigint) AS posicao
FROM leads GROUP BY ETAPA"""


def dashboard_trend_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months' places in the order of the trend."""
    data, month = gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False), "mes_entrega"
    return plain(measure(data, [month], [gold.REVENUE], gold.sales_measures(), order=[(F.col(month), False)], position="lugar"))


DASHBOARD_TREND_ORDER = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"""
SELECT strftime(mes_entrega, '%Y-%m-%d 00:00:00') AS mes_entrega, {_money('sum(billed)')} AS "{gold.REVENUE}",
       row_number() OVER (ORDER BY mes_entrega) AS lugar
FROM dataset GROUP BY mes_entrega"""


def dashboard_sellers_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sellers' places, largest revenue first."""
    data, revenue = gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False), gold.sales_measures()[gold.REVENUE]
    return plain(measure(data, ["vendedor"], [gold.REVENUE], gold.sales_measures(), order=[(revenue, True)], position="lugar"))


DASHBOARD_SELLERS_ORDER = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + f"""
SELECT vendedor, {_money('sum(billed)')} AS "{gold.REVENUE}", row_number() OVER (ORDER BY sum(billed) DESC, vendedor) AS lugar
FROM dataset GROUP BY 1"""


def dashboard_stages_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' places by an aggregate that is not shown."""
    data = gold.leads_dataset(Lake(spark, sf_dir, *LEADS_STAR))
    order = [(min_rank("etapa_ordem"), False)]
    return plain(measure(data, ["etapa"], [gold.CLIENTS], gold.leads_measures(), order=order, position="lugar"))


DASHBOARD_STAGES_ORDER = _with(LEADS_CTE) + f"""
SELECT ETAPA AS etapa, count(DISTINCT ID_CLIENTE) AS "{gold.CLIENTS}", row_number() OVER (ORDER BY min({_RANK}), ETAPA) AS lugar
FROM leads GROUP BY ETAPA"""


def proofs_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine proofs with their place in the report."""
    t = Lake(spark, sf_dir, *FACTS, *MARTS, *gold.DIM_KEYS)
    return plain(report(gold.proofs(t, t), "lugar"))


PROOFS_REPORT = f"SELECT * EXCLUDE (ORDEM), ORDEM AS lugar FROM ({_proofs_sql()})"


def dashboard_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years, products and sellers the filters offer."""
    data = gold.sales_dataset(Lake(spark, sf_dir, *SALES_STAR), clients=False)
    return all_choices(data, ["ano", "carro", "vendedor"], "filtro", "valor")


DASHBOARD_CHOICES = _with(SALES_CTE, LEADS_CTE, ATTRIBUTES_CTE) + _SALES_DATASET + "\nUNION ALL ".join(
    f"SELECT DISTINCT '{n}' AS filtro, cast({n} AS varchar) AS valor FROM dataset" for n in ("ano", "carro", "vendedor")
)

QUERIES = [
    Query("silver_sales", silver_sales, SILVER_SALES),
    Query("silver_leads", silver_leads, SILVER_LEADS),
    Query("silver_positions", silver_positions, SILVER_POSITIONS),
    Query("silver_parts", silver_parts, SILVER_PARTS),
    Query("silver_contracts", silver_contracts, _contracts_sql()),
    Query("silver_summary", silver_summary, SILVER_SUMMARY),
    Query("identity_quarantine", identity_quarantine, IDENTITY_QUARANTINE),
    Query("identity_evidence", identity_evidence, IDENTITY_EVIDENCE),
    Query("stock_quarantine", stock_quarantine, STOCK_QUARANTINE),
    Query("quarantine_summary", quarantine_summary, QUARANTINE_SUMMARY),
    Query("client_dimension", client_dimension, CLIENT_DIMENSION),
    Query("dimension_keys", dimension_keys, DIMENSION_KEYS),
    Query("product_mapping_check", product_check, PRODUCT_CHECK),
    Query("dealership_sales_fact", sales_fact, SALES_FACT),
    Query("dealership_lead_fact", lead_fact, LEAD_FACT),
    Query("dealership_stock_fact", position_fact, POSITION_FACT),
    Query("dealership_fact_contracts", fact_contracts, FACT_CONTRACTS),
    Query("dealership_seller_mart", seller_mart, SELLER_MART),
    Query("dealership_product_mart", product_mart, PRODUCT_MART),
    Query("dealership_finance_mart", finance_mart, FINANCE_MART),
    Query("dealership_funnel_mart", funnel_mart, FUNNEL_MART),
    Query("dealership_proofs", proofs, _proofs_sql()),
    Query("dealership_load", pipeline_run, _proofs_sql()),
    Query("dashboard_sales_dataset", sales_dataset, SALES_DATASET),
    Query("dashboard_leads_dataset", leads_dataset, LEADS_DATASET),
    Query("dashboard_kpis", dashboard_kpis, DASHBOARD_KPIS),
    Query("dashboard_trend", dashboard_trend, DASHBOARD_TREND),
    Query("dashboard_products", dashboard_products, DASHBOARD_PRODUCTS),
    Query("dashboard_sellers", dashboard_sellers, DASHBOARD_SELLERS),
    Query("dashboard_channels", dashboard_channels, DASHBOARD_CHANNELS),
    Query("dashboard_stages", dashboard_stages, DASHBOARD_STAGES),
    Query("dashboard_trend_order", dashboard_trend_order, DASHBOARD_TREND_ORDER),
    Query("dashboard_sellers_order", dashboard_sellers_order, DASHBOARD_SELLERS_ORDER),
    Query("dashboard_stages_order", dashboard_stages_order, DASHBOARD_STAGES_ORDER),
    Query("proofs_report", proofs_report, PROOFS_REPORT),
    Query("dashboard_choices", dashboard_choices, DASHBOARD_CHOICES),
]
