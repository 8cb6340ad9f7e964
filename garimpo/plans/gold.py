"""Quarantine, star schema, marts, proofs and dashboard datasets over the cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions import (
    count_where,
    distinct_count,
    money_avg,
    money_sum,
    month_of_key,
    safe_ratio,
    stage_rank,
)
from garimpo.functions.aggregates import MONEY
from garimpo.operators.contracts import (
    HeldReference,
    Reference,
    beside,
    check_fact,
    check_position_fact,
    check_unique,
    close,
    compare_groups,
    orphan_rows,
    presence,
    reconcile_totals,
    require_none,
    result,
    totals,
    traced,
    traced_with_held,
    unique_in,
)
from garimpo.operators.dimensions import (
    calendar_dim,
    check_span,
    conformed_dim,
    date_bounds,
    mapped_dim,
    shared_dim,
    union_all,
    unmapped,
    value_dim,
)
from garimpo.operators.facts import lookup, lookup_unless_held
from garimpo.operators.marts import abc_curve, funnel, money_measures, monthly_rollup, outer_position_join
from garimpo.operators.measures import Measure, catalogue
from garimpo.operators.quarantine import (
    Split,
    evidence,
    evidence_arrays,
    exclude,
    grain_conflicts,
    identity_profile,
    split_profile,
)
from garimpo.plans import spec

CLIENT_ATTRIBUTES = ("NOME", "DATA_NASCIMENTO", "GENERO", "CONTATO")
EVIDENCE = {"NOME": "NOMES", "DATA_NASCIMENTO": "NASCIMENTOS", "GENERO": "GENEROS", "CONTATO": "CONTATOS"}
# The held ids alone, which is all a lookup or a proof needs of the identity quarantine.
HELD_IDS = "quarentena_cliente_ids"
PROFILE = "perfil_cliente"
GRAIN = ("COD_PRODUTO", "MES_REFERENCIA")
STOCK_GRAIN = ("SK_PRODUTO", "SK_DATA_REFERENCIA")

Tables = Mapping[str, DataFrame]


# --- quarantine ------------------------------------------------------------------------------------------------------


def client_attributes(leads: DataFrame, sales: DataFrame) -> DataFrame:
    return union_all(
        leads.select("ID_CLIENTE", F.col("CLIENTE").alias("NOME"), "GENERO", "CONTATO"),
        sales.select("ID_CLIENTE", F.col("NOME_CLIENTE").alias("NOME"), "DATA_NASCIMENTO"),
    )


def client_profile(leads: DataFrame, sales: DataFrame) -> DataFrame:
    """Sole values and conflict flag per client; written once and then split."""
    return identity_profile(client_attributes(leads, sales), "ID_CLIENTE", CLIENT_ATTRIBUTES)


def client_split(profile: DataFrame) -> Split:
    return split_profile(profile, "ID_CLIENTE")


def client_evidence(leads: DataFrame, sales: DataFrame, held: DataFrame) -> DataFrame:
    """Every conflicting value, one per row."""
    return evidence(client_attributes(leads, sales), held, "ID_CLIENTE", CLIENT_ATTRIBUTES)


def client_quarantine(values: DataFrame) -> DataFrame:
    """The held ids with their values as sorted arrays: one row each, or more parts where an id has very many."""
    arrays = evidence_arrays(values, "ID_CLIENTE", EVIDENCE)
    return arrays.withColumn("MOTIVO_QUARENTENA", F.lit(spec.IDENTITY_REASON))


def stock_quarantine(positions: DataFrame) -> DataFrame:
    held = grain_conflicts(positions, GRAIN).held
    return held.select(
        "ID_REGISTRO",
        "COD_PRODUTO",
        "PRODUTO",
        "MES_REFERENCIA",
        "ESTOQUE_ATUAL",
        "CAMPANHA_ATUAL",
        F.lit(spec.GRAIN_REASON).alias("MOTIVO_QUARENTENA"),
    )


# --- dimensions ------------------------------------------------------------------------------------------------------


def client_dim(accepted: DataFrame) -> DataFrame:
    return conformed_dim(accepted, "ID_CLIENTE", "SK_CLIENTE", "cliente")


def product_dim(spark: SparkSession) -> DataFrame:
    return mapped_dim(spark, spec.PRODUCTS, "SK_PRODUTO", ("COD_PRODUTO", "NOME_PRODUTO"), "produto")


def product_sources(leads: DataFrame, sales: DataFrame, positions: DataFrame) -> DataFrame:
    code = F.lit(None).cast("string").alias("COD_PRODUTO")
    return union_all(
        leads.select(F.lit("CRM").alias("SISTEMA"), code, F.col("PRODUTO_INTERESSE").alias("NOME_PRODUTO")),
        sales.select(F.lit("ERP").alias("SISTEMA"), code, F.col("PRODUTO").alias("NOME_PRODUTO")),
        positions.select(F.lit("ESTOQUE").alias("SISTEMA"), "COD_PRODUTO", F.col("PRODUTO").alias("NOME_PRODUTO")),
    )


def unmapped_products(leads: DataFrame, sales: DataFrame, positions: DataFrame, products: DataFrame) -> DataFrame:
    return unmapped(product_sources(leads, sales, positions), products, "COD_PRODUTO", "NOME_PRODUTO")


def require_mapped(offenders: DataFrame) -> None:
    text = F.concat(
        F.col("SISTEMA"),
        F.lit(":"),
        F.coalesce("COD_PRODUTO", F.lit("<sem código>")),
        F.lit("/"),
        F.coalesce("NOME_PRODUTO", F.lit("<sem nome>")),
    )
    require_none(offenders, text, "Mapeamento de produto inválido")


def seller_dim(sales: DataFrame) -> DataFrame:
    return value_dim(sales, "VENDEDOR", "SK_VENDEDOR", "vendedor", "NOME")


def payment_dim(leads: DataFrame, sales: DataFrame) -> DataFrame:
    return shared_dim([leads, sales], "FORMA_PAGAMENTO", "SK_PAGAMENTO", "pagamento")


def channel_dim(leads: DataFrame) -> DataFrame:
    return value_dim(leads, "FONTE", "SK_CANAL", "canal")


def calendar_bounds(leads: DataFrame, sales: DataFrame, positions: DataFrame) -> DataFrame:
    return date_bounds(
        [
            (leads, ["DATA_INTERESSE", "DATA_ULTIMO_CONTATO"]),
            (sales, ["DATA_NASCIMENTO", "DATA_ENTREGA"]),
            (positions, ["MES_REFERENCIA"]),
        ]
    )


def span_contract(bounds: DataFrame) -> DataFrame:
    return check_span(bounds, *spec.CALENDAR_SPAN, "dim_calendario: datas fora do intervalo")


def calendar(bounds: DataFrame) -> DataFrame:
    return calendar_dim(bounds, spec.MONTHS, spec.WEEKDAYS)


DIM_KEYS = {
    "dim_cliente": "SK_CLIENTE",
    "dim_produto": "SK_PRODUTO",
    "dim_vendedor": "SK_VENDEDOR",
    "dim_pagamento": "SK_PAGAMENTO",
    "dim_canal": "SK_CANAL",
    "dim_calendario": "SK_DATA",
}


def key_checks(t: Tables) -> DataFrame:
    return union_all(*[check_unique(t[name], key, name) for name, key in DIM_KEYS.items()])


# --- facts -----------------------------------------------------------------------------------------------------------


def sales_fact(sales: DataFrame, t: Tables) -> DataFrame:
    """One row per cleaned sale. The discount is already in the revenue and is not taken off again."""
    f = lookup_unless_held(sales, t[HELD_IDS], "ID_CLIENTE", "ID_CLIENTE", "SK_CLIENTE", "cliente")
    f = lookup(f, t["dim_produto"], "PRODUTO", "NOME_PRODUTO", {"SK_PRODUTO": "SK_PRODUTO"})
    f = lookup(f, t["dim_vendedor"], "VENDEDOR", "NOME", {"SK_VENDEDOR": "SK_VENDEDOR"})
    f = lookup(f, t["dim_pagamento"], "FORMA_PAGAMENTO", "FORMA_PAGAMENTO", {"SK_PAGAMENTO": "SK_PAGAMENTO"})
    f = lookup(f, t["dim_calendario"], "DATA_ENTREGA", "DATA", {"SK_DATA": "SK_DATA_ENTREGA"})
    amounts = ["VALOR_PADRAO", "DESCONTO", "VALOR_FATURAMENTO", "CUSTO"]
    return f.select(
        "ID_REGISTRO",
        F.col("ID_CLIENTE").alias("ID_CLIENTE_ORIGEM"),
        "SK_CLIENTE",
        "SK_PRODUTO",
        "SK_VENDEDOR",
        "SK_PAGAMENTO",
        "SK_DATA_ENTREGA",
        "BANCO",
        "MODELO",
        "COR_PRODUTO",
        F.col("ANO").alias("ANO_VEICULO"),
        "ZERO_KM_OU_SEMINOVO",
        *[F.col(a).cast(MONEY).alias(a) for a in amounts],
        (F.col("VALOR_FATURAMENTO") - F.col("CUSTO")).cast(MONEY).alias("MARGEM_BRUTA_CALCULADA"),
    )


def lead_fact(leads: DataFrame, t: Tables) -> DataFrame:
    """One row per cleaned lead; the calendar is looked up once for each of its two dates."""
    f = lookup(
        leads, t["dim_cliente"], "ID_CLIENTE", "ID_CLIENTE",
        {"SK_CLIENTE": "SK_CLIENTE", "DATA_NASCIMENTO": "DATA_NASCIMENTO"},
    )
    f = lookup(f, t["dim_produto"], "PRODUTO_INTERESSE", "NOME_PRODUTO", {"SK_PRODUTO": "SK_PRODUTO"})
    f = lookup(f, t["dim_pagamento"], "FORMA_PAGAMENTO", "FORMA_PAGAMENTO", {"SK_PAGAMENTO": "SK_PAGAMENTO"})
    f = lookup(f, t["dim_canal"], "FONTE", "FONTE", {"SK_CANAL": "SK_CANAL"})
    f = lookup(f, t["dim_calendario"], "DATA_INTERESSE", "DATA", {"SK_DATA": "SK_DATA_INTERESSE"})
    f = lookup(f, t["dim_calendario"], "DATA_ULTIMO_CONTATO", "DATA", {"SK_DATA": "SK_DATA_ULTIMO_CONTATO"})
    return f.select(
        "ID_REGISTRO",
        F.col("ID_CLIENTE").alias("ID_CLIENTE_ORIGEM"),
        "SK_CLIENTE",
        "SK_PRODUTO",
        "SK_PAGAMENTO",
        "SK_CANAL",
        "SK_DATA_INTERESSE",
        "SK_DATA_ULTIMO_CONTATO",
        F.col("ENTRADA_PCT").cast("decimal(5,2)").alias("ENTRADA_PCT"),
        "IDADE",
        "DATA_NASCIMENTO",
        "ETAPA",
        "TEMPERATURA",
        "MOTIVO_INSUCESSO",
        "FEZ_TEST_DRIVE",
    )


def position_fact(positions: DataFrame, t: Tables) -> DataFrame:
    """One row per accepted product-month. A position may be added across products, never across months."""
    f = exclude(positions, t["quarentena_estoque_mensal"], "ID_REGISTRO")
    f = lookup(f, t["dim_produto"], "COD_PRODUTO", "COD_PRODUTO", {"SK_PRODUTO": "SK_PRODUTO"})
    f = lookup(f, t["dim_calendario"], "MES_REFERENCIA", "DATA", {"SK_DATA": "SK_DATA_REFERENCIA"})
    return f.select(
        "ID_REGISTRO",
        "SK_PRODUTO",
        "SK_DATA_REFERENCIA",
        F.col("ESTOQUE_ATUAL").alias("QUANTIDADE_ESTOQUE"),
        "CAMPANHA_ATUAL",
    )


def fact_ids(silver: Tables, t: Tables) -> dict[str, DataFrame]:
    """Per fact how often each record id is in the fact, in what is held back and in the cleaned rows it is made from.

    Written once, these tables answer the uniqueness of the cleaned keys, the facts' contracts and the proofs, so an id goes
    through one shuffle.
    """
    held = t["quarentena_estoque_mensal"]
    return {
        "fato_vendas": presence("ID_REGISTRO", fact=t["fato_vendas"], source=silver["erp"]),
        "fato_oportunidade": presence("ID_REGISTRO", fact=t["fato_oportunidade"], source=silver["crm"]),
        "fato_estoque_mensal": presence("ID_REGISTRO", fact=t["fato_estoque_mensal"], held=held, source=silver["estoque"]),
    }


def record_keys(ids: Tables) -> DataFrame:
    """Uniqueness of the cleaned tables' record ids."""
    sources = {"fato_vendas": "erp", "fato_oportunidade": "crm", "fato_estoque_mensal": "estoque"}
    return union_all(*[unique_in(ids[fact], "source", f"{name}: ID_REGISTRO duplicado") for fact, name in sources.items()])


def fact_contracts(silver: Tables, t: Tables, ids: Tables | None = None) -> list[DataFrame]:
    held = t[HELD_IDS]
    ids = ids or {}
    return [
        check_fact(
            t["fato_vendas"], silver["erp"], "ID_REGISTRO",
            ["SK_PRODUTO", "SK_VENDEDOR", "SK_PAGAMENTO", "SK_DATA_ENTREGA"],
            "fato_vendas", held, "SK_CLIENTE", "ID_CLIENTE_ORIGEM", "ID_CLIENTE", ids.get("fato_vendas"),
        ),
        check_fact(
            t["fato_oportunidade"], silver["crm"], "ID_REGISTRO",
            ["SK_PRODUTO", "SK_PAGAMENTO", "SK_CANAL", "SK_DATA_INTERESSE", "SK_DATA_ULTIMO_CONTATO"],
            "fato_oportunidade", held, "SK_CLIENTE", "ID_CLIENTE_ORIGEM", "ID_CLIENTE", ids.get("fato_oportunidade"),
        ),
        check_position_fact(
            t["fato_estoque_mensal"], t["quarentena_estoque_mensal"], silver["estoque"], "ID_REGISTRO",
            STOCK_GRAIN, "fato_estoque_mensal", ids.get("fato_estoque_mensal"),
        ),
    ]


# --- marts -----------------------------------------------------------------------------------------------------------


def seller_mart(fact: DataFrame) -> DataFrame:
    return monthly_rollup(
        fact,
        "SK_DATA_ENTREGA",
        "SK_MES_ENTREGA",
        ["SK_VENDEDOR"],
        {
            "FATURAMENTO": money_sum("VALOR_FATURAMENTO"),
            "MARGEM_BRUTA_CALCULADA": money_sum("MARGEM_BRUTA_CALCULADA"),
            "REGISTROS_VENDA": F.count(F.lit(1)),
            "CLIENTES_DISTINTOS": distinct_count("ID_CLIENTE_ORIGEM"),
            "TICKET_MEDIO_POR_REGISTRO": money_avg("VALOR_FATURAMENTO"),
        },
    )


def product_months(fact: DataFrame, positions: DataFrame) -> DataFrame:
    """Sales of each product-month beside its stock position."""
    flow = monthly_rollup(
        fact,
        "SK_DATA_ENTREGA",
        "SK_MES",
        ["SK_PRODUTO"],
        money_measures({"FATURAMENTO": "VALOR_FATURAMENTO", "MARGEM_BRUTA_CALCULADA": "MARGEM_BRUTA_CALCULADA"})
        | {"REGISTROS_VENDA": F.count(F.lit(1))},
    )
    position = positions.select("SK_PRODUTO", F.col("SK_DATA_REFERENCIA").alias("SK_MES"), "QUANTIDADE_ESTOQUE")
    return outer_position_join(
        flow, position, ["SK_PRODUTO", "SK_MES"], ["FATURAMENTO", "MARGEM_BRUTA_CALCULADA", "REGISTROS_VENDA"]
    )


def product_mart(fact: DataFrame, positions: DataFrame, slices: int | None = None) -> DataFrame:
    rows = product_months(fact, positions)
    curve = abc_curve(
        rows, "SK_MES", "SK_PRODUTO", "FATURAMENTO", "MARGEM_BRUTA_CALCULADA", "REGISTROS_VENDA", slices
    )
    return curve.select(
        "SK_PRODUTO",
        "SK_MES",
        "FATURAMENTO",
        "MARGEM_BRUTA_CALCULADA",
        "MARGEM_PCT",
        "REGISTROS_VENDA",
        "CURVA_ABC",
        "QUANTIDADE_ESTOQUE",
    )


def finance_mart(fact: DataFrame) -> DataFrame:
    sums = {
        "VALOR_PADRAO": "VALOR_PADRAO",
        "DESCONTO": "DESCONTO",
        "FATURAMENTO": "VALOR_FATURAMENTO",
        "CUSTO": "CUSTO",
        "MARGEM_BRUTA_CALCULADA": "MARGEM_BRUTA_CALCULADA",
    }
    return monthly_rollup(fact, "SK_DATA_ENTREGA", "SK_MES_ENTREGA", [], money_measures(sums))


FUNNEL_KEYS = ["SK_CANAL", "SK_PRODUTO", "SK_MES_INTERESSE", "ETAPA"]


def funnel_mart(fact: DataFrame) -> DataFrame:
    names = ("REGISTROS_OPORTUNIDADE", "CLIENTES_DISTINTOS", "REGISTROS_COM_TEST_DRIVE")
    by = ["SK_CANAL", "SK_PRODUTO", "ETAPA"]
    mart = funnel(fact, "SK_DATA_INTERESSE", "SK_MES_INTERESSE", by, "ID_CLIENTE_ORIGEM", "FEZ_TEST_DRIVE", names)
    return mart.select(*FUNNEL_KEYS, *names)


# --- the nine proofs -------------------------------------------------------------------------------------------------

SALE_TOTALS = {
    "valor_padrao": "VALOR_PADRAO",
    "desconto": "DESCONTO",
    "faturamento": "VALOR_FATURAMENTO",
    "custo": "CUSTO",
    "margem": "MARGEM_BRUTA_CALCULADA",
}


def _trace_result(order: int, test: str, ids: DataFrame) -> DataFrame:
    t = traced(ids)
    found = F.to_json(F.struct("linhas", "ids", "ausentes", "extras"))
    zero = F.lit(0)
    expected = F.to_json(
        F.struct(
            F.col("linhas_origem").alias("linhas"),
            F.col("linhas_origem").alias("ids"),
            zero.alias("ausentes"),
            zero.alias("extras"),
        )
    )
    passed = (
        (F.col("linhas") == F.col("linhas_origem"))
        & (F.col("ids") == F.col("linhas"))
        & (F.col("ausentes") == 0)
        & (F.col("extras") == 0)
    )
    return t.select(*result(order, test, found, expected, passed))


def _stock_result(t: Tables, ids: DataFrame) -> DataFrame:
    grains = t["fato_estoque_mensal"].groupBy(*STOCK_GRAIN).agg(F.count(F.lit(1)).alias("_n"))
    both = beside(t=traced_with_held(ids), g=grains.agg(F.count_if(F.col("_n") > 1).alias("n")))
    zero = F.lit(0)
    flat = both.select("t.*", F.col("g.n").alias("graos_duplicados"))
    found = F.to_json(
        F.struct("aceitas", "quarentena", "total_silver", "graos_duplicados", "ausentes", "extras", "sobreposicoes")
    )
    expected = F.to_json(
        F.struct(
            F.col("total_silver").alias("aceitas_mais_quarentena"),
            *[zero.alias(n) for n in ("graos_duplicados", "ausentes", "extras", "sobreposicoes")],
        )
    )
    passed = F.col("aceitas") + F.col("quarentena") == F.col("total_silver")
    for n in ("graos_duplicados", "ausentes", "extras", "sobreposicoes"):
        passed = passed & (F.col(n) == 0)
    return flat.select(*result(4, "grao_e_rastreabilidade_estoque", found, expected, passed))


def _integrity_result(t: Tables) -> DataFrame:
    held = t[HELD_IDS]
    customer = HeldReference("SK_CLIENTE", t["dim_cliente"], "SK_CLIENTE", "ID_CLIENTE_ORIGEM", held, "ID_CLIENTE")
    product = Reference("SK_PRODUTO", t["dim_produto"], "SK_PRODUTO")
    payment = Reference("SK_PAGAMENTO", t["dim_pagamento"], "SK_PAGAMENTO")

    def day(column: str) -> Reference:
        return Reference(column, t["dim_calendario"], "SK_DATA")

    seller = Reference("SK_VENDEDOR", t["dim_vendedor"], "SK_VENDEDOR")
    channel = Reference("SK_CANAL", t["dim_canal"], "SK_CANAL")
    lead_refs = [product, payment, channel, day("SK_DATA_INTERESSE"), day("SK_DATA_ULTIMO_CONTATO")]
    found = beside(
        v=orphan_rows(t["fato_vendas"], [product, seller, payment, day("SK_DATA_ENTREGA")], customer),
        o=orphan_rows(t["fato_oportunidade"], lead_refs, customer),
        e=orphan_rows(t["fato_estoque_mensal"], [product, day("SK_DATA_REFERENCIA")]),
    ).select(
        F.col("v.linhas").alias("vendas_orfas"),
        F.col("o.linhas").alias("oportunidades_orfas"),
        F.col("e.linhas").alias("estoque_orfao"),
    )
    names = found.columns
    passed = F.lit(True)
    for n in names:
        passed = passed & (F.col(n) == 0)
    expected = F.to_json(F.struct(*[F.lit(0).alias(n) for n in names]))
    return found.select(*result(5, "integridade_dimensional", F.to_json(F.struct(*names)), expected, passed))


def _product_result(t: Tables, fact: DataFrame) -> DataFrame:
    mart = t["mart_produto_performance"]
    summed = mart.agg(
        money_sum("FATURAMENTO").alias("faturamento"),
        money_sum("MARGEM_BRUTA_CALCULADA").alias("margem"),
        F.sum("REGISTROS_VENDA").alias("registros"),
    )
    stock = t["fato_estoque_mensal"]
    same = (F.col("SK_PRODUTO") == F.col("_p")) & (F.col("SK_DATA_REFERENCIA") == F.col("_m"))
    keys = mart.select(F.col("SK_PRODUTO").alias("_p"), F.col("SK_MES").alias("_m"))
    lost = stock.join(keys, same, "left_anti").agg(F.count(F.lit(1)).alias("estoques_ausentes"))
    found = beside(m=summed, l=lost).select("m.*", "l.*")
    expected = fact.select("faturamento", "margem", "registros", F.lit(0).cast("bigint").alias("estoques_ausentes"))
    return reconcile_totals(
        7, "mart_produto_performance_vs_fatos", found, expected, exact=["registros", "estoques_ausentes"]
    )


def _funnel_result(t: Tables) -> DataFrame:
    mart, fact = t["mart_funil_comercial"], t["fato_oportunidade"]
    recomputed = (
        fact.filter(F.col("SK_DATA_INTERESSE").isNotNull())
        .groupBy("SK_CANAL", "SK_PRODUTO", month_of_key("SK_DATA_INTERESSE").alias("SK_MES_INTERESSE"), "ETAPA")
        .agg(
            F.count(F.lit(1)).alias("registros"),
            distinct_count("ID_CLIENTE_ORIGEM").alias("clientes"),
            count_where(F.col("FEZ_TEST_DRIVE")).alias("test_drives"),
        )
    )
    measures = {
        "REGISTROS_OPORTUNIDADE": "registros",
        "CLIENTES_DISTINTOS": "clientes",
        "REGISTROS_COM_TEST_DRIVE": "test_drives",
    }
    both = beside(
        g=compare_groups(mart, recomputed, FUNNEL_KEYS, measures),
        m=mart.agg(F.sum("REGISTROS_OPORTUNIDADE").alias("registros"), F.sum("REGISTROS_COM_TEST_DRIVE").alias("test_drives")),
        f=fact.agg(F.count(F.lit(1)).alias("registros"), count_where(F.col("FEZ_TEST_DRIVE")).alias("test_drives")),
    )
    found = both.select(
        F.col("g.grupos_divergentes"),
        F.col("m.registros").alias("registros"),
        F.col("m.test_drives").alias("test_drives"),
        F.lit(0).alias("_zero"),
        F.col("f.registros").alias("_registros"),
        F.col("f.test_drives").alias("_test_drives"),
    )
    expected = F.struct(
        F.col("_zero").alias("grupos_divergentes"),
        F.col("_registros").alias("registros"),
        F.col("_test_drives").alias("test_drives"),
    )
    passed = (
        (F.col("grupos_divergentes") == 0)
        & (F.col("registros") == F.col("_registros"))
        & (F.col("test_drives") == F.col("_test_drives"))
    )
    calculated = F.to_json(F.struct("grupos_divergentes", "registros", "test_drives"))
    return found.select(*result(9, "mart_funil_comercial_vs_fato", calculated, F.to_json(expected), passed))


def proofs(silver: Tables, t: Tables, ids: Tables | None = None) -> DataFrame:
    """Nine reconciliations as rows (ORDEM, TESTE, VALOR_CALCULADO, VALOR_ESPERADO, PASSOU).

    A total that is NULL because a table is empty does not pass. `ids`: what `fact_ids` gives, if it is written already.
    """
    ids = ids or fact_ids(silver, t)
    margin = F.col("VALOR_FATURAMENTO") - F.col("CUSTO")
    source = totals(silver["erp"], **(SALE_TOTALS | {"margem": margin}))
    fact = totals(t["fato_vendas"], **SALE_TOTALS)
    seller = t["mart_vendas_por_vendedor"].agg(
        money_sum("FATURAMENTO").alias("faturamento"),
        money_sum("MARGEM_BRUTA_CALCULADA").alias("margem"),
        F.sum("REGISTROS_VENDA").alias("registros"),
    )
    finance = t["mart_financeiro"].agg(
        *[
            money_sum(column).alias(name)
            for name, column in {
                "valor_padrao": "VALOR_PADRAO",
                "desconto": "DESCONTO",
                "faturamento": "FATURAMENTO",
                "custo": "CUSTO",
                "margem": "MARGEM_BRUTA_CALCULADA",
            }.items()
        ]
    )
    pair, triple = ["faturamento", "margem"], ["faturamento", "margem", "registros"]
    return union_all(
        reconcile_totals(1, "financeiro_fato_vs_erp", fact.select(*pair), source.select(*pair)),
        _trace_result(2, "rastreabilidade_fato_vendas", ids["fato_vendas"]),
        _trace_result(3, "rastreabilidade_fato_oportunidade", ids["fato_oportunidade"]),
        _stock_result(t, ids["fato_estoque_mensal"]),
        _integrity_result(t),
        reconcile_totals(6, "mart_vendas_por_vendedor_vs_fato", seller, fact.select(*triple), exact=["registros"]),
        _product_result(t, fact),
        reconcile_totals(8, "mart_financeiro_vs_fato", finance, fact.select(*SALE_TOTALS)),
        _funnel_result(t),
    )


# --- dashboard datasets and measures ---------------------------------------------------------------------------------


def sales_dataset(t: Tables, clients: bool = True) -> DataFrame:
    """One row per sale. The column `cliente` needs a join with the one dimension that grows with the data, which Spark cannot
    leave out by itself; figures that do not show it ask for none."""
    f, d, p = t["fato_vendas"], t["dim_calendario"], t["dim_produto"]
    joined = (
        f.join(d, f["SK_DATA_ENTREGA"] == d["SK_DATA"])
        .join(p, "SK_PRODUTO")
        .join(t["dim_vendedor"].withColumnRenamed("NOME", "vendedor"), "SK_VENDEDOR")
    )
    client = []
    if clients:
        joined = joined.join(t["dim_cliente"].select("SK_CLIENTE", "NOME"), "SK_CLIENTE", "left")
        held = F.concat(F.lit(spec.HELD_LABEL), F.col("ID_CLIENTE_ORIGEM"))
        client = [F.coalesce(F.col("NOME"), held).alias("cliente")]
    return joined.select(
        F.col("ID_REGISTRO").alias("id_registro"),
        F.col("ID_CLIENTE_ORIGEM").alias("id_cliente_origem"),
        *client,
        F.col("DATA").alias("data_entrega"),
        F.col("ANO").alias("ano"),
        F.date_trunc("MONTH", F.col("DATA")).alias("mes_entrega"),
        F.col("NOME_PRODUTO").alias("carro"),
        F.col("vendedor"),
        F.col("VALOR_FATURAMENTO").alias("valor_faturamento"),
        F.col("MARGEM_BRUTA_CALCULADA").alias("margem_bruta_calculada"),
    )


def leads_dataset(t: Tables) -> DataFrame:
    o, d = t["fato_oportunidade"], t["dim_calendario"]
    joined = (
        o.join(d, o["SK_DATA_INTERESSE"] == d["SK_DATA"])
        .join(t["dim_produto"], "SK_PRODUTO")
        .join(t["dim_canal"], "SK_CANAL")
    )
    return joined.select(
        F.col("ID_REGISTRO").alias("id_registro"),
        F.col("ID_CLIENTE_ORIGEM").alias("id_cliente_origem"),
        F.col("DATA").alias("data_interesse"),
        F.col("ANO").alias("ano"),
        F.date_trunc("MONTH", F.col("DATA")).alias("mes_interesse"),
        F.col("NOME_PRODUTO").alias("carro"),
        F.col("FONTE").alias("canal"),
        F.col("ETAPA").alias("etapa"),
        stage_rank("ETAPA", spec.STAGES).alias("etapa_ordem"),
    )


REVENUE, MARGIN, RECORDS = "Receita", "Margem bruta", "Registros de venda"
TICKET, MARGIN_SHARE, CLIENTS = "Ticket médio por registro", "Margem %", "Clientes únicos"


def sales_measures():
    revenue, margin = F.sum("valor_faturamento"), F.sum("margem_bruta_calculada")
    records = F.count("id_registro")
    return catalogue(
        [
            Measure(REVENUE, revenue),
            Measure(MARGIN, margin),
            Measure(RECORDS, records),
            Measure(TICKET, revenue / F.nullif(records, F.lit(0))),
            Measure(MARGIN_SHARE, safe_ratio("margem_bruta_calculada", "valor_faturamento")),
        ]
    )


def leads_measures():
    return catalogue([Measure(CLIENTS, distinct_count("id_cliente_origem"))])
