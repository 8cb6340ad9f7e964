"""Cleaning of leads, sales and stock positions: text in, typed and versioned rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.functions import (
    canonical,
    code_name,
    format_phone,
    lenient_cast,
    parse_date,
    parse_month,
    project,
    record_key,
    strict_cast,
    title_case,
    tri_bool,
)
from garimpo.operators.contracts import Contract
from garimpo.operators.shift import repair_shift
from garimpo.operators.versions import SOURCE_ROWS, consolidate_versions
from garimpo.plans import spec

PROCESSED_AT = "_processado_em"
RECORD = "ID_REGISTRO"
_AMOUNT = "decimal(15,2)"


def _client_versions(bronze: DataFrame, business: list[str]) -> DataFrame:
    key = F.upper(F.trim("id_cliente")).alias("_chave")
    return consolidate_versions(bronze.select(*business, key), ["_chave"], business)


def clean_leads(bronze: DataFrame) -> DataFrame:
    """Opportunities of the CRM; refused rows carry `_problema`."""
    rows = _client_versions(bronze, spec.LEAD_COLUMNS)
    return project(
        rows,
        {
            RECORD: record_key("_chave", "_versao"),
            "ID_CLIENTE": F.col("_chave"),
            "CLIENTE": title_case("cliente"),
            "GENERO": canonical("genero", spec.labels(spec.GENDERS, spec.GENDER_SPELLINGS)),
            "IDADE": strict_cast("idade", "int", "crm: IDADE"),
            "CONTATO": format_phone("contato"),
            "FONTE": canonical("fonte", spec.labels(spec.CHANNELS)),
            "PRODUTO_INTERESSE": canonical("produto_interesse", spec.labels(spec.PRODUCT_NAMES)),
            "FORMA_PAGAMENTO": canonical("forma_pagamento", spec.labels(spec.PAYMENTS)),
            "ENTRADA_PCT": strict_cast("entrada_pct", "decimal(5,2)", "crm: ENTRADA_PCT"),
            "FEZ_TEST_DRIVE": tri_bool(
                "fez_test_drive", spec.TEST_DRIVE_YES, spec.TEST_DRIVE_NO, "CRM: FEZ_TEST_DRIVE desconhecido"
            ),
            "DATA_INTERESSE": parse_date("data_interesse"),
            "ETAPA": canonical("etapa", spec.labels(spec.STAGES, spec.STAGE_SPELLINGS)),
            "MOTIVO_INSUCESSO": canonical("motivo_insucesso", spec.labels(spec.LOSS_REASONS)),
            "TEMPERATURA": canonical("temperatura", spec.labels(spec.TEMPERATURES)),
            "DATA_ULTIMO_CONTATO": parse_date("data_ultimo_contato"),
            PROCESSED_AT: F.current_timestamp(),
            SOURCE_ROWS: F.col(SOURCE_ROWS),
        },
    )


def clean_sales(bronze: DataFrame) -> DataFrame:
    """Sales of the ERP, moved rows repaired. Amounts are kept as told: negative, zero and never recomputed."""
    rows = _client_versions(bronze, spec.SALE_COLUMNS)
    rows = repair_shift(rows, spec.SALE_SHIFT, "_deslocamento")
    return project(
        rows,
        {
            RECORD: record_key("_chave", "_versao"),
            "ID_CLIENTE": F.col("_chave"),
            "NOME_CLIENTE": title_case("nome_cliente"),
            "DATA_NASCIMENTO": parse_date("data_nascimento"),
            "VENDEDOR": title_case("vendedor"),
            "VALOR_PADRAO": lenient_cast("valor_padrao", _AMOUNT),
            "DESCONTO": lenient_cast("desconto", _AMOUNT),
            "VALOR_FATURAMENTO": lenient_cast("valor_faturamento", _AMOUNT),
            "FORMA_PAGAMENTO": canonical("forma_pagamento", spec.labels(spec.PAYMENTS)),
            "BANCO": canonical("banco", spec.labels(spec.BANKS)),
            "CUSTO": lenient_cast("custo", _AMOUNT),
            "PRODUTO": canonical("produto", spec.labels(spec.PRODUCT_NAMES)),
            "COR_PRODUTO": canonical("cor_produto", spec.labels(spec.COLOURS, spec.COLOUR_SPELLINGS)),
            "ANO": lenient_cast("ano", "int"),
            "MODELO": title_case("modelo", spec.MODEL_FIXES),
            "DATA_ENTREGA": parse_date("data_entrega"),
            "ZERO_KM_OU_SEMINOVO": canonical("zero_km_ou_seminovo", spec.labels(spec.CONDITIONS)),
            PROCESSED_AT: F.current_timestamp(),
            SOURCE_ROWS: F.col(SOURCE_ROWS),
        },
        F.col("_deslocamento"),
    )


def clean_positions(bronze: DataFrame) -> DataFrame:
    """Monthly stock. The name follows from the code; months are parsed before rows compete for a version."""
    key = [parse_month("mes_referencia").alias("_mes"), F.upper(F.trim("cod_produto")).alias("_codigo")]
    rows = consolidate_versions(bronze.select(*spec.POSITION_COLUMNS, *key), ["_mes", "_codigo"], spec.POSITION_COLUMNS)
    return project(
        rows,
        {
            RECORD: record_key(F.date_format("_mes", "yyyy-MM"), "_codigo", "_versao"),
            "MES_REFERENCIA": F.col("_mes"),
            "COD_PRODUTO": F.col("_codigo"),
            "PRODUTO": code_name("cod_produto", dict(spec.PRODUCTS), "Estoque: codigo de produto desconhecido"),
            "ESTOQUE_ATUAL": strict_cast("estoque_atual", "int", "estoque: ESTOQUE_ATUAL"),
            "CAMPANHA_ATUAL": canonical("campanha_atual", spec.labels(spec.CAMPAIGNS)),
            PROCESSED_AT: F.current_timestamp(),
            SOURCE_ROWS: F.col(SOURCE_ROWS),
        },
    )


# --- row contracts ---------------------------------------------------------------------------------------------------


def _filled(*names: str):
    held = F.lit(True)
    for n in names:
        held = held & F.col(n).isNotNull() & (F.length(n) > 0)
    return held


def _present(*names: str):
    held = F.lit(True)
    for n in names:
        held = held & F.col(n).isNotNull()
    return held


def _within(optional: dict, required: dict):
    held = F.lit(True)
    for n, domain in required.items():
        held = held & F.col(n).isNotNull() & F.col(n).isin(*domain)
    for n, domain in optional.items():
        held = held & (F.col(n).isNull() | F.col(n).isin(*domain))
    return held


def _client_keys():
    return _present(RECORD, "ID_CLIENTE") & F.col(RECORD).rlike(spec.CLIENT_RECORD_PATTERN) & F.col(
        "ID_CLIENTE"
    ).rlike(spec.CLIENT_PATTERN)


def _audited():
    return _present(PROCESSED_AT, SOURCE_ROWS) & (F.col(SOURCE_ROWS) >= 1)


def lead_contracts() -> list[Contract]:
    return [
        Contract("crm_chaves", _client_keys()),
        Contract("crm_obrigatorios", _filled("CLIENTE") & _present("DATA_INTERESSE", "DATA_ULTIMO_CONTATO")),
        Contract(
            "crm_dominios",
            _within(
                {"GENERO": spec.GENDERS, "MOTIVO_INSUCESSO": spec.LOSS_REASONS},
                {
                    "FONTE": spec.CHANNELS,
                    "PRODUTO_INTERESSE": spec.PRODUCT_NAMES,
                    "FORMA_PAGAMENTO": spec.PAYMENTS,
                    "ETAPA": spec.STAGES,
                    "TEMPERATURA": spec.TEMPERATURES,
                },
            ),
        ),
        Contract("crm_contato", F.col("CONTATO").isNull() | F.col("CONTATO").rlike(spec.PHONE_PATTERN)),
        Contract("crm_auditoria", _audited()),
    ]


def sale_contracts() -> list[Contract]:
    return [
        Contract("erp_chaves", _client_keys()),
        Contract("erp_obrigatorios", _filled("NOME_CLIENTE", "VENDEDOR", "MODELO") & _present("ANO", "DATA_ENTREGA")),
        Contract("erp_financeiro", _present("VALOR_PADRAO", "DESCONTO", "VALOR_FATURAMENTO", "CUSTO")),
        Contract(
            "erp_dominios",
            _within(
                {"BANCO": spec.BANKS, "ZERO_KM_OU_SEMINOVO": spec.CONDITIONS},
                {"FORMA_PAGAMENTO": spec.PAYMENTS, "PRODUTO": spec.PRODUCT_NAMES, "COR_PRODUTO": spec.COLOURS},
            ),
        ),
        Contract("erp_auditoria", _audited()),
    ]


def position_contracts() -> list[Contract]:
    codes = [code for code, _ in spec.PRODUCTS]
    return [
        Contract(
            "estoque_chaves",
            _present(RECORD, "COD_PRODUTO")
            & F.col(RECORD).rlike(spec.POSITION_RECORD_PATTERN)
            & F.col("COD_PRODUTO").isin(*codes),
        ),
        Contract("estoque_mes", _present("MES_REFERENCIA") & (F.dayofmonth("MES_REFERENCIA") == 1)),
        Contract("estoque_dominios", _within({}, {"PRODUTO": spec.PRODUCT_NAMES, "CAMPANHA_ATUAL": spec.CAMPAIGNS})),
        Contract("estoque_auditoria", _audited()),
    ]
