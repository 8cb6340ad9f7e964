"""Fixed values of the dealership model: labels, domains, patterns, names and columns."""

from garimpo.operators.shift import ShiftSpec
from garimpo.sources.raw import SourceSpec

# --- Fixed values: files of the source systems -----------------------------------------------------------------------
SOURCES = (
    SourceSpec("crm", "crm", "crm_concessionaria_2024_2025.csv", "crm", "Leads as received, all text"),
    SourceSpec("erp", "erp", "erp_concessionaria_2024_2025.csv", "erp", "Sales as received, all text"),
    SourceSpec("estoque", "loja", "estoque_concessionaria_2024_2025.csv", "estoque", "Monthly stock as received, all text"),
)

# --- Fixed values: business columns, in file order -------------------------------------------------------------------
LEAD_COLUMNS = [
    "id_cliente",
    "cliente",
    "genero",
    "idade",
    "contato",
    "fonte",
    "produto_interesse",
    "forma_pagamento",
    "entrada_pct",
    "fez_test_drive",
    "data_interesse",
    "etapa",
    "motivo_insucesso",
    "temperatura",
    "data_ultimo_contato",
]
SALE_COLUMNS = [
    "id_cliente",
    "nome_cliente",
    "data_nascimento",
    "vendedor",
    "valor_padrao",
    "desconto",
    "valor_faturamento",
    "forma_pagamento",
    "banco",
    "custo",
    "produto",
    "cor_produto",
    "ano",
    "modelo",
    "data_entrega",
    "zero_km_ou_seminovo",
]
POSITION_COLUMNS = [
    "mes_referencia",
    "cod_produto",
    "produto",
    "estoque_atual",
    "campanha_atual",
]

# --- Fixed values: domains and the spellings that lead to them -------------------------------------------------------
PRODUCTS = (
    ("VW-POL", "Polo"),
    ("VW-NIV", "Nivus"),
    ("VW-SAV", "Saveiro"),
    ("VW-VIR", "Virtus"),
    ("VW-TCR", "T-Cross"),
    ("VW-TAO", "Taos"),
    ("VW-AMA", "Amarok"),
    ("VW-TIG", "Tiguan Allspace"),
)
PRODUCT_NAMES = [name for _, name in PRODUCTS]
GENDERS = ["Masculino", "Feminino"]
CHANNELS = ["Instagram", "WhatsApp", "Google Ads", "Site", "Loja Física", "Indicação", "Facebook Ads", "OLX"]
PAYMENTS = ["Financiamento", "À Vista"]
# In funnel order.
STAGES = ["Primeiro Contato", "Agendamento", "Negociação", "Sucesso", "Interesse Futuro", "Insucesso"]
LOSS_REASONS = [
    "Financeiro",
    "Produto Indisponível",
    "Crédito Negado",
    "Comprou em Outra Concessionária",
    "Comprou no Particular",
    "Contato Sem Sucesso",
]
TEMPERATURES = ["Quente", "Morno", "Frio"]
BANKS = ["Montadora", "Bradesco", "Santander", "BV"]
COLOURS = ["Branco", "Prata", "Preto", "Cinza", "Vermelho", "Azul"]
CONDITIONS = ["0 KM", "Semi Novo"]
CAMPAIGNS = [
    "Nenhuma",
    "Desconto na Entrada",
    "Taxa Zero",
    "Bônus na Troca",
    "IPI Reduzido",
    "Semana do Consumidor",
]
TEST_DRIVE_YES = ("sim", "s", "1")
TEST_DRIVE_NO = ("não",)
GENDER_SPELLINGS = {"m": "Masculino", "fem": "Feminino", "feminno": "Feminino"}
STAGE_SPELLINGS = {"negociacao": "Negociação"}
COLOUR_SPELLINGS = {"brnaco": "Branco", "pratta": "Prata", "pretoo": "Preto"}
MODEL_FIXES = {"T-cross": "T-Cross"}

# --- Fixed values: key and phone patterns of the contracts -----------------------------------------------------------
CLIENT_PATTERN = "^CLI[0-9]+$"
CLIENT_RECORD_PATTERN = "^CLI[0-9]+-[1-9][0-9]*$"
POSITION_RECORD_PATTERN = "^[0-9]{4}-[0-9]{2}-VW-[A-Z]{3}-[1-9][0-9]*$"
PHONE_PATTERN = "^([(][0-9]{2}[)] )?[0-9]{4,5}-[0-9]{4}$"

# --- Fixed values: calendar names ------------------------------------------------------------------------------------
MONTHS = [
    "Janeiro",
    "Fevereiro",
    "Março",
    "Abril",
    "Maio",
    "Junho",
    "Julho",
    "Agosto",
    "Setembro",
    "Outubro",
    "Novembro",
    "Dezembro",
]
WEEKDAYS = [
    "Domingo",
    "Segunda-feira",
    "Terça-feira",
    "Quarta-feira",
    "Quinta-feira",
    "Sexta-feira",
    "Sábado",
]

# Own choice: dates outside it are taken for errors, and the calendar would otherwise span them.
CALENDAR_SPAN = ("1900-01-01", "2100-12-31")

# --- Fixed values: texts of the quarantine tables and of the quarantine label ----------------------------------------
IDENTITY_REASON = "Atributos incompatíveis para o mesmo ID_CLIENTE; nenhuma identidade foi escolhida."
GRAIN_REASON = "Mais de um registro Silver para o mesmo produto/mês; nenhum saldo foi escolhido ou somado."
HELD_LABEL = "ID em quarentena: "


def labels(domain: list[str], spellings: dict[str, str] | None = None) -> dict[str, str]:
    """Lower-case spelling -> canonical label: the domain itself and the known misspellings."""
    return {label.lower(): label for label in domain} | (spellings or {})


SALE_SHIFT = ShiftSpec(
    columns=SALE_COLUMNS[4:],
    amounts=("valor_padrao", "desconto", "valor_faturamento", "custo"),
    payment="forma_pagamento",
    payment_labels=[p.lower() for p in PAYMENTS],
    product="cor_produto",
    product_labels=[p.lower() for p in PRODUCT_NAMES],
    year="modelo",
    date="zero_km_ou_seminovo",
    identity="id_cliente",
    system="ERP",
)
