"""The cleaning rules one by one, each on small rows made for it, and the invariants on random rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from garimpo.functions import PROBLEM
from garimpo.operators.contracts import ContractBroken, check_rows, fail_on_contracts, require_clean
from garimpo.plans import silver, spec

_LEAD = dict(
    id_cliente="CLI500001", cliente="Davi Prado", genero="M", idade="52", contato="4733221100", fonte="Site", produto_interesse="Polo",
    forma_pagamento="À Vista", entrada_pct="10", fez_test_drive="Sim", data_interesse="2023-11-30", etapa="Sucesso",
    motivo_insucesso=None, temperatura="Morno", data_ultimo_contato="2023-12-01",
)
_SALE = dict(
    id_cliente="CLI500009", nome_cliente="Iris Melo", data_nascimento="1979-12-31", vendedor="Caio Reis", valor_padrao="75400.10",
    desconto="1200.00", valor_faturamento="74200.10", forma_pagamento="À Vista", banco="BV", custo="70011.99", produto="Nivus",
    cor_produto="Prata", ano="2023", modelo="nivus highline", data_entrega="2023-12-15", zero_km_ou_seminovo="Semi Novo",
)
_POSITION = dict(mes_referencia="2023-12", cod_produto="VW-TCR", produto="T-Cross", estoque_atual="3", campanha_atual="Nenhuma")


def lead(**changes):
    return [(_LEAD | changes)[c] for c in spec.LEAD_COLUMNS]


def sale(**changes):
    return [(_SALE | changes)[c] for c in spec.SALE_COLUMNS]


def position(**changes):
    return [(_POSITION | changes)[c] for c in spec.POSITION_COLUMNS]


KINDS = {
    "leads": (silver.clean_leads, spec.LEAD_COLUMNS, lead, silver.lead_contracts),
    "sales": (silver.clean_sales, spec.SALE_COLUMNS, sale, silver.sale_contracts),
    "positions": (silver.clean_positions, spec.POSITION_COLUMNS, position, silver.position_contracts),
}


def clean(frame, kind, rows):
    cleaner, columns, *_ = KINDS[kind]
    out = cleaner(frame(columns, rows)).drop(silver.PROCESSED_AT).collect()
    return [r.asDict() for r in out]


def split_amount(row, name, whole, cents):
    """The row as it is read when `name` was written with a decimal comma: everything after it moves one column on."""
    at = spec.SALE_COLUMNS.index(name)
    return [*row[:at], whole, cents, *row[at + 1 : -1]]


@pytest.mark.parametrize("kind", KINDS)
def test_ids_and_counts_on_random_rows(frame, kind):
    """Against a plain count: as many rows as distinct inputs, copies counted, ids 1..n per key, any input order."""
    _, _, make, contracts = KINDS[kind]
    rng = random.Random(kind)
    if kind == "positions":
        rows = [position(mes_referencia=rng.choice(["2023-12", "12/2023", "2024/01"]), estoque_atual=str(rng.randrange(4))) for _ in range(60)]
    else:
        key = "id_cliente"
        other = "idade" if kind == "leads" else "ano"
        rows = [make(**{key: rng.choice(["cli500001", "CLI500001 ", "CLI500002", "CLI500003"]), other: str(rng.randrange(20, 26))}) for _ in range(60)]
    got = clean(frame, kind, rows)
    distinct = Counter(map(tuple, rows))
    assert len(got) == len(distinct)
    assert sorted(r["_linhas_origem"] for r in got) == sorted(distinct.values())
    groups = Counter(r["ID_REGISTRO"].rsplit("-", 1)[0] for r in got)
    assert {r["ID_REGISTRO"] for r in got} == {f"{k}-{i}" for k, n in groups.items() for i in range(1, n + 1)}
    rng.shuffle(rows)
    assert sorted(map(str, got)) == sorted(map(str, clean(frame, kind, rows)))
    cleaner, columns, *_ = KINDS[kind]
    assert check_rows(cleaner(frame(columns, rows)), contracts()).filter("NOT passou").count() == 0


@pytest.mark.parametrize("kind", KINDS)
def test_rows_are_dealt_once(frame, kind):
    """Folding copies and numbering versions share one exchange and one sort."""
    cleaner, columns, make, _ = KINDS[kind]
    plan = cleaner(frame(columns, [make(), make()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize(
    "column,out,told",
    [
        ("contato", "CONTATO", {"4733221100": "(47) 3322-1100", "47933221100": "(47) 93322-1100", "33221100": "3322-1100",
                                "933221100": "93322-1100", "33x21100": None, "123": None}),
        ("fez_test_drive", "FEZ_TEST_DRIVE", {"sim": "True", "Não": "False", "  ": "None"}),
        ("data_interesse", "DATA_INTERESSE", {"2024-02-29": "2024-02-29", "29/02/2024": "2024-02-29", "12/31/2023": "2023-12-31", "31/31/2023": "None"}),
        ("entrada_pct", "ENTRADA_PCT", {"0": "0.00", "-2.5": "-2.50", "": "None"}),
        ("cliente", "CLIENTE", {"ZOE DA luz ": "Zoe Da Luz"}),
        ("fonte", "FONTE", {" SITE": "Site"}),
    ],
)
def test_lead_rules(frame, column, out, told):
    rows = [lead(id_cliente=f"CLI50010{i}", **{column: raw}) for i, raw in enumerate(told)]
    got = {r["ID_CLIENTE"]: r[out] for r in clean(frame, "leads", rows)}
    assert {raw: str(got[f"CLI50010{i}"]) for i, raw in enumerate(told)} == {k: str(v) for k, v in told.items()}


@pytest.mark.parametrize("name", ["valor_padrao", "desconto", "valor_faturamento", "custo"])
def test_a_split_amount_reads_like_the_whole_one(frame, name):
    """Any amount of a thousand or more: the repaired row equals the row that was never split, but for the lost last column."""
    rng = random.Random(name)
    amounts = [(rng.choice(["", "-"]), rng.randrange(1, 900), rng.randrange(1000), rng.randrange(100)) for _ in range(12)]
    whole = [sale(id_cliente=f"CLI5002{i:02d}", **{name: f"{s}{t}{h:03d}.{c:02d}"}) for i, (s, t, h, c) in enumerate(amounts)]
    moved = [split_amount(row, name, f"{s}{t}.{h:03d}", f"{c:02d}") for row, (s, t, h, c) in zip(whole, amounts, strict=True)]
    last = "ZERO_KM_OU_SEMINOVO"
    expected = {r["ID_CLIENTE"]: r | {last: None} for r in clean(frame, "sales", whole)}
    got = {r["ID_CLIENTE"]: r for r in clean(frame, "sales", moved)}
    assert got == expected and all(r[PROBLEM] is None for r in got.values())


def test_a_split_that_cannot_be_placed_is_refused(frame):
    small = split_amount(sale(id_cliente="A"), "valor_padrao", "640", "15")  # no dot before the comma
    both = split_amount(sale(id_cliente="B", forma_pagamento="qualquer"), "custo", "640", "15")
    got = {r["ID_CLIENTE"]: r[PROBLEM] for r in clean(frame, "sales", [small, both, sale(id_cliente="C")])}
    assert got["A"] == "ERP: linha de A deslocada, sem valor partido antes do pagamento" and got["C"] is None
    with pytest.raises(ContractBroken, match="A"):
        cleaner, columns, *_ = KINDS["sales"]
        require_clean(cleaner(frame(columns, [small])), "vendas")


def test_positions_of_one_month_and_code_share_a_key(frame):
    rows = [position(mes_referencia=m, cod_produto=c, estoque_atual=n) for m, c, n in
            [("2023-12", "VW-TCR", "3"), ("2023/12", " vw-tcr", "-1"), ("12/2023", "VW-TCR", None), ("2024-01", "VW-TCR", "3")]]
    got = clean(frame, "positions", rows)
    assert Counter(str(r["MES_REFERENCIA"]) for r in got) == {"2023-12-01": 3, "2024-01-01": 1}
    assert {r["PRODUTO"] for r in got} == {"T-Cross"} and {r["ESTOQUE_ATUAL"] for r in got} == {3, -1, None}


@pytest.mark.parametrize(
    "kind,column,value,word",
    [
        ("leads", "idade", "4x", "IDADE"),
        ("leads", "entrada_pct", "dez", "ENTRADA_PCT"),
        ("leads", "fez_test_drive", "?", "FEZ_TEST_DRIVE"),
        ("positions", "estoque_atual", "1.5.2", "ESTOQUE_ATUAL"),
        ("positions", "cod_produto", "VW-000", "VW-000"),
    ],
)
def test_refused_values_name_their_column(frame, kind, column, value, word):
    cleaner, columns, make, _ = KINDS[kind]
    with pytest.raises(ContractBroken, match=word):
        require_clean(cleaner(frame(columns, [make(), make(**{column: value})])), kind)


@pytest.mark.parametrize("kind,column", [("leads", "data_interesse"), ("sales", "data_entrega"), ("positions", "mes_referencia")])
def test_unreadable_dates_break_a_contract(frame, kind, column):
    cleaner, columns, make, contracts = KINDS[kind]
    out = cleaner(frame(columns, [make(), make(**{column: "32.13.9"})]))
    assert out.filter(F.col(column.upper()).isNull()).count() == 1
    broken = check_rows(out, contracts()).filter("NOT passou")
    assert {r["violacoes"] for r in broken.collect()} == {1}
    with pytest.raises(ContractBroken):
        fail_on_contracts(broken, kind)
