"""The dealership's layers over the driver tables, each table written when it is first asked for."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions import PROBLEM
from garimpo.operators.contracts import fail_on_contracts, require_clean
from garimpo.plans import gold, silver, spec
from garimpo.session import shared_dir
from garimpo.sources.tables import publish, publish_all, scan, together
from workload import raw

SILVER = ("crm", "erp", "estoque")
SALE_DIMS = (gold.HELD_IDS, "dim_produto", "dim_vendedor", "dim_pagamento", "dim_calendario")
LEAD_DIMS = ("dim_cliente", "dim_produto", "dim_pagamento", "dim_canal", "dim_calendario")
STOCK_DIMS = ("quarentena_estoque_mensal", "dim_produto", "dim_calendario")

# What each table is built from.
NEEDS = {
    "crm": ("bronze_crm",),
    "erp": ("bronze_erp",),
    "estoque": ("bronze_estoque",),
    gold.PROFILE: ("crm", "erp"),
    gold.HELD_IDS: (gold.PROFILE,),
    "quarentena_cliente_evidencia": ("crm", "erp", gold.HELD_IDS),
    "quarentena_cliente_identidade": ("quarentena_cliente_evidencia",),
    "quarentena_estoque_mensal": ("estoque",),
    "dim_cliente": (gold.PROFILE,),
    "dim_vendedor": ("erp",),
    "dim_pagamento": ("crm", "erp"),
    "dim_canal": ("crm",),
    "limites_calendario": SILVER,
    "dim_calendario": ("limites_calendario",),
    "fato_vendas": ("erp", *SALE_DIMS),
    "fato_oportunidade": ("crm", *LEAD_DIMS),
    "fato_estoque_mensal": ("estoque", *STOCK_DIMS),
    "mart_vendas_por_vendedor": ("fato_vendas",),
    "mart_produto_performance": ("fato_vendas", "fato_estoque_mensal"),
    "mart_financeiro": ("fato_vendas",),
    "mart_funil_comercial": ("fato_oportunidade",),
}


_RAW = raw.RAW
# Where this session's raw tables lie. They stand in for the files a dealership would be given, so they are rendered
# once per session and folder; everything after them is worked out anew by every query.
_landed: dict[tuple[str, str, str], str] = {}


def land(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}/{name}"
        publish(raw.derive(spark, sf_dir, *_RAW[name]), path)
        _landed[key] = path
    return scan(spark, _landed[key])


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw tables as headed, compressed CSV in a folder laid out like the landing area."""
    root = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    for s in spec.SOURCES:
        name = f"bronze_{s.table}"
        # What no query has landed yet goes straight to the files and is not kept a second time.
        landed = (spark.sparkContext.applicationId, sf_dir, name) in _landed
        rows = land(spark, sf_dir, name) if landed else raw.derive(spark, sf_dir, *_RAW[name])
        rows.write.options(header=True, compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(s.path(root))
    return root


class Lake(Mapping):
    """Tables by name, written to the shared folder as a load does, but only those that are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, *wanted: str):
        self.out = f"{shared_dir(spark)}/lake-{uuid.uuid4().hex}"
        self.tables: dict[str, DataFrame] = {}
        crm, erp, stock = (lambda: self["crm"]), (lambda: self["erp"]), (lambda: self["estoque"])
        self.rules: dict[str, Callable[[], DataFrame]] = {
            "crm": lambda: silver.clean_leads(self["bronze_crm"]),
            "erp": lambda: silver.clean_sales(self["bronze_erp"]),
            "estoque": lambda: silver.clean_positions(self["bronze_estoque"]),
            gold.PROFILE: lambda: gold.client_profile(crm(), erp()),
            gold.HELD_IDS: lambda: gold.client_split(self[gold.PROFILE]).held,
            "quarentena_cliente_evidencia": lambda: gold.client_evidence(crm(), erp(), self[gold.HELD_IDS]),
            "quarentena_cliente_identidade": lambda: gold.client_quarantine(self["quarentena_cliente_evidencia"]),
            "quarentena_estoque_mensal": lambda: gold.stock_quarantine(stock()),
            "dim_cliente": lambda: gold.client_dim(gold.client_split(self[gold.PROFILE]).accepted),
            "dim_produto": lambda: gold.product_dim(spark),
            "dim_vendedor": lambda: gold.seller_dim(erp()),
            "dim_pagamento": lambda: gold.payment_dim(crm(), erp()),
            "dim_canal": lambda: gold.channel_dim(crm()),
            "limites_calendario": lambda: gold.calendar_bounds(crm(), erp(), stock()),
            "dim_calendario": lambda: self.calendar(),
            "fato_vendas": lambda: gold.sales_fact(erp(), self),
            "fato_oportunidade": lambda: gold.lead_fact(crm(), self),
            "fato_estoque_mensal": lambda: gold.position_fact(stock(), self),
            "mart_vendas_por_vendedor": lambda: gold.seller_mart(self["fato_vendas"]),
            "mart_produto_performance": lambda: gold.product_mart(self["fato_vendas"], self["fato_estoque_mensal"]),
            "mart_financeiro": lambda: gold.finance_mart(self["fato_vendas"]),
            "mart_funil_comercial": lambda: gold.funnel_mart(self["fato_oportunidade"]),
        }
        self.spark, self.sf_dir = spark, sf_dir
        self.need(wanted)

    def cleaned(self, name: str) -> DataFrame:
        """The cleaned rows, none of which may have been refused: counted while they are written, once."""
        refused = F.count_if(F.col(PROBLEM).isNotNull())
        written = publish(self.rules[name](), f"{self.out}/{name}", {"recusadas": refused})
        return require_clean(written.table, name) if written.counts["recusadas"] else written.table.drop(PROBLEM)

    def calendar(self) -> DataFrame:
        bounds = self["limites_calendario"]
        fail_on_contracts(gold.span_contract(bounds), "dim_calendario: intervalo")
        return gold.calendar(bounds)

    def need(self, names) -> None:
        """Write the tables, what they are built from first, tables of one level a few at a time."""
        missing = [n for n in names if n not in self.tables]
        if missing:
            self.need({m for n in missing for m in NEEDS.get(n, ())})
            left = [n for n in missing if n not in self.tables and n not in _RAW]
            for n in _RAW.keys() & set(missing):
                self.tables[n] = land(self.spark, self.sf_dir, n)
            # A table of this list may be built from another of it, which is then written by now.
            clean = [n for n in left if n in SILVER]
            self.tables |= together({n: lambda n=n: self.cleaned(n) for n in clean})
            self.tables |= publish_all({n: self.rules[n] for n in left if n not in SILVER}, self.out)

    def __getitem__(self, name: str) -> DataFrame:
        self.need([name])
        return self.tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*_RAW, *self.rules])

    def __len__(self) -> int:
        return len(_RAW) + len(self.rules)

    def frame(self, name: str) -> DataFrame:
        """The table's plan over the written tables it needs, itself not written."""
        self.need(NEEDS.get(name, ()))
        return self.rules[name]()
