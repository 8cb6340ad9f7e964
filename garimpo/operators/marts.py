"""Monthly marts. Every side is aggregated before it is joined."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions import count_where, distinct_count, month_of_key, money_sum
from garimpo.functions.aggregates import MONEY
from garimpo.operators.running import running_total

# Upper bounds of the classes, and the labels.
ABC_CUTS = (("A", "0.80"), ("B", "0.95"))
ABC_REST = "C"
NO_SALE = "Sem Venda"


def monthly_rollup(
    fact: DataFrame, date: str, month: str, by: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Measures per month and group.

    The month key follows from the date key, so there is no join; a row without a date key belongs to no month.
    """
    dated = fact.filter(F.col(date).isNotNull())
    return dated.groupBy(*by, month_of_key(date).alias(month)).agg(*[c.alias(n) for n, c in measures.items()])


def outer_position_join(
    flow: DataFrame, position: DataFrame, keys: Sequence[str], zero_fill: Sequence[str]
) -> DataFrame:
    """Full outer join of two frames already at one row per key; flows absent on one side are 0, positions NULL."""
    joined = flow.join(position, list(keys), "full")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(flow.schema[c].dataType)) for c in zero_fill}
    )


def abc_class(revenue: Column, accumulated: Column, total: Column, records: Column) -> Column:
    """Class of a row by the share its month has reached with it; the row itself counts."""
    share = accumulated / F.nullif(total, F.lit(0))
    label = F.when(records == 0, NO_SALE).when(total == 0, ABC_REST)
    for name, cut in ABC_CUTS:
        label = label.when(share <= F.lit(cut).cast("decimal(3,2)"), name)
    return label.otherwise(ABC_REST)


def abc_curve(
    rows: DataFrame,
    month: str,
    product: str,
    revenue: str,
    margin: str,
    records: str,
    slices: int | None = None,
    margin_pct: str = "MARGEM_PCT",
    label: str = "CURVA_ABC",
) -> DataFrame:
    """Margin percentage and monthly ABC class of product-month rows (runs the action of `running_total`)."""
    total, accumulated = f"_{revenue}_mes", f"_{revenue}_acumulado"
    order = [F.col(revenue).desc(), F.col(product).asc()]
    ranked = running_total(rows, revenue, [month], order, accumulated, slices, total)
    percent = F.col(margin) / F.nullif(F.col(revenue), F.lit(0)) * 100
    return ranked.select(
        *rows.columns,
        percent.cast("decimal(9,4)").alias(margin_pct),
        abc_class(F.col(revenue), F.col(accumulated), F.col(total), F.col(records)).alias(label),
    )


def money_measures(columns: Mapping[str, str]) -> dict[str, Column]:
    return {name: money_sum(c) for name, c in columns.items()}


def funnel(
    fact: DataFrame, date: str, month: str, by: Sequence[str], client: str, flag: str, names: tuple[str, str, str]
) -> DataFrame:
    """Records, distinct clients and flagged records per month, group and stage. A photo, not a conversion rate."""
    records, clients, flagged = names
    measures = {
        records: F.count(F.lit(1)),
        clients: distinct_count(client),
        flagged: count_where(F.col(flag)),
    }
    return monthly_rollup(fact, date, month, by, measures)


__all__ = [
    "MONEY",
    "abc_class",
    "abc_curve",
    "funnel",
    "money_measures",
    "monthly_rollup",
    "outer_position_join",
]
