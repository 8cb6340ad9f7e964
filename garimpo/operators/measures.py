"""Named measures that can be asked for in any grouping."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.operators.dimensions import distinct_values
from garimpo.operators.positions import with_position


class Measure(NamedTuple):
    name: str
    expression: Column


def catalogue(measures: Sequence[Measure]) -> dict[str, Column]:
    return {m.name: m.expression for m in measures}


def apply_filters(df: DataFrame, filters: Mapping[str, object] | None, exempt: Collection[str] = ()) -> DataFrame:
    """Keep rows equal to the chosen value, or to one of the chosen values, of each column.

    `exempt` names the filters that do not reach this dataset; any other filter must be on one of its columns.
    """
    unknown = sorted(set(filters or {}) - set(df.columns) - set(exempt))
    if unknown:
        raise ValueError(f"no such column to filter by: {', '.join(unknown)}")
    for name, wanted in (filters or {}).items():
        if name not in exempt:
            values = wanted if isinstance(wanted, (list, tuple, set)) else [wanted]
            df = df.filter(F.col(name).isin(*values))
    return df


def measure(
    df: DataFrame,
    by: Sequence[str],
    names: Sequence[str],
    measures: Mapping[str, Column],
    filters: Mapping[str, object] | None = None,
    order: Sequence[tuple[Column, bool]] = (),
    exempt: Collection[str] = (),
    position: str | None = None,
) -> DataFrame:
    """Measures per group; filters come first. `order` lists (aggregate or group column, descending)
    and may use aggregates of columns that are not in the result. With `position` the order is given out as a column of that
    name instead of as the order of the rows; groups that tie in it go by the group columns."""
    grouped = apply_filters(df, filters, exempt).groupBy(*by)
    sorts = [o.alias(f"_o{i}") for i, (o, _) in enumerate(order)]
    out = grouped.agg(*[measures[n].alias(n) for n in names], *sorts)
    if position:
        sorted_by = [(F.col(f"_o{i}"), down) for i, (_, down) in enumerate(order)]
        return with_position(out, [*sorted_by, *[(F.col(b), False) for b in by]], position).select(*by, *names, position)
    if order:
        out = out.orderBy(*[F.col(f"_o{i}").desc() if down else F.col(f"_o{i}").asc() for i, (_, down) in enumerate(order)])
    return out.select(*by, *names)


def series_long(
    df: DataFrame, by: Sequence[str], names: Sequence[str], measures: Mapping[str, Column], series: str, value: str
) -> DataFrame:
    """Measures per group as one row per measure: (group, series, value)."""
    wide = measure(df, by, names, measures)
    return wide.unpivot(list(by), list(names), series, value)


def choices(df: DataFrame, name: str) -> DataFrame:
    """The values a filter offers."""
    return distinct_values(df, [name]).orderBy(name)


def all_choices(df: DataFrame, names: Sequence[str], filter_name: str, value: str) -> DataFrame:
    """(filter, value as text): what each of several filters offers, from one pass over the rows."""
    met = df.select(*[F.col(n).cast("string").alias(n) for n in names]).distinct()
    return met.unpivot([], list(names), filter_name, value).distinct()
