"""Aggregates with a fixed result type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.text import column

MONEY = "decimal(18,2)"


def money_sum(c: Column | str) -> Column:
    return F.sum(column(c)).cast(MONEY)


def money_avg(c: Column | str) -> Column:
    """Sum over the number of rows (rows without a value count too)."""
    return (F.sum(column(c)) / F.count(F.lit(1))).cast(MONEY)


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """sum(a) / sum(b), NULL when the divisor is zero."""
    return F.sum(column(a)) / F.nullif(F.sum(column(b)), F.lit(0))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; NULL is not."""
    return F.count_if(condition)


def distinct_count(c: Column | str) -> Column:
    return F.countDistinct(column(c))


def distinct_tuples(*columns: Column | str) -> Column:
    """Distinct tuples, those holding NULL included (a plain distinct count over columns skips them)."""
    return F.countDistinct(F.struct(*[column(c) for c in columns]))


def sole_value(c: Column | str) -> Column:
    """The one non-NULL value of a group known to hold at most one."""
    return F.max(column(c))


def sorted_set(c: Column | str) -> Column:
    """Distinct non-NULL values in order. Only for groups of bounded size: all of it lands in one row."""
    return F.sort_array(F.collect_set(column(c)))


def min_rank(c: Column | str) -> Column:
    return F.min(column(c))
