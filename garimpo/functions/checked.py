"""Values that may be refused.

An error raised inside a projection disappears when the column is pruned, so a strict function gives the value
together with the reason for refusing it. The reason travels as data and the contract step decides.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBLEM = "_problema"


class Checked(NamedTuple):
    value: Column
    problem: Column


def project(df: DataFrame, columns: Mapping[str, Column | Checked], *also: Column | None) -> DataFrame:
    """Select the named columns and gather every reason for refusal (NULL when there is none) in `_problema`."""
    values, problems = [], [reason for reason in also if reason is not None]
    for name, column in columns.items():
        if isinstance(column, Checked):
            values.append(column.value.alias(name))
            problems.append(column.problem)
        else:
            values.append(column.alias(name))
    reason = F.nullif(F.concat_ws("; ", *problems), F.lit("")) if problems else F.lit(None).cast("string")
    return df.select(*values, reason.alias(PROBLEM))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reason column, refused rows with it)"""
    return df.filter(F.col(PROBLEM).isNull()).drop(PROBLEM), df.filter(F.col(PROBLEM).isNotNull())
