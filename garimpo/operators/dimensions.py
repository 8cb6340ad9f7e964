"""Conformed, mapped, value, shared and calendar dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions import date_key, surrogate


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column a frame lacks is a typed NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def conformed_dim(accepted: DataFrame, id: str, key: str, entity: str) -> DataFrame:
    """The conflict-free ids of `attribute_conflicts` with their surrogate key."""
    return accepted.select(surrogate(entity, id).alias(key), "*")


def mapped_dim(spark: SparkSession, pairs: Sequence[tuple[str, str]], key: str, names: tuple[str, str], entity: str) -> DataFrame:
    """A dimension that is a fixed list of (code, name)."""
    code, name = names
    rows = spark.createDataFrame(list(pairs), f"`{code}` string, `{name}` string")
    return rows.select(surrogate(entity, code).alias(key), code, name)


def unmapped(values: DataFrame, dim: DataFrame, code: str, name: str) -> DataFrame:
    """Distinct values with no entry of that name in the mapping, or of that code where they carry one.

    The values are made distinct before the join, so its size does not grow with the sources.
    """
    known = dim.select(F.col(code).alias("_code"), F.col(name).alias("_name"))
    fits = (F.col(name) == F.col("_name")) & (F.col(code).isNull() | (F.col(code) == F.col("_code")))
    return values.distinct().join(known, fits, "left_anti")


def value_dim(df: DataFrame, natural: str, key: str, entity: str, name: str | None = None) -> DataFrame:
    """One row per distinct non-NULL value (all NULLs would share one key)."""
    name = name or natural
    values = df.select(F.col(natural).alias(name)).filter(F.col(name).isNotNull()).distinct()
    return values.select(surrogate(entity, name).alias(key), name)


def shared_dim(frames: Sequence[DataFrame], natural: str, key: str, entity: str) -> DataFrame:
    """One row per value found in any of the sources."""
    return value_dim(union_all(*[f.select(natural) for f in frames]), natural, key, entity)


def date_bounds(columns: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(first, last) over all the date columns; one pass per frame, NULLs ignored."""
    per_frame = [
        df.agg(
            F.array_min(F.array(*[F.min(c).cast("date") for c in names])).alias("first"),
            F.array_max(F.array(*[F.max(c).cast("date") for c in names])).alias("last"),
        )
        for df, names in columns
    ]
    return union_all(*per_frame).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def check_span(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """One row: the bounds are there and lie between two dates, so that a calendar over them has a known size."""
    within = (F.col("first") >= F.lit(first).cast("date")) & (F.col("last") <= F.lit(last).cast("date"))
    return bounds.select(
        F.lit(name).alias("contrato"),
        F.col("first").cast("string").alias("primeira"),
        F.col("last").cast("string").alias("ultima"),
        F.coalesce(within, F.lit(False)).alias("passou"),
    )


def calendar_dim(bounds: DataFrame, months: Sequence[str], weekdays: Sequence[str]) -> DataFrame:
    """One row per day between the bounds, with month and weekday names (the week starts on Sunday).

    `check_span` on the bounds comes first: without it one outlying date gives millions of days.
    """
    day = F.col("DATA")
    days = bounds.filter("first IS NOT NULL").select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("DATA")
    )
    return days.select(
        date_key(day).alias("SK_DATA"),
        day,
        F.year(day).alias("ANO"),
        F.month(day).alias("MES"),
        F.array(*[F.lit(m) for m in months])[F.month(day) - 1].alias("NOME_MES"),
        F.quarter(day).alias("TRIMESTRE"),
        F.array(*[F.lit(w) for w in weekdays])[F.dayofweek(day) - 1].alias("DIA_SEMANA"),
    )
