"""Whole groups are held back instead of picking a winner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.functions import sole_value
from garimpo.operators.running import running_total

CONFLICT = "_conflito"
PART, PART_VALUES = "PARTE", 1000


class Split(NamedTuple):
    accepted: DataFrame
    held: DataFrame


def identity_profile(df: DataFrame, id: str, attributes: Sequence[str]) -> DataFrame:
    """Per id the sole value of each attribute and whether any attribute has two or more.

    An attribute has at most one distinct non-NULL value exactly when its minimum equals its maximum, so one
    aggregate of constant size per id answers it, partly done before the shuffle; no set of values is gathered.
    """
    many = F.lit(False)
    for a in attributes:
        many = many | F.coalesce(F.min(a) < F.max(a), F.lit(False))
    return df.groupBy(id).agg(*[sole_value(a).alias(a) for a in attributes], many.alias(CONFLICT))


def attribute_conflicts(df: DataFrame, id: str, attributes: Sequence[str]) -> Split:
    """Ids whose attributes agree, with their sole values, and ids held back because one does not.

    Where both sides are used, write the profile first and split that, so the sources are read once.
    """
    return split_profile(identity_profile(df, id, attributes), id)


def split_profile(profile: DataFrame, id: str) -> Split:
    accepted = profile.filter(~F.col(CONFLICT) & F.col(id).isNotNull()).drop(CONFLICT)
    return Split(accepted, profile.filter(CONFLICT).select(id))


def evidence(df: DataFrame, held: DataFrame, id: str, attributes: Sequence[str]) -> DataFrame:
    """(id, attribute, value): every distinct non-NULL value of the held ids, one per row, whatever their number."""
    marked = held.select(F.col(id).alias("_id"))
    rows = df.join(marked, F.col(id).eqNullSafe(F.col("_id")), "left_semi")
    texts = rows.select(F.col(id), *[F.col(a).cast("string").alias(a) for a in attributes])
    long = texts.unpivot([id], list(attributes), "atributo", "valor")
    return long.filter(F.col("valor").isNotNull()).distinct()


def evidence_arrays(
    values: DataFrame, id: str, names: Mapping[str, str], part_values: int = PART_VALUES, part: str = PART
) -> DataFrame:
    """(id, part, one sorted array per attribute) from the rows of `evidence`, every value kept.

    `names` maps attribute to array column. Part n holds the values n * part_values and on of each attribute in their order, so an ordinary id
    is one row (part 1) and no row grows with the data. Positions are numbered by range slices, for ids with any number of values.
    """
    one = values.withColumn("_one", F.lit(1))
    numbered = running_total(one, "_one", [id, "atributo"], [F.col("valor")], "_at")
    of = (F.floor((F.col("_at") - 1) / part_values) + 1).cast("int").alias(part)
    arrays = [F.sort_array(F.collect_list(F.when(F.col("atributo") == a, F.col("valor")))).alias(n) for a, n in names.items()]
    return numbered.groupBy(id, of).agg(*arrays)


def grain_conflicts(df: DataFrame, grain: Sequence[str]) -> Split:
    """Rows alone on their grain, and all rows of every grain that occurs more than once.

    The grains are counted first (partly before the shuffle) and joined back: a join partition with a hot grain can
    be split, a window over the grain could not. A NULL never equals another, so a row with a NULL in its grain is
    accepted here and left to the grain's NOT NULL contract.
    """
    repeated = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*grain)
    return Split(df.join(repeated, list(grain), "left_anti"), df.join(repeated, list(grain), "left_semi"))


def exclude(df: DataFrame, held: DataFrame, id: str) -> DataFrame:
    """Rows whose id is not among the held ones."""
    return df.join(held.select(id), id, "left_anti")


def held_summary(ids: DataFrame, rows: DataFrame, grain: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """How many ids and how many grains are held back."""
    counted = ids.agg(F.count(F.lit(1)).alias("_n")).select(F.lit(0).alias("_i"), "_n")
    grains = rows.agg(F.countDistinct(F.struct(*grain)).alias("_n")).select(F.lit(1).alias("_i"), "_n")
    both = counted.unionByName(grains)
    return both.agg(*[F.max(F.when(F.col("_i") == i, F.col("_n"))).alias(n) for i, n in enumerate(names)])
