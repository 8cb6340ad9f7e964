"""Lookups of dimension keys. They never drop or multiply a fact row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.functions import surrogate


def lookup(fact: DataFrame, dim: DataFrame, on: str, natural: str, take: Mapping[str, str]) -> DataFrame:
    """Left join that adds `take` (dimension column -> new name) where `fact.on` equals the dimension's natural key.

    No join hint: the side is broadcast when its measured size is below the session's threshold, and a large
    dimension is joined by shuffle, where AQE splits the partition of a hot key (the NULL key too).
    """
    side = dim.select(F.col(natural).alias("_natural"), *[F.col(c).alias(n) for c, n in take.items()])
    return fact.join(side, F.col(on) == F.col("_natural"), "left").drop("_natural")


def lookup_unless_held(fact: DataFrame, held: DataFrame, on: str, id: str, key: str, entity: str) -> DataFrame:
    """The key of a conformed dimension for a fact that is one of its sources.

    Every id of a source is either in the dimension, under a key that follows from the id, or held back. So it is
    enough to join the few held ids instead of the dimension, which grows with the data.
    """
    marks = held.select(F.col(id).alias("_held"))
    known = F.when(F.col("_held").isNull() & F.col(on).isNotNull(), surrogate(entity, on))
    return fact.join(marks, F.col(on) == F.col("_held"), "left").withColumn(key, known).drop("_held")
