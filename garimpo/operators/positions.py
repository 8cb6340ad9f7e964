"""Order as data: each row's place in the order of a whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.session import settle, shuffle_partitions


def with_position(
    df: DataFrame, order: Sequence[tuple[Column, bool]], name: str = "posicao", parts: int | None = None
) -> DataFrame:
    """Add each row's place, from 1 and gapless, in the order of the whole frame: (column, descending) as in `measure`.

    Rows are dealt by range of the order and written, as the ranges are sampled; each range is numbered on its own and moved up by
    the ranges before it, so no task holds more than a range and only the ranges' sizes are added up in one place. Rows that tie
    get places next to each other in no fixed order; they are dealt over several ranges, so that many of them don't meet in one.
    """
    count = parts or shuffle_partitions(df.sparkSession)
    keys = {f"_o{i}": column for i, (column, _) in enumerate(order)}
    held = df.withColumns(keys | {"_tie": F.monotonically_increasing_id()})
    by = [F.col(k).desc() if down else F.col(k).asc() for k, (_, down) in zip(keys, order, strict=True)]
    by.append(F.col("_tie"))
    dealt = settle(held.repartitionByRange(count, *by).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    moved = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*by)
    placed = dealt.withColumn("_local", F.row_number().over(within)).join(moved, "_range")
    return placed.select(*df.columns, (F.col("_local") + F.col("_before")).cast("bigint").alias(name))
