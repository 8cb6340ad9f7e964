"""Running totals over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.session import settle, shuffle_partitions


def partition_total(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Add each group's total to its rows.

    The total is aggregated first (partly before the shuffle) and joined back, so a group is never gathered in one
    task as a window would; a large join partition is split by AQE.
    """
    totals = df.groupBy(*by).agg(F.sum(value).alias(name))
    kept = totals.select(*[F.col(k).alias(f"_{k}") for k in by], name)
    same = F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(kept, same, "left").drop(*[f"_{k}" for k in by])


def running_total(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order: Sequence[Column],
    name: str,
    slices: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add the running sum of `value` within each group, in `order`, the row itself included; with `total` the group's sum too.

    `order` must be total within a group. The rows are cut by range over (group, order), so one group may span many
    slices and no task holds more than a slice, whatever the size of a group. Each slice is summed on its own and
    moved up by the slices of its group before it; the group's sum is that of its slices. One shuffle of the rows by
    (group, slice) serves the window and the join with the slices' sums, and no row is dealt by its group alone.

    Runs one action: the ranges are sampled, so the sliced rows are written to the shared folder before they are read
    twice.
    """
    count = slices or shuffle_partitions(df.sparkSession)
    sliced = settle(
        df.repartitionByRange(count, *[F.col(k) for k in by], *order).withColumn("_slice", F.spark_partition_id())
    )
    # A struct is never NULL and equals another with NULLs at the same places, so it can be a plain join key.
    sliced = sliced.withColumn("_group", F.struct(F.lit(0).alias("_"), *by))

    every = Window.partitionBy("_group")
    before = every.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("_group", "_slice").agg(F.sum(value).alias("_sum"))
    kind = sums.schema["_sum"].dataType
    moved = sums.select(
        "_group", "_slice", F.sum("_sum").over(before).alias("_before"), F.sum("_sum").over(every).cast(kind).alias("_total")
    )

    within = Window.partitionBy("_group", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.coalesce(F.col("_local") + F.col("_before"), "_local", "_before").cast(kind)
    joined = sliced.withColumn("_local", F.sum(value).over(within)).join(moved, ["_group", "_slice"])
    return joined.select(*df.columns, reached.alias(name), *([F.col("_total").alias(total)] if total else []))
