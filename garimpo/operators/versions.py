"""Exact-duplicate consolidation and version numbers that do not depend on input order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions import content_hash
from garimpo.session import settle

SOURCE_ROWS = "_linhas_origem"


def consolidate(df: DataFrame, business: Sequence[str], source_rows: str = SOURCE_ROWS) -> DataFrame:
    """One row per distinct business content, with the number of input rows behind it.

    NULLs are equal to each other. The count is partly done before the shuffle, so any number of copies of one row
    costs one row per map task.
    """
    return df.groupBy(*business).agg(F.count(F.lit(1)).alias(source_rows))


def load_summary(table: str, silver: DataFrame, source_rows: str = SOURCE_ROWS) -> DataFrame:
    rows, source = F.count(F.lit(1)), F.coalesce(F.sum(source_rows), F.lit(0))
    return silver.agg(
        F.lit(table).alias("tabela"),
        rows.alias("registros_silver"),
        source.alias("linhas_bronze"),
        (source - rows).alias("duplicatas_exatas_removidas"),
    )


#: Rows of a key that are numbered as one piece; a key of more is cut into as many pieces as hold about so many.
PIECE_ROWS = 100_000
SPREAD = 4096


def _hash_slice(digest: Column, slices: Column) -> Column:
    """Which of `slices` equal ranges of the hash space a digest falls in; keeps the order of the digests."""
    prefix = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.shiftright(prefix * slices, 32).cast("int")


def _keyless(key: Sequence[str]) -> Column:
    broken = F.lit(False)
    for name in key:
        broken = broken | F.col(name).isNull()
    return broken


def number_versions(
    df: DataFrame, key: Sequence[str], content: Sequence[str], version: str = "_versao", rows: DataFrame | None = None
) -> DataFrame:
    """Number the rows of each key 1, 2, .. in the order of the hash of their content.

    The numbers are the same whatever order the rows arrive in. A row with a NULL in its key gets a NULL number (its
    record key is NULL anyway).

    A key is cut into even ranges of the (uniform) hash in proportion to its counted rows, so a key of any size is spread and one
    of a few rows is a single range. Keys of more than `PIECE_ROWS` rows are written as a small table first (`rows`: a
    frame with the key columns to count them on, one with no fewer rows of a key; the frame itself if there is none). The rows are
    then dealt once, by key and range; that one exchange serves the numbering within a range and the join that moves the
    ranges of a large key up by the ranges before them, which alone are counted.
    """
    broken = _keyless(key)
    pieces = F.ceil(F.col("_all") / PIECE_ROWS).cast("bigint").alias("_pieces")
    counted = (df if rows is None else rows).where(~broken).groupBy(*key).agg(F.count(F.lit(1)).alias("_all"))
    large = settle(counted.where(F.col("_all") > PIECE_ROWS).select(*key, pieces), "large-keys")

    hashed = df.withColumn("_hash", content_hash(content)).join(large, list(key), "left")
    # Rows without a key are not numbered and may lie anywhere.
    pieces = F.when(broken, SPREAD).otherwise(F.coalesce("_pieces", F.lit(1)))
    slice_ = _hash_slice(F.col("_hash"), pieces.cast("bigint"))
    dealt = hashed.withColumn("_slice", slice_).repartition(*key, "_slice")

    # Equal hashes of different rows would be a SHA-256 collision; the content itself then decides, without shipping
    # the JSON through the shuffle.
    within = Window.partitionBy(*key, "_slice").orderBy("_hash", *content)
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.where(F.col("_pieces").isNotNull()).groupBy(*key, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    moved = counts.select(*key, "_slice", F.sum("_rows").over(before).alias("_before"))
    numbered = dealt.withColumn("_local", F.row_number().over(within)).join(moved, [*key, "_slice"], "left")
    number = F.when(~broken, F.col("_local") + F.coalesce("_before", F.lit(0))).cast("bigint")
    return numbered.withColumn(version, number).select(*df.columns, version)


def consolidate_versions(
    df: DataFrame, key: Sequence[str], business: Sequence[str], source_rows: str = SOURCE_ROWS, version: str = "_versao"
) -> DataFrame:
    """What `consolidate` and then `number_versions` give, where the `key` columns of `df` follow from its `business` columns.

    Copies of a row share its key, so one exchange by key and one sort by key and content serve both the folding and the
    numbering: among rows in the order of their content the peers of a row are its copies and its dense rank is its version.
    Rows of a key of more than `PIECE_ROWS` rows, copies included, and rows without a key would be hot there; only they are
    folded before the exchange and dealt by ranges of the hash. Such keys are counted first and written as a small table.
    """
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_all"))
    apart = settle(counted.where(_keyless(key) | (F.col("_all") > PIECE_ROWS)).select(*key), "keys-apart")
    columns = [*business, *key]
    if apart.isEmpty():
        return _fold_dealt(df.select(*columns), key, business, source_rows, version)

    large = apart.where(~_keyless(key))
    some = df.select(*columns)
    ordinary = some.where(~_keyless(key)).join(large, list(key), "left_anti").select(*columns)
    hot = some.where(_keyless(key)).unionByName(some.join(large, list(key), "left_semi").select(*columns))
    folded = consolidate(hot, columns, source_rows)
    return _fold_dealt(ordinary, key, business, source_rows, version).unionByName(
        number_versions(folded, key, business, version, hot.select(*key))
    )


def _fold_dealt(df: DataFrame, key: Sequence[str], business: Sequence[str], source_rows: str, version: str) -> DataFrame:
    hashed = df.repartition(*key).withColumn("_hash", content_hash(business))
    order = Window.partitionBy(*key).orderBy("_hash", *business)
    copies = order.rangeBetween(Window.currentRow, Window.currentRow)
    ranked = hashed.select(
        *df.columns,
        F.count(F.lit(1)).over(copies).alias(source_rows),
        F.dense_rank().over(order).cast("bigint").alias(version),
        (F.rank().over(order) == F.row_number().over(order)).alias("_first"),
    )
    return ranked.where("_first").drop("_first")
