"""Longest-processing-time sharding of groups that must stay together."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from garimpo.llm.common import numbered, slices_for
from garimpo.session import settle

# Significant bits of a size class: sizes below 1024 are exact, larger ones share a class within one part in 512.
CLASS_BITS = 10


def size_class(size: Column) -> Column:
    """A number that rises with the size and takes at most about 28,000 values over all 64-bit sizes."""
    shift = F.greatest(F.length(F.bin(size)) - CLASS_BITS, F.lit(0))
    return (shift * (1 << (CLASS_BITS - 1)) + F.call_function("shiftright", size, shift)).cast("int")


def schedule(classes: Sequence[Row], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """Longest first onto the least loaded shard, a class of like-sized groups at a time.

    Handing `n` groups of mean size `m` one by one to the least loaded shard raises the lowest loads to a common level;
    that level is computed, each shard gets the whole groups that fit under it, and the few left go one by one through
    a heap. Gives per class the ends of the runs of positions and the shard of each run.
    """
    loads = [0.0] * shards
    plan = []
    for row in sorted(classes, key=lambda r: -r["class"]):
        count, mean = row["n"], row["bytes"] / row["n"]
        by_load = np.sort(np.array(loads))
        levels = (np.cumsum(by_load) + count * mean) / np.arange(1, shards + 1)
        filled = int(np.flatnonzero(levels >= by_load)[-1])
        given = [max(0, int((levels[filled] - load) // mean)) for load in loads]
        while sum(given) > count:  # rounding of the level
            given[int(np.argmax(given))] -= 1
        heap = [(load + g * mean, s) for s, (load, g) in enumerate(zip(loads, given, strict=True))]
        heapq.heapify(heap)
        for _ in range(count - sum(given)):
            load, s = heap[0]
            given[s] += 1
            heapq.heapreplace(heap, (load + mean, s))
        loads = [load + g * mean for load, g in zip(loads, given, strict=True)]
        used = [s for s in range(shards) if given[s]]
        plan.append((row["class"], np.cumsum([given[s] for s in used]).tolist(), used))
    return plan


def lpt_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal whole groups of equal texts to `shards` shards whose sizes in bytes come out near equal.

    Returns (doc_id, size, text_crc32, shard, slot): size is the UTF-8 bytes of the text plus 8, slot the gapless position
    in the shard. The groups are summed by Spark and counted by size class; only the counts per class (at most about 28,000
    rows, whatever the input) reach the driver, where the classes are scheduled longest first through a heap. Groups
    take their shard by their position within their class.

    A null text has no bytes (size 8) and a null checksum; all null texts are one group, another than that of the
    empty text. Rows with equal or null ids are kept, each with a slot of its own. An empty table gives an empty result.
    Other columns are ignored, so their names cannot clash.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("binary")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("_key"),
    )
    rows = settle(rows, "digests")
    slices = slices_for(docs)
    groups = (
        rows.groupBy("_key")
        .agg(F.sum("size").alias("_bytes"))
        .select("_key", "_bytes", size_class(F.col("_bytes")).alias("class"))
        .withColumn("_slice", F.pmod(F.xxhash64("_key"), F.lit(slices)))
    )
    classes = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("bytes")).collect()
    plan = spark.createDataFrame(schedule(classes, shards), "class int, ends array<long>, shards array<int>")
    placed = (
        numbered(groups, ["class"], "_slice", [F.col("_key")], "_at")
        .join(F.broadcast(plan), "class")
        .select("_key", F.expr("shards[size(filter(ends, e -> e <= _at))]").alias("shard"))
    )
    dealt = settle(rows.join(placed, "_key").drop("_key"), "dealt")
    # Where a row lies in the written table is as even as a hash can be, however many rows are equal.
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    dealt = dealt.select("*", F.pmod(place, F.lit(slices)).alias("_slice"), place.alias("_place"))
    return numbered(dealt, ["shard"], "_slice", [F.col("_place")], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
