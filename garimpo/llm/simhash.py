"""SimHash fingerprints linked through BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from garimpo.llm.common import LOWER, components, lean, map_batches
from garimpo.session import settle

#: The 64 bits fall into six blocks. Four differing bits touch at most four of them, so any two fingerprints within the radius
#: agree on at least two whole blocks: sharding by every pair of blocks loses no link.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
RADIUS = 4
#: Fingerprints in one tree; a larger shard is cut into several trees and every one of them is asked.
TREE = 2048
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 16


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """64 bits, each set if it is set in over half of the hashes of the shingles of `width` words, repeats included."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, seed)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[: len(words) - width]]
    hashes = np.array([xxh64_intdigest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :], strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(ids: list, texts: list) -> Iterator[dict]:
        prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        yield {"doc_id": ids, "fp": prints.tolist()}

    kept = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_batches(kept, run, f"doc_id {kept.dtypes[0][1]}, fp long")


class Tree:
    """A BK-tree: the children of a node are keyed by their Hamming distance from it."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if not distance:
                return
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = (value, {})
                return
            node = child

    def near(self, value: int, radius: int) -> list[int]:
        """The values within `radius`. By the triangle inequality only edges of a length within `radius` of the distance
        to their upper end can lead to one."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            at, children = open_nodes.pop()
            distance = (at ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            if children:
                low, high = distance - radius, distance + radius
                open_nodes += [child for edge, child in children.items() if low <= edge <= high]
        return found


def shard_links(tree_side: list[int], asking: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what a shard's tree connects: at most one for each fingerprint, however many lie close together.

    `tree_side` is in the tree; `asking` is asked against it, or `tree_side` itself if it is empty.
    """
    top = {v: v for v in (*tree_side, *asking)}

    def root(v: int) -> int:
        while top[v] != v:
            top[v] = top[top[v]]
            v = top[v]
        return v

    tree, links = Tree(), []
    if asking:
        for v in tree_side:
            tree.add(v)
    for v in asking or tree_side:
        for other in tree.near(v, radius):
            a, b = root(v), root(other)
            if a != b:
                top[max(a, b)] = min(a, b)
                links.append((v, other))
        if not asking:
            tree.add(v)
    return links


def _blocks(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, at).bitwiseAND((1 << width) - 1) for at, width in BLOCKS]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links among distinct fingerprints (column fp) whose connected groups are those of all pairs within `radius`.

    A shard is the fingerprints that agree on two blocks; each one is in 15 shards. A shard's tree meets its queries in one
    task through the shuffle by shard, as the trees grow with the corpus and so are not for a broadcast. A shard of more than
    `TREE` fingerprints is cut into parts, and every pair of parts is a task's work of its own, so a hot shard is spread.
    """
    if radius > RADIUS:
        raise ValueError(f"the blocks find all links up to {RADIUS} bits")
    blocks = _blocks(F.col("fp"))
    keys = [
        (F.lit(n << 22) + blocks[i] * 2048 + blocks[j]).cast("int") for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("shard"))
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_n") / TREE).cast("int")
    mine = F.pmod(F.xxhash64("fp", "shard"), F.col("_parts")).cast("int")
    sized = rows.join(sizes.select("shard", parts.alias("_parts")), "shard").withColumn("_mine", mine)
    work = sized.withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)"))).select(
        "shard",
        F.least("_mine", "_other").alias("low"),
        F.greatest("_mine", "_other").alias("high"),
        (F.col("_mine") > F.col("_other")).alias("asks"),
        "fp",
    )
    dealt = work.repartition("shard", "low", "high").sortWithinPartitions("shard", "low", "high")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        found: list[tuple[int, int]] = []
        for _, group in groupby(rows(), key=lambda r: r[:3]):
            members = list(group)
            if len(members) > 1:
                low, high = members[0][1], members[0][2]
                tree_side = [r[4] & (1 << 64) - 1 for r in members if not r[3]]
                asking = [r[4] & (1 << 64) - 1 for r in members if r[3]]
                if low == high or asking:
                    found += shard_links(tree_side, asking, radius)
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    return dealt.mapInArrow(lean(run), "a long, b long")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    sides = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(sides[:, 0]), pa.array(sides[:, 1])], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): fingerprint in 16 hex digits, component_id the smallest doc_id linked to it.

    Documents of one fingerprint are one node, so copies cost one row; the nodes' links come from BK-trees. A null, empty or
    wordless text has fingerprint zero, which links like any other. Equal rows are all kept. Rows with a null id are
    kept too; a group of nothing but such rows has a null component_id. An empty table gives an empty result.
    Other columns are ignored.
    """
    prints = settle(fingerprints(docs, id_col, text_col), "prints")
    nodes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    groups = components(links(nodes.select("fp")))
    placed = nodes.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group")
    )
    lowest = placed.groupBy("group").agg(F.min("first").alias("component_id"))
    by_print = placed.join(lowest, "group").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(by_print, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
