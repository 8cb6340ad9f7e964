"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import components, starts, usable, whole_keys
from garimpo.session import settle

#: Components of a block, leading coordinates of a block that make the grid of its range join, and the width of a cell in radii.
DIMS, GRID, WIDTH = 8, 2, 3.0
#: Vectors of a cell that one unit of work pairs; a larger cell is cut into parts and every two parts are a unit.
PART = 4096
#: Rounding that the budgets forgive; the exact test follows.
SLACK = 1e-6


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation, so that the blocks share a distance evenly whatever the data look like."""
    return np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))[0]


def blocks(dim: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), max(1, dim // DIMS))


def rotated(rows: np.ndarray) -> np.ndarray:
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)) @ rotation(rows.shape[1])


def reach(places: np.ndarray, width: float, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, cell, home): the cell each place lies in, and those later in order that its ball reaches into.

    Of two places within the radius, the one in the earlier cell so comes to the home of the other.
    """
    home = np.floor(places / width).astype(np.int64)
    low = np.floor((places - radius) / width).astype(np.int64)
    high = np.floor((places + radius) / width).astype(np.int64)
    yield np.arange(len(places)), home, np.ones(len(places), bool)
    steps = (high - low).max(axis=0) if len(places) else np.zeros(places.shape[1], np.int64)
    for step in np.ndindex(*(steps + 1)):
        cell = low + np.array(step)
        later = np.zeros(len(places), bool)
        for axis in range(places.shape[1] - 1, -1, -1):
            later = (cell[:, axis] > home[:, axis]) | ((cell[:, axis] == home[:, axis]) & later)
        rows = np.flatnonzero((cell <= high).all(axis=1) & later)
        yield rows, cell[rows], np.zeros(len(rows), bool)


_CELLS = "label string, dim int, block int, x long, y long, home boolean, node long, copies long, vector binary"


def cells(reps: DataFrame, least: float) -> DataFrame:
    """Each vector in the cells it reaches, for every block."""
    budget = 2 - 2 * least

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            vectors = part["e"].to_pylist()
            lengths = np.array([len(v) for v in vectors])
            for dim in np.unique(lengths):
                some = np.flatnonzero(lengths == dim)
                rows = np.array([vectors[i] for i in some], np.float64)
                raw = pa.array([r.tobytes() for r in rows.astype("<f4")], pa.binary())
                turned = rotated(rows)
                for n, block in enumerate(blocks(int(dim))):
                    radius = float(np.sqrt(budget * len(block) / dim)) * (1 + SLACK) + SLACK
                    places = turned[:, block[:GRID]]
                    for at, cell, home in reach(places, WIDTH * radius, radius):
                        if len(at):
                            rows_at = pa.array(some[at])
                            y = cell[:, 1] if cell.shape[1] > 1 else np.zeros(len(at), np.int64)
                            yield pa.RecordBatch.from_arrays(
                                [
                                    part["label"].take(rows_at),
                                    pa.array(np.full(len(at), dim, np.int32)),
                                    pa.array(np.full(len(at), n, np.int32)),
                                    pa.array(cell[:, 0]),
                                    pa.array(y),
                                    pa.array(home),
                                    part["node"].take(rows_at),
                                    part["copies"].take(rows_at),
                                    raw.take(pa.array(at)),
                                ],
                                names=["label", "dim", "block", "x", "y", "home", "node", "copies", "vector"],
                            )

    return reps.select("node", "label", "copies", "e").mapInArrow(run, _CELLS)


def _joined(top: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the pairs (a, b) are joined: the smallest row number of each group."""
    while True:
        x, y = top[a], top[b]
        differ = x != y
        if not differ.any():
            return top
        low = np.minimum(x, y)[differ]
        top = top.copy()
        np.minimum.at(top, x[differ], low)
        np.minimum.at(top, y[differ], low)
        while (top[top] != top).any():
            top = top[top]


def links(reps: DataFrame, least: float) -> DataFrame:
    """(a, b, n): with b null, n of the vectors that `a` links to; else a link, enough of them to connect what is connected.

    Two unit vectors whose squared distance is within the budget stay, in at least one block, within that block's share of it; so a range
    join per block misses no pair. A pair that passes the exact test is counted in the block where it lies closest, measured
    against the share, and in the home cell of its later member, so it counts once. Only counts and a spanning set of links
    leave a task, however many pairs a dense group has.
    """
    held = settle(cells(reps, least), "cells")
    keys = ["label", "dim", "block", "x", "y"]
    sizes = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > PART).select(*keys, F.ceil(F.col("_n") / PART).cast("int").alias("_parts"))
    sized = held.join(large, keys, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int")
    work = sized.withColumn("_mine", mine).withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)")))
    unit = F.xxhash64(*keys, F.least("_mine", "_other"), F.greatest("_mine", "_other"))
    second = F.col("_mine") > F.col("_other")
    dealt = work.select(unit.alias("unit"), "dim", "block", "home", second.alias("second"), (F.col("_mine") != F.col("_other")).alias("split"), "node", "copies", "vector")
    budget = 2 - 2 * least

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(parts, ["unit"], 8192):
            at = starts(table, ["unit"])
            count = np.zeros(table.num_rows, np.int64)
            edges: list[tuple[np.ndarray, np.ndarray]] = []
            nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
            home, second = table["home"].to_numpy(), table["second"].to_numpy()
            for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
                if b - a < 2 or not home[a:b].any():
                    continue
                dim, block = table["dim"][int(a)].as_py(), table["block"][int(a)].as_py()
                rows = np.frombuffer(b"".join(table["vector"].slice(a, b - a).to_pylist()), "<f4").reshape(-1, dim).astype(np.float64)
                parted = table["split"][int(a)].as_py()
                n, ed = pairs(rows, block, home[a:b], second[a:b] if parted else None, nodes[a:b], copies[a:b], least, budget)
                count[a:b] += n
                edges.append((nodes[a:b][ed[0]], nodes[a:b][ed[1]]))
            some = np.flatnonzero(count)
            left = np.concatenate([nodes[some], *(x for x, _ in edges)])
            right = pa.array(np.concatenate([np.zeros(len(some), np.int64), *(y for _, y in edges)]), mask=np.arange(len(left)) < len(some))
            number = np.concatenate([count[some], np.zeros(len(left) - len(some), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(left), right, pa.array(number)], names=["a", "b", "n"])

    return dealt.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long, n long")


def pairs(
    rows: np.ndarray, block: int, home: np.ndarray, second: np.ndarray | None, nodes: np.ndarray, copies: np.ndarray, least: float, budget: float
) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Links counted per row, and rows whose links connect the groups."""
    dim = rows.shape[1]
    parts = blocks(dim)
    turned, norm = rotated(rows), np.linalg.norm(rows, axis=1)
    shares = np.array([budget * len(p) / dim for p in parts])
    here = turned[:, parts[block]]
    square = (here * here).sum(1)
    count, top = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for at in range(0, len(rows), 512):
        i = np.arange(at, min(at + 512, len(rows)))
        near = square[i][:, None] + square[None, :] - 2 * here[i] @ here.T <= shares[block] * (1 + SLACK) + SLACK
        # One of the two is at home here; two at home are taken once, by their node.
        wanted = home[i][:, None] & (~home[None, :] | (nodes[i][:, None] < nodes[None, :]))
        if second is not None:
            wanted &= second[i][:, None] != second[None, :]
        x, y = np.nonzero(near & wanted)
        x = i[x]
        for c in range(0, len(x), 1 << 16):
            p, q = x[c : c + (1 << 16)], y[c : c + (1 << 16)]
            close = (rows[p] * rows[q]).sum(1) / (norm[p] * norm[q]) >= least
            p, q = p[close], q[close]
            square_of = (turned[p] - turned[q]) ** 2
            share = np.stack([square_of[:, part].sum(1) for part in parts], axis=1) / shares
            first = share.argmin(1) == block
            p, q = p[first], q[first]
            np.add.at(count, p, copies[q])
            np.add.at(count, q, copies[p])
            top = _joined(top, p, q)
    moved = np.flatnonzero(top != np.arange(len(rows)))
    return count, (moved, top[moved])


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): links are pairs of one label with a cosine of at least `least`, in double precision.

    Equal vectors of a label are one node with a number of copies, and link with each other. Every pair with that cosine is found.
    n_links counts the other rows linked directly; component_id is the smallest id reachable; kept says that this is the row's
    own.

    A null vector, a zero vector, one with a null or non-finite component and one without a label link with nothing and are
    kept. Vectors of different dimension don't link. Rows with equal ids are rows of their own. A row with a null id counts as a link; it is
    kept if no row it reaches has an id. An empty table gives an empty result. Other columns are ignored.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<float>").alias("e"),
    )
    linked = F.col("label").isNotNull() & usable(F.col("e"))
    reps = rows.where(linked).groupBy("label", "e").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    reps = settle(reps.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = settle(links(reps, least), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b is not null").select("a", "b"))
    placed = reps.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    lowest = placed.groupBy("group").agg(F.min("first").alias("lowest"))
    told = (
        placed.join(lowest, "group")
        .join(counts, "node", "left")
        .select(
            F.xxhash64("label", "e").alias("_h"),
            F.col("label").alias("_label"),
            F.col("e").alias("_e"),
            "lowest",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
        )
    )
    keyed = rows.withColumn("_k", F.when(linked, F.xxhash64("label", "e")))
    same = (F.col("_k") == F.col("_h")) & (F.col("label") == F.col("_label")) & (F.col("e") == F.col("_e"))
    group = F.coalesce("lowest", "vec_id")
    return keyed.join(told, same, "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        group.alias("component_id"),
        F.col("vec_id").eqNullSafe(group).alias("kept"),
    )


#: The same rows from DuckDB.
SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n from embeddings
  where embedding is not null and label is not null
), l as (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where a.n > 0 and b.n > 0 and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), r(x, y) as (
  select x, y from l union select r.x, l.y from r join l on r.y = l.x
)
select vec_id, (select count(*) from l where l.x = vec_id)::bigint as n_links,
       least(vec_id, coalesce((select min(y) from r where r.x = vec_id), vec_id)) as component_id,
       vec_id <= coalesce((select min(y) from r where r.x = vec_id), vec_id) as kept
from embeddings
"""
