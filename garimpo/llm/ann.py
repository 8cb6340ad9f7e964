"""Nearest neighbours by inner product: NN-descent builds a graph, queries search it greedily."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import lowest, packed, starts, usable, whole_keys
from garimpo.session import settle

#: Neighbours of a node in the graph, rounds of NN-descent, nodes that a query keeps open for its search.
NEIGHBOURS, ROUNDS, BEAM = 32, 2, 112
#: Random trees that give NN-descent its first graph, vectors in a leaf, and vectors in a cell that one task gathers.
TREES, LEAF, CELL = 6, 6000, 50_000
#: Vectors the trees' planes are drawn from: the bound of what the driver holds.
SAMPLE = 8192
#: Nodes of a cell that a query may start from.
ENTRIES = 4
#: The longest vector of a band is at most so many times as long as its shortest.
BAND = 4.0


class Tree(NamedTuple):
    planes: list[np.ndarray]
    cuts: list[float]
    children: list[tuple[int, int]]  # negative: cell -1-x


def grow(sample: np.ndarray, cells: int, rng: np.random.Generator) -> Tree:
    """A tree that cuts the sample into about `cells` even cells by planes between two random members each."""
    tree, made = Tree([], [], []), [0]

    def cut(rows: np.ndarray, parts: int) -> int:
        if parts <= 1 or len(rows) < 4:
            made[0] += 1
            return -made[0]
        plane, value, below = halve(sample[rows], rng)
        at = len(tree.planes)
        tree.planes.append(plane)
        tree.cuts.append(value)
        tree.children.append((0, 0))
        tree.children[at] = (cut(rows[below], parts // 2), cut(rows[~below], parts - parts // 2))
        return at

    cut(np.arange(len(sample)), cells)
    return tree


def halve(rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float, np.ndarray]:
    """A plane, and which rows lie below its median cut; rows that cannot be told apart are dealt at random."""
    a, b = rng.choice(len(rows), 2, replace=False)
    plane = rows[a] - rows[b]
    along = rows @ plane
    value = float(np.median(along))
    below = along < value
    if not below.any() or below.all():
        below = rng.permutation(len(rows)) < len(rows) // 2
    return plane, value, below


def cell_of(tree: Tree, rows: np.ndarray) -> np.ndarray:
    at = np.zeros(len(rows), np.int64) if tree.planes else np.full(len(rows), -1)
    while (at >= 0).any():
        for node in np.unique(at[at >= 0]):
            here = np.flatnonzero(at == node)
            below = rows[here] @ tree.planes[node] < tree.cuts[node]
            at[here] = np.where(below, *tree.children[node])
    return -1 - at


def leaves(rows: np.ndarray, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Row numbers in even leaves of at most `size`."""
    todo = [np.arange(len(rows))]
    while todo:
        some = todo.pop()
        if len(some) <= size:
            yield some
        else:
            below = halve(rows[some], rng)[2]
            todo += [some[below], some[~below]]


def nearest_in_leaf(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the places and scores of its `k` nearest others, in blocks of rows."""
    k = min(k, len(rows) - 1)
    places, scores = [], []
    for at in range(0, len(rows), 512):
        near = rows[at : at + 512] @ rows.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        places.append(best)
        scores.append(np.take_along_axis(near, best, axis=1))
    return np.concatenate(places), np.concatenate(scores)


def to_code(rows: np.ndarray) -> list[bytes]:
    """The added last component and a scale as floats, one signed byte for each other component: enough to steer the search.

    The scale is that of the vector's own components, which the added one may exceed by far. The results are scored anew.
    """
    own, added = rows[:, :-1], np.ascontiguousarray(rows[:, -1:], "<f4")
    scale = np.abs(own).max(axis=1, keepdims=True) / 127 + 1e-30
    coded = np.concatenate([added.view(np.int8), scale.astype("<f4").view(np.int8), np.rint(own / scale).astype(np.int8)], axis=1)
    return [x.tobytes() for x in coded]


def from_code(codes: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    added, scale = np.ascontiguousarray(rows[:, :8]).view("<f4").T
    return np.concatenate([rows[:, 8:].astype(np.float32) * scale[:, None], added[:, None]], axis=1)


def best_lists(owner: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per owner its `k` best others, each once, best first."""
    order = np.lexsort((other, -score, owner))
    owner, other, score = owner[order], other[order], score[order]
    bounds = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        ids, first = np.unique(other[a:b], return_index=True)
        keep = np.sort(first)[:k]
        yield int(owner[a]), other[a:b][keep], score[a:b][keep]


def _batch(schema: list[tuple[str, pa.DataType]], columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


_LIST = [("node", pa.int64()), ("ids", pa.binary()), ("scores", pa.binary())]
_LIST_SCHEMA = "node long, ids binary, scores binary"


def _lists(rows: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for node, ids, scores in rows:
        out.append((node, ids.astype("<i8").tobytes(), scores.astype("<f4").tobytes()))
        if len(out) == 20_000:
            yield _batch(_LIST, list(zip(*out, strict=True)))
            out = []
    if out:
        yield _batch(_LIST, list(zip(*out, strict=True)))


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, n = packed(table["ids"].to_pylist(), "<i8")
    scores, _ = packed(table["scores"].to_pylist(), "<f4")
    return np.repeat(table["node"].to_numpy(), n), ids, scores


def _merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of one node become one list."""
    for table in whole_keys(parts, ["node"]):
        yield from _lists(best_lists(*_unpack(table), NEIGHBOURS))


class Forest(NamedTuple):
    trees: list[Tree]
    first: int  # cells of the bands before

    def cells(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The cells of the rows, tree by tree."""
        for t, tree in enumerate(self.trees):
            yield (self.first + cell_of(tree, rows)) * TREES + t


def forest(vectors: DataFrame, dim: int, counts: list[int]) -> tuple[DataFrame, DataFrame, list[Forest]]:
    """The first graph: in every leaf of a few random trees of its band each vector meets all others.

    The upper part of a tree is drawn from a bounded sample and deals the vectors to cells; a cell is cut on into leaves where it is
    gathered, always at the median, so leaves stay even however the vectors crowd. A band of one cell needs no sample.
    """
    rng = np.random.default_rng(11)
    forests, made = [], 0
    for band, count in enumerate(counts):
        cells = max(1, min(SAMPLE // 8, -(-count // CELL)))
        sample = lowest(vectors.where(F.col("band") == band), F.xxhash64("node"), SAMPLE).select("vector").collect() if cells > 1 else []
        rows = np.frombuffer(b"".join(r["vector"] for r in sample), "<f4").reshape(len(sample), dim)
        forests.append(Forest([grow(rows, cells, rng) for _ in range(TREES)], made))
        made += cells

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            bands = part["band"].to_numpy()
            for band in np.unique(bands):
                some = part.filter(pa.array(bands == band))
                here = np.frombuffer(b"".join(some["vector"].to_pylist()), "<f4").reshape(-1, dim)
                for cell in forests[band].cells(here):
                    yield pa.RecordBatch.from_arrays([pa.array(cell), some["node"], some["vector"]], names=["cell", "node", "vector"])

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(parts, ["cell"], 1):
            at = starts(table, ["cell"])
            for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
                nodes = table["node"].slice(a, b - a).to_numpy()
                here = np.frombuffer(b"".join(table["vector"].slice(a, b - a).to_pylist()), "<f4").reshape(-1, dim)
                for leaf in leaves(here, LEAF, np.random.default_rng(int(table["cell"][int(a)].as_py()))):
                    if len(leaf) > 1:
                        places, scores = nearest_in_leaf(here[leaf], NEIGHBOURS)
                        yield from _lists(zip(nodes[leaf].tolist(), nodes[leaf][places], scores, strict=True))

    dealt = settle(vectors.mapInArrow(deal, "cell long, node long, vector binary"), "cells")
    met = dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(meet, _LIST_SCHEMA)
    graph = settle(met.repartition("node").sortWithinPartitions("node").mapInArrow(_merge, _LIST_SCHEMA), "graph")
    first = Window.partitionBy("cell").orderBy(F.xxhash64("node", "cell"))
    entries = dealt.select("cell", "node", F.row_number().over(first).alias("n")).where(F.col("n") <= ENTRIES)
    return settle(entries.select("cell", "node"), "entries"), graph, forests


def descend(graph: DataFrame, coded: DataFrame) -> DataFrame:
    """One round of NN-descent: neighbours of neighbours, over edges taken both ways.

    Every node sends its code along its edges in both directions, so at a node those that point at it meet those it points at; a
    pair goes on only if it beats the worst neighbour that either side has. Work at a node grows with its in-degree
    times `NEIGHBOURS`, so a hub is no quadratic group and nobody is left out.
    """
    edges = graph.select("node", "ids", "scores")

    def both_ways(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                node, ids, _ = _unpack(pa.Table.from_batches([part]))
                ahead, back = np.ones(len(node), bool), np.zeros(len(node), bool)
                columns = [np.concatenate(x) for x in ((node, ids), (ids, node), (ahead, back))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["center", "member", "ahead"])

    def worst(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scores, n = packed(part["scores"].to_pylist(), "<f4")
            ends = np.cumsum(n)
            low = np.where(n == NEIGHBOURS, scores[ends - 1], -np.inf) if len(n) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([part["node"], pa.array(low, pa.float32())], names=["node", "low"])

    known = coded.join(graph.mapInArrow(worst, "node long, low float"), "node")
    members = edges.mapInArrow(both_ways, "center long, member long, ahead boolean")
    sent = members.join(known, F.col("member") == F.col("node")).select("center", "member", "ahead", "low", "code")

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(parts, ["center"]):
            member, low = table["member"].to_numpy(), table["low"].to_numpy()
            ahead = table["ahead"].to_numpy()
            rows = from_code(table["code"].to_pylist())
            found: list[tuple[np.ndarray, ...]] = []
            at = starts(table, ["center"])
            for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
                to = a + np.flatnonzero(ahead[a:b])
                of = a + np.flatnonzero(~ahead[a:b])
                if not len(to) or not len(of):
                    continue
                for c in range(0, len(of), 4096):
                    some = of[c : c + 4096]
                    near = rows[some] @ rows[to].T
                    for wanted, flip in ((near > low[some][:, None], False), (near > low[to][None, :], True)):
                        i, j = np.nonzero(wanted & (member[some][:, None] != member[to][None, :]))
                        pair = (member[some[i]], member[to[j]])
                        found.append((*(pair[::-1] if flip else pair), near[i, j]))
            if found:
                yield from _lists(best_lists(*(np.concatenate(x) for x in zip(*found, strict=True)), NEIGHBOURS))

    offers = sent.repartition("center").sortWithinPartitions("center").mapInArrow(meet, _LIST_SCHEMA)
    both = graph.unionByName(offers).repartition("node").sortWithinPartitions("node")
    return settle(both.mapInArrow(_merge, _LIST_SCHEMA), "graph")


_STATE = [("q", pa.int64()), ("code", pa.binary()), ("ids", pa.binary()), ("scores", pa.binary()), ("done", pa.binary()), ("seen", pa.binary()), ("open", pa.int64())]
_STATE_SCHEMA = "q long, code binary, ids binary, scores binary, done binary, seen binary, open long"


def _hashed(nodes: np.ndarray) -> np.ndarray:
    """32 bits of a node, to remember which nodes a query has scored."""
    return ((nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype("<u4")


def _score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A query's state row (member null) and the nodes to score (with their codes) become its next state."""
    for table in whole_keys(parts, ["q"]):
        at, out = starts(table, ["q"]), []
        member = table["member"].to_pylist()
        codes = table["member_code"].to_pylist()
        for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
            state = table.slice(a, 1).to_pylist()[0]
            ids, scores = np.frombuffer(state["ids"], "<i8"), np.frombuffer(state["scores"], "<f4")
            done, seen = np.frombuffer(state["done"], np.uint8), np.frombuffer(state["seen"], "<u4")
            done = np.ones_like(done)  # what was open has been asked for its neighbours by now
            if b > a + 1:
                new = np.array(member[a + 1 : b], np.int64)
                new, first = np.unique(new, return_index=True)
                rows = from_code([codes[a + 1 + i] for i in first])
                near = rows @ from_code([state["code"]])[0]
                ids, scores = np.concatenate([ids, new]), np.concatenate([scores, near.astype("<f4")])
                done = np.concatenate([done, np.zeros(len(new), np.uint8)])
                seen = np.concatenate([seen, _hashed(new)])
                keep = np.lexsort((ids, -scores))[:BEAM]
                ids, scores, done = ids[keep], scores[keep], done[keep]
            out.append((state["q"], state["code"], ids.tobytes(), scores.tobytes(), done.tobytes(), seen.tobytes(), int((done == 0).sum())))
        yield _batch(_STATE, list(zip(*out, strict=True)))


def _asked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open nodes of each query."""
    for part in parts:
        ids, n = packed(part["ids"].to_pylist(), "<i8")
        done, _ = packed(part["done"].to_pylist(), "u1")
        wanted = done == 0
        q = np.repeat(part["q"].to_numpy(), n)
        yield pa.RecordBatch.from_arrays([pa.array(q[wanted]), pa.array(ids[wanted])], names=["q", "node"])


def _unseen(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A query's state row and its open nodes' neighbour lists become the nodes that it has not scored yet."""
    for table in whole_keys(parts, ["q"]):
        at = starts(table, ["q"])
        seen, near, q = table["seen"].to_pylist(), table["near"].to_pylist(), table["q"].to_numpy()
        for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
            if b > a + 1:
                new = np.unique(np.frombuffer(b"".join(near[a + 1 : b]), "<i8"))
                new = new[~np.isin(_hashed(new), np.frombuffer(seen[a], "<u4"))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(new), q[a])), pa.array(new)], names=["q", "member"])


def walk(state: DataFrame, graph: DataFrame, coded: DataFrame, seeds: DataFrame) -> DataFrame:
    """Greedy search of all queries at once: each step is two joins, of the open nodes with the graph and of what they lead to
    with the codes. A query is at its end when none of its best `BEAM` nodes is open."""
    codes = coded.select(F.col("node").alias("member"), F.col("code").alias("member_code"))
    pairs = seeds
    while True:
        found = pairs.join(codes, "member").select("q", "member", "member_code")
        rows = state.unionByName(found, allowMissingColumns=True).repartition("q")
        rows = rows.sortWithinPartitions("q", F.col("member").asc_nulls_first())
        after = settle(rows.select("q", "code", "ids", "scores", "done", "seen", "open", "member", "member_code").mapInArrow(_score, _STATE_SCHEMA), "state")
        state = after.withColumns({"member": F.lit(None).cast("long"), "member_code": F.lit(None).cast("binary")})
        if not after.agg(F.coalesce(F.sum("open"), F.lit(0))).first()[0]:
            return after
        asked = after.select("q", "ids", "done").mapInArrow(_asked, "q long, node long")
        near = asked.join(graph.select("node", F.col("ids").alias("near")), "node").select("q", "near")
        both = after.select("q", "seen").unionByName(near, allowMissingColumns=True).repartition("q")
        pairs = both.sortWithinPartitions("q", F.col("near").isNotNull()).select("q", "seen", "near").mapInArrow(_unseen, "q long, member long")


def search(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The `k` nearest rows of `vectors` found for each row of `queries`: (query_id, rank, vec_id, score).

    Nearness is the inner product, in double precision on the original vectors; ties go to the smaller id. A query's own row,
    the one with its id, is no candidate. All vectors are in the index; equal vectors are one node of it and each of
    them is a candidate. For the graph, vectors fall into bands of similar length; in a band they are scaled by its longest one and
    given one more component that makes all lengths equal, so that the largest inner product is the smallest distance. Every
    query searches every band on its own, and all that its searches end on is scored exactly, so a long vector hides no other.

    Null vectors, zero vectors and those with a null or non-finite component take no part, nor do those of another dimension
    than the most common one. With fewer than `k` candidates all are returned as far as the graph connects them. Rows with a null id are
    candidates, last among ties; a query with a null id is answered with a null query_id. Empty tables give an empty result.
    Other columns are ignored.
    """
    wanted = [F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("e")]
    rows = vectors.select(*wanted).where(usable(F.col("e")))
    sizes = rows.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    norm = F.sqrt(F.aggregate("e", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    common = sizes.orderBy(F.col("n").desc(), "d").first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = common["d"]
    rows = rows.where(F.size("e") == d)
    nodes = settle(rows.groupBy("e").agg(norm.alias("norm")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    longest = nodes.agg(F.max("norm")).first()[0]
    step = F.floor(F.log(F.lit(longest) / F.col("norm")) / float(np.log(BAND)))
    # Floats differ by less than 2^280 in length, so there are at most some 140 bands.
    bands = nodes.groupBy(step.alias("step")).agg(F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    band_of = {b["step"]: n for n, b in enumerate(bands)}
    tops = np.array([b["norm"] for b in bands])
    dim = d + 1

    def prepare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            band = np.array([band_of[x] for x in part["step"].to_pylist()], np.int64)
            unit = np.array(part["e"].to_pylist(), np.float64).reshape(-1, d) / tops[band][:, None]
            unit = np.concatenate([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1, keepdims=True)))], axis=1).astype("<f4")
            made = [pa.array([x.tobytes() for x in unit], pa.binary()), pa.array(to_code(unit) if len(unit) else [], pa.binary())]
            yield pa.RecordBatch.from_arrays([part["node"], pa.array(band), *made], names=["node", "band", "vector", "code"])

    ready = nodes.select("node", "e", step.alias("step")).mapInArrow(prepare, "node long, band long, vector binary, code binary")
    ready = settle(ready, "vectors")
    coded = ready.select("node", "code")
    entries, graph, forests = forest(ready.select("node", "band", "vector"), dim, [b["n"] for b in bands])
    for _ in range(ROUNDS):
        graph = descend(graph, coded)

    asking = queries.select(*wanted).where(usable(F.col("e")) & (F.size("e") == d))
    asking = settle(asking.withColumn("q", F.monotonically_increasing_id()), "queries")
    none = np.zeros(0).tobytes()

    # A query's search of a band is a search of its own.
    searches = len(bands)

    def units(part: pa.RecordBatch) -> np.ndarray:
        unit = np.array(part["e"].to_pylist(), np.float64).reshape(-1, d)
        return np.concatenate([unit / np.linalg.norm(unit, axis=1, keepdims=True), np.zeros((len(unit), 1))], axis=1).astype("<f4")

    def begin(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            codes = to_code(units(part)) if part.num_rows else []
            for band in range(searches):
                out = [(q * searches + band, c, none, none, none, none, 0) for q, c in zip(part["q"].to_pylist(), codes, strict=True)]
                yield _batch(_STATE, list(zip(*out, strict=True)) if out else [[] for _ in _STATE])

    def enter(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            unit, q = units(part), part["q"].to_numpy()
            for band, trees in enumerate(forests if len(unit) else []):
                for cell in trees.cells(unit):
                    yield pa.RecordBatch.from_arrays([pa.array(q * searches + band), pa.array(cell)], names=["q", "cell"])

    state = asking.select("q", "e").mapInArrow(begin, _STATE_SCHEMA)
    state = state.withColumns({"member": F.lit(None).cast("long"), "member_code": F.lit(None).cast("binary")})
    into = asking.select("q", "e").mapInArrow(enter, "q long, cell long").join(entries, "cell").select("q", F.col("node").alias("member"))
    own = _meet(asking, nodes).join(ready.select("node", "band"), "node")
    own = own.select((F.col("q") * searches + F.col("band")).alias("q"), F.col("node").alias("member"))
    ended = walk(state, graph, coded, into.unionByName(own).distinct())

    def best(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the searches ended on, all of it: codes only say where to look."""
        for part in parts:
            ids, n = packed(part["ids"].to_pylist(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part["q"].to_numpy() // searches, n)), pa.array(ids)], names=["q", "node"])

    product = F.aggregate(
        F.zip_with("e", "qe", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    asked = asking.select("q", F.col("id").alias("query_id"), F.col("e").alias("qe"))
    scored = (
        ended.select("q", "ids")
        .mapInArrow(best, "q long, node long")
        .join(nodes.select("node", "e"), "node")
        .join(asked, "q")
        .select("q", "query_id", "node", product.alias("score"))
    )
    # Of equal vectors, no more than k and the query's own row can be in one answer.
    nth = Window.partitionBy("node").orderBy(F.col("id").asc_nulls_last())
    members = _meet(rows, nodes).select("node", "id", F.row_number().over(nth).alias("nth")).where(F.col("nth") <= k + 1)
    rank = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (
        scored.join(members, "node")
        .where(~F.coalesce(F.col("id") == F.col("query_id"), F.lit(False)))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )


def _meet(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows with the node of their vector."""
    keyed = nodes.select("node", F.col("e").alias("_e"), F.xxhash64("e").alias("_h"))
    return rows.withColumn("_k", F.xxhash64("e")).join(keyed, (F.col("_k") == F.col("_h")) & (F.col("e") == F.col("_e")))
