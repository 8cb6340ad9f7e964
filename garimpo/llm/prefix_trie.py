"""The trie of conversation prefixes by truncation peeling: conversations that begin alike share nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import numbered, pa_schema
from garimpo.session import settle, shuffle_partitions

#: Turns of one conversation that a window runs over; longer conversations are put together from such slices.
SLICE = 1024
#: A piece of a node's list of ended conversations covers this many neighbouring ids (2 to this power).
PIECE_BITS = 16
KEY = ("depth", "k1", "k2")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, size): each turn's place in its conversation from 1, a 128-bit hash of role and text, code points of the text.

    In order of `turn`, null first; turns of one number go by that hash. The rows are cut by range, so a conversation of any
    length is numbered in parts. From here on the texts are not needed again.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().alias("known"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"),
        F.length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),  # tells equal turns apart; written below, so it is drawn once
    )
    order = [F.col(c) for c in ("known", "turn", "a", "b", "row")]
    parts = shuffle_partitions(conversations.sparkSession)
    dealt = settle(turns.repartitionByRange(parts, "conv_id", *order).withColumn("slice", F.spark_partition_id()), "turns")
    placed = numbered(dealt, ["conv_id"], "slice", order, "pos")
    return placed.select("conv_id", (F.col("pos") + 1).alias("pos"), "a", "b", "size")


def counted(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their number of turns, turns with it) of ordered turns."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return convs, turns.join(convs, "conv_id")


def grafted(turns: DataFrame, head: Column, most: int, root: Column) -> tuple[DataFrame, DataFrame]:
    """Replace the first `head` turns of each conversation by those of the conversation `root`, as far as it has them.

    `head` and `root` are columns over conv_id, `head` is at most `most`. Returns what `counted` does.
    """
    turns = settle(turns, "ordered")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumns({"head": head, "root": root})
    lengths = convs.select(F.col("conv_id").alias("root"), F.least(F.col("own"), F.lit(most)).alias("has"))
    taken = F.least(F.col("head"), F.coalesce("has", F.lit(0)))
    convs = convs.join(lengths, "root", "left").select(
        "conv_id",
        "root",
        "head",
        taken.alias("taken"),
        (taken + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("turns"),
    )
    convs = settle(convs, "convs")
    openings = turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "root")
    begun = convs.join(openings, "root").where(F.col("pos") <= F.col("taken"))
    rest = turns.join(convs, "conv_id").where(F.col("pos") > F.col("head"))
    rest = rest.withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    columns = ("conv_id", "turns", "pos", "a", "b", "size")
    return convs.select("conv_id", "turns"), begun.select(*columns).unionByName(rest.select(*columns))


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every truncation of every conversation: (conv_id, depth, k1, k2, p1, p2, size, ended).

    (depth, k1, k2) names a sequence of turns: the exclusive or, over its turns, of a 128-bit hash of place and turn. It runs along a
    conversation slice by slice, and taking the last turn's hash off again gives the name of the shorter sequence, (p1, p2).
    """
    mixed = turns.select(
        "conv_id",
        (F.col("pos") == F.col("turns")).alias("ended"),
        F.col("pos").alias("depth"),
        F.floor((F.col("pos") - 1) / SLICE).alias("slice"),
        F.xxhash64("pos", "a", "b").alias("x1"),
        F.xxhash64("b", "a", "pos").alias("x2"),
        "size",
    )
    sums = mixed.groupBy("conv_id", "slice").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(
        "conv_id", "slice", *[F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(s) for s in ("s1", "s2")]
    )
    within = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = mixed.withColumns({"l1": F.bit_xor("x1").over(within), "l2": F.bit_xor("x2").over(within)})
    paths = local.join(ahead, ["conv_id", "slice"]).withColumns(
        {"k1": F.col("l1").bitwiseXOR(F.col("s1")), "k2": F.col("l2").bitwiseXOR(F.col("s2"))}
    )
    none = F.lit(0).cast("long")
    roots = convs.select(
        "conv_id",
        none.alias("depth"),
        *[none.alias(c) for c in ("k1", "k2", "p1", "p2", "size")],
        (F.col("turns") == 0).alias("ended"),
    )
    return roots.unionByName(
        paths.select(
            "conv_id",
            "depth",
            "k1",
            "k2",
            F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"),
            F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"),
            "size",
            "ended",
        )
    )


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The trie's nodes: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), all long but the last.

    `convs` (conv_id, turns) and `turns` (conv_id, turns, pos, a, b, size) as `counted` and `grafted` give them. A node is a
    distinct sequence of first turns, the root the empty one; its members are the conversations that begin with it. n_leaves counts
    the childless nodes of its subtree, saved_tokens sums (n_convs - 1) times the size of the last turn over it, ends_sha256 is the
    hash of the comma-joined ids, ascending, of the conversations that end there.

    All truncations are grouped at once, partly before the shuffle, which finds the nodes with their members, parent and ends. A
    conversation alone on a node is alone to its end, so that tail has its figures at sight. What more than one
    conversation shares is peeled from its deepest level up: the nodes of a level with what branches off or ends there and the
    survivors of the level below, stripped of their last turn, are grouped again and hand their sums on. There is one
    small written table for each level down to the deepest shared one, whatever the length of the conversations.

    Sequences are told apart by 128-bit hashes. Rows without a conversation are left out; a null role or text is an empty one, equal
    rows are turns of their own. A conversation of any length and a node of any number of members are summed in parts; the
    ids that end at one node are streamed through one task, as their hash is one sequence, packed to a row per 65,536
    neighbouring ids. An empty table has no nodes. Other columns are ignored.
    """
    paths = settle(prefixes(convs, turns), "prefixes")
    ended = F.col("ended")
    nodes = settle(
        paths.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("size").alias("size"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.sum(ended.cast("long")).alias("n_ends"),
            F.min(F.when(ended, F.col("conv_id"))).alias("end_id"),
        ),
        "nodes",
    )
    alone = F.col("n_convs") == 1
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    below = nodes.where("depth > 0").select(*up, alone.cast("long").alias("tail"))
    kids = below.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"), F.sum("tail").alias("tails"))
    named = nodes.join(kids, list(KEY), "left").fillna(0, ["n_children", "tails"])

    shared = settle(
        named.where(~alone).select(
            *KEY,
            "p1",
            "p2",
            "conv_id",
            (F.col("tails") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        ),
        "shared",
    )
    sums = peeled(shared)
    parents = shared.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    lists = ends(paths.where("ended").select("conv_id", *KEY), nodes.where("n_ends > 1").select(*KEY))
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id"))
    listed = F.when(F.col("n_ends") == 0, F.sha2(F.lit(""), 256)).when(
        F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string"), 256)
    )
    return (
        named.join(sums, list(KEY), "left")
        .join(lists, list(KEY), "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            parent.alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
            listed.otherwise(F.col("ends_sha256")).alias("ends_sha256"),
        )
    )


def peeled(shared: DataFrame) -> DataFrame:
    """(depth, k1, k2, leaves, saved) of every shared node, summed over its subtree from the deepest level up."""
    columns = ("k1", "k2", "p1", "p2", "leaves", "saved")
    deepest = shared.agg(F.max("depth")).first()[0]
    levels = [shared.where(F.lit(False)).select(*KEY, "leaves", "saved")]
    survivors = None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        level = shared.where(F.col("depth") == depth).select(*columns)
        if survivors is not None:
            none = F.lit(None).cast("long")
            stripped = survivors.select(
                F.col("p1").alias("k1"), F.col("p2").alias("k2"), none.alias("p1"), none.alias("p2"), "leaves", "saved"
            )
            level = level.unionByName(stripped).groupBy("k1", "k2").agg(*[F.sum(c).alias(c) if c in ("leaves", "saved") else F.max(c).alias(c) for c in columns[2:]])
        survivors = settle(level, "level")
        levels.append(survivors.select(F.lit(depth).cast("long").alias("depth"), "k1", "k2", "leaves", "saved"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def ends(last: DataFrame, wanted: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the `wanted` nodes, from (conv_id, depth, k1, k2) of where each conversation ends."""
    here = last.join(wanted, list(KEY), "left_semi")
    pieces = here.groupBy(*KEY, F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")
    )
    schema = "depth long, k1 long, k2 long, ends_sha256 string"
    out = pa_schema(last, schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, digest.hexdigest()), out, strict=True)], schema=out)

        for batch in batches:
            for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key:
                    if key is not None:
                        yield row()
                    key, digest = now, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if key is not None:
            yield row()

    parts = shuffle_partitions(last.sparkSession)
    return pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "piece").mapInArrow(hashed, schema)


#: The query's result for DuckDB, from the trie's definition: members of every prefix, and each node's sums over those of its
#: conversations' longer prefixes.
SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS root, own,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda s, z: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384::BIGINT) ELSE s // 2 END)), 4294967295::BIGINT) % 6 AS head
  FROM (SELECT conv_id, count(*) AS own FROM own GROUP BY conv_id)
),
sized AS (
  SELECT c.conv_id, c.root, c.head, least(c.head, coalesce(r.own, 0)) AS taken,
    least(c.head, coalesce(r.own, 0)) + greatest(c.own - c.head, 0) AS turns
  FROM convs c LEFT JOIN convs r ON r.conv_id = c.root
),
rebuilt AS (
  SELECT s.conv_id, s.turns, o.pos, o.role, o.text FROM sized s JOIN own o ON o.conv_id = s.root WHERE o.pos <= s.taken
  UNION ALL
  SELECT s.conv_id, s.turns, o.pos - s.head + s.taken, o.role, o.text FROM sized s JOIN own o ON o.conv_id = s.conv_id
  WHERE o.pos > s.head
),
prefixes AS (
  SELECT conv_id, turns, 0 AS depth, 0 AS size, [] AS path FROM sized
  UNION ALL
  SELECT conv_id, turns, pos, length(text), list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY pos)
  FROM rebuilt
),
members AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node FROM prefixes),
found AS (
  SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = turns), '')) AS ends_sha256
  FROM members GROUP BY node, depth
),
linked AS (
  SELECT f.*, m.node AS parent FROM found f LEFT JOIN members m ON m.conv_id = f.node AND m.depth = f.depth - 1
),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.parent = l.node AND k.depth = l.depth
),
sums AS (
  SELECT m.node, m.depth, sum((c.n_children = 0)::BIGINT) AS n_leaves, sum(c.saved) AS saved_tokens
  FROM counted c JOIN members m ON m.conv_id = c.node AND m.depth <= c.depth GROUP BY m.node, m.depth
)
SELECT c.node::BIGINT AS conv_id, c.depth::BIGINT AS depth, c.parent::BIGINT AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
  c.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.node = c.node AND s.depth = c.depth
"""
