"""Mixing sources to target weights with distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import WORD, indexed, null_safe
from garimpo.session import settle

# Hex digits of the hash key that name a slice: 4096 even ranges of the key space per source.
SLICE_DIGITS = 3


def mix_key(id_col: str, text_col: str) -> Column:
    """The hash-random place of a document: it depends on its id and text and on nothing else."""
    known = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (id_col, text_col)]
    return F.md5(F.concat(known[0], F.lit("|"), known[1]))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """Add each source's target to (source, source_size).

    `share` of all sizes is split by weight; a source stops at `epochs` times its size, and what it leaves is shared again by
    weight among the others until none is above. The weights repeat over the sources by code point, null last. Each
    round is one sum over the sources, which stay distributed.
    """
    ordered = indexed(sizes, ["source"], "_at")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    ordered = settle(ordered.withColumn("_weight", weight), "sources")
    cap = F.col("source_size") * epochs
    total = ordered.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else cap < F.lit(level) * F.col("_weight")
        taken, weighed, count = ordered.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)),
        ).first()
        if count == full or not weighed:
            break
        level, full = (share * total - taken) / weighed, count
    level = float("inf") if level is None else level
    target = F.least(cap.cast("double"), F.lit(level) * F.col("_weight"))
    return ordered.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    epochs: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes: (doc_id, source, text, size, source_size, target, taken).

    A document's key is the MD5 of its id and text, so its place in the random order depends on nothing else and reruns
    agree. Each source is cut into 4096 ranges of the key; the prefix sum of the sizes in key order is the sum of the
    ranges before plus a running sum inside the range, so no task holds a source. Whole epochs are taken of all documents,
    and the last, partial one ends exactly at the budget: the document on the border gives only the words still needed.

    A null or wordless text has size 0 and is taken 0 times. A null source is a source, the last one. Equal rows are
    kept and tie in any order, which changes no row's content. An empty table gives an empty result. Columns other than the
    named three are ignored.
    """
    # The text is hashed and counted before the shuffle and is not carried through it.
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        mix_key(id_col, text_col).alias("_key"),
    )
    rows = settle(rows.withColumn("_slice", F.substring("_key", 1, SLICE_DIGITS)), "sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    sources = sources.withColumnRenamed("source", "_source")

    ranges = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("source").alias("_source"),
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
    )
    ranges = ranges.join(sources.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    within = Window.partitionBy("source", "_slice").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = null_safe([F.col("source"), F.col("_slice")], [F.col("_source"), F.col("_at")])
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0)
    left = budget - whole * F.col("source_size") - F.col("_before") - F.col("_local")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return local.join(ranges, same).select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "_key"
    )


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of `docs`, a row for every time a document is taken.

    The document on a source's border is taken last, up to the budget's last word, its words then joined by one space.
    Takes the options of `mix`, treats odd rows as it does, and keeps all columns of `docs` under any names.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    # Equal rows share a key, and each of them is one row of `mix`: numbered on both sides, they meet one to one.
    twin = Window.partitionBy("_key")
    taken = mix(docs, **options).where("taken > 0").select(
        F.col("_key").alias("_mix"),
        F.col("size").alias("_size"),
        F.col("taken").alias("_taken"),
        F.row_number().over(twin.orderBy("taken")).alias("_nth"),
    )
    own = docs.select(F.struct("*").alias("_row"), mix_key(id_col, text_col).alias("_key"))
    own = own.withColumn("_twin", F.row_number().over(twin.orderBy(F.lit(0))))
    turn = F.explode(F.expr("sequence(1, cast((_taken + _size - 1) div _size as int))"))
    both = own.join(taken, (F.col("_key") == F.col("_mix")) & (F.col("_twin") == F.col("_nth"))).withColumn("_turn", turn)
    text, left = F.col("_row")[text_col], F.col("_taken") - (F.col("_turn") - 1) * F.col("_size")
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), left.cast("int"))
    cut = F.when(left >= F.col("_size"), text).otherwise(F.array_join(words, " "))
    return both.select(*[(cut if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns])


#: The same rows from DuckDB.
SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')) as k
  from documents
), s as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w
  from d group by source
), r as (
  select *, coalesce(sum(2 * source_size) over (order by 2.0 * source_size / w, source nulls last
                     rows between unbounded preceding and 1 preceding), 0)::bigint as below,
         sum(w) over (order by 2.0 * source_size / w, source nulls last rows between current row and unbounded following)::bigint as rest,
         (sum(source_size) over ())::bigint as total
  from s
), l as (
  select max((1.5 * total - below)::double / rest) filter (where (1.5 * total - below)::double / rest <= 2.0 * source_size / w) as level from r
), t as (
  select source, source_size, least((2 * source_size)::double, level * w) as target from s, l
), c as (
  select d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::bigint as budget,
         coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join t on d.source is not distinct from t.source
)
select doc_id, size::bigint as size, source_size, target,
       (case when source_size > 0 then budget // source_size * size else 0 end
        + greatest(0, least(size, budget - case when source_size > 0 then budget // source_size * source_size else 0 end - before)))::bigint as taken
from c
"""
