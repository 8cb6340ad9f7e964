"""What several operators share: numbering and components without gathering a group in one task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from garimpo.session import settle, shuffle_partitions

# White space as the contracts define it: space and the five controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that Spark passes to Python at once, besides its bound on rows.
BATCH_BYTES = 4 << 20
# Lower-cases A-Z in bytes and nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def null_safe(left: Sequence[Column], right: Sequence[Column]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same = same & a.eqNullSafe(b)
    return same


def slices_for(df: DataFrame) -> int:
    """Into how many slices a group is cut: a few per shuffle partition, so it follows the size of the job."""
    return 4 * shuffle_partitions(df.sparkSession)


def numbered(df: DataFrame, by: Sequence[str], slice_col: str, order: Sequence[Column], name: str) -> DataFrame:
    """Add the position (from 0, gapless) of each row within its group, for groups of any size.

    `slice_col` cuts a group into pieces that are numbered on their own and moved up by the pieces before them, so the
    window holds a piece and never a group. `by` and `slice_col` must not be null. Rows that tie in `order` get different positions.
    """
    before = Window.partitionBy(*by).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*by, slice_col).agg(F.count(F.lit(1)).alias("_rows"))
    moved = sizes.select(*by, slice_col, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*by, slice_col).orderBy(*order)
    local = df.withColumn("_local", F.row_number().over(within))
    return (
        local.join(moved, [*by, slice_col])
        .withColumn(name, F.col("_before") + F.col("_local") - 1)
        .drop("_before", "_local")
    )


def indexed(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the position (from 0) of each row in the order of the whole frame, ascending, nulls last.

    The rows are dealt by range and written, as the ranges are sampled; only the ranges' sizes are gathered.
    """
    parts = shuffle_partitions(df.sparkSession)
    keys = [F.col(c).asc_nulls_last() for c in order]
    dealt = settle(df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()), "indexed")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    moved = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    local = dealt.withColumn("_local", F.row_number().over(Window.partitionBy("_range").orderBy(*keys)))
    return local.join(moved, "_range").withColumn(name, F.col("_before") + F.col("_local") - 1).drop("_range", "_before", "_local")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected `edges` (columns a, b, any integers).

    Alternates the large-star and small-star steps of the known MapReduce algorithm. Every step is a partly pre-aggregated
    minimum and a join that AQE can split, so a node with very many edges is never gathered; each round is a written table.
    """

    def tidy(df: DataFrame) -> DataFrame:
        pairs = df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        return settle(pairs, "edges")

    def told(df: DataFrame) -> tuple:
        # Equal tables have equal sums; the sum is over a wide decimal, so it can't overflow.
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = tidy(edges)
    seen = told(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = tidy(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        links = tidy(joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.toDF("a", "b")))
        now = told(links)
        if now == seen:
            break
        seen = now
    # Stars are left: every node points at the smallest of its component.
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def map_batches(
    df: DataFrame, run: Callable[..., Iterable[dict]], schema: str, begin: Callable | None = None, name: str | None = None
) -> DataFrame:
    """`run(columns of a batch as lists) -> rows as dicts of lists`, batch by batch; text arrives as UTF-8 bytes or None.

    With `begin`, what it makes at the start of a task is the first argument of each `run` of that task. With `name`, the worker's
    next task of that name goes on with it, see `kept`.
    """
    out = pa_schema(df, schema)
    bound_batches(df.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [kept(name, begin) if name else begin()] if begin else []
        for part in small(parts):
            for rows in run(*state, *columns(part)):
                yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(lean(batches, name), schema)


# What this Python worker keeps for its next task, by the name of the tasks that use it; one name at most.
_kept: dict[str, object] = {}


def kept(name: str | None, begin: Callable | None = None) -> object:
    """What `begin` makes, or made in an earlier task of this name in this worker; what is kept under any other name is dropped."""
    for other in [n for n in _kept if n != name]:
        del _kept[other]
    if begin and name not in _kept:
        _kept[name] = begin()
    return _kept.get(name)


def bound_batches(spark: SparkSession) -> None:
    """Pass at most `BATCH_BYTES` at once to Python and back from now on, however long the rows, unless the session was started with its own bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(name) is None:
        spark.conf.set(name, BATCH_BYTES)


def lean(run: Callable[[Iterator], Iterator], name: str | None = None) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow; when its task ends, the worker gives back what it no longer uses.

    Workers go on to serve other stages, and memory that their allocators keep for later would add up over a pipeline. So what tasks
    of another `name` have `kept` is dropped first.
    """

    def task(parts: Iterator) -> Iterator:
        kept(name)
        try:
            yield from run(parts)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return task


def small(parts: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that few texts are unpacked at once."""
    for part in parts:
        for at in range(0, part.num_rows, rows):
            yield part.slice(at, rows)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside pass at most `rows` rows at once to Python, which bounds what long rows hold in memory on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """What jobs run inside have shuffled is dropped when they end, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def lowest(df: DataFrame, order: Column, rows: int) -> DataFrame:
    """About `rows` rows with the lowest hash `order` (a long), `rows` at most.

    Only rows below a cut that lets a little more than that many pass are ever sorted or sent, whatever the number of partitions.
    """
    count = df.count()
    share = min(1.0, (rows + 6 * rows**0.5 + 50) / max(1, count))
    cut = int(-(2.0**63) + share * 2.0**64)
    return df.withColumn("_order", order).where(F.col("_order") <= min(cut, 2**63 - 1)).orderBy("_order").limit(rows)


def columns(part: pa.RecordBatch) -> list[list]:
    """The columns of a batch as lists, text as UTF-8 bytes."""
    return [
        (c.cast(pa.large_binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c).to_pylist()
        for c in part.columns
    ]


def pa_schema(df: DataFrame, schema: str) -> pa.Schema:
    """The Arrow form of a DDL schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def whole_keys(parts: Iterable[pa.RecordBatch], keys: Sequence[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """The rows of a partition sorted by `keys` in tables of about `rows` rows that never cut a key."""
    held: list[pa.RecordBatch] = []
    count = 0
    for part in parts:
        if not part.num_rows:
            continue
        held.append(part)
        count += part.num_rows
        if count >= rows:
            table = pa.Table.from_batches(held)
            done = 0
            for at in starts(table, keys)[1:].tolist():
                if at - done >= rows:
                    yield table.slice(done, at - done)
                    done = at
            last = int(starts(table, keys)[-1])
            if last > done:
                yield table.slice(done, last - done)
            held = table.slice(last).combine_chunks().to_batches()  # a key larger than `rows` goes on growing
            count = table.num_rows - last
    if held:
        yield pa.Table.from_batches(held)


def starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where each run of equal keys begins."""
    changed = np.zeros(table.num_rows, bool)
    changed[0] = True
    for key in keys:
        values = table[key].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null, not zero, every component finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(column: Sequence[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as one array, and how many items each of them has."""
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column), kind), np.fromiter((len(x) // size for x in column), np.int64, len(column))


def matrix(vectors: list[list[float]]) -> np.ndarray:
    return np.array(vectors, np.float64)
