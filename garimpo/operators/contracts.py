"""Contracts as data: what was found, what was expected, and whether it passed. NULL never passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions import PROBLEM
from garimpo.functions.aggregates import MONEY
from garimpo.operators.dimensions import union_all
from garimpo.operators.positions import with_position
from garimpo.session import scratch, settle

TOLERANCE = "0.01"
EXAMPLES = 20


class ContractBroken(RuntimeError):
    pass


class Contract(NamedTuple):
    name: str
    holds: Column


def check_rows(df: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """(contrato, linhas, violacoes, passou) from one pass over the frame; a NULL condition is a violation."""
    broken = [F.count_if(~F.coalesce(c.holds, F.lit(False))).alias(c.name) for c in contracts]
    counted = df.agg(F.count(F.lit(1)).alias("linhas"), *broken)
    long = counted.unpivot(["linhas"], [c.name for c in contracts], "contrato", "violacoes")
    return long.select("contrato", "linhas", "violacoes", (F.col("violacoes") == 0).alias("passou"))


ROWS = "linhas"


def row_counts(contracts: Sequence[Contract]) -> dict[str, Column]:
    """The aggregates behind `check_rows`, to be taken while the rows are written."""
    return {ROWS: F.count(F.lit(1))} | {c.name: F.count_if(~F.coalesce(c.holds, F.lit(False))) for c in contracts}


def checked_rows(spark: SparkSession, counts: Mapping[str, int], contracts: Sequence[Contract]) -> DataFrame:
    """What `check_rows` gives, from counts that were taken before."""
    rows = [(c.name, counts[ROWS], counts[c.name], counts[c.name] == 0) for c in contracts]
    return spark.createDataFrame(rows, "contrato string, linhas bigint, violacoes bigint, passou boolean")


def checked_lineage(spark: SparkSession, name: str, behind: int | None, landed: int) -> DataFrame:
    """What `check_lineage` gives, from the input rows behind the silver rows and the rows landed, counted before."""
    behind = behind or 0
    rows = [(name, behind, landed, behind == landed)]
    return spark.createDataFrame(rows, "contrato string, linhas bigint, chaves bigint, passou boolean")


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("linhas")).filter("linhas > 1")


def check_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: every row has a key and no two share one."""
    rows, keys = F.sum("_n"), F.count_if(F.col(key).isNotNull())
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counted = per_key.agg(F.coalesce(rows, F.lit(0)).alias("linhas"), keys.alias("chaves"))
    return counted.select(
        F.lit(name).alias("contrato"), "linhas", "chaves", (F.col("linhas") == F.col("chaves")).alias("passou")
    )


def beside(**frames: DataFrame) -> DataFrame:
    """One row with a struct column per one-row frame."""
    tagged = [f.select(F.struct(*f.columns).alias(name)) for name, f in frames.items()]
    return union_all(*tagged).agg(*[F.any_value(name, F.lit(True)).alias(name) for name in frames])


def check_lineage(silver: DataFrame, bronze: DataFrame, source_rows: str, name: str) -> DataFrame:
    """One row: the input rows behind the silver rows are all the bronze rows."""
    both = beside(
        s=silver.agg(F.coalesce(F.sum(source_rows), F.lit(0)).alias("n")), b=bronze.agg(F.count(F.lit(1)).alias("n"))
    )
    return both.select(
        F.lit(name).alias("contrato"),
        F.col("s.n").alias("linhas"),
        F.col("b.n").alias("chaves"),
        F.coalesce(F.col("s.n") == F.col("b.n"), F.lit(False)).alias("passou"),
    )


def result(order: int, test: str, found: Column, expected: Column, passed: Column) -> list[Column]:
    return [
        F.lit(order).alias("ORDEM"),
        F.lit(test).alias("TESTE"),
        found.alias("VALOR_CALCULADO"),
        expected.alias("VALOR_ESPERADO"),
        F.coalesce(passed, F.lit(False)).alias("PASSOU"),
    ]


def totals(df: DataFrame, **sums: Column | str) -> DataFrame:
    """One row: money sums with a fixed type, and the number of rows as `registros`."""
    money = [F.sum(F.col(c) if isinstance(c, str) else c).cast(MONEY).alias(n) for n, c in sums.items()]
    return df.agg(*money, F.count(F.lit(1)).alias("registros"))


def close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(TOLERANCE).cast(MONEY)


def presence(id: str, **frames: DataFrame) -> DataFrame:
    """Per id the number of rows each frame has for it: (_id, one column per frame).

    One aggregate answers absence both ways, uniqueness and overlap at once; it is partly done before the shuffle, so
    neither many copies of an id nor many NULL ids land in one task, as they would in anti joins. Written once, it serves every
    check on these ids: `unique_in`, `traced`, `traced_with_held`.
    """
    tagged = union_all(*[f.select(F.col(id).alias("_id"), F.lit(n).alias("_in")) for n, f in frames.items()])
    return tagged.groupBy("_id").agg(*[F.count_if(F.col("_in") == n).alias(n) for n in frames])


def _rows(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def _rows_outside(name: str, other: Column) -> Column:
    # A NULL id equals no other, so its rows are always outside.
    outside = (other == 0) | F.col("_id").isNull()
    return F.coalesce(F.sum(F.when(outside, F.col(name)).otherwise(0)), F.lit(0))


def _ids(name: str) -> Column:
    return F.count_if((F.col(name) > 0) & F.col("_id").isNotNull())


def unique_in(ids: DataFrame, frame: str, name: str) -> DataFrame:
    """What `check_unique` gives for the frame `frame` of a `presence`."""
    counted = ids.agg(_rows(frame).alias("linhas"), _ids(frame).alias("chaves"))
    return counted.select(
        F.lit(name).alias("contrato"), "linhas", "chaves", (F.col("linhas") == F.col("chaves")).alias("passou")
    )


def traced(ids: DataFrame) -> DataFrame:
    """What `trace` gives, from the presence of `fact` and `source`."""
    return ids.agg(
        _rows("fact").alias("linhas"),
        _ids("fact").alias("ids"),
        _rows("source").alias("linhas_origem"),
        _rows_outside("source", F.col("fact")).alias("ausentes"),
        _rows_outside("fact", F.col("source")).alias("extras"),
    )


def trace(fact: DataFrame, source: DataFrame, id: str) -> DataFrame:
    """One row: rows, distinct ids, rows of the source absent from the fact, rows of the fact not in the source."""
    return traced(presence(id, fact=fact, source=source))


def traced_with_held(ids: DataFrame) -> DataFrame:
    """What `trace_with_held` gives, from the presence of `fact`, `held` and `source`."""
    pairs = F.when(F.col("_id").isNotNull(), F.col("fact") * F.col("held")).otherwise(0)
    return ids.agg(
        _rows("fact").alias("aceitas"),
        _rows("held").alias("quarentena"),
        _rows("source").alias("total_silver"),
        _ids("fact").alias("ids"),
        _rows_outside("source", F.col("fact") + F.col("held")).alias("ausentes"),
        (_rows_outside("fact", F.col("source")) + _rows_outside("held", F.col("source"))).alias("extras"),
        F.coalesce(F.sum(pairs), F.lit(0)).alias("sobreposicoes"),
    )


def trace_with_held(fact: DataFrame, held: DataFrame, source: DataFrame, id: str) -> DataFrame:
    """As `trace`, with rows held back; `sobreposicoes` counts pairs of accepted and held rows of one id."""
    return traced_with_held(presence(id, fact=fact, held=held, source=source))


def absent(a: DataFrame, b: DataFrame, id: str) -> DataFrame:
    """Rows of `a` whose id is not in `b`."""
    return a.join(b.select(id).distinct(), id, "left_anti")


def overlap(a: DataFrame, b: DataFrame, id: str) -> DataFrame:
    """Rows of `a` whose id is also in `b`."""
    return a.join(b.select(id).distinct(), id, "left_semi")


class Reference(NamedTuple):
    """A foreign key of a fact and the dimension column it points to."""

    column: str
    dim: DataFrame
    key: str


class HeldReference(NamedTuple):
    """A foreign key that is NULL exactly when the source id is held back."""

    column: str
    dim: DataFrame
    key: str
    source_id: str
    held: DataFrame
    held_id: str


def orphan_marks(fact: DataFrame, references: Sequence[Reference], customer: HeldReference | None = None) -> DataFrame:
    """The fact's rows with a key no dimension has, or whose customer key and quarantine disagree.

    Each key is looked at on its own: its distinct values, found partly before the shuffle, are joined with its dimension, and so
    are the pairs of customer key and source id. The values that fail, few or none, are one small written table; the rows are then
    marked by joins with it. So no row of the fact goes through a shuffle, and none that is held by all its keys at once.
    """
    missing = F.lit(False)
    kept = fact
    broken = []
    for i, r in enumerate(references):
        missing = missing | F.col(r.column).isNull()
        side = r.dim.select(F.col(r.key).alias("_k"))
        values = fact.select(F.col(r.column).alias("_v")).where(F.col("_v").isNotNull()).distinct()
        lost = values.join(side, F.col("_v") == F.col("_k"), "left_anti")
        broken.append(lost.select(F.lit(i).alias("_i"), F.col("_v").cast("string").alias("_v")))
    if customer:
        dim = customer.dim.select(F.col(customer.key).alias("_kc"))
        held = customer.held.select(F.col(customer.held_id).alias("_kq"))
        pairs = fact.select(F.col(customer.column).alias("_v"), F.col(customer.source_id).alias("_w")).distinct()
        pairs = pairs.join(dim, F.col("_v") == F.col("_kc"), "left").join(held, F.col("_w") == F.col("_kq"), "left")
        key, is_held = F.col("_v").isNotNull(), F.col("_kq").isNotNull()
        lost = pairs.where((key == is_held) | (key & F.col("_kc").isNull()))
        broken.append(
            lost.select(F.lit(len(references)).alias("_i"), F.col("_v").cast("string").alias("_v"), F.col("_w").cast("string").alias("_w"))
        )
    table = settle(union_all(*broken), "orphans") if broken else None
    bad = missing
    for i, r in enumerate(references):
        side = table.where(F.col("_i") == i).select(F.col("_v").alias(f"_b{i}"))
        kept = kept.join(side, F.col(r.column).cast("string") == F.col(f"_b{i}"), "left")
        bad = bad | F.col(f"_b{i}").isNotNull()
    if customer:
        side = table.where(F.col("_i") == len(references)).select(F.col("_v").alias("_bv"), F.col("_w").alias("_bw"), F.lit(True).alias("_bad"))
        same = F.col(customer.column).cast("string").eqNullSafe(F.col("_bv")) & F.col(customer.source_id).cast("string").eqNullSafe(F.col("_bw"))
        kept = kept.join(side, same, "left")
        bad = bad | F.coalesce("_bad", F.lit(False))
    return kept.where(bad).select(fact.columns)


def orphans(fact: DataFrame, references: Sequence[Reference], customer: HeldReference | None = None) -> DataFrame:
    """The rows that `orphan_marks` finds, by their keys; `linhas` is the number of fact rows behind each result row."""
    keys = [r.column for r in references]
    if customer:
        keys += [customer.column, customer.source_id]
    return orphan_marks(fact, references, customer).groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"))


def orphan_rows(*args, **kwargs) -> DataFrame:
    return orphan_marks(*args, **kwargs).agg(F.count(F.lit(1)).alias("linhas"))


def coverage(fact: DataFrame, held: DataFrame, key: str, id: str, held_id: str) -> DataFrame:
    """One row: NULL keys whose id is not held, and keys whose id is. Both must be zero."""
    counted = fact.groupBy(id, F.col(key).isNotNull().alias("_has_key")).agg(F.count(F.lit(1)).alias("_n"))
    marks = held.select(F.col(held_id).alias("_held"))
    joined = counted.join(marks, F.col(id) == F.col("_held"), "left")
    has_key, is_held = F.col("_has_key"), F.col("_held").isNotNull()
    return joined.agg(
        F.coalesce(F.sum(F.when(~has_key & ~is_held, F.col("_n"))), F.lit(0)).alias("sem_chave_fora"),
        F.coalesce(F.sum(F.when(has_key & is_held, F.col("_n"))), F.lit(0)).alias("com_chave_dentro"),
    )


def check_fact(
    fact: DataFrame,
    source: DataFrame,
    id: str,
    required: Sequence[str],
    name: str,
    held: DataFrame | None = None,
    key: str | None = None,
    source_id: str | None = None,
    held_id: str | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """One row: no source row was lost or multiplied, ids are unique, required keys are present, and the customer key
    is NULL exactly for the held ids. `ids`: the presence of `fact` and `source`, if it is there already."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    parts = {
        "t": trace(fact, source, id) if ids is None else traced(ids),
        "m": fact.agg(F.count_if(missing).alias("chaves_ausentes")),
    }
    if held is not None:
        parts["q"] = coverage(fact, held, key, source_id, held_id)
    both = beside(**parts)
    passed = (
        (F.col("t.linhas") == F.col("t.linhas_origem"))
        & (F.col("t.ids") == F.col("t.linhas"))
        & (F.col("m.chaves_ausentes") == 0)
    )
    outside = inside = F.lit(0).cast("bigint")
    if held is not None:
        outside, inside = F.col("q.sem_chave_fora"), F.col("q.com_chave_dentro")
        passed = passed & (outside == 0) & (inside == 0)
    return both.select(
        F.lit(name).alias("contrato"),
        F.col("t.linhas").alias("linhas"),
        F.col("t.linhas_origem").alias("linhas_origem"),
        F.col("t.ids").alias("ids"),
        outside.alias("sem_chave_fora"),
        inside.alias("com_chave_dentro"),
        F.col("m.chaves_ausentes").alias("chaves_ausentes"),
        F.coalesce(passed, F.lit(False)).alias("passou"),
    )


def check_position_fact(
    fact: DataFrame, held: DataFrame, source: DataFrame, id: str, grain: Sequence[str], name: str, ids: DataFrame | None = None
) -> DataFrame:
    """One row: accepted and held rows make up the source, ids and grains are unique, the grain is never NULL. `ids`: the
    presence of `fact`, `held` and `source`, if it is there already."""
    missing = F.lit(False)
    for c in grain:
        missing = missing | F.col(c).isNull()
    both = beside(
        t=trace_with_held(fact, held, source, id) if ids is None else traced_with_held(ids),
        g=fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.count(F.lit(1)).alias("graos"), F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("ausentes")
        ),
    )
    passed = (
        (F.col("t.aceitas") + F.col("t.quarentena") == F.col("t.total_silver"))
        & (F.col("t.ids") == F.col("t.aceitas"))
        & (F.col("g.graos") == F.col("t.aceitas"))
        & (F.col("g.ausentes") == 0)
    )
    return both.select(
        F.lit(name).alias("contrato"),
        F.col("t.aceitas").alias("linhas"),
        F.col("t.quarentena").alias("quarentena"),
        F.col("t.total_silver").alias("linhas_origem"),
        F.col("t.ids").alias("ids"),
        F.col("g.graos").alias("graos"),
        F.col("g.ausentes").alias("chaves_ausentes"),
        F.coalesce(passed, F.lit(False)).alias("passou"),
    )


def reconcile_totals(order: int, test: str, found: DataFrame, expected: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """One result row: the columns of two one-row frames agree, money within a cent and `exact` ones exactly."""
    both = beside(c=found, e=expected)
    passed = F.lit(True)
    for name in found.columns:
        a, b = F.col(f"c.{name}"), F.col(f"e.{name}")
        passed = passed & (a == b if name in exact else close(a, b))
    return both.select(*result(order, test, F.to_json("c"), F.to_json("e"), passed))


def compare_groups(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """One row: groups whose measures differ, or that only one side has; NULL keys are equal to each other."""
    a = actual.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *measures)
    e = expected.select(*[F.col(k).alias(f"_e_{k}") for k in keys], *[F.col(m).alias(f"_e_{m}") for m in measures.values()])
    same, agree = F.lit(True), F.lit(True)
    for k in keys:
        same = same & F.col(f"_a_{k}").eqNullSafe(F.col(f"_e_{k}"))
    for mine, theirs in measures.items():
        agree = agree & F.col(mine).eqNullSafe(F.col(f"_e_{theirs}"))
    return a.join(e, same, "full").agg(F.count_if(~agree).alias("grupos_divergentes"))


def failures(results: DataFrame) -> DataFrame:
    text = F.concat(
        F.col("TESTE"),
        F.lit(" calculado="),
        F.coalesce("VALOR_CALCULADO", F.lit("NULL")),
        F.lit(" esperado="),
        F.coalesce("VALOR_ESPERADO", F.lit("NULL")),
    )
    return results.filter(~F.coalesce("PASSOU", F.lit(False))).select("ORDEM", text.alias("falha"))


def fail_on(results: DataFrame, title: str = "Testes Gold falharam") -> None:
    """Raise one error that lists every failed test. Brings the failed result rows to the driver: one per test."""
    failed = [r["falha"] for r in failures(results).orderBy("falha").collect()]
    if failed:
        raise ContractBroken(f"{title}: " + "; ".join(failed))


def fail_on_contracts(checks: DataFrame, title: str) -> None:
    """Raise one error that lists every broken contract of a `contrato, .., passou` frame (one row per contract)."""
    failed = checks.filter(~F.coalesce("passou", F.lit(False)))
    lines = [f"{r['contrato']}: {r.asDict()}" for r in failed.orderBy("contrato").collect()]
    if lines:
        raise ContractBroken(f"{title}\n- " + "\n- ".join(lines))


def failure_message(offenders: DataFrame, text: Column, examples: int = EXAMPLES) -> DataFrame:
    """One row: how many offenders there are and the first ones in order, for an error message.

    The message is short on purpose; the offenders themselves are in the frame.
    """
    counted = offenders.agg(F.count(F.lit(1)).alias("total"))
    first = offenders.select(text.alias("_t")).orderBy("_t").limit(examples)
    listed = first.agg(F.concat_ws("; ", F.sort_array(F.collect_list("_t"))).alias("texto"))
    return beside(n=counted, m=listed).select(F.col("n.total").alias("total"), F.col("m.texto").alias("mensagem"))


def require_none(offenders: DataFrame, text: Column, title: str) -> None:
    """Raise when there is any offender. All of them are then in a table of the shared folder that the message names."""
    row = failure_message(offenders, text).first()
    if row["total"]:
        path = scratch(offenders.sparkSession, "offenders")
        offenders.write.parquet(path)
        raise ContractBroken(f"{title}: {row['mensagem']} (total {row['total']}, all of them in {path})")


def require_clean(df: DataFrame, title: str) -> DataFrame:
    """Raise when any row was refused; otherwise the rows without the reason column."""
    refused = df.filter(F.col(PROBLEM).isNotNull())
    reasons = refused.groupBy(PROBLEM).agg(F.count(F.lit(1)).alias("_n"))
    require_none(reasons, F.concat(F.col(PROBLEM), F.lit(" x"), F.col("_n").cast("string")), title)
    return df.drop(PROBLEM)


def report(results: DataFrame, position: str | None = None) -> DataFrame:
    """The results in their fixed order, which `position` names as a column if given."""
    if position:
        return with_position(results, [(F.col("ORDEM"), False)], position).drop("ORDEM")
    return results.orderBy("ORDEM").drop("ORDEM")


def preview(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first rows in order, for a small printed report."""
    return df.orderBy(*order).limit(rows)
