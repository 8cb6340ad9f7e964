"""Operators against brute force, with groups that hold most of the rows."""

import datetime
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from garimpo.operators import contracts, dimensions, facts, marts, measures, positions, quarantine, running, versions
from garimpo.plans import spec


@pytest.mark.parametrize("piece", [50, 100_000])
def test_versions_of_a_hot_key(spark, monkeypatch, piece):
    monkeypatch.setattr(versions, "PIECE_ROWS", piece)
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", str(i), rng.choice("abc")) for i in range(4000)]
    rows += [(None, str(i), "z") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, a string, b string").repartition(5)
    got = {tuple(r) for r in versions.number_versions(df, ["k"], ["a", "b"]).collect()}
    again = versions.number_versions(df.orderBy(F.rand(3)), ["k"], ["a", "b"])
    assert got == {tuple(r) for r in again.collect()} and len(got) == len(rows)
    per_key = defaultdict(list)
    for k, _, _, v in got:
        per_key[k].append(v)
    for k, numbers in per_key.items():
        assert numbers == [None] * 500 if k is None else sorted(numbers) == list(range(1, len(numbers) + 1))


def test_consolidation_counts_copies_and_groups_nulls(spark):
    df = spark.createDataFrame([("a", None)] * 3 + [("a", "b"), (None, None), (None, None)], "x string, y string")
    got = {(r["x"], r["y"]): r["_linhas_origem"] for r in versions.consolidate(df, ["x", "y"]).collect()}
    assert got == {("a", None): 3, ("a", "b"): 1, (None, None): 2}
    summary = versions.load_summary("t", versions.consolidate(df, ["x", "y"])).first()
    assert tuple(summary) == ("t", 3, 6, 3)


@pytest.mark.parametrize("piece", [50, 100_000])
def test_folding_and_numbering_by_key_is_both_steps_in_one(spark, monkeypatch, piece):
    monkeypatch.setattr(versions, "PIECE_ROWS", piece)
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", f"k{rng.randrange(40)}"]), str(rng.randrange(300)), rng.choice(["a", None])) for i in range(3000)]
    rows += [("copies", "1", "z")] * 400 + [(None, str(i % 7), "z") for i in range(100)]
    df = spark.createDataFrame(rows, "k string, a string, b string").repartition(5).select("*", F.upper("k").alias("key"))
    got = versions.consolidate_versions(df, ["key"], ["k", "a", "b"])
    folded = versions.consolidate(df, ["k", "a", "b"]).withColumn("key", F.upper("k"))
    both = versions.number_versions(folded, ["key"], ["k", "a", "b"])
    names = ["k", "a", "b", "key", "_linhas_origem", "_versao"]
    assert sorted(map(repr, got.select(*names).collect())) == sorted(map(repr, both.select(*names).collect()))
    assert got.agg(F.sum("_linhas_origem")).first()[0] == len(rows)


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_running_total_of_a_hot_group_with_many_ties(spark, slices):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        month = 1 if i % 3 else rng.randrange(2, 6)
        rows.append((month, i, Decimal(rng.choice([0, 0, 0, 5, -2, rng.randrange(1000)]))))
    rows += [(None, 9000 + i, Decimal(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "m int, k int, v decimal(18,2)")
    out = running.running_total(df, "v", ["m"], [F.col("v").desc(), F.col("k").asc()], "acc", slices, "total")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "hashpartitioning(m#" not in plan
    again = running.partition_total(df, "v", ["m"], "alone")
    alone = {(r["m"], r["k"]): r["alone"] for r in again.collect()}
    got = {(r["m"], r["k"]): (r["acc"], r["total"]) for r in out.collect()}
    assert alone == {k: v[1] for k, v in got.items()}
    assert len(got) == len(rows)
    for m in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == m), key=lambda r: (-r[2], r[1]))
        total, acc = sum(r[2] for r in group), Decimal(0)
        for _, k, v in group:
            acc += v
            assert got[(m, k)] == (acc, total)


def test_running_total_passes_over_nulls_as_a_window_does(spark):
    rows = [("a", i, None if i % 4 else i) for i in range(40)] + [(None, 1, 5), (None, 2, None), ("b", 1, None)]
    df = spark.createDataFrame(rows, "m string, k int, v long")
    got = {(r["m"], r["k"]): (r["acc"], r["total"]) for r in running.running_total(df, "v", ["m"], [F.col("k")], "acc", 8, "total").collect()}
    for m in ("a", "b", None):
        group = sorted((k, v) for g, k, v in rows if g == m)
        for k, _ in group:
            so_far = [v for at, v in group if at <= k and v is not None]
            known = [v for _, v in group if v is not None]
            assert got[m, k] == (sum(so_far) if so_far else None, sum(known) if known else None)


def test_identity_conflicts_split_exactly(spark):
    rng = random.Random(5)
    rows = [(f"c{rng.randrange(60)}", rng.choice(["n1", "n1", "n1", "n2", None]), rng.choice(["g", None])) for _ in range(300)]
    rows += [("hot", f"n{i % 50}", None) for i in range(2000)] + [("empty", None, None)]
    df = spark.createDataFrame(rows, "id string, n string, g string")
    accepted, held = quarantine.attribute_conflicts(df, "id", ["n", "g"])
    seen = defaultdict(lambda: defaultdict(set))
    for i, n, g in rows:
        seen[i]["n"].add(n)
        seen[i]["g"].add(g)
    values = {i: {a: v - {None} for a, v in s.items()} for i, s in seen.items()}
    bad = {i for i, s in values.items() if any(len(v) > 1 for v in s.values())}
    assert {r["id"] for r in held.collect()} == bad
    got = {r["id"]: (r["n"], r["g"]) for r in accepted.collect()}
    assert got == {i: (max(s["n"], default=None), max(s["g"], default=None)) for i, s in values.items() if i not in bad}

    long = quarantine.evidence(df, held, "id", ["n", "g"])
    assert Counter(tuple(r) for r in long.collect()) == Counter(
        (i, a, v) for i in bad for a in ("n", "g") for v in values[i][a]
    )
    parts = quarantine.evidence_arrays(long, "id", {"n": "ns", "g": "gs"}, 10).orderBy("id", "PARTE").collect()
    assert {r["id"] for r in parts} == bad and max(r["PARTE"] for r in parts) > 1
    for i in bad:
        mine = [r for r in parts if r["id"] == i]
        assert [r["PARTE"] for r in mine] == list(range(1, len(mine) + 1))
        for attribute, name in (("n", "ns"), ("g", "gs")):
            assert [v for r in mine for v in r[name]] == sorted(values[i][attribute])
            assert all(len(r[name]) <= 10 for r in mine)


def test_grains_are_held_whole_and_null_grains_are_not_equal(spark):
    rows = [("p", 1, "a"), ("p", 1, "b"), ("p", 2, "c"), (None, 1, "d"), (None, 1, "e")]
    df = spark.createDataFrame(rows, "p string, m int, id string")
    split = quarantine.grain_conflicts(df, ["p", "m"])
    assert {r["id"] for r in split.held.collect()} == {"a", "b"}
    assert {r["id"] for r in split.accepted.collect()} == {"c", "d", "e"}
    assert {r["id"] for r in quarantine.exclude(df, split.held, "id").collect()} == {"c", "d", "e"}
    assert tuple(quarantine.held_summary(df.select("p"), split.held, ["p", "m"], ("ids", "grains")).first()) == (5, 1)


def test_lookups_keep_every_row(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("a", 10)], "nat string, sk int")
    got = facts.lookup(fact, dim, "k", "nat", {"sk": "key"}).collect()
    assert {(r["n"], r["key"]) for r in got} == {(1, 10), (2, None), (3, None)}
    held = spark.createDataFrame([("b",)], "id string")
    known = facts.lookup_unless_held(fact, held, "k", "id", "sk", "cliente").collect()
    assert {r["n"] for r in known if r["sk"] is not None} == {1}


def test_calendar_covers_every_day_with_names(spark):
    d = datetime.date
    df = spark.createDataFrame([(d(2024, 2, 28), None), (d(2024, 3, 3), d(2024, 2, 27))], "a date, b date")
    bounds = dimensions.date_bounds([(df, ["a", "b"])])
    rows = dimensions.calendar_dim(bounds, spec.MONTHS, spec.WEEKDAYS).orderBy("DATA").collect()
    assert [r["SK_DATA"] for r in rows] == [20240227, 20240228, 20240229, 20240301, 20240302, 20240303]
    last = rows[-1]
    assert (last["ANO"], last["MES"], last["NOME_MES"], last["TRIMESTRE"], last["DIA_SEMANA"]) == (2024, 3, "Março", 1, "Domingo")
    assert dimensions.calendar_dim(dimensions.date_bounds([(df.limit(0), ["a"])]), spec.MONTHS, spec.WEEKDAYS).count() == 0


def test_mapping_needs_the_name_and_the_code_when_there_is_one(spark):
    dim = dimensions.mapped_dim(spark, [("C1", "one"), ("C2", "two")], "sk", ("code", "name"), "e")
    told = spark.createDataFrame([(None, "one"), ("C2", "one"), ("C2", "two"), (None, None), (None, "x"), (None, "x")], "code string, name string")
    got = {tuple(r) for r in dimensions.unmapped(told, dim, "code", "name").collect()}
    assert got == {("C2", "one"), (None, None), (None, "x")}
    message = contracts.failure_message(dimensions.unmapped(told, dim, "code", "name"), F.coalesce("name", F.lit("?")), 2).first()
    assert message["total"] == 3 and message["mensagem"] == "?; one"


def abc(spark, rows):
    df = spark.createDataFrame(rows, "m int, p string, rev decimal(18,2), margin decimal(18,2), n bigint, stock int")
    out = marts.abc_curve(df, "m", "p", "rev", "margin", "n", slices=3)
    return {(r["m"], r["p"]): (r["CURVA_ABC"], r["MARGEM_PCT"]) for r in out.collect()}


def test_abc_classes(spark):
    D = Decimal
    got = abc(
        spark,
        [
            (1, "a", D(90), D(9), 1, None),  # 90 % alone is B: the row itself counts
            (1, "b", D(10), D(-5), 1, None),
            (2, "a", D(50), D(0), 1, 3),
            (2, "b", D(30), D(0), 1, 3),
            (2, "c", D(15), D(0), 1, 3),
            (2, "d", D(5), D(0), 1, 3),
            (2, "e", D(0), D(0), 0, 3),  # in stock, not sold
            (3, "a", D(0), D(7), 2, None),  # sold for nothing
        ],
    )
    assert {k: v[0] for k, v in got.items()} == {
        (1, "a"): "B", (1, "b"): "C", (2, "a"): "A", (2, "b"): "A", (2, "c"): "B", (2, "d"): "C", (2, "e"): "Sem Venda", (3, "a"): "C",
    }
    assert got[(1, "b")][1] == D("-50.0000") and got[(3, "a")][1] is None


def test_outer_join_fills_flows_but_not_positions(spark):
    flow = spark.createDataFrame([(1, Decimal(5), 2)], "k int, rev decimal(18,2), n bigint")
    position = spark.createDataFrame([(1, None), (2, 7)], "k int, stock int")
    got = {tuple(r) for r in marts.outer_position_join(flow, position, ["k"], ["rev", "n"]).collect()}
    assert got == {(1, Decimal("5.00"), 2, None), (2, Decimal("0.00"), 0, 7)}


def test_trace_counts_rows_both_ways(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "id string")
    source = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert tuple(contracts.trace(fact, source, "id").first()) == (4, 2, 4, 3, 2)
    held = spark.createDataFrame([("b",), ("a",)], "id string")
    row = contracts.trace_with_held(fact, held, source, "id").first().asDict()
    assert row == {"aceitas": 4, "quarentena": 2, "total_silver": 4, "ids": 2, "ausentes": 1, "extras": 2, "sobreposicoes": 2}


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_in_the_order_of_the_whole_frame(spark, parts):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 1, 2, 2, 2, 9]), rng.choice("ab")) for i in range(700)]
    df = spark.createDataFrame(rows, "i int, n int, s string").repartition(5)
    got = positions.with_position(df, [(F.col("n"), True), (F.col("s"), False), (F.col("i"), False)], "place", parts)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert [tuple(r) for r in got.orderBy("place").collect()] == [(*r, k) for k, r in enumerate(order, 1)]


def test_positions_of_rows_that_tie_and_of_none(spark):
    df = spark.createDataFrame([(1, "x")] * 400 + [(0, "y")], "n int, s string").repartition(4)
    got = positions.with_position(df, [(F.col("n"), False)]).collect()
    assert sorted(r["posicao"] for r in got) == list(range(1, 402)) and {r["posicao"] for r in got if r["n"] == 0} == {1}
    assert positions.with_position(df.where("n > 5"), [(F.col("n"), False)]).collect() == []


def test_measures_and_reports_give_out_their_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5), ("d", 2)], "g string, v int")
    named = measures.catalogue([measures.Measure("total", F.sum("v"))])
    got = measures.measure(df, ["g"], ["total"], named, order=[(F.sum("v"), True)], position="place")
    assert sorted(map(tuple, got.collect())) == [("a", 1, 4), ("b", 5, 1), ("c", 5, 2), ("d", 2, 3)]
    results = spark.createDataFrame([(3, "z"), (1, "x"), (2, "y")], "ORDEM int, TESTE string")
    assert sorted(map(tuple, contracts.report(results, "lugar").collect())) == [("x", 1), ("y", 2), ("z", 3)]
    assert [r["TESTE"] for r in contracts.report(results).collect()] == ["x", "y", "z"]


def test_span_of_a_calendar(spark):
    bounds = spark.sql("SELECT DATE'2024-01-01' AS first, DATE'9999-12-31' AS last")
    broken = dimensions.check_span(bounds, "1900-01-01", "2100-12-31", "span").first()
    assert not broken["passou"] and broken["ultima"] == "9999-12-31"
    assert dimensions.check_span(bounds, "1900-01-01", "9999-12-31", "span").first()["passou"]
    none = spark.sql("SELECT cast(NULL AS date) AS first, cast(NULL AS date) AS last")
    assert not dimensions.check_span(none, "1900-01-01", "2100-12-31", "span").first()["passou"]


def test_one_presence_answers_uniqueness_and_traces(spark):
    rng = random.Random(4)
    frames = {n: [(rng.choice([None, *range(30)]),) for _ in range(40)] for n in ("fact", "held", "source")}
    dfs = {n: spark.createDataFrame(r, "id int") for n, r in frames.items()}
    ids = contracts.presence("id", **dfs)
    for name, df in dfs.items():
        assert contracts.unique_in(ids, name, "c").first() == contracts.check_unique(df, "id", "c").first()
    assert contracts.traced_with_held(ids).first() == contracts.trace_with_held(dfs["fact"], dfs["held"], dfs["source"], "id").first()


def test_a_row_with_several_broken_keys_is_one_orphan(spark):
    fact = spark.createDataFrame([(1, 1), (9, 9), (None, 1), (1, 9), (1, 1)], "a int, b int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    refs = [contracts.Reference("a", dim, "k"), contracts.Reference("b", dim, "k")]
    assert contracts.orphan_rows(fact, refs).first()["linhas"] == 3
    assert {tuple(r) for r in contracts.orphans(fact, refs).collect()} == {(9, 9, 1), (None, 1, 1), (1, 9, 1)}
    plan = contracts.orphan_rows(fact, refs)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a" not in plan


def test_orphans_agree_with_the_quarantine(spark):
    fact = spark.createDataFrame(
        [("ok", 1, 5), ("held", None, 5), ("lost", None, 5), ("held", 2, 5), ("gone", 9, 5), ("ok", 1, 6), ("ok", 1, None)],
        "id string, sk int, p int",
    )
    customers, products = spark.createDataFrame([(1,), (2,)], "sk int"), spark.createDataFrame([(5,)], "p int")
    held = spark.createDataFrame([("held",)], "id string")
    customer = contracts.HeldReference("sk", customers, "sk", "id", held, "id")
    got = contracts.orphans(fact, [contracts.Reference("p", products, "p")], customer).collect()
    assert {(r["id"], r["sk"], r["p"]) for r in got} == {
        ("lost", None, 5), ("held", 2, 5), ("gone", 9, 5), ("ok", 1, 6), ("ok", 1, None),
    }
    assert tuple(contracts.coverage(fact, held, "sk", "id", "id").first()) == (1, 1)


def test_null_never_passes(spark):
    empty = spark.createDataFrame([], "x decimal(18,2)")
    result = contracts.reconcile_totals(1, "t", contracts.totals(empty, x="x"), contracts.totals(empty, x="x"))
    assert result.first()["PASSOU"] is False
    with pytest.raises(contracts.ContractBroken, match="t calculado="):
        contracts.fail_on(result)
    rows = spark.createDataFrame([(None,), (1,)], "x int")
    check = contracts.check_rows(rows, [contracts.Contract("c", F.col("x") > 0)]).first()
    assert (check["violacoes"], check["passou"]) == (1, False)


def test_unique_needs_a_key_on_every_row(spark):
    def passed(rows):
        return contracts.check_unique(spark.createDataFrame(rows, "k string"), "k", "t").first()["passou"]

    assert passed([("a",), ("b",)]) and not passed([("a",), ("a",)]) and not passed([("a",), (None,)])


def test_groups_compare_null_safely(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, n int")
    b = spark.createDataFrame([(None, 1), ("x", 5), ("z", 3)], "k string, m int")
    assert contracts.compare_groups(a, b, ["k"], {"n": "m"}).first()[0] == 3


def test_failed_proofs_are_listed_together(spark):
    rows = [(1, "a", "1", "2", False), (2, "b", "1", "1", True), (3, "c", None, "1", None)]
    df = spark.createDataFrame(rows, "ORDEM int, TESTE string, VALOR_CALCULADO string, VALOR_ESPERADO string, PASSOU boolean")
    with pytest.raises(contracts.ContractBroken) as e:
        contracts.fail_on(df)
    assert str(e.value) == "Testes Gold falharam: a calculado=1 esperado=2; c calculado=NULL esperado=1"
    contracts.fail_on(df.filter("ORDEM = 2"))
    assert contracts.report(df).columns[0] == "TESTE"


def test_measures_filter_first_and_order_by_what_is_not_shown(spark):
    df = spark.createDataFrame([("b", 2, 5), ("a", 1, 7), ("b", 2, 1), ("c", 0, 9)], "stage string, rank int, v int")
    m = measures.catalogue([measures.Measure("total", F.sum("v")), measures.Measure("n", F.count("v"))])
    got = measures.measure(df, ["stage"], ["total"], m, {"stage": ["a", "b"], "absent": 1}, [(F.min("rank"), False)], ["absent"])
    assert [tuple(r) for r in got.collect()] == [("a", 7), ("b", 6)] and got.columns == ["stage", "total"]
    with pytest.raises(ValueError, match="stge"):
        measures.measure(df, ["stage"], ["total"], m, {"stge": "a"})
    down = measures.measure(df, ["stage"], ["total"], m, order=[(F.sum("v"), True)])
    assert [r["total"] for r in down.collect()] == [9, 7, 6]
    long = measures.series_long(df, ["stage"], ["total", "n"], m, "s", "v").collect()
    assert {tuple(r) for r in long} >= {("a", "total", 7), ("a", "n", 1)} and len(long) == 6
    assert [r[0] for r in measures.choices(df, "stage").collect()] == ["a", "b", "c"]
