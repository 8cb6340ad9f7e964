import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from garimpo.functions import (
    PROBLEM,
    canonical,
    code_name,
    date_key,
    format_phone,
    lenient_cast,
    month_key,
    month_of_key,
    parse_date,
    parse_month,
    project,
    record_key,
    row_json,
    split_rejects,
    stage_rank,
    strict_cast,
    surrogate,
    title_case,
    tri_bool,
)


def texts(spark, values, column, result="x"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.select("i", column.alias("y")).orderBy("i").select("y").collect()]


def test_canonical_labels_fold_known_spellings_and_pass_others_trimmed(spark):
    labels = {"olx": "OLX", "loja física": "Loja Física"}
    got = texts(spark, [" oLX ", "LOJA FÍSICA", " Outro ", "  ", None], canonical("x", labels))
    assert got == ["OLX", "Loja Física", "Outro", None, None]


def test_title_case_repairs_what_initcap_leaves(spark):
    got = texts(spark, ["  ana LIMA ", "t-cross highline", " ", None], title_case("x", {"T-cross": "T-Cross"}))
    assert got == ["Ana Lima", "T-Cross Highline", None, None]


def test_phone_shapes(spark):
    given = ["33334444", "933334444", "(21) 3333-4444", "+21 93333.4444", "1234567", "123456789012", "2133A34444", " ", None]
    want = ["3333-4444", "93333-4444", "(21) 3333-4444", "(21) 93333-4444", None, None, None, None, None]
    assert texts(spark, given, format_phone("x")) == want


def test_dates_day_first_then_month_first_then_iso(spark):
    given = ["05/04/2024", "04/25/2024", " 2024-04-05 ", "31/02/2024", "5/4/2024", "2024-04-05 10:00", "05/04/0000", "x", "", None]
    d = datetime.date
    want = [d(2024, 4, 5), d(2024, 4, 25), d(2024, 4, 5), None, None, None, None, None, None, None]
    assert texts(spark, given, parse_date("x")) == want


def test_months_three_ways(spark):
    given = ["2024-03", " 2024/03", "03/2024 ", "2024-13", "2024-03-01", "3/2024", None]
    first = datetime.date(2024, 3, 1)
    assert texts(spark, given, parse_month("x")) == [first, first, first, None, None, None, None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet="0123456789/- ", max_size=11), min_size=20, max_size=40))
def test_dates_agree_with_the_formatter(spark, values):
    mixed = values + ["29/02/2024", "29/02/2023", "12/31/1999", "0024-01-01", "9999-12-31"]
    formats = ("dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd")
    by_formatter = F.coalesce(*[F.try_to_date(F.trim("x"), f) for f in formats])
    assert texts(spark, mixed, parse_date("x")) == texts(spark, mixed, by_formatter)


def test_strict_and_lenient_numbers(spark):
    df = spark.createDataFrame([(" 12 ",), ("-1",), ("",), (None,), ("abc",), ("5.7",), ("99999999999",)], "x string")
    out = project(df, {"n": strict_cast("x", "int", "t: N"), "m": lenient_cast("x", "decimal(15,2)")})
    rows = [(r["n"], r["m"], r[PROBLEM]) for r in out.collect()]
    assert rows == [
        (12, Decimal("12.00"), None),
        (-1, Decimal("-1.00"), None),
        (None, None, None),
        (None, None, None),
        (None, None, "t: N invalido"),
        (None, Decimal("5.70"), "t: N invalido"),
        (None, Decimal("99999999999.00"), "t: N invalido"),
    ]
    good, bad = split_rejects(out)
    assert good.count() == 4 and bad.count() == 3 and PROBLEM not in good.columns


def test_refusal_survives_column_pruning(spark):
    df = spark.createDataFrame([("abc", "k")], "x string, k string")
    out = project(df, {"k": F.col("k"), "n": strict_cast("x", "int", "t: N")})
    assert out.filter(F.col(PROBLEM).isNotNull()).select("k").count() == 1


def test_three_valued_boolean(spark):
    df = spark.createDataFrame([(v,) for v in (" SIM", "1", "Não", "", None, "nao")], "x string")
    out = project(df, {"b": tri_bool("x", ("sim", "s", "1"), ("não",), "desconhecido")}).collect()
    assert [(r["b"], r[PROBLEM]) for r in out] == [
        (True, None), (True, None), (False, None), (None, None), (None, None), (None, "desconhecido"),
    ]


def test_name_follows_from_code(spark):
    df = spark.createDataFrame([(" vw-pol",), ("VW-XXX",), (None,)], "x string")
    out = project(df, {"n": code_name("x", {"VW-POL": "Polo"}, "codigo")}).collect()
    assert [(r["n"], r[PROBLEM]) for r in out] == [("Polo", None), (None, "codigo: VW-XXX"), (None, "codigo: <NULL>")]


def test_stage_rank(spark):
    assert texts(spark, ["a", "b", "z", None], stage_rank("x", ["a", "b"])) == [1, 2, 99, 99]


def test_keys(spark):
    df = spark.createDataFrame([("A", 1, None)], "a string, v int, n string")
    row = df.select(
        record_key("a", "v"), record_key("a", "n"), row_json(["a", "n"]), surrogate("e", "a"), F.xxhash64(F.lit("e|A"))
    ).first()
    assert row[0] == "A-1" and row[1] is None and row[2] == '{"a":"A","n":null}' and row[3] == row[4]


@pytest.mark.parametrize("day,key,month", [("2024-03-22", 20240322, 20240301), ("0024-12-01", 241201, 241201)])
def test_date_keys(spark, day, key, month):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d"))
    assert tuple(df.select(date_key("d"), month_key("d"), month_of_key(date_key("d"))).first()) == (key, month, month)


def test_dates_of_one_shape_share_its_test(frame):
    """Day first and month first look alike: the shape is tested once for both, so a date costs two patterns, not three."""
    df = frame(["d"], [("31/12/2023",), ("12/31/2023",), (" 2024-02-29 ",), ("31/31/2023",), ("x",), (None,)])
    out = df.select(parse_date("d").alias("d"))
    assert [str(r["d"]) for r in out.collect()] == ["2023-12-31", "2023-12-31", "2024-02-29", "None", "None", "None"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 2
