"""One query per operator, straight over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions import (
    PROBLEM,
    blank_to_null,
    canonical,
    code_name,
    content_hash,
    count_where,
    date_key,
    distinct_count,
    distinct_tuples,
    format_phone,
    lenient_cast,
    money_avg,
    money_sum,
    parse_date,
    parse_month,
    project,
    record_key,
    safe_ratio,
    sorted_set,
    stage_rank,
    strict_cast,
    tri_bool,
)
from garimpo.operators.contracts import (
    ROWS,
    Contract,
    HeldReference,
    Reference,
    absent,
    check_fact,
    check_lineage,
    check_rows,
    check_unique,
    checked_lineage,
    checked_rows,
    compare_groups,
    duplicates,
    failure_message,
    orphan_marks,
    overlap,
    preview,
    reconcile_totals,
    row_counts,
    totals,
    trace,
    trace_with_held,
)
from garimpo.operators.dimensions import (
    calendar_dim,
    check_span,
    conformed_dim,
    date_bounds,
    mapped_dim,
    shared_dim,
    union_all,
    union_distinct,
    unmapped,
    value_dim,
)
from garimpo.operators.facts import lookup, lookup_unless_held
from garimpo.operators.marts import abc_curve, funnel, monthly_rollup, outer_position_join
from garimpo.operators.measures import Measure, catalogue, measure, series_long
from garimpo.operators.positions import with_position
from garimpo.operators.quarantine import attribute_conflicts, evidence, evidence_arrays, exclude, grain_conflicts
from garimpo.operators.running import running_total
from garimpo.operators.shift import SPLIT, detect_shift, realign
from garimpo.operators.versions import consolidate, load_summary, number_versions
from garimpo.plans import spec
from garimpo.session import scratch, shared_dir
from garimpo.sources.control import expected_counts, reconcile_counts, table_counts
from garimpo.sources.raw import SourceSpec, inspect, land
from garimpo.sources.tables import Release, current, publish, retire
from workload import raw
from workload.base import Query, plain
from workload.lake import Lake, raw_files
from workload.raw import load


def _money(c: str):
    """Money of the driver tables is double; as a decimal its totals do not depend on the order of addition."""
    return F.col(c).cast("decimal(18,2)")


# --- duplicates and versions -----------------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The whole text goes into the digest, and only the digest through the shuffle.
    return load(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"), "lang", "source")


def consolidate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(_documents(spark, sf_dir), ["digest", "lang", "source"])


CONSOLIDATE = """
SELECT sha256(text) AS digest, lang, source, count(*) AS _linhas_origem FROM documents GROUP BY 1, 2, 3"""


def duplicate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_summary("documents", consolidate_duplicates(spark, sf_dir))


DUPLICATE_SUMMARY = """
SELECT 'documents' AS tabela, count(*) AS registros_silver, cast(sum(n) AS bigint) AS linhas_bronze,
       cast(sum(n) - count(*) AS bigint) AS duplicatas_exatas_removidas
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)"""

_EVENT = ["event_id", "event_type", "props"]


def version_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("string").alias("event_id"), *_EVENT[1:])
    numbered = number_versions(events, ["user_id"], _EVENT)
    return numbered.select(record_key("user_id", "_versao").alias("id_registro"), content_hash(_EVENT).alias("digest"))


VERSION_KEYS = """
SELECT user_id || '-' || row_number() OVER (PARTITION BY user_id ORDER BY digest) AS id_registro, digest
FROM (SELECT user_id, sha256(cast(to_json({'event_id': cast(event_id AS varchar), 'event_type': event_type,
      'props': props}) AS varchar)) AS digest FROM events)"""

# --- cleaning functions ----------------------------------------------------------------------------------------------

_TYPE_LABELS = {"economy": "Economy", "large": "Large", "medium": "Medium", "promo": "Promo", "promoo": "Promo"}
_BRANDS = {f"BRAND#{i}": f"Marca {i}" for i in range(1, 21)}
LABELS = """
SELECT p_partkey,
       CASE p_partkey % 6 WHEN 0 THEN lower(p_type) WHEN 1 THEN ' ' || p_type || '  ' WHEN 2 THEN '  '
                          WHEN 3 THEN cast(NULL AS string) WHEN 4 THEN 'Promoo' ELSE p_type || '?' END AS label,
       CASE p_partkey % 2 WHEN 0 THEN ' ' || lower(p_brand) ELSE p_brand END AS code
FROM {part}"""


def canonical_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.derive(spark, sf_dir, LABELS, ["p_partkey", "label", "code"])
    return project(
        rows,
        {
            "p_partkey": F.col("p_partkey"),
            "label": canonical("label", _TYPE_LABELS),
            "trimmed": blank_to_null("label"),
            "brand": code_name("code", _BRANDS, "codigo desconhecido"),
        },
    )


CANONICAL = f"""
SELECT p_partkey,
       CASE lower(trim(label)) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPE_LABELS.items())}
            ELSE nullif(trim(label), '') END AS label,
       nullif(trim(label), '') AS trimmed,
       CASE WHEN known THEN 'Marca ' || substr(trim(code), 7) END AS brand,
       CASE WHEN NOT known THEN 'codigo desconhecido: ' || code END AS _problema
FROM (SELECT *, cast(substr(trim(code), 7) AS int) <= 20 AS known FROM ({raw.plain_sql(LABELS)}))"""

NUMBERS = """
SELECT event_id,
       CASE event_id % 7 WHEN 0 THEN 'abc' WHEN 1 THEN ' ' WHEN 2 THEN cast(NULL AS string)
            WHEN 3 THEN ' ' || cast(user_id AS string) || ' ' WHEN 4 THEN '5.7' WHEN 5 THEN '-' || cast(user_id AS string)
            ELSE '99999999999' END AS age,
       CASE event_id % 5 WHEN 0 THEN '1234.50' WHEN 1 THEN ' -0.25' WHEN 2 THEN 'R$ 10' WHEN 3 THEN '' ELSE
            cast(event_id AS string) || '.05' END AS price,
       CASE event_id % 7 WHEN 0 THEN ' SIM' WHEN 1 THEN 's' WHEN 2 THEN '1' WHEN 3 THEN 'Não' WHEN 4 THEN ' '
            WHEN 5 THEN cast(NULL AS string) ELSE 'talvez' END AS drive
FROM {events}"""


def strict_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.derive(spark, sf_dir, NUMBERS, ["event_id", "age", "price", "drive"])
    return plain(
        project(
            rows,
            {
                "event_id": F.col("event_id"),
                "age": strict_cast("age", "int", "crm: IDADE"),
                "price": lenient_cast("price", "decimal(15,2)"),
                "drive": tri_bool("drive", spec.TEST_DRIVE_YES, spec.TEST_DRIVE_NO, "FEZ_TEST_DRIVE desconhecido"),
            },
        )
    )


STRICT_CASTS = f"""
SELECT event_id, CASE WHEN whole THEN try_cast(trim(age) AS int) END::bigint AS age,
       try_cast(trim(price) AS decimal(15,2))::double AS price,
       CASE WHEN lower(trim(drive)) IN ('sim', 's', '1') THEN true WHEN lower(trim(drive)) = 'não' THEN false END AS drive,
       nullif(concat_ws('; ', CASE WHEN trim(age) <> '' AND (NOT whole OR try_cast(trim(age) AS int) IS NULL)
                                   THEN 'crm: IDADE invalido' END,
                        CASE WHEN trim(drive) NOT IN ('', 'SIM', 's', '1', 'Não') THEN 'FEZ_TEST_DRIVE desconhecido' END),
              '') AS _problema
FROM (SELECT *, regexp_full_match(trim(age), '-?[0-9]+') AS whole FROM ({raw.plain_sql(NUMBERS)}))"""


def _date_text(d: str, key: str) -> str:
    y, m, dd = raw.text(f"year({d})"), raw.pad(f"month({d})", 2), raw.pad(f"day({d})", 2)
    return (
        f"CASE {key} % 5 WHEN 0 THEN ' ' || {dd} || '/' || {m} || '/' || {y} WHEN 1 THEN {m} || '/' || {dd} || '/' || {y} "
        f"WHEN 2 THEN {y} || '-' || {m} || '-' || {dd} || ' ' WHEN 3 THEN '31/02/' || {y} ELSE 'data-invalida' END"
    )


def _month_text(d: str, key: str) -> str:
    y, m = raw.text(f"year({d})"), raw.pad(f"month({d})", 2)
    return (
        f"CASE {key} % 4 WHEN 0 THEN {y} || '-' || {m} WHEN 1 THEN {y} || '/' || {m} || ' ' "
        f"WHEN 2 THEN {m} || '/' || {y} ELSE '13/' || {y} END"
    )


DATES = f"""
SELECT o_orderkey, {_date_text('o_orderdate', 'o_orderkey')} AS told, {_month_text('o_orderdate', 'o_orderkey')} AS month_told
FROM {{orders}}"""


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.derive(spark, sf_dir, DATES, ["o_orderkey", "told", "month_told"])
    return plain(rows.select("o_orderkey", parse_date("told").alias("day"), parse_month("month_told").alias("month")))


PARSE_DATES = f"""
SELECT o_orderkey,
       cast(cast(coalesce(try_strptime(trim(told), '%d/%m/%Y'), try_strptime(trim(told), '%m/%d/%Y'),
            try_strptime(trim(told), '%Y-%m-%d')) AS date) AS varchar) AS day,
       cast(cast(coalesce(try_strptime(trim(month_told) || '-01', '%Y-%m-%d'),
            try_strptime(trim(month_told) || '/01', '%Y/%m/%d'),
            try_strptime('01/' || trim(month_told), '%d/%m/%Y')) AS date) AS varchar) AS month
FROM ({raw.plain_sql(DATES)})"""

PHONES = """
SELECT c_custkey,
       CASE c_custkey % 9
         WHEN 0 THEN lpad(cast(c_custkey AS string), 8, '9') WHEN 1 THEN ' ' || lpad(cast(c_custkey AS string), 9, '9')
         WHEN 2 THEN '(11) ' || lpad(cast(c_custkey AS string), 8, '3')
         WHEN 3 THEN '+' || lpad(cast(c_custkey AS string), 11, '2') WHEN 4 THEN lpad(cast(c_custkey AS string), 7, '1')
         WHEN 5 THEN lpad(cast(c_custkey AS string), 12, '1') WHEN 6 THEN '11 9A' || cast(c_custkey AS string)
         WHEN 7 THEN '  ' ELSE cast(NULL AS string) END AS phone
FROM {customer}"""


def format_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.derive(spark, sf_dir, PHONES, ["c_custkey", "phone"])
    return rows.select("c_custkey", format_phone("phone").alias("phone"))


FORMAT_PHONES = f"""
SELECT c_custkey, CASE
  WHEN NOT regexp_full_match(trim(phone), '[0-9() +.-]+') THEN NULL
  WHEN length(d) = 8 THEN substr(d, 1, 4) || '-' || substr(d, 5)
  WHEN length(d) = 9 THEN substr(d, 1, 5) || '-' || substr(d, 6)
  WHEN length(d) = 10 THEN '(' || substr(d, 1, 2) || ') ' || substr(d, 3, 4) || '-' || substr(d, 7)
  WHEN length(d) = 11 THEN '(' || substr(d, 1, 2) || ') ' || substr(d, 3, 5) || '-' || substr(d, 8) END AS phone
FROM (SELECT *, regexp_replace(trim(phone), '[^0-9]', '', 'g') AS d FROM ({raw.plain_sql(PHONES)}))"""


def repair_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw sale with its moved columns put back, before any typing; those whose split cannot be placed with the reason alone."""
    rows = Lake(spark, sf_dir)["defeitos_erp"]
    found = detect_shift(spec.SALE_SHIFT)
    fixed = realign(rows.withColumns({SPLIT: found.value, PROBLEM: found.problem}), spec.SALE_SHIFT)
    values = {
        **{a: lenient_cast(a, "decimal(15,2)") for a in spec.SALE_SHIFT.amounts},
        "ano": F.trim("ano"),
        "modelo": F.col("modelo"),
        "data_entrega": parse_date("data_entrega"),
        "cor_produto": canonical("cor_produto", spec.labels(spec.COLOURS, spec.COLOUR_SPELLINGS)),
        "zero_km_ou_seminovo": canonical("zero_km_ou_seminovo", spec.labels(spec.CONDITIONS)),
    }
    placed = F.col(PROBLEM).isNull()
    shown = [F.when(placed, v).alias(n) for n, v in values.items()]
    return plain(fixed.select(F.upper(F.trim("id_cliente")).alias("id_cliente"), SPLIT, PROBLEM, *shown))


_REPAIRED = {
    SPLIT: "cast(split AS bigint)",
    "valor_padrao": "cast(price AS double) / 100",
    "desconto": "cast(off AS double) / 100",
    "valor_faturamento": "cast(billed AS double) / 100",
    "custo": "cast(cost AS double) / 100",
    "ano": "cast(t_ano AS varchar)",
    "modelo": "lower(t_modelo)",
    "data_entrega": "cast(t_entrega AS varchar)",
    "cor_produto": "t_cor",
    "zero_km_ou_seminovo": "t_condicao",
}
REPAIR_SHIFTED = f"""
SELECT t_id_cliente AS id_cliente, t_problema AS {PROBLEM},
       {', '.join(f'CASE WHEN t_problema IS NULL THEN {v} END AS {n}' for n, v in _REPAIRED.items())}
FROM ({raw.plain_sql(raw.SALES_REFUSED)})"""

# --- quarantine and dimensions ---------------------------------------------------------------------------------------


def _parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers told under one number: the nation of both, the segment of the customer."""
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party"), F.col("s_nationkey").alias("nation")
    )
    return union_all(customers, suppliers)


_PARTIES = """
WITH parties AS (
  SELECT c_custkey AS party, c_nationkey AS nation, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_suppkey, s_nationkey, NULL FROM supplier),
held AS (SELECT party FROM parties GROUP BY party HAVING count(DISTINCT nation) > 1 OR count(DISTINCT segment) > 1)"""


def conflict_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parties(spark, sf_dir)
    held = attribute_conflicts(rows, "party", ["nation", "segment"]).held
    return evidence(rows, held, "party", ["nation", "segment"])


CONFLICT_EVIDENCE = _PARTIES + """
SELECT DISTINCT party, 'nation' AS atributo, cast(nation AS varchar) AS valor FROM parties SEMI JOIN held USING (party)
WHERE nation IS NOT NULL
UNION ALL
SELECT DISTINCT party, 'segment', segment FROM parties SEMI JOIN held USING (party) WHERE segment IS NOT NULL"""


def conflict_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = conflict_evidence(spark, sf_dir)
    return plain(evidence_arrays(values, "party", {"nation": "nations", "segment": "segments"}).drop("PARTE"))


def conflict_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers and parts of each return flag, in parts of 500 values: far more than one part holds."""
    lines = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", "l_partkey")
    held = lines.select("l_returnflag").distinct()
    values = evidence(lines, held, "l_returnflag", ["l_suppkey", "l_partkey"])
    parts = evidence_arrays(values, "l_returnflag", {"l_suppkey": "suppliers", "l_partkey": "parts"}, 500)
    return plain(parts.withColumnRenamed("PARTE", "part"))


CONFLICT_PARTS = """
WITH v AS (
  SELECT DISTINCT l_returnflag, 's' AS a, cast(l_suppkey AS varchar) AS x FROM lineitem WHERE l_suppkey IS NOT NULL
  UNION ALL SELECT DISTINCT l_returnflag, 'p', cast(l_partkey AS varchar) FROM lineitem WHERE l_partkey IS NOT NULL
), n AS (
  SELECT *, (row_number() OVER (PARTITION BY l_returnflag, a ORDER BY x) - 1) // 500 + 1 AS part FROM v
)
SELECT l_returnflag, cast(part AS bigint) AS part,
       coalesce(string_agg(x, '|' ORDER BY x) FILTER (a = 's'), '') AS suppliers,
       coalesce(string_agg(x, '|' ORDER BY x) FILTER (a = 'p'), '') AS parts
FROM n GROUP BY l_returnflag, part"""


def version_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions where one key holds most of the rows."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    flag = F.when(F.col("l_orderkey") % 20 == 0, F.col("l_returnflag")).otherwise("*")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    numbered = number_versions(lines.withColumn("flag", flag), ["flag"], columns)
    totals = numbered.groupBy("flag").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("_versao").alias("versions"), F.min("_versao").alias("first"), F.max("_versao").alias("last")
    )
    return plain(totals)


VERSION_ONE_KEY = """
SELECT CASE WHEN l_orderkey % 20 = 0 THEN l_returnflag ELSE '*' END AS flag, count(*) AS records, count(*) AS versions,
       1::bigint AS first, count(*) AS last
FROM lineitem GROUP BY 1"""


CONFLICT_ARRAYS = _PARTIES + """
SELECT party, array_to_string(list_sort(list(DISTINCT cast(nation AS varchar))), '|') AS nations,
       coalesce(array_to_string(list_sort(list(DISTINCT segment) FILTER (segment IS NOT NULL)), '|'), '') AS segments
FROM parties SEMI JOIN held USING (party) GROUP BY party"""


def conformed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = attribute_conflicts(_parties(spark, sf_dir), "party", ["nation", "segment"]).accepted
    return plain(conformed_dim(accepted, "party", "sk", "party").drop("sk"))


CONFORMED = _PARTIES + """
SELECT party, cast(max(nation) AS bigint) AS nation, max(segment) AS segment
FROM parties ANTI JOIN held USING (party) GROUP BY party"""

_LINE = ["l_orderkey", "l_linenumber"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(*_LINE, "l_partkey", "l_quantity")


def grain_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(grain_conflicts(_lines(spark, sf_dir), _LINE).held)


def grain_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(grain_conflicts(_lines(spark, sf_dir), _LINE).accepted)


_GRAINS = """
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n """
GRAIN_HELD, GRAIN_ACCEPTED = _GRAINS + "> 1", _GRAINS + "= 1"


def grain_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated grains themselves."""
    return plain(duplicates(load(spark, sf_dir, "lineitem"), _LINE))


GRAIN_REPEATED = """
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, count(*) AS linhas
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""


def exclude_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without any line whose grain is held."""
    held = grain_conflicts(_lines(spark, sf_dir), _LINE).held.select(F.col("l_orderkey").alias("o_orderkey"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return exclude(orders, held, "o_orderkey")


EXCLUDE_HELD = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) h
  WHERE h.l_orderkey = o.o_orderkey)"""

# Brands 21 to 25 are missing from the mapping, and brand 7 goes by another code there.
_PAIRS = [(f"B{7 + 100 if i == 7 else i:03d}", f"Brand#{i}") for i in range(1, 21)]


def mapped_dimension_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    dim = mapped_dim(spark, _PAIRS, "sk", ("code", "name"), "brand")
    number = F.lpad(F.substring("p_brand", 7, 3), 3, "0")
    told = union_all(
        part.select(F.lit("NAME").alias("system"), F.lit(None).cast("string").alias("code"), F.col("p_brand").alias("name")),
        part.select(F.lit("CODE").alias("system"), F.concat(F.lit("B"), number).alias("code"), F.col("p_brand").alias("name")),
    )
    return unmapped(told, dim, "code", "name")


MAPPED = f"""
WITH dim(code, name) AS (VALUES {', '.join(f"('{c}', '{n}')" for c, n in _PAIRS)}),
told AS (
  SELECT 'NAME' AS system, cast(NULL AS varchar) AS code, p_brand AS name FROM part
  UNION ALL SELECT 'CODE', 'B' || lpad(substr(p_brand, 7), 3, '0'), p_brand FROM part)
SELECT DISTINCT t.* FROM told t LEFT JOIN dim d ON t.name = d.name AND (t.code IS NULL OR t.code = d.code)
WHERE d.code IS NULL"""


def shared_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("status"))
    return shared_dim([orders, lines], "status", "sk", "status").drop("sk")


SHARED = "SELECT o_orderstatus AS status FROM orders UNION SELECT l_linestatus FROM lineitem"


def value_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two value dimensions and the uniqueness of their keys."""
    segments = value_dim(load(spark, sf_dir, "customer"), "c_mktsegment", "sk", "segment")
    priorities = value_dim(load(spark, sf_dir, "orders"), "o_orderpriority", "sk", "priority")
    return union_all(check_unique(segments, "sk", "segment"), check_unique(priorities, "sk", "priority"))


VALUE_DIMENSIONS = """
SELECT 'segment' AS contrato, count(DISTINCT c_mktsegment) AS linhas, count(DISTINCT c_mktsegment) AS chaves, true AS passou
FROM customer
UNION ALL SELECT 'priority', count(DISTINCT o_orderpriority), count(DISTINCT o_orderpriority), true FROM orders"""


def union_of_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids of three tables."""
    return union_distinct(
        load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")),
        load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")),
        load(spark, sf_dir, "events").select(F.col("user_id").alias("id")),
    )


UNION_OF_IDS = "SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey FROM supplier UNION SELECT user_id FROM events"


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = date_bounds(
        [(load(spark, sf_dir, "orders"), ["o_orderdate"]), (load(spark, sf_dir, "lineitem"), ["l_shipdate"])]
    )
    return calendar_dim(bounds, spec.MONTHS, spec.WEEKDAYS)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_calendar(spark, sf_dir))


def calendar_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar's bounds against two spans, one of which they leave."""
    bounds = date_bounds([(load(spark, sf_dir, "orders"), ["o_orderdate"]), (load(spark, sf_dir, "lineitem"), ["l_shipdate"])])
    return plain(
        union_all(check_span(bounds, "1990-01-01", "2005-12-31", "wide"), check_span(bounds, "1990-01-01", "1996-06-30", "narrow"))
    )


CALENDAR_SPAN = """
WITH dates AS (SELECT cast(o_orderdate AS date) AS d FROM orders UNION ALL SELECT cast(l_shipdate AS date) FROM lineitem),
bounds AS (SELECT min(d) AS a, max(d) AS b FROM dates)
SELECT c.contrato, cast(a AS varchar) AS primeira, cast(b AS varchar) AS ultima, a >= DATE '1990-01-01' AND b <= c.upto AS passou
FROM bounds, (VALUES ('wide', DATE '2005-12-31'), ('narrow', DATE '1996-06-30')) c(contrato, upto)"""

CALENDAR = f"""
WITH dates AS (SELECT cast(o_orderdate AS date) AS d FROM orders UNION ALL SELECT cast(l_shipdate AS date) FROM lineitem),
days AS (SELECT cast(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS date) AS d FROM dates)
SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS SK_DATA, cast(d AS varchar) AS DATA, year(d) AS ANO, month(d) AS MES,
       CASE month(d) {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(spec.MONTHS, 1))} END AS NOME_MES,
       quarter(d) AS TRIMESTRE,
       CASE dayofweek(d) {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(spec.WEEKDAYS))} END AS DIA_SEMANA
FROM days"""

# --- facts -----------------------------------------------------------------------------------------------------------


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's customer and date, as a sales fact."""
    lines = raw.spread(load(spark, sf_dir, "lineitem"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    price = _money("l_extendedprice")
    rate = F.lit(1).cast("decimal(3,0)") - F.col("l_discount").cast("decimal(4,2)")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("o_custkey").alias("client"),
        date_key("o_orderdate").alias("order_key"),
        date_key("l_shipdate").alias("ship_key"),
        price.alias("list_price"),
        (price * rate).cast("decimal(18,2)").alias("revenue"),
        (_money("l_quantity") * 900).cast("decimal(18,2)").alias("cost"),
    )


def sales_mart_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).withColumn("margin", (F.col("revenue") - F.col("cost")).cast("decimal(18,2)"))


_SALES = """
WITH sales AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey AS client, cast(o_orderdate AS date) AS ordered,
         cast(l_shipdate AS date) AS shipped, cast(round(l_extendedprice * 100) AS bigint) AS price,
         cast(floor((cast(round(l_extendedprice * 100) AS bigint) * (100 - cast(round(l_discount * 100) AS bigint)) + 50) / 100.0)
              AS bigint) AS revenue,
         cast(l_quantity AS bigint) * 90000 AS cost
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""
_SHIP_MONTH = "cast(strftime(shipped, '%Y%m01') AS bigint)"


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line with its part, supplier and customer and the calendar in two roles."""
    f = _sales(spark, sf_dir)
    # Written first: it is used twice, and its size is then known.
    days = publish(_calendar(spark, sf_dir), f"{shared_dir(spark)}/calendar-{uuid.uuid4().hex}")
    f = lookup(f, load(spark, sf_dir, "part"), "l_partkey", "p_partkey", {"p_brand": "brand"})
    f = lookup(f, load(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", {"s_name": "seller"})
    f = lookup(f, load(spark, sf_dir, "customer"), "client", "c_custkey", {"c_name": "client_name"})
    f = lookup(f, days, "order_key", "SK_DATA", {"NOME_MES": "order_month"})
    f = lookup(f, days, "ship_key", "SK_DATA", {"DIA_SEMANA": "ship_weekday"})
    return plain(f.select("l_orderkey", "l_linenumber", "brand", "seller", "client_name", "order_month", "ship_weekday", "revenue"))


STAR_FACT = _SALES + f"""
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, p_brand AS brand, s_name AS seller, c_name AS client_name,
       CASE month(ordered) {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(spec.MONTHS, 1))} END AS order_month,
       CASE dayofweek(shipped) {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(spec.WEEKDAYS))} END AS ship_weekday,
       cast(revenue AS double) / 100 AS revenue
FROM sales LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
     LEFT JOIN customer ON client = c_custkey"""


def _held_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_conflicts(_parties(spark, sf_dir), "party", ["nation", "segment"]).held


def conformed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and whether the customer has a key, without joining the customers."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    f = lookup_unless_held(orders, _held_parties(spark, sf_dir), "o_custkey", "party", "sk", "party")
    return f.select("o_orderkey", "o_custkey", F.col("sk").isNotNull().alias("has_key"))


CONFORMED_LOOKUP = _PARTIES + """
SELECT o_orderkey, o_custkey, o_custkey NOT IN (SELECT party FROM held) AS has_key FROM orders"""


def fact_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of a fact whose customer key is NULL exactly for the held customers."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    held = _held_parties(spark, sf_dir)
    fact = lookup_unless_held(orders, held, "o_custkey", "party", "sk", "party")
    return check_fact(fact, orders, "o_orderkey", ["o_orderdate"], "orders", held, "sk", "o_custkey", "party")


FACT_CONTRACT = """
SELECT 'orders' AS contrato, count(*) AS linhas, count(*) AS linhas_origem, count(DISTINCT o_orderkey) AS ids,
       0::bigint AS sem_chave_fora, 0::bigint AS com_chave_dentro, 0::bigint AS chaves_ausentes, true AS passou
FROM orders"""

# --- marts -----------------------------------------------------------------------------------------------------------


def seller_month_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, margin, records, distinct customers and average ticket per supplier and month."""
    return plain(
        monthly_rollup(
            sales_mart_input(spark, sf_dir),
            "ship_key",
            "month",
            ["l_suppkey"],
            {
                "revenue": money_sum("revenue"),
                "margin": money_sum("margin"),
                "records": F.count(F.lit(1)),
                "clients": distinct_count("client"),
                "ticket": money_avg("revenue"),
            },
        )
    )


SELLER_MONTH = _SALES + f"""
SELECT l_suppkey, {_SHIP_MONTH} AS month, cast(sum(revenue) AS double) / 100 AS revenue,
       cast(sum(revenue - cost) AS double) / 100 AS margin, count(*) AS records, count(DISTINCT client) AS clients,
       floor(cast(sum(revenue) AS double) / count(*) + 0.5) / 100 AS ticket
FROM sales GROUP BY 1, 2"""


def financial_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = {n: money_sum(n) for n in ("list_price", "revenue", "cost", "margin")}
    return plain(monthly_rollup(sales_mart_input(spark, sf_dir), "ship_key", "month", [], sums))


FINANCIAL = _SALES + f"""
SELECT {_SHIP_MONTH} AS month, cast(sum(price) AS double) / 100 AS list_price, cast(sum(revenue) AS double) / 100 AS revenue,
       cast(sum(cost) AS double) / 100 AS cost, cast(sum(revenue - cost) AS double) / 100 AS margin
FROM sales GROUP BY 1"""


def _part_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per part and month beside a stock position, which each part has in one month."""
    flow = monthly_rollup(
        sales_mart_input(spark, sf_dir),
        "ship_key",
        "month",
        ["l_partkey"],
        {"revenue": money_sum("revenue"), "margin": money_sum("margin"), "records": F.count(F.lit(1))},
    )
    position = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        (F.lit(19980001) + F.lit(100) * (F.col("p_partkey") % 12 + 1)).cast("int").alias("month"),
        F.col("p_size").alias("stock"),
    )
    return outer_position_join(flow, position, ["l_partkey", "month"], ["revenue", "margin", "records"])


def abc_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part_months(spark, sf_dir)
    return plain(abc_curve(rows, "month", "l_partkey", "revenue", "margin", "records", margin_pct="margin_pct", label="abc"))


_PART_MONTHS = _SALES + f""",
flow AS (
  SELECT l_partkey, {_SHIP_MONTH} AS month, cast(sum(revenue) AS bigint) AS revenue,
         cast(sum(revenue - cost) AS bigint) AS margin, count(*) AS records
  FROM sales GROUP BY 1, 2),
position AS (SELECT p_partkey AS l_partkey, 19980001 + 100 * (p_partkey % 12 + 1) AS month, p_size AS stock FROM part),
part_months AS (
  SELECT coalesce(f.l_partkey, p.l_partkey) AS l_partkey, coalesce(f.month, p.month) AS month,
         coalesce(revenue, 0) AS revenue, coalesce(margin, 0) AS margin, coalesce(records, 0) AS records, stock
  FROM flow f FULL JOIN position p ON f.l_partkey = p.l_partkey AND f.month = p.month),
shares AS (
  SELECT *, sum(revenue) OVER (PARTITION BY month) AS total,
         sum(revenue) OVER (PARTITION BY month ORDER BY revenue DESC, l_partkey ROWS UNBOUNDED PRECEDING) AS acc
  FROM part_months)"""
ABC = _PART_MONTHS + """
SELECT l_partkey, month, cast(revenue AS double) / 100 AS revenue, cast(margin AS double) / 100 AS margin, records,
       cast(stock AS bigint) AS stock,
       CASE WHEN revenue <> 0 THEN round(margin * 100 / revenue, 4) END AS margin_pct,
       CASE WHEN records = 0 THEN 'Sem Venda' WHEN total = 0 THEN 'C' WHEN acc / total <= 0.80 THEN 'A'
            WHEN acc / total <= 0.95 THEN 'B' ELSE 'C' END AS abc
FROM shares"""


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's total and the running total behind the curve."""
    rows = _part_months(spark, sf_dir).select("l_partkey", "month", "revenue")
    order = [F.col("revenue").desc(), F.col("l_partkey").asc()]
    return plain(running_total(rows, "revenue", ["month"], order, "accumulated", total="month_total"))


RUNNING = _PART_MONTHS + """
SELECT l_partkey, month, cast(revenue AS double) / 100 AS revenue, cast(acc AS double) / 100 AS accumulated,
       cast(total AS double) / 100 AS month_total
FROM shares"""


def funnel_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(
        "event_type", (F.col("user_id") % 8).alias("channel"), "user_id", date_key("ts").alias("day"),
        (F.col("value") > 100).alias("large"),
    )
    return plain(funnel(events, "day", "month", ["event_type", "channel"], "user_id", "large", ("records", "clients", "large")))


FUNNEL = """
SELECT event_type, user_id % 8 AS channel, cast(strftime(ts, '%Y%m01') AS bigint) AS month, count(*) AS records,
       count(DISTINCT user_id) AS clients, count(*) FILTER (value > 100) AS large
FROM events GROUP BY 1, 2, 3"""


def aggregate_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every aggregate of the library, by supplier nation."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey")
    clients = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = orders.join(clients, F.col("o_custkey") == F.col("c_custkey"))
    price = _money("o_totalprice")
    return plain(
        rows.groupBy("c_nationkey").agg(
            money_sum(price).alias("total"),
            money_avg(price).alias("mean"),
            F.round(safe_ratio(F.when(F.col("o_orderstatus") == "F", price), price), 4).alias("finished_share"),
            count_where(F.col("o_orderstatus") == "F").alias("finished"),
            distinct_count("o_custkey").alias("clients"),
            distinct_tuples("c_mktsegment", F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("pairs"),
            sorted_set("c_mktsegment").alias("segments"),
            F.min(stage_rank("o_orderstatus", ["F", "O"])).alias("first_stage"),
            F.max(stage_rank("o_orderstatus", ["F", "O"])).alias("last_stage"),
        )
    )


AGGREGATES = """
SELECT cast(c_nationkey AS bigint) AS c_nationkey, cast(sum(cents) AS double) / 100 AS total,
       floor(cast(sum(cents) AS double) / count(*) + 0.5) / 100 AS mean,
       round(cast(sum(cents) FILTER (o_orderstatus = 'F') AS double) / sum(cents), 4) AS finished_share,
       count(*) FILTER (o_orderstatus = 'F') AS finished, count(DISTINCT o_custkey) AS clients,
       count(DISTINCT c_mktsegment || coalesce(nullif(o_orderstatus, 'P'), '?')) AS pairs,
       array_to_string(list_sort(list(DISTINCT c_mktsegment)), '|') AS segments,
       cast(min(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 99 END) AS bigint) AS first_stage,
       cast(max(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 99 END) AS bigint) AS last_stage
FROM (SELECT *, cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders JOIN customer ON o_custkey = c_custkey)
GROUP BY c_nationkey"""

# --- contracts -------------------------------------------------------------------------------------------------------


def row_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    named = F.nullif(F.col("l_returnflag"), F.lit("A"))
    return check_rows(
        lines,
        [
            Contract("quantidade", F.col("l_quantity").between(1, 45)),
            Contract("dominio", named.isin("N", "R")),
            Contract("desconto", F.col("l_discount") < F.col("l_tax") + 0.09),
            Contract("chaves", F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull()),
        ],
    )


ROW_CONTRACTS = """
SELECT c.contrato, n AS linhas, c.violacoes, c.violacoes = 0 AS passou FROM (
  SELECT count(*) AS n, count(*) FILTER (NOT coalesce(l_quantity BETWEEN 1 AND 45, false)) AS a,
         count(*) FILTER (NOT coalesce(nullif(l_returnflag, 'A') IN ('N', 'R'), false)) AS b,
         count(*) FILTER (NOT coalesce(l_discount < l_tax + 0.09::double, false)) AS c,
         count(*) FILTER (l_orderkey IS NULL OR l_partkey IS NULL) AS d
  FROM lineitem), LATERAL (VALUES ('quantidade', a), ('dominio', b), ('desconto', c), ('chaves', d)) c(contrato, violacoes)"""


def unique_and_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = consolidate_duplicates(spark, sf_dir)
    return union_all(
        check_unique(load(spark, sf_dir, "orders"), "o_orderkey", "orders"),
        check_unique(load(spark, sf_dir, "lineitem"), "l_orderkey", "lineitem"),
        check_lineage(folded, load(spark, sf_dir, "documents"), "_linhas_origem", "documents"),
    )


UNIQUE_AND_LINEAGE = """
SELECT 'orders' AS contrato, count(*) AS linhas, count(DISTINCT o_orderkey) AS chaves, count(*) = count(DISTINCT o_orderkey) AS passou
FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), count(*) = count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'documents', count(*), count(*), true FROM documents"""


def trace_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against orders by order id: repeated ids, orders without lines, lines without orders."""
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return trace(lines, load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), "id")


TRACE = """
SELECT (SELECT count(*) FROM lineitem) AS linhas, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS ids,
       (SELECT count(*) FROM orders) AS linhas_origem,
       (SELECT count(*) FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey) AS ausentes,
       (SELECT count(*) FROM lineitem ANTI JOIN orders ON o_orderkey = l_orderkey) AS extras"""


def trace_three_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users accepted, suppliers held, customers as the source."""
    accepted = load(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    held = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return trace_with_held(accepted, held, load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id")


TRACE_HELD = """
SELECT (SELECT count(*) FROM events) AS aceitas, (SELECT count(*) FROM supplier) AS quarentena,
       (SELECT count(*) FROM customer) AS total_silver, (SELECT count(DISTINCT user_id) FROM events) AS ids,
       (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
          AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)) AS ausentes,
       (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer))
         + (SELECT count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)) AS extras,
       (SELECT count(*) FROM events JOIN supplier ON user_id = s_suppkey) AS sobreposicoes"""


def absent_and_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that never ordered nor appear among the event users, and those among the event users."""
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return union_all(
        absent(customers, users, "id").withColumn("side", F.lit("absent")),
        overlap(customers, users, "id").withColumn("side", F.lit("overlap")),
    )


ABSENT = """
SELECT c_custkey AS id, c_name, CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 'overlap' ELSE 'absent' END AS side
FROM customer"""


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is not in a short dimension, or whose customer key and quarantine disagree."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    held = _held_parties(spark, sf_dir)
    # The key is left out for every customer of the first half of the held ones and beyond, so both rules are broken.
    fact = orders.withColumn("key", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")))
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sk"))
    statuses = value_dim(load(spark, sf_dir, "lineitem"), "l_linestatus", "k", "status")
    found = orphan_marks(
        fact,
        [Reference("o_orderstatus", statuses, "l_linestatus")],
        HeldReference("key", customers, "sk", "o_custkey", held, "party"),
    )
    return found.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("linhas"))


ORPHANS = _PARTIES + """
SELECT o_orderstatus, count(*) AS linhas
FROM (SELECT *, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS key FROM orders) o
     LEFT JOIN customer ON key = c_custkey LEFT JOIN held ON o_custkey = party
WHERE o_orderstatus NOT IN (SELECT l_linestatus FROM lineitem) OR (key IS NULL) = (party IS NULL)
   OR (key IS NOT NULL AND c_custkey IS NULL)
GROUP BY 1"""


def reconcile_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart against the lines: totals within a cent and the exact number of rows."""
    fact = sales_mart_input(spark, sf_dir)
    mart = monthly_rollup(
        fact, "ship_key", "month", [], {"revenue": money_sum("revenue"), "records": F.count(F.lit(1))}
    )
    found = mart.agg(money_sum("revenue").alias("revenue"), F.sum("records").alias("registros"))
    return plain(reconcile_totals(1, "mart_vs_fact", found, totals(fact, revenue="revenue"), exact=["registros"]))


RECONCILE = _SALES + """,
shown AS (
  SELECT '{"revenue":' || cast(cast(cast(sum(revenue) AS decimal(18,2)) / 100 AS decimal(18,2)) AS varchar)
         || ',"registros":' || count(*) || '}' AS t FROM sales)
SELECT 1::bigint AS ORDEM, 'mart_vs_fact' AS TESTE, t AS VALOR_CALCULADO, t AS VALOR_ESPERADO, true AS PASSOU FROM shown"""


def compare_groupings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of lines and of orders by customer status that disagree, NULL groups included."""
    orders = load(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_orderpriority", "o_custkey"
    )
    a = orders.groupBy("status", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    b = orders.filter("o_orderpriority <> '5-LOW'").groupBy("status", "o_orderpriority").agg(F.count(F.lit(1)).alias("m"))
    return compare_groups(a, b, ["status", "o_orderpriority"], {"n": "m"})


COMPARE = """
SELECT count(DISTINCT o_orderstatus || o_orderpriority) AS grupos_divergentes FROM orders WHERE o_orderpriority = '5-LOW'"""

# --- raw files and counts --------------------------------------------------------------------------------------------


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files written from the tables, checked, landed as text and counted against the control."""
    root = raw_files(spark, sf_dir)
    control = inspect(spark, root, spec.SOURCES)
    tables = {s.table: land(spark, root, s) for s in spec.SOURCES}
    return reconcile_counts(table_counts(spark, tables), expected_counts(control, spec.SOURCES))


RAW_LANDING = "\nUNION ALL ".join(
    f"SELECT '{name}' AS tabela, count(*) AS linhas_tabela, count(*) AS linhas_esperadas, 'OK' AS status FROM ({raw.plain_sql(sql)})"
    for name, sql in (("crm", raw.LEADS), ("erp", raw.SALES), ("estoque", raw.POSITIONS))
)


def raw_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table counts against a control that is right, off, repeated and missing by turns."""
    names = ["orders", "lineitem", "customer", "region"]
    tables = {n: load(spark, sf_dir, n) for n in names}
    counted = table_counts(spark, tables)
    file = F.concat(F.col("tabela"), F.lit(".parquet"))
    rows = F.col("linhas_tabela") + F.when(F.col("tabela") == "lineitem", 1).otherwise(0)
    control = counted.select(F.lit("sf").alias("sistema"), file.alias("arquivo"), rows.alias("linhas"))
    control = union_all(
        control.filter("arquivo <> 'region.parquet'"), control.filter("arquivo = 'customer.parquet'")
    )
    specs = [SourceSpec("sf", "", f"{n}.parquet", n) for n in names]
    expected = expected_counts(control, specs)
    return reconcile_counts(counted, expected).join(expected.select("tabela", "erro"), "tabela")


RAW_RECONCILE = """
SELECT 'orders' AS tabela, count(*) AS linhas_tabela, count(*) AS linhas_esperadas, 'OK' AS status, NULL AS erro FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) + 1, 'DIVERGENTE', NULL FROM lineitem
UNION ALL SELECT 'customer', count(*), NULL, 'DIVERGENTE', 'o controle traz sf/customer.parquet 2 vezes'
FROM customer
UNION ALL SELECT 'region', count(*), NULL, 'DIVERGENTE', 'o controle nao traz sf/region.parquet' FROM region"""

# --- measures --------------------------------------------------------------------------------------------------------


def _dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = sales_mart_input(spark, sf_dir)
    f = lookup(f, load(spark, sf_dir, "part"), "l_partkey", "p_partkey", {"p_brand": "brand"})
    month = F.col("ship_key") - F.col("ship_key") % 100 + 1
    return f.withColumns({"year": F.floor(F.col("ship_key") / 10000), "month": month})


def _measures():
    revenue, margin, records = F.sum("revenue"), F.sum("margin"), F.count("l_orderkey")
    return catalogue(
        [
            Measure("revenue", revenue),
            Measure("margin", margin),
            Measure("records", records),
            Measure("ticket", F.round(revenue / F.nullif(records, F.lit(0)), 4)),
            Measure("margin_share", F.round(safe_ratio("margin", "revenue"), 4)),
        ]
    )


_ALL = ["revenue", "margin", "records", "ticket", "margin_share"]
_MEASURES = """cast(sum(revenue) AS double) / 100 AS revenue, cast(sum(revenue - cost) AS double) / 100 AS margin,
       count(*) AS records, round(cast(sum(revenue) AS double) / count(*) / 100, 4) AS ticket,
       round(cast(sum(revenue - cost) AS double) / nullif(sum(revenue), 0), 4) AS margin_share"""


def measures_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(measure(_dataset(spark, sf_dir), [], _ALL, _measures()))


MEASURES_KPI = _SALES + f"SELECT {_MEASURES} FROM sales"


def measures_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(measure(_dataset(spark, sf_dir), ["month"], _ALL, _measures(), order=[(F.col("month"), False)]))


MEASURES_BY_MONTH = _SALES + f"SELECT {_SHIP_MONTH} AS month, {_MEASURES} FROM sales GROUP BY 1"


def filtered_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of two brands, by supplier, largest revenue first."""
    return plain(
        measure(
            _dataset(spark, sf_dir), ["l_suppkey"], _ALL, _measures(),
            {"year": 1998, "brand": ["Brand#3", "Brand#14"]}, [(F.sum("revenue"), True)],
        )
    )


FILTERED = _SALES + f"""
SELECT l_suppkey, {_MEASURES} FROM sales JOIN part ON l_partkey = p_partkey
WHERE year(shipped) = 1998 AND p_brand IN ('Brand#3', 'Brand#14') GROUP BY 1"""


def product_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(series_long(_dataset(spark, sf_dir), ["brand"], ["revenue", "margin"], _measures(), "series", "value"))


PRODUCT_SERIES = _SALES + """
SELECT p_brand AS brand, 'revenue' AS series, cast(sum(revenue) AS double) / 100 AS value
FROM sales JOIN part ON l_partkey = p_partkey GROUP BY 1
UNION ALL
SELECT p_brand, 'margin', cast(sum(revenue - cost) AS double) / 100 FROM sales JOIN part ON l_partkey = p_partkey GROUP BY 1"""


def top_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small printed report: the first ten suppliers by records."""
    by = measure(_dataset(spark, sf_dir), ["l_suppkey"], ["records"], _measures())
    return preview(by.withColumn("_down", -F.col("records")), ["_down", "l_suppkey"], 10).drop("_down")


TOP_SELLERS = """
SELECT l_suppkey, count(*) AS records FROM lineitem GROUP BY 1 ORDER BY records DESC, l_suppkey LIMIT 10"""

def order_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's place by price, dearest first."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", _money("o_totalprice").alias("price"))
    return plain(with_position(orders, [(F.col("price"), True), (F.col("o_orderkey"), False)], "place"))


ORDER_POSITIONS = """
SELECT o_orderkey, o_orderstatus, cast(cents AS double) / 100 AS price,
       row_number() OVER (ORDER BY cents DESC, o_orderkey) AS place
FROM (SELECT *, cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders)"""


def offenders_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many brands are outside the mapping, and the first of them in one line."""
    offenders = mapped_dimension_check(spark, sf_dir)
    return failure_message(offenders, F.concat_ws("/", "system", F.coalesce("code", F.lit("-")), "name"), 5)


OFFENDERS_MESSAGE = f"""
WITH offenders AS ({MAPPED}),
texts AS (SELECT system || '/' || coalesce(code, '-') || '/' || name AS t FROM offenders)
SELECT (SELECT count(*) FROM texts) AS total, (SELECT string_agg(t, '; ' ORDER BY t) FROM (SELECT t FROM texts ORDER BY t LIMIT 5)) AS mensagem"""


def release_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers find while orders are replaced by a table of other columns: before, while the new load is written and only
    some of its tables are there, and after it became the current one."""
    orders, name = load(spark, sf_dir, "orders"), f"pedidos_{uuid.uuid4().hex}"

    def seen(moment: str) -> DataFrame:
        table = current(spark, name)["pedidos"]
        price = "preco" if "preco" in table.columns else "centavos"
        row = table.agg(F.count(F.lit(1)).alias("linhas"), F.sum(price).cast("double").alias("soma")).first()
        told = [(moment, ",".join(table.columns), len(current(spark, name)), row["linhas"], row["soma"])]
        return spark.createDataFrame(told, "momento string, colunas string, tabelas bigint, linhas bigint, soma double")

    first = Release(spark, name, shared_dir(spark))
    first.write("pedidos", orders.select(F.col("o_orderkey").alias("pedido"), _money("o_totalprice").alias("preco")))
    first.commit()
    before = seen("antes")
    second = Release(spark, name, shared_dir(spark))
    cents = (_money("o_totalprice") * 100).cast("bigint").alias("centavos")
    finished = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("pedido"), "o_orderstatus", cents)
    second.write("pedidos", finished)
    during = seen("durante")
    second.write("clientes", orders.select("o_custkey").distinct())
    second.commit()
    after = seen("depois")
    retire(spark, name)
    return union_all(before, during, after)


RELEASE_SWITCH = """
WITH o AS (SELECT o_orderstatus, cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders)
SELECT 'antes' AS momento, 'pedido,preco' AS colunas, 1::bigint AS tabelas, count(*) AS linhas, cast(sum(cents) AS double) / 100 AS soma FROM o
UNION ALL SELECT 'durante', 'pedido,preco', 1, count(*), cast(sum(cents) AS double) / 100 FROM o
UNION ALL SELECT 'depois', 'pedido,o_orderstatus,centavos', 2, count(*), cast(sum(cents) AS double) FROM o WHERE o_orderstatus = 'F'"""


def counted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row contracts and the consolidation's summary, taken while the tables are written."""
    lines = load(spark, sf_dir, "lineitem")
    contracts = [
        Contract("quantidade", F.col("l_quantity").between(1, 45)),
        Contract("desconto", F.col("l_discount") < F.col("l_tax") + 0.09),
    ]
    written = publish(lines, scratch(spark, "lines"), row_counts(contracts))
    folded = publish(
        consolidate_duplicates(spark, sf_dir), scratch(spark, "folded"), {ROWS: F.count(F.lit(1)), "behind": F.sum("_linhas_origem")}
    )
    landed = load(spark, sf_dir, "documents").count()
    lineage = checked_lineage(spark, "documents", folded.counts["behind"], landed)
    kept = F.lit(folded.counts[ROWS]).cast("bigint")
    return union_all(
        checked_rows(spark, written.counts, contracts),
        lineage.select("contrato", kept.alias("linhas"), (F.col("linhas") - F.col("chaves")).alias("violacoes"), "passou"),
    )


COUNTED_WRITE = """
SELECT 'quantidade' AS contrato, count(*) AS linhas, count(*) FILTER (NOT coalesce(l_quantity BETWEEN 1 AND 45, false)) AS violacoes,
       count(*) FILTER (NOT coalesce(l_quantity BETWEEN 1 AND 45, false)) = 0 AS passou FROM lineitem
UNION ALL
SELECT 'desconto', count(*), count(*) FILTER (NOT coalesce(l_discount < l_tax + 0.09::double, false)),
       count(*) FILTER (NOT coalesce(l_discount < l_tax + 0.09::double, false)) = 0 FROM lineitem
UNION ALL
SELECT 'documents', count(*), 0, true FROM (SELECT DISTINCT text, lang, source FROM documents)"""

QUERIES = [
    Query("seller_month_mart", seller_month_mart, SELLER_MONTH),
    Query("consolidate_duplicates", consolidate_duplicates, CONSOLIDATE),
    Query("duplicate_summary", duplicate_summary, DUPLICATE_SUMMARY),
    Query("version_keys", version_keys, VERSION_KEYS),
    Query("canonical_labels", canonical_labels, CANONICAL),
    Query("strict_casts", strict_casts, STRICT_CASTS),
    Query("parse_dates", parse_dates, PARSE_DATES),
    Query("format_phones", format_phones, FORMAT_PHONES),
    Query("repair_shifted", repair_shifted, REPAIR_SHIFTED),
    Query("conflict_evidence", conflict_evidence, CONFLICT_EVIDENCE),
    Query("conflict_arrays", conflict_arrays, CONFLICT_ARRAYS),
    Query("conflict_parts", conflict_parts, CONFLICT_PARTS),
    Query("version_one_key", version_one_key, VERSION_ONE_KEY),
    Query("conformed_dimension", conformed_dimension, CONFORMED),
    Query("conformed_lookup", conformed_lookup, CONFORMED_LOOKUP),
    Query("grain_conflicts", grain_held, GRAIN_HELD),
    Query("grain_accepted", grain_accepted, GRAIN_ACCEPTED),
    Query("grain_repeated", grain_repeated, GRAIN_REPEATED),
    Query("exclude_held", exclude_held, EXCLUDE_HELD),
    Query("mapped_dimension_check", mapped_dimension_check, MAPPED),
    Query("shared_dimension", shared_dimension, SHARED),
    Query("value_dimensions", value_dimensions, VALUE_DIMENSIONS),
    Query("union_of_ids", union_of_ids, UNION_OF_IDS),
    Query("calendar", calendar, CALENDAR),
    Query("calendar_span", calendar_span, CALENDAR_SPAN),
    Query("star_fact", star_fact, STAR_FACT),
    Query("fact_contract", fact_contract, FACT_CONTRACT),
    Query("financial_mart", financial_mart, FINANCIAL),
    Query("abc_curve", abc_by_part, ABC),
    Query("running_totals", running_totals, RUNNING),
    Query("funnel_mart", funnel_mart, FUNNEL),
    Query("aggregate_functions", aggregate_functions, AGGREGATES),
    Query("row_contracts", row_contracts, ROW_CONTRACTS),
    Query("unique_and_lineage", unique_and_lineage, UNIQUE_AND_LINEAGE),
    Query("trace", trace_orders, TRACE),
    Query("trace_with_held", trace_three_ways, TRACE_HELD),
    Query("absent_and_overlap", absent_and_overlapping, ABSENT),
    Query("orphans", orphan_keys, ORPHANS),
    Query("reconcile_totals", reconcile_revenue, RECONCILE),
    Query("compare_groups", compare_groupings, COMPARE),
    Query("raw_landing", raw_landing, RAW_LANDING),
    Query("raw_reconcile", raw_reconcile, RAW_RECONCILE),
    Query("measures_kpi", measures_kpi, MEASURES_KPI),
    Query("measures_by_month", measures_by_month, MEASURES_BY_MONTH),
    Query("filtered_measures", filtered_measures, FILTERED),
    Query("product_series_long", product_series, PRODUCT_SERIES),
    Query("top_sellers", top_sellers, TOP_SELLERS),
    Query("order_positions", order_positions, ORDER_POSITIONS),
    Query("offenders_message", offenders_message, OFFENDERS_MESSAGE),
    Query("release_switch", release_switch, RELEASE_SWITCH),
    Query("counted_write", counted_write, COUNTED_WRITE),
]
