"""Raw dealership files derived from the driver tables, in SQL that both engines read alike.

Every row of the tables becomes a raw text row, with the defects the cleaning is there for: padding, casing,
misspellings, three date formats, amounts split by a decimal comma, rows told twice (the returned and settled ones),
clients told in two ways and stock told twice. A second set of the files also holds rows that the cleaning refuses. Beside the text stand the true values (`t_..`), which only the checking SQL reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from garimpo.plans import spec

TABLES = "region nation customer supplier part orders lineitem events documents".split()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use all cores where a small file comes in few splits; a scan with enough splits is left alone.

    Rows dealt by the key of their first join need no exchange of their own for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(*key) if key else df.repartition(cores)


def derive(spark: SparkSession, sf_dir: str, text: str, columns: list[str]) -> DataFrame:
    """The raw text columns as a DataFrame.

    Sales are read by the same SQL over their lines as Spark joins them with less to exchange, see `_SOLD_LINES`. What is only
    summed is not spread.
    """
    text = text.replace(_SOLD, _SOLD_LINES)
    used = [t for t in TABLES if "{" + t + "}" in text]
    frames = {t: load(spark, sf_dir, t) for t in used}
    if "events" in frames:
        frames["events"] = spread(frames["events"])
    if "lineitem" in frames and "orders" in frames:
        frames["lineitem"] = spread(frames["lineitem"], "l_orderkey")
    return spark.sql(text, **frames).select(*columns)


def plain_sql(text: str) -> str:
    """The same SQL over the tables by name."""
    return text.format(**{t: t for t in TABLES})


def pick(key: str, values: list[str | None]) -> str:
    """CASE that picks a literal by a 0-based integer key."""
    arms = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {key} {arms} END"


def literal(v: str | None) -> str:
    return "cast(NULL AS string)" if v is None else f"'{v}'"


def text(x: str) -> str:
    return f"cast({x} AS string)"


def pad(x: str, width: int) -> str:
    return f"lpad({text(x)}, {width}, '0')"


def whole(x: str, by: int) -> str:
    return f"cast(floor({x} / {by}) AS bigint)"


def sign(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN '-' ELSE '' END"


def amount(c: str) -> str:
    """Cents as 1234.05"""
    return f"({sign(c)} || {text(whole(f'abs({c})', 100))} || '.' || {pad(f'abs({c}) % 100', 2)})"


def dotted(c: str) -> str:
    """The whole part of cents as 1.234 or 1.234.567"""
    units, thousands = whole(f"abs({c})", 100), whole(f"abs({c})", 100_000)
    big = f"{text(whole(f'abs({c})', 100_000_000))} || '.' || {pad(f'{thousands} % 1000', 3)} || '.' || {pad(f'{units} % 1000', 3)}"
    small = f"{text(thousands)} || '.' || {pad(f'{units} % 1000', 3)}"
    return f"({sign(c)} || CASE WHEN abs({c}) >= 100000000 THEN {big} ELSE {small} END)"


def ymd(d: str) -> str:
    return f"({text(f'year({d})')} || '-' || {pad(f'month({d})', 2)} || '-' || {pad(f'day({d})', 2)})"


def three_dates(d: str, key: str) -> str:
    """Day first, month first where that cannot be misread, or ISO."""
    y, m, dd = text(f"year({d})"), pad(f"month({d})", 2), pad(f"day({d})", 2)
    return (
        f"CASE {key} % 3 WHEN 0 THEN {dd} || '/' || {m} || '/' || {y} "
        f"WHEN 1 THEN CASE WHEN day({d}) > 12 THEN ' ' || {m} || '/' || {dd} || '/' || {y} ELSE {ymd(d)} END "
        f"ELSE {ymd(d)} || ' ' END"
    )


def client(key: str, variant: str) -> str:
    return f"CASE {variant} % 3 WHEN 0 THEN 'cli' || {text(key)} WHEN 1 THEN ' CLI' || {text(key)} || ' ' ELSE 'Cli' || {text(key)} END"


def mixed(values: list[str]) -> list[str]:
    """Spelling variants that the cleaning folds back."""
    return [(v.upper(), f" {v.lower()}", f"{v} ")[i % 3] for i, v in enumerate(values)]


# --- sales -----------------------------------------------------------------------------------------------------------

_COLOURS = [*spec.COLOURS, *spec.COLOUR_SPELLINGS.values()]
_COLOURS_RAW = [*mixed(spec.COLOURS), *spec.COLOUR_SPELLINGS]
_SEGMENTS = {"BUILDING": "bv", "AUTOMOBILE": "BRADESCO", "MACHINERY": " santander ", "HOUSEHOLD": "montadora"}
_BANK_OF = {"BUILDING": "BV", "AUTOMOBILE": "Bradesco", "MACHINERY": "Santander", "HOUSEHOLD": "Montadora"}
_SPLIT_AT = {1: ("valor_padrao", "price"), 2: ("desconto", "off"), 3: ("valor_faturamento", "billed"), 4: ("custo", "cost")}


def _by_segment(values: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE c_mktsegment {arms} END"


#: Which rows of the files with defects hold something the cleaning refuses.
_NO_GROUPS = "l_partkey % 7 = 4"


def _priced(lines: str) -> str:
    return f"""priced AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, c_name, c_mktsegment, s_name,
         cast(l_shipdate AS date) AS shipped,
         cast(round(l_extendedprice * 100) AS bigint) AS price,
         cast(round(l_discount * 100) AS bigint) AS pct
  FROM {lines}
       JOIN {{supplier}} ON l_suppkey = s_suppkey
)"""


_SOLD = f"""told AS (
  SELECT * FROM {{lineitem}}
  UNION ALL
  SELECT * FROM {{lineitem}} WHERE l_returnflag = 'A' AND l_linestatus = 'F'
), {_priced("""told JOIN {orders} ON l_orderkey = o_orderkey
       JOIN {customer} ON o_custkey = c_custkey""")}"""

# The same rows for Spark, which joins as written: orders meet customers before the many more lines meet them, and a line that is
# told twice takes one path through the joins.
_SOLD_LINES = f"""marked AS (
  SELECT *, coalesce(l_returnflag = 'A' AND l_linestatus = 'F', false) AS twice FROM {{lineitem}}
), bought AS (
  SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
), sold AS (
  SELECT * FROM marked JOIN bought ON l_orderkey = o_orderkey
), {_priced("""(SELECT *, explode(CASE WHEN twice THEN array(1, 2) ELSE array(1) END) AS telling FROM sold)""")}"""


def _sales_sql(refused: bool = False) -> str:
    """With `refused`, some split amounts lost the dots of their whole part, so the split cannot be placed."""
    tokens = {
        "valor_padrao": amount("price"),
        "desconto": amount("off"),
        "valor_faturamento": amount("billed"),
        "forma_pagamento": "CASE l_orderkey % 2 WHEN 0 THEN ' FINANCIAMENTO' ELSE 'À vista' END",
        "banco": _by_segment(_SEGMENTS),
        "custo": amount("cost"),
        "produto": pick("l_partkey % 8", mixed(spec.PRODUCT_NAMES)),
        "cor_produto": pick(f"l_suppkey % {len(_COLOURS)}", _COLOURS_RAW),
        "ano": text("year(shipped)"),
        "modelo": pick("l_partkey % 8", [f"{p.lower()} comfortline" for p in spec.PRODUCT_NAMES]),
        "data_entrega": three_dates("shipped", "l_linenumber"),
        "zero_km_ou_seminovo": "CASE l_suppkey % 2 WHEN 0 THEN '0 km' ELSE 'SEMI NOVO ' END",
    }
    names = list(tokens)
    split = " ".join(
        f"WHEN l_orderkey % 13 = {k} AND abs({cents}) >= 100000 THEN {names.index(name)}"
        for k, (name, cents) in _SPLIT_AT.items()
    )
    at = {names.index(name): cents for name, cents in _SPLIT_AT.values()}

    def moved(i: int) -> str:
        here = f"k_{names[i]}"
        arms = [f"WHEN split IS NULL OR split > {i} THEN {here}"]
        if i in at:
            if refused:
                arms.append(f"WHEN split = {i} AND {_NO_GROUPS} THEN {sign(at[i])} || {text(whole(f'abs({at[i]})', 100))}")
            arms.append(f"WHEN split = {i} THEN {dotted(at[i])}")
        if i - 1 in at:
            arms.append(f"WHEN split = {i - 1} THEN {pad(f'abs({at[i - 1]}) % 100', 2)}")
        before = f"ELSE k_{names[i - 1]}" if i else f"ELSE {here}"
        return f"CASE {' '.join(arms)} {before} END AS {names[i]}"

    before, after = ("'antes'", "'depois'")
    home = names.index("forma_pagamento")
    reason = (
        f"'ERP: linha de ' || {client('o_custkey', 'l_linenumber')} || ' deslocada, sem valor partido ' || "
        f"CASE WHEN split < {home} THEN {before} ELSE {after} END || ' do pagamento'"
    )
    problem = f"CASE WHEN split IS NOT NULL AND {_NO_GROUPS} THEN {reason} END" if refused else "cast(NULL AS string)"

    # A client out of nineteen has two names, one out of twenty-three two birth dates.
    true_name = "CASE WHEN o_custkey % 19 = 0 AND l_linenumber = 1 THEN c_name || 'b' ELSE c_name END"
    true_birth_day = "1 + (o_custkey + CASE WHEN o_custkey % 23 = 0 AND l_linenumber = 2 THEN 1 ELSE 0 END) % 28"
    birth = f"({text('1950 + o_custkey % 50')} || '-' || {pad('1 + o_custkey % 12', 2)} || '-' || {pad(true_birth_day, 2)})"
    return f"""
WITH {_SOLD}, discounted AS (
  SELECT *, CASE WHEN pct = 0 THEN -12345 ELSE {whole('price * pct', 100)} END AS off,
         {whole('price * (60 + l_partkey % 45)', 100)} AS cost
  FROM priced
), billed AS (
  SELECT *, price - off AS billed FROM discounted
), tokens AS (
  SELECT *, CASE {split} END AS split,
         {', '.join(f'{v} AS k_{n}' for n, v in tokens.items())}
  FROM billed
)
SELECT {client('o_custkey', 'l_linenumber')} AS id_cliente,
       CASE l_linenumber % 2 WHEN 0 THEN upper({true_name}) ELSE ' ' || lower({true_name}) || ' ' END AS nome_cliente,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE {birth} END AS data_nascimento,
       CASE l_linenumber % 2 WHEN 0 THEN upper(s_name) ELSE s_name || ' ' END AS vendedor,
       {', '.join(moved(i) for i in range(len(names)))},
       'CLI' || {text('o_custkey')} AS t_id_cliente,
       {true_name} AS t_nome,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE {birth} END AS t_nascimento,
       s_name AS t_vendedor,
       price, off, billed, cost, split,
       CASE l_orderkey % 2 WHEN 0 THEN 'Financiamento' ELSE 'À Vista' END AS t_pagamento,
       {_by_segment(_BANK_OF)} AS t_banco,
       {pick('l_partkey % 8', spec.PRODUCT_NAMES)} AS t_produto,
       {pick(f'l_suppkey % {len(_COLOURS)}', _COLOURS)} AS t_cor,
       year(shipped) AS t_ano,
       {pick('l_partkey % 8', [f'{p} Comfortline' for p in spec.PRODUCT_NAMES])} AS t_modelo,
       shipped AS t_entrega,
       CASE WHEN split IS NULL THEN CASE l_suppkey % 2 WHEN 0 THEN '0 KM' ELSE 'Semi Novo' END END AS t_condicao,
       {problem} AS t_problema
FROM tokens"""


SALES = _sales_sql()
SALES_REFUSED = _sales_sql(refused=True)

# --- leads -----------------------------------------------------------------------------------------------------------

_STAGE_OF = {"signup": "Primeiro Contato", "view": "Agendamento", "click": "Negociação", "purchase": "Sucesso", "error": "Insucesso"}
_STAGE_RAW = {"signup": "primeiro contato", "view": "AGENDAMENTO ", "click": "negociacao", "purchase": " Sucesso", "error": "insucesso"}


def _by_type(values: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE event_type {arms} END"


def _leads_sql(refused: bool = False) -> str:
    """With `refused`, some ages are words, some shares are too large and some test drives have no known answer."""
    def number(width: int) -> str:
        return f"lpad({text(f'(user_id * 7919) % {10**width}')}, {width}, '1')"

    true_name = "CASE WHEN user_id % 29 = 0 AND event_id % 2 = 0 THEN 'Customer#' || lpad(cast(user_id AS string), 9, '0') || 'c' ELSE 'Customer#' || lpad(cast(user_id AS string), 9, '0') END"
    n8, n9, n10, n11 = number(8), number(9), number(10), number(11)
    phone_raw = (
        f"CASE user_id % 6 WHEN 0 THEN {n8} WHEN 1 THEN ' ' || {n9} WHEN 2 THEN '+' || {n10} || '.' "
        f"WHEN 3 THEN '(' || substr({n11}, 1, 2) || ') ' || substr({n11}, 3) WHEN 4 THEN '98A' || {n8} ELSE NULL END"
    )
    phone = (
        f"CASE user_id % 6 WHEN 0 THEN substr({n8}, 1, 4) || '-' || substr({n8}, 5) "
        f"WHEN 1 THEN substr({n9}, 1, 5) || '-' || substr({n9}, 6) "
        f"WHEN 2 THEN '(' || substr({n10}, 1, 2) || ') ' || substr({n10}, 3, 4) || '-' || substr({n10}, 7) "
        f"WHEN 3 THEN '(' || substr({n11}, 1, 2) || ') ' || substr({n11}, 3, 5) || '-' || substr({n11}, 8) END"
    )
    cents = "cents"
    drive_raw = pick("event_id % 6", [" Sim", "S", "1", "NÃO", None, " "])
    drive = "CASE WHEN event_id % 6 < 3 THEN true WHEN event_id % 6 = 3 THEN false END"
    reasons = spec.LOSS_REASONS
    age = f"CASE user_id % 4 WHEN 0 THEN '-1' WHEN 1 THEN ' ' ELSE ' ' || {text('18 + user_id % 60')} END"
    share = f"CASE WHEN event_id % 5 = 0 THEN NULL ELSE {amount(cents)} END"
    problem = "cast(NULL AS string)"
    if refused:
        word, large, unknown = "event_id % 11 = 2", "event_id % 13 = 3", "event_id % 17 = 4"
        age = f"CASE WHEN {word} THEN ' quarenta' ELSE {age} END"
        share = f"CASE WHEN {large} THEN '1234.50' ELSE {share} END"
        drive_raw = f"CASE WHEN {unknown} THEN 'Talvez' ELSE {drive_raw} END"
        told = [
            f"CASE WHEN {word} THEN 'crm: IDADE invalido' END",
            f"CASE WHEN {large} THEN 'crm: ENTRADA_PCT invalido' END",
            f"CASE WHEN {unknown} THEN 'CRM: FEZ_TEST_DRIVE desconhecido' END",
        ]
        problem = f"nullif(concat_ws('; ', {', '.join(told)}), '')"
    return f"""
WITH typed AS (
  SELECT event_id, user_id, event_type, cast(ts AS date) AS seen,
         cast(round(value * 100) AS bigint) % 10000 AS cents
  FROM {{events}}
)
SELECT {client('user_id', 'event_id')} AS id_cliente,
       CASE event_id % 2 WHEN 0 THEN upper({true_name}) ELSE ' ' || lower({true_name}) END AS cliente,
       {pick('user_id % 5', ['M', 'Feminno', ' masculino', 'FEM', None])} AS genero,
       {age} AS idade,
       {phone_raw} AS contato,
       {pick('event_id % 8', mixed(spec.CHANNELS))} AS fonte,
       {pick('(event_id + user_id) % 8', mixed(spec.PRODUCT_NAMES))} AS produto_interesse,
       CASE event_id % 2 WHEN 0 THEN 'financiamento ' ELSE 'À VISTA' END AS forma_pagamento,
       {share} AS entrada_pct,
       {drive_raw} AS fez_test_drive,
       {three_dates('seen', 'event_id')} AS data_interesse,
       {_by_type(_STAGE_RAW)} AS etapa,
       CASE WHEN event_type = 'error' THEN {pick('event_id % 6', mixed(reasons))} END AS motivo_insucesso,
       {pick('user_id % 3', mixed(spec.TEMPERATURES))} AS temperatura,
       {ymd('seen')} AS data_ultimo_contato,
       'CLI' || {text('user_id')} AS t_id_cliente,
       {true_name} AS t_nome,
       {pick('user_id % 5', ['Masculino', 'Feminino', 'Masculino', 'Feminino', None])} AS t_genero,
       CASE user_id % 4 WHEN 0 THEN -1 WHEN 1 THEN NULL ELSE 18 + user_id % 60 END AS t_idade,
       {phone} AS t_contato,
       {pick('event_id % 8', spec.CHANNELS)} AS t_fonte,
       {pick('(event_id + user_id) % 8', spec.PRODUCT_NAMES)} AS t_produto,
       CASE event_id % 2 WHEN 0 THEN 'Financiamento' ELSE 'À Vista' END AS t_pagamento,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE cents END AS t_entrada,
       {drive} AS t_drive,
       seen AS t_data,
       {_by_type(_STAGE_OF)} AS t_etapa,
       CASE WHEN event_type = 'error' THEN {pick('event_id % 6', reasons)} END AS t_motivo,
       {pick('user_id % 3', spec.TEMPERATURES)} AS t_temperatura,
       {problem} AS t_problema
FROM typed"""


LEADS = _leads_sql()
LEADS_REFUSED = _leads_sql(refused=True)

# --- stock positions -------------------------------------------------------------------------------------------------


def _positions_sql(refused: bool = False) -> str:
    """With `refused`, some positions have a code outside the list and some stocks are not whole numbers."""
    codes = [code for code, _ in spec.PRODUCTS]
    code_raw = pick("code", [c.lower() if i % 2 else f" {c}" for i, c in enumerate(codes)])
    stock_raw = f"CASE WHEN m = 6 AND code = 3 THEN ' ' ELSE {text('stock')} END"
    code_true, problem = pick("code", codes), "cast(NULL AS string)"
    if refused:
        other, broken = "code = 5 AND m % 4 = 1", "code = 2 AND m % 3 = 2"
        code_raw = f"CASE WHEN {other} THEN ' vw-xyz' ELSE {code_raw} END"
        code_true = f"CASE WHEN {other} THEN 'VW-XYZ' ELSE {code_true} END"
        stock_raw = f"CASE WHEN {broken} THEN {text('stock')} || ',5' ELSE {stock_raw} END"
        told = [
            f"CASE WHEN {other} THEN 'Estoque: codigo de produto desconhecido:  vw-xyz' END",
            f"CASE WHEN {broken} THEN 'estoque: ESTOQUE_ATUAL invalido' END",
        ]
        problem = f"nullif(concat_ws('; ', {', '.join(told)}), '')"
    month = f"({text('y')} || '-' || {pad('m', 2)})"
    month_raw = (
        f"CASE m % 3 WHEN 0 THEN {month} WHEN 1 THEN ' ' || {text('y')} || '/' || {pad('m', 2)} "
        f"ELSE {pad('m', 2)} || '/' || {text('y')} END"
    )
    return f"""
WITH counted AS (
  SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, l_partkey % 8 AS code,
         CASE WHEN (month(l_shipdate) + l_partkey) % 8 = 0 THEN l_linestatus ELSE 'X' END AS told,
         cast(sum(cast(l_quantity AS bigint)) AS bigint) AS moved
  FROM {{lineitem}}
  GROUP BY year(l_shipdate), month(l_shipdate), l_partkey % 8,
           CASE WHEN (month(l_shipdate) + l_partkey) % 8 = 0 THEN l_linestatus ELSE 'X' END
), balance AS (
  SELECT y, m, code, told, moved % 997 - 40 AS stock FROM counted
)
SELECT {month_raw} AS mes_referencia,
       {code_raw} AS cod_produto,
       CASE WHEN told = 'F' THEN 'Polo' ELSE {pick('code', mixed(spec.PRODUCT_NAMES))} END AS produto,
       {stock_raw} AS estoque_atual,
       {pick('(y + m) % 6', mixed(spec.CAMPAIGNS))} AS campanha_atual,
       {month} || '-01' AS t_mes,
       {code_true} AS t_codigo,
       {pick('code', spec.PRODUCT_NAMES)} AS t_produto,
       CASE WHEN m = 6 AND code = 3 THEN NULL ELSE stock END AS t_estoque,
       {pick('(y + m) % 6', spec.CAMPAIGNS)} AS t_campanha,
       {problem} AS t_problema
FROM balance"""


POSITIONS = _positions_sql()
POSITIONS_REFUSED = _positions_sql(refused=True)


#: The raw tables: as a load takes them, and with rows that the cleaning refuses.
RAW = {
    "bronze_crm": (LEADS, spec.LEAD_COLUMNS),
    "bronze_erp": (SALES, spec.SALE_COLUMNS),
    "bronze_estoque": (POSITIONS, spec.POSITION_COLUMNS),
    "defeitos_crm": (LEADS_REFUSED, spec.LEAD_COLUMNS),
    "defeitos_erp": (SALES_REFUSED, spec.SALE_COLUMNS),
    "defeitos_estoque": (POSITIONS_REFUSED, spec.POSITION_COLUMNS),
}
