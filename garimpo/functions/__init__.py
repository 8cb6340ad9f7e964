"""Column expressions: every function takes and gives `Column`, so all of it stays inside codegen."""

from garimpo.functions.aggregates import (
    count_where,
    distinct_count,
    distinct_tuples,
    min_rank,
    money_avg,
    money_sum,
    safe_ratio,
    sole_value,
    sorted_set,
)
from garimpo.functions.checked import PROBLEM, Checked, project, split_rejects
from garimpo.functions.dates import date_key, month_key, month_of_key, parse_date, parse_month
from garimpo.functions.keys import content_hash, record_key, row_json, surrogate
from garimpo.functions.numbers import lenient_cast, strict_cast
from garimpo.functions.text import blank_to_null, canonical, code_name, format_phone, stage_rank, title_case, tri_bool

__all__ = [
    "PROBLEM",
    "Checked",
    "blank_to_null",
    "canonical",
    "code_name",
    "content_hash",
    "count_where",
    "date_key",
    "distinct_count",
    "distinct_tuples",
    "format_phone",
    "lenient_cast",
    "min_rank",
    "money_avg",
    "money_sum",
    "month_key",
    "month_of_key",
    "parse_date",
    "parse_month",
    "project",
    "record_key",
    "row_json",
    "safe_ratio",
    "sole_value",
    "sorted_set",
    "split_rejects",
    "stage_rank",
    "strict_cast",
    "surrogate",
    "title_case",
    "tri_bool",
]
