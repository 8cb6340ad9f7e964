"""Labels, names, phones and three-valued flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.checked import Checked

# The characters a phone may hold, and how many digits stand before the last four.
PHONE_CHARACTERS = r"^[0-9() +.-]+$"
PHONE_LENGTHS = (8, 9, 10, 11)
AREA_CODE_DIGITS = 2


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(column(c)), F.lit(""))


def _lookup(key: Column, pairs: Mapping[str, str]) -> Column:
    # Catalyst rewrites a lookup in a literal map to one CASE over the key.
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])[key]


def canonical(c: Column | str, labels: Mapping[str, str]) -> Column:
    """The canonical spelling of a label; an unknown one passes through trimmed for the domain contract to judge."""
    return F.coalesce(_lookup(F.lower(F.trim(column(c))), labels), blank_to_null(c))


def code_name(c: Column | str, names: Mapping[str, str], problem: str) -> Checked:
    """The name that belongs to a code; a code outside the list, or none at all, is refused."""
    name = _lookup(F.upper(F.trim(column(c))), names)
    reason = F.concat(F.lit(f"{problem}: "), F.coalesce(column(c), F.lit("<NULL>")))
    return Checked(name, F.when(name.isNull(), reason))


def title_case(c: Column | str, fixes: Mapping[str, str] | None = None) -> Column:
    """Capitalised words; `fixes` repairs spellings that initcap leaves wrong."""
    titled = F.initcap(blank_to_null(c))
    for wrong, right in (fixes or {}).items():
        titled = F.replace(titled, F.lit(wrong), F.lit(right))
    return titled


def tri_bool(c: Column | str, true: Iterable[str], false: Iterable[str], problem: str) -> Checked:
    """true / false for the listed words, NULL for blank, refused for anything else."""
    word = F.lower(blank_to_null(c))
    value = F.when(word.isin(*true), True).when(word.isin(*false), False)
    return Checked(value, F.when(word.isNotNull() & value.isNull(), F.lit(problem)))


def format_phone(c: Column | str) -> Column:
    """8 or 9 local digits, or 10 or 11 with area code, punctuated; anything else, letters included, is NULL."""
    text = F.trim(column(c))
    digits = F.regexp_replace(text, "[^0-9]", "")
    size = F.length(digits)
    area = F.when(
        size > 9, F.concat(F.lit("("), F.substring(digits, 1, AREA_CODE_DIGITS), F.lit(") "))
    ).otherwise("")
    start = F.when(size > 9, AREA_CODE_DIGITS + 1).otherwise(1)
    prefix = F.substr(digits, start, size - F.lit(3) - start)
    shaped = F.concat(area, prefix, F.lit("-"), F.right(digits, F.lit(4)))
    return F.when(text.rlike(PHONE_CHARACTERS) & size.isin(*PHONE_LENGTHS), shaped)


def stage_rank(c: Column | str, stages: Sequence[str], unknown: int = 99) -> Column:
    """1-based position in the list, `unknown` for anything else (NULL too)."""
    position = F.array_position(F.array(*[F.lit(s) for s in stages]), column(c)).cast("int")
    return F.when(position > 0, position).otherwise(unknown)
