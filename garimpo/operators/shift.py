"""Repair of rows moved one column to the right by an unescaped decimal comma.

`143.000,00` without quotes is read as two fields, so every later field sits one column too far and the last token is
lost when the file is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions import Checked, parse_date

# How the two halves of a split amount look.
THOUSANDS = r"^-?[0-9]{1,3}([.][0-9]{3})+$"
CENTS = r"^[0-9]{2}$"
YEAR = r"^[0-9]{4}$"

SPLIT = "_coluna_partida"


@dataclass(frozen=True)
class ShiftSpec:
    """What a moved row looks like.

    columns: the columns from the first amount to the last one, in file order
    amounts: those of them that may have been split
    payment: the column whose label tells on which side of it the split was
    product, year, date: columns that hold a product label, a year and a date when, and only when, the row is moved
    """

    columns: Sequence[str]
    amounts: Sequence[str]
    payment: str
    payment_labels: Sequence[str]
    product: str
    product_labels: Sequence[str]
    year: str
    date: str
    identity: str
    system: str


def _holds(name: str, labels: Sequence[str]) -> Column:
    return F.coalesce(F.lower(F.trim(F.col(name))).isin(*labels), F.lit(False))


def _looks(name: str, pattern: str) -> Column:
    return F.coalesce(F.trim(F.col(name)).rlike(pattern), F.lit(False))


def detect_shift(spec: ShiftSpec) -> Checked:
    """Position in `spec.columns` of the amount that was split; NULL for a row that is in place.

    A row that is moved but whose split amount cannot be told is refused.
    """
    at = {name: i for i, name in enumerate(spec.columns)}
    home = at[spec.payment]
    moved = (
        _holds(spec.product, spec.product_labels)
        & _looks(spec.year, YEAR)
        & parse_date(spec.date).isNotNull()
    )
    # A split before the payment column moves its label along; a split after it leaves the label where it was.
    split_before = _holds(spec.columns[home + 1], spec.payment_labels)
    split_after = ~split_before & _holds(spec.payment, spec.payment_labels)

    candidates = []
    for name in spec.amounts:
        side = split_before if at[name] < home else split_after
        halves = _looks(name, THOUSANDS) & _looks(spec.columns[at[name] + 1], CENTS)
        candidates.append(F.when(side & halves, F.lit(at[name])))
    position = F.when(moved, F.coalesce(*candidates))

    who = F.coalesce(F.col(spec.identity), F.lit("<NULL>"))
    side = F.when(split_before, "antes").when(split_after, "depois").otherwise("fora")
    told = F.format_string(f"{spec.system}: linha de %s deslocada, sem valor partido %s do pagamento", who, side)
    refused = F.when(moved & position.isNull(), told)
    return Checked(position, refused)


def realign(df: DataFrame, spec: ShiftSpec, split: str = SPLIT) -> DataFrame:
    """Join the two halves of the split amount and move the later columns back; the lost last token is NULL.

    `split` names the column that holds the position found by `detect_shift`.
    """
    position = F.col(split)
    names = list(spec.columns)

    def back(i: int) -> Column:
        here = F.col(names[i])
        after = F.col(names[i + 1]) if i + 1 < len(names) else F.lit(None).cast("string")
        whole = F.concat(F.replace(F.trim(here), F.lit("."), F.lit("")), F.lit("."), F.trim(after))
        return F.when(position.isNull() | (position > i), here).when(position == i, whole).otherwise(after)

    return df.withColumns({name: back(i) for i, name in enumerate(names)})


def repair_shift(df: DataFrame, spec: ShiftSpec, problem: str) -> DataFrame:
    """Both steps; `problem` names the column that tells why a moved row could not be repaired."""
    found = detect_shift(spec)
    marked = df.withColumns({SPLIT: found.value, problem: found.problem})
    return realign(marked, spec).drop(SPLIT)
