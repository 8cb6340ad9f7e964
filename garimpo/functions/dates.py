"""Dates written in several ways, and integer date keys."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.text import column

# Accepted formats, first hit wins, so an ambiguous day and month is read day first.
DATE_FORMATS = ("dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd")
# A month is a date with the day left out: text before it, text after it, format of the whole.
MONTH_FORMATS = (("", "-01", "yyyy-MM-dd"), ("", "/01", "yyyy/MM/dd"), ("01/", "", "dd/MM/yyyy"))

_FIELDS = {"yyyy": "(?!0000)[0-9]{4}", "MM": "[0-9]{2}", "dd": "[0-9]{2}"}


def _shape(pattern: str) -> str:
    return "".join(_FIELDS.get(p, re.escape(p)) for p in re.split("(yyyy|MM|dd)", pattern))


def _digits_as_date(text: Column, pattern: str) -> Column:
    return F.concat_ws("-", *[F.substring(text, pattern.index(f) + 1, len(f)) for f in ("yyyy", "MM", "dd")]).try_cast("date")


def read_date(text: Column, *patterns: str) -> Column:
    """The date written in a fixed-width pattern of yyyy, MM and dd; NULL for any other text or an impossible day.

    A formatter tells a text that does not fit by throwing, which costs far more than the parsing when most texts are
    in one of several formats. Here the shape is tested first and the digits are put in ISO order for a plain cast.
    Of several patterns, the first that gives a date; those of one shape that follow each other share its test.
    """
    groups = [(shape, list(those)) for shape, those in groupby(patterns, _shape)]
    return F.coalesce(
        *[F.when(text.rlike(f"^{shape}\\z"), F.coalesce(*[_digits_as_date(text, p) for p in those])) for shape, those in groups]
    )


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return read_date(F.trim(column(c)), *formats)


def parse_month(c: Column | str) -> Column:
    """First day of a month written yyyy-MM, yyyy/MM or MM/yyyy."""
    text = F.trim(column(c))
    return F.coalesce(
        *[read_date(F.concat(F.lit(before), text, F.lit(after)), f) for before, after, f in MONTH_FORMATS]
    )


def date_key(c: Column | str) -> Column:
    """yyyymmdd as an integer."""
    day = column(c)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(c: Column | str) -> Column:
    """yyyymm01 as an integer."""
    day = column(c)
    return (F.year(day) * 10000 + F.month(day) * 100 + 1).cast("int")


def month_of_key(c: Column | str) -> Column:
    """The month key of a date key, by arithmetic alone, so a rollup needs no join with the calendar."""
    key = column(c)
    return (key - key % 100 + 1).cast("int")
