"""Text to number, strict or lenient."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.checked import Checked
from garimpo.functions.text import blank_to_null, column


def strict_cast(c: Column | str, dtype: str, label: str) -> Checked:
    """Blank is NULL; text that is there but does not parse is refused as `<label> invalido`."""
    text = blank_to_null(c)
    value = text.try_cast(dtype)
    return Checked(value, F.when(text.isNotNull() & value.isNull(), F.lit(f"{label} invalido")))


def lenient_cast(c: Column | str, dtype: str) -> Column:
    """What does not parse is NULL, for a NOT NULL contract to refuse later."""
    return F.trim(column(c)).try_cast(dtype)
