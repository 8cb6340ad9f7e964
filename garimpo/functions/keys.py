"""Record, surrogate and content keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.text import column


def row_json(columns: Sequence[str]) -> Column:
    """The row as JSON, NULL fields kept, so a NULL and an absent field cannot be taken for each other."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_hash(columns: Sequence[str]) -> Column:
    return F.sha2(row_json(columns), 256)


def record_key(*parts: Column | str) -> Column:
    """Parts joined by a dash; NULL as soon as one part is, so a broken key cannot look whole."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), column(part).cast("string")]
    return F.concat(*pieces[1:])


def surrogate(entity: str, natural: Column | str) -> Column:
    """Deterministic key of an entity's natural key."""
    return F.xxhash64(F.concat(F.lit(f"{entity}|"), column(natural).cast("string")))
