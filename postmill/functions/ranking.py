"""Priority and rank of an address, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.schema import FIELDS, PRIORITY, TEXT_FIELDS


def priority(source: Column) -> Column:
    out = F.lit(None).cast("double")
    for name, value in PRIORITY.items():
        out = F.when(source == name, F.lit(value)).otherwise(out)
    return out


def non_empty_fields(fields: tuple[str, ...] = TEXT_FIELDS) -> Column:
    """How many fields of an address are present; its coordinates always are. An empty text counts as present."""
    return sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(2))


def rank(source: Column) -> Column:
    """Priority plus a fraction below one for completeness, so that the source always decides first."""
    return priority(source) + non_empty_fields() / F.lit(1.0 + len(FIELDS))
