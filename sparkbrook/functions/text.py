"""Column-level text functions; all stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything but ASCII letters, digits and whitespace goes; accented letters too.
SPECIAL = r"[^a-zA-Z0-9\s]"


def strip_special(column: Column) -> Column:
    return F.regexp_replace(column, SPECIAL, "")


def joined_address(columns: list[Column]) -> Column:
    """Space-joined parts without special characters. Nulls are skipped, ``""`` is not."""
    return strip_special(F.concat_ws(" ", *columns))


def null_or_empty(column: Column) -> Column:
    return column.isNull() | (column == F.lit(""))
