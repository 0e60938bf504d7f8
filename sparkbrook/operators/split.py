"""Splitting records by mandatory fields, and the multiset difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Split(NamedTuple):
    valid: DataFrame
    invalid: DataFrame


def has_all(fields: Sequence[str]) -> Column:
    """True where no field is null, and never null itself. Empty strings count as present."""
    return reduce(lambda a, b: a & b, (F.col(f"`{name}`").isNotNull() for name in fields), F.lit(True))


def split_required(df: DataFrame, fields: Sequence[str]) -> Split:
    """(valid, invalid) by two narrow filters of one predicate.

    All copies of a row agree on the predicate, so the negated filter equals the multiset
    difference of input and valid rows without its full-row shuffle.
    """
    ok = has_all(fields)
    return Split(df.filter(ok), df.filter(~ok))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` minus those of ``right``, counting copies."""
    return left.exceptAll(right)
