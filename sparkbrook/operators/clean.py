"""Row-level cleaning; each operator is one projection built from the schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbrook.functions.text import joined_address, null_or_empty, strip_special
from sparkbrook.models import ADDRESS_COLUMN, TIME_COLUMN

Defaults = Mapping[type[T.DataType], Any]


def combine_address(df: DataFrame, fields: Sequence[str], output: str = ADDRESS_COLUMN) -> DataFrame:
    """Adds the space-joined ``fields`` without special characters; all null gives ``""``."""
    return df.withColumn(output, joined_address([F.col(f"`{name}`") for name in fields]))


def lowercase_strings(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Lower-cases every string column but the excluded; arrays of strings stay."""
    return df.withColumns({f.name: F.lower(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude})


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keeps ASCII letters, digits and whitespace in ``columns``; null stays null."""
    return df.withColumns({name: strip_special(F.col(f"`{name}`")) for name in columns})


def fill_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Fills nulls (not ``""``) per column, keeping each column's type."""
    unknown = [name for name in values if name not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.withColumns({name: F.coalesce(F.col(f"`{name}`"), F.lit(value).cast(df.schema[name].dataType)) for name, value in values.items()})


def stamp_time(df: DataFrame, now: Column | None = None, output: str = TIME_COLUMN) -> DataFrame:
    """Adds the processing time; ``now`` replaces the clock in tests and replays."""
    return df.withColumn(output, F.current_timestamp() if now is None else now)


def standard_defaults(now: Column | None = None) -> dict[type[T.DataType], Any]:
    """Text, number, flag, time and date defaults; NTZ timestamps are filled as well."""
    clock = F.current_timestamp() if now is None else now
    return {
        T.StringType: "Unknown",
        T.NumericType: 0,
        T.BooleanType: False,
        T.TimestampType: clock,
        T.TimestampNTZType: clock.cast(T.TimestampNTZType()),
        T.DateType: clock.cast("date"),
    }


def fill_defaults(df: DataFrame, keep: Sequence[str] = (), defaults: Defaults | None = None, now: Column | None = None) -> DataFrame:
    """Type-driven defaults for every column outside ``keep``.

    The first entry whose type the column's type is a subclass of applies; a given table
    replaces the standard one, an empty one does not. Plain values replace null, and in
    string columns ``""`` too; Column values replace null only. The column keeps its type.
    """
    table = defaults or standard_defaults(now)
    filled = {}
    for field in df.schema.fields:
        rule = next((v for kind, v in table.items() if isinstance(field.dataType, kind)), None)
        if field.name in keep or rule is None:
            continue
        column, value = F.col(f"`{field.name}`"), (rule if isinstance(rule, Column) else F.lit(rule)).cast(field.dataType)
        if isinstance(field.dataType, T.StringType) and not isinstance(rule, Column):
            filled[field.name] = F.when(null_or_empty(column), value).otherwise(column)
        else:
            filled[field.name] = F.coalesce(column, value)
    return df.withColumns(filled) if filled else df
