"""Nested-to-flat operators: record explosion and breadth-first struct expansion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class _Leaf:
    """An output column: its name, where it sits in the current frame, and its type."""

    name: str
    path: tuple[str, ...]
    dtype: T.DataType

    def column(self):
        return F.col(".".join(f"`{part.replace('`', '``')}`" for part in self.path)).alias(self.name)


def _is_record_array(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def _expand_once(leaves: list[_Leaf]) -> list[_Leaf]:
    """Columns that are no structs keep their order; the structs' children follow."""
    flat = [leaf for leaf in leaves if not isinstance(leaf.dtype, T.StructType)]
    for leaf in leaves:
        if isinstance(leaf.dtype, T.StructType):
            flat += [_Leaf(f"{leaf.name}_{f.name}", (*leaf.path, f.name), f.dataType) for f in leaf.dtype.fields]
    return flat


def _check_names(leaves: list[_Leaf], case_sensitive: bool) -> None:
    seen: dict[str, tuple[str, ...]] = {}
    for leaf in leaves:
        key = leaf.name if case_sensitive else leaf.name.lower()
        if key in seen:
            raise ValueError(f"flattening makes the column {leaf.name!r} twice: from {seen[key]} and {leaf.path}")
        seen[key] = leaf.path


def flatten(df: DataFrame, explode: bool = False, max_depth: int | None = None, raw_column: str | None = None) -> DataFrame:
    """Replace every struct by its children, named ``parent_child``, until none is left.

    explode: arrays of structs become rows (outer: an empty or null array keeps its row);
        otherwise such arrays stay as they are.
    max_depth: how many levels to open; None goes on to the end.
    raw_column: adds the record as JSON text, taken before anything is opened.

    A null struct gives null children, an empty struct vanishes, maps and arrays of plain
    values stay. Two columns that would get one name raise ValueError. Between two
    explosions there is one projection however many columns there are.
    """
    if raw_column:
        if raw_column in df.columns:
            raise ValueError(f"the input already has a column {raw_column!r}")
        df = df.withColumn(raw_column, F.to_json(F.struct("*")))
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    leaves = [_Leaf(f.name, (f.name,), f.dataType) for f in df.schema.fields]
    _check_names(leaves, case_sensitive)
    depth = 0
    while max_depth is None or depth < max_depth:
        arrays = [leaf for leaf in leaves if explode and _is_record_array(leaf.dtype)]
        if not arrays and not any(isinstance(leaf.dtype, T.StructType) for leaf in leaves):
            break
        if arrays:
            df = df.select([leaf.column() for leaf in leaves])
            leaves = [_Leaf(leaf.name, (leaf.name,), leaf.dtype) for leaf in leaves]
            for array in arrays:  # Spark takes one generator per projection
                df = df.select([F.explode_outer(leaf.column()).alias(leaf.name) if leaf.name == array.name else leaf.column() for leaf in leaves])
                leaves = [_Leaf(leaf.name, leaf.path, leaf.dtype.elementType) if leaf.name == array.name else leaf for leaf in leaves]
        leaves = _expand_once(leaves)
        _check_names(leaves, case_sensitive)
        depth += 1
    return df.select([leaf.column() for leaf in leaves])


def explode_records(df: DataFrame, column: str = "hotels", explode: bool = True, max_depth: int | None = None, raw_column: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array of records ``column``, flattened.

    A document whose array is null or empty keeps one row of nulls; all other columns of
    the document go, but those in ``keep``, which each of its records gets.
    """
    if keep:
        kept = [F.col(f"`{name}`") for name in keep]
        records = df.select(F.explode_outer(F.col(f"`{column}`")).alias("record"), *kept)
        raw = [F.to_json(F.struct("record.*")).alias(raw_column)] if raw_column else []
        return flatten(records.select("record.*", *raw, *kept), explode=explode, max_depth=max_depth)
    records = df.select(F.explode_outer(F.col(f"`{column}`")).alias("record")).select("record.*")
    return flatten(records, explode=explode, max_depth=max_depth, raw_column=raw_column)
