"""Composition of frame-to-frame steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def run_chain(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Apply ``steps`` left to right; the order is part of the meaning."""
    return reduce(lambda frame, step: frame.transform(step), steps, df)
