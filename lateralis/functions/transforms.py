"""Configured column transforms and their inverses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col, ratio

UNARY = {"log": F.ln, "square": lambda c: c * c, "sqrt": F.sqrt}
UNARY_INVERSE = {"log": F.exp, "square": F.sqrt, "sqrt": lambda c: c * c}
BINARY = {"multiply": lambda a, b: a * b}
BINARY_INVERSE = {"multiply": ratio}


def transform_column(x: Column, spec: Any, inverse: bool = False) -> Column:
    """``spec`` is a name, or ``{name: [other column]}`` of which the first entry counts."""
    if isinstance(spec, Mapping):
        name, others = next(iter(spec.items()))
        table = BINARY_INVERSE if inverse else BINARY
        arguments = [col(others[0]).cast("double")]
    else:
        name, arguments = spec, []
        table = UNARY_INVERSE if inverse else UNARY
    if name not in table:
        raise ValueError(f"transform {name!r} is not available; known: {sorted(table)}")
    return table[name](x.cast("double"), *arguments)


def apply_transforms(df: DataFrame, spec: Mapping[str, Any], order: Sequence[str] | None = None) -> DataFrame:
    """Transforms in order, each one seeing the results of those before it.

    ``order`` both restricts and reorders the columns.
    """
    names = [c for c in order if c in spec] if order else list(spec)
    for name in names:
        df = df.withColumn(name, transform_column(col(name), spec[name]))
    return df


def invert_transforms(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """Undo :func:`apply_transforms`, last one first; columns the frame lacks are left out."""
    for name in reversed(list(spec)):
        if name in df.columns:
            df = df.withColumn(name, transform_column(col(name), spec[name], inverse=True))
    return df
