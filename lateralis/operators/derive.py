"""Derived well columns and the validated projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col, midpoint, unit_cost

# Input and output names of the derived columns.
COORDINATES = ("LatitudeBHWGS84", "LatitudeSHWGS84", "LongitudeBHWGS84", "LongitudeSHWGS84")
UNIT_COST = "cost/ft_Lateral"


def add_midpoints(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "LatitudeMP": midpoint(col("LatitudeBHWGS84"), col("LatitudeSHWGS84")),
            "LongitudeMP": midpoint(col("LongitudeBHWGS84"), col("LongitudeSHWGS84")),
        }
    )


def derive_well_columns(df: DataFrame) -> DataFrame:
    """Midpoints, completion year and unit cost; their raw inputs are dropped."""
    derived = add_midpoints(df).withColumns(
        {
            "CompletionYear": F.year("CompletionDate"),
            UNIT_COST: unit_cost(col("TotalWellCost_USDMM"), col("LateralLength_FT")),
        }
    )
    return derived.drop(*COORDINATES, "CompletionDate")


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.select(*[col(c) for c in columns])


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise KeyError(f"columns {absent} not in {df.columns}")
