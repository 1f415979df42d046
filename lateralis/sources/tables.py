"""Filtered scans of the two well tables and the Parquet snapshot of the working set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateralis.functions.columns import col

# Column names, predicates and spellings of the two catalog tables.
COMPLETIONS_COLUMNS = (
    "API10", "API14", "WellName",
    "LatitudeBHWGS84", "LatitudeSHWGS84", "LongitudeBHWGS84", "LongitudeSHWGS84",
    "CompletionDate",
    "CompletionCost_ENV_USDMM", "DrillCost_ENV_USDMM", "FacilitiesCost_ENV_USDMM", "TotalWellCost_ENV_USDMM",
    "Proppant_LBSPerFT", "Fluid_BBLPerFT", "TVD_FT", "LateralLength_FT",
    "OperatorGold", "ReservoirGoldConsolidated",
)
REFERENCE_COLUMNS = (
    "API10", "API14", "WellName",
    "CompletionCost_USDMM", "DrillCost_USDMM", "FacilitiesCost_USDMM", "TotalWellCost_USDMM",
)
COST_RENAMES = {
    "TotalWellCost_ENV_USDMM": "TotalWellCost_USDMM",
    "DrillCost_ENV_USDMM": "DrillCost_USDMM",
    "FacilitiesCost_ENV_USDMM": "FacilitiesCost_USDMM",
    "CompletionCost_ENV_USDMM": "CompletionCost_USDMM",
}
FIRST_COMPLETION_DATE = "2014-01-01"
COMPLETIONS_DIRECTION = "H"
REFERENCE_DIRECTION = "HORIZONTAL"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column: NULL is the only missing value from here on."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.nanvl(col(f.name), F.lit(None)).cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, floating)
            else col(f.name)
            for f in df.schema
        ]
    )


def filtered_scan(
    table: DataFrame,
    columns: Sequence[str],
    *,
    after: Mapping[str, str] | None = None,
    equal: Mapping[str, Any] | None = None,
    one_of: Mapping[str, Sequence[Any]] | None = None,
    present: Sequence[str] = (),
) -> DataFrame:
    """Project ``columns`` under simple predicates, all of which a Parquet scan can take over."""
    predicates = [col(c) > F.lit(v).cast("date") for c, v in (after or {}).items()]
    predicates += [col(c) == F.lit(v) for c, v in (equal or {}).items()]
    predicates += [col(c).isin(*values) for c, values in (one_of or {}).items()]
    predicates += [col(c).isNotNull() for c in present]
    scanned = table.where(reduce(and_, predicates)) if predicates else table
    cleaned = nan_to_null(scanned.select(*[col(c) for c in columns]))
    return cleaned.dropna("any", subset=[c for c in present if c in columns]) if present else cleaned


def scan_completions(
    table: DataFrame, basin: str, reservoirs: Sequence[str], after: str = FIRST_COMPLETION_DATE
) -> DataFrame:
    return filtered_scan(
        table,
        COMPLETIONS_COLUMNS,
        after={"CompletionDate": after},
        equal={"HoleDirection": COMPLETIONS_DIRECTION, "BasinQuantum": basin},
        one_of={"ReservoirGoldConsolidated": list(reservoirs)},
        present=["TotalWellCost_ENV_USDMM"],
    )


def scan_reference_costs(table: DataFrame, basin: str, after: str = FIRST_COMPLETION_DATE) -> DataFrame:
    return filtered_scan(
        table,
        REFERENCE_COLUMNS,
        after={"CompletionDate": after},
        equal={"HoleDirection": REFERENCE_DIRECTION, "BasinQuantum": basin},
        present=["TotalWellCost_USDMM"],
    )


def rename_costs(df: DataFrame, renames: Mapping[str, str] = COST_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def write_snapshot(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
