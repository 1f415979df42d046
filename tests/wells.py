"""Seeded synthetic wells with a planted cost model, made by Spark expressions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASIN = "ANADARKO EAST"
RESERVOIRS = ("WOODFORD", "MISSISSIPPIAN")
N_OPERATORS = 8
COEFFICIENTS = {"Proppant_LBSPerFT": 0.15, "Fluid_BBLPerFT": 4.0, "LateralLength_FT": -0.02}
INTERCEPT = 700.0


def _uniform(seed: int, low: float, high: float):
    return F.lit(low) + (high - low) * F.rand(seed)


def completions(spark: SparkSession, rows: int = 3000, outliers: float = 0.04, noise: float = 10.0) -> DataFrame:
    base = spark.range(0, rows, 1, 4)
    df = base.select(
        F.format_string("%010d", "id").alias("API10"),
        F.format_string("%014d", "id").alias("API14"),
        F.when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("WELL "), "id")).alias("WellName"),
        F.when(F.col("id") % 11 == 0, "MIDLAND").otherwise(BASIN).alias("BasinQuantum"),
        F.when(F.col("id") % 13 == 0, "V").otherwise("H").alias("HoleDirection"),
        F.when(F.col("id") % 101 == 0, F.lit("2014-01-01"))
        .otherwise(F.date_add(F.lit("2012-01-01"), (F.col("id") % 4000).cast("int")).cast("string"))
        .cast("date").alias("CompletionDate"),
        F.when(F.col("id") % 53 == 0, None).otherwise(_uniform(1, 35.0, 36.0)).alias("LatitudeBHWGS84"),
        _uniform(2, 35.0, 36.0).alias("LatitudeSHWGS84"),
        _uniform(3, -98.5, -97.5).alias("LongitudeBHWGS84"),
        _uniform(4, -98.5, -97.5).alias("LongitudeSHWGS84"),
        _uniform(5, 500.0, 3500.0).alias("Proppant_LBSPerFT"),
        _uniform(6, 10.0, 80.0).alias("Fluid_BBLPerFT"),
        _uniform(7, 5000.0, 14000.0).alias("TVD_FT"),
        F.when(F.col("id") % 301 == 0, 0.0).otherwise(_uniform(8, 3000.0, 16000.0)).alias("LateralLength_FT"),
        F.concat(F.lit("OP"), F.least(F.floor(-F.log(F.rand(9)) * 1.7), F.lit(N_OPERATORS - 1)).cast("string")).alias("OperatorGold"),
        F.when(F.rand(10) < 0.5, RESERVOIRS[0]).when(F.rand(11) < 0.9, RESERVOIRS[1]).otherwise("HUNTON")
        .alias("ReservoirGoldConsolidated"),
        (F.randn(12) * noise).alias("_noise"),
        (F.rand(13) < outliers).alias("_outlier"),
        (F.rand(14) < 0.1).alias("_odd_split"),
    )
    unit = F.lit(INTERCEPT) + F.col("_noise")
    for name, weight in COEFFICIENTS.items():
        unit = unit + F.lit(weight) * F.col(name)
    unit = unit + F.when(F.col("ReservoirGoldConsolidated") == "WOODFORD", 50.0).otherwise(0.0)
    unit = F.when(F.col("_outlier"), unit * 4).otherwise(unit)
    total = unit * F.greatest(F.col("LateralLength_FT"), F.lit(3000.0)) / 1e6
    df = df.withColumn("TotalWellCost_ENV_USDMM", total).withColumns(
        {
            "DrillCost_ENV_USDMM": F.when(F.col("_odd_split"), total * 0.5).otherwise(total * 0.325),
            "FacilitiesCost_ENV_USDMM": total * 0.05,
            "CompletionCost_ENV_USDMM": total * 0.625,
        }
    )
    return df.drop("_noise", "_outlier", "_odd_split")


def reference_costs(wells: DataFrame) -> DataFrame:
    total = F.col("TotalWellCost_ENV_USDMM")
    return wells.where(F.col("API14").cast("long") % 10 < 7).select(
        "API10", "API14", "WellName", F.lit("HORIZONTAL").alias("HoleDirection"), "BasinQuantum", "CompletionDate",
        (total * 0.625).alias("CompletionCost_USDMM"),
        (total * 0.325).alias("DrillCost_USDMM"),
        (total * 0.05).alias("FacilitiesCost_USDMM"),
        total.alias("TotalWellCost_USDMM"),
    )


def areas(spark: SparkSession) -> DataFrame:
    """Four boxes and one concave ring over the wells' area."""
    rings = [
        ("NW", [(-98.5, 35.5), (-98.0, 35.5), (-98.0, 36.0), (-98.5, 36.0), (-98.5, 35.5)]),
        ("NE", [(-98.0, 35.5), (-97.5, 35.5), (-97.5, 36.0), (-98.0, 36.0), (-98.0, 35.5)]),
        ("SW", [(-98.5, 35.0), (-98.0, 35.0), (-98.0, 35.5), (-98.5, 35.5), (-98.5, 35.0)]),
        ("L", [(-98.0, 35.0), (-97.5, 35.0), (-97.5, 35.5), (-97.75, 35.5), (-97.75, 35.2), (-98.0, 35.2), (-98.0, 35.0)]),
    ]
    rows = [(name, "Anadarko", str(i), [{"x": x, "y": y} for x, y in ring]) for i, (name, ring) in enumerate(rings)]
    return spark.createDataFrame(rows, "Area string, Basin string, NAME string, ring array<struct<x:double,y:double>>")
