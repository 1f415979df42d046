"""Models of several basins at once, on the order lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.models import CLEAN_SQL, KEY_SQL, planted_rows
from lateralis.checks.registry import check, table
from lateralis.config import FilterConfig, RunConfig
from lateralis.functions.columns import col
from lateralis.operators.grouped_models import grouped_huber, grouped_least_squares, score_by_group
from lateralis.operators.models import LABEL
from lateralis.operators.quantiles import group_quantiles
from lateralis.plans.stages import scaler_of
from lateralis.plans.train import train_basins

PLANTED_SQL = f"CASE WHEN l_extendedprice > 100000 THEN 4 * {CLEAN_SQL} ELSE {CLEAN_SQL} END"
BASIN_SQL = "l_returnflag || l_linestatus"


def _basin_rows(spark: SparkSession, folder: str) -> DataFrame:
    return planted_rows(spark, folder).withColumn("basin", F.concat("l_returnflag", "l_linestatus"))


@check(f"""
WITH r AS (SELECT {BASIN_SQL} AS basin, l_quantity AS x, l_discount AS z, {PLANTED_SQL} AS y FROM lineitem),
s AS (SELECT basin, count(*) AS rows, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz,
             covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM r GROUP BY basin),
f AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS c FROM s),
e AS (SELECT basin, median(abs(y - (my + b * (x - mx) + c * (z - mz))) / abs(y)) AS error FROM r JOIN f USING (basin) GROUP BY basin)
SELECT basin, rows, round(b, 4) AS quantity, round(c, 3) AS discount, round(my - b * mx - c * mz, 3) AS intercept,
       round(100 * error, 3) AS median_error FROM f JOIN e USING (basin)""")
def basin_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """Least squares of all basins from one aggregate, and the median percentage error of each."""
    rows, features = _basin_rows(spark, folder), ["l_quantity", "l_discount"]
    fits = grouped_least_squares(rows, "basin", features, LABEL)
    scored = score_by_group(rows, fits, "basin", features).withColumn("error", F.abs(F.col(LABEL) - F.col("prediction")) / F.abs(col(LABEL)))
    errors = group_quantiles(scored, {"error": [0.5]}, ["basin"])
    weight = lambda i, digits: F.round(F.get("coefficients", F.lit(i)), digits)
    return fits.join(errors, "basin").select(
        "basin", "rows", weight(0, 4).alias("quantity"), weight(1, 3).alias("discount"), F.round("intercept", 3).alias("intercept"),
        F.round(100 * F.get("error", F.lit(0)), 3).alias("median_error"),
    )


@check(f"""
WITH RECURSIVE r AS (SELECT {BASIN_SQL} AS basin, l_quantity AS x, {PLANTED_SQL} AS y FROM lineitem),
start AS (SELECT basin, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, sqrt(regr_syy(y, x) * (1 - regr_r2(y, x)) / count(*)) AS s FROM r GROUP BY basin),
steps(k, basin, b, a, s) AS (
  SELECT 0, basin, b, a, s FROM start
  UNION ALL
  SELECT k + 1, basin, (sxy - sx * sy / n) / (sxx - sx * sx / n + 0.0001 * s),
         (sy - sx * (sxy - sx * sy / n) / (sxx - sx * sx / n + 0.0001 * s)) / n, sqrt(squares / (rows - 1.35 * 1.35 * outer_rows))
  FROM (SELECT k, basin, any_value(s) AS s, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy,
               sum(CASE WHEN e <= 1.35 * s THEN e * e ELSE 0 END) AS squares, count(*) AS rows, count_if(e > 1.35 * s) AS outer_rows
        FROM (SELECT k, basin, s, x, y, e, CASE WHEN e <= 1.35 * s THEN 1 ELSE 1.35 * s / e END AS w
              FROM (SELECT k, basin, s, x, y, abs(y - a - b * x) AS e FROM steps JOIN r USING (basin) WHERE k < 60)) GROUP BY k, basin))
SELECT basin, round(b, 4) AS quantity, round(a, 3) AS intercept, round(s, 3) AS scale FROM steps WHERE k = 60""")
def basin_robust_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """The robust fits of all basins, which advance together, against sixty rounds in SQL."""
    fits = grouped_huber(_basin_rows(spark, folder), "basin", ["l_quantity"], LABEL)
    return fits.select(
        "basin", F.round(F.get("coefficients", F.lit(0)), 4).alias("quantity"), F.round("intercept", 3).alias("intercept"),
        F.round("scale", 3).alias("scale"),
    )


def _completions(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines as a table of completions; every line is a well, its return flag the basin."""
    price, missing = F.col("l_extendedprice"), F.lit(None).cast("double")
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    total = price / 1e4
    return table(spark, folder, "lineitem").select(
        key.alias("API10"), key.alias("API14"), key.alias("WellName"), F.col("l_returnflag").alias("BasinQuantum"), F.lit("H").alias("HoleDirection"),
        F.lit("2020-06-01").cast("date").alias("CompletionDate"),
        *(F.col("l_tax").alias(c) for c in ("LatitudeBHWGS84", "LatitudeSHWGS84", "LongitudeBHWGS84", "LongitudeSHWGS84")),
        (total * 0.625).alias("CompletionCost_ENV_USDMM"), (total * 0.325).alias("DrillCost_ENV_USDMM"), (total * 0.05).alias("FacilitiesCost_ENV_USDMM"),
        total.alias("TotalWellCost_ENV_USDMM"), (F.col("l_discount") * 20_000).alias("Proppant_LBSPerFT"), (F.col("l_tax") * 1000).alias("Fluid_BBLPerFT"),
        F.coalesce(missing, F.lit(9_000.0)).alias("TVD_FT"), (F.col("l_quantity") * 200).alias("LateralLength_FT"),
        F.col("l_linestatus").alias("OperatorGold"), F.col("l_linestatus").alias("ReservoirGoldConsolidated"),
    )


@check(f"""
WITH w AS (SELECT l_returnflag AS basin, l_quantity * 200 AS x, 100 * l_extendedprice / (l_quantity * 200) AS y,
                  ('0x' || substr(md5('42|' || {KEY_SQL}), 1, 8))::BIGINT % 10000 AS h FROM lineitem)
SELECT basin, count(*)::BIGINT AS training_rows, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 3) AS intercept
FROM w WHERE h >= 2800 GROUP BY basin""")
def basins_trained_together(spark: SparkSession, folder: str) -> DataFrame:
    """Several basins through the whole training plan, from one scan of the completions."""
    config = RunConfig(
        reservoirs=("F", "O"), filtering=FilterConfig(keep=("LateralLength_FT", "cost/ft_Lateral")), features=("LateralLength_FT",),
        target="cost/ft_Lateral", models={"LinearRegression": {}},
    )
    trained = train_basins(_completions(spark, folder), None, {b: config for b in ("A", "N", "R")}, cv_folds=None, importance_repeats=0)
    found = []
    for basin, result in trained.items():
        _, _, center, scale = scaler_of(result.pipeline).parameters()[0]
        model = result.fitted["LinearRegression"].model
        slope = float(model.coefficients[0]) / scale
        found.append((basin, result.metadata["training_rows"], round(slope, 6), round(float(model.intercept) - slope * center, 3)))
    return spark.createDataFrame(found, "basin string, training_rows long, slope double, intercept double")
