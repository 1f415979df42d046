"""Batch scoring of whole tables."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.aggregates import BIN_COLUMNS, ERRORS_SQL, binned_input, nested_sql
from lateralis.checks.joins import PAIRS_SQL, nation_areas
from lateralis.checks.registry import check, table
from lateralis.functions.columns import composite_key, cost_breakdown, key_suffix, linear_score, total_from_unit_cost, unit_cost
from lateralis.operators.categories import group_rare, recode_to_list, unknown_fallback
from lateralis.operators.derive import add_midpoints
from lateralis.operators.errorbins import absolute_percentage_error, bin_spec, error_table, expected_error
from lateralis.operators.models import FEATURES
from lateralis.plans.score import Package, locate_wells, score_wells, validate, validation_rows
from lateralis.session import spread

_LISTED = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"]
_KNOWN = [f"{t}_{b}" for t in ("ECONOMY", "SMALL") for b in (*_LISTED[:3], "miscellaneous")]


@check(f"""
WITH {ERRORS_SQL},
coded AS (SELECT *, p_type || '_' || CASE WHEN p_brand IN ({', '.join(f"'{b}'" for b in _LISTED)}) THEN p_brand ELSE 'miscellaneous' END AS k FROM x),
fallen AS (SELECT *, CASE WHEN k IN ({', '.join(f"'{k}'" for k in _KNOWN)}) THEN k ELSE p_type || '_miscellaneous' END AS operator FROM coded),
scored AS (SELECT *, operator IN ({', '.join(f"'{k}'" for k in _KNOWN)}) AS usable,
    800.0 + 35.5 * (l_quantity - 25) / 12.5 - 12.25 * (p_retailprice - 950) / 50
        + CASE WHEN operator = 'SMALL_Brand#1' THEN 17.5 ELSE 0 END + CASE WHEN operator = 'SMALL_miscellaneous' THEN -4.25 ELSE 0 END AS unit
    FROM fallen)
SELECT l_orderkey, l_linenumber, operator, split_part(operator, '_', -1) AS operator_name,
       CASE WHEN usable THEN round(unit / 7.013337, 2) END AS "Cost_USDPerFT",
       CASE WHEN usable THEN round(unit / 7.013337 * lateral_length / 1e6, 2) END AS "TotalCost_USDMM",
       CASE WHEN usable THEN round(unit / 7.013337 * lateral_length / 1e6 * 0.325, 6) END AS "Drilling_USDMM",
       round(m, 2) AS "expected_cost_variance_%",
       round(1e6 * (l_quantity / 1000) / lateral_length, 6) AS "ActualcostPerFT"
FROM scored LEFT JOIN errors ON bin_ll = CAST(a AS BIGINT) || ' - ' || CAST(a + 1000 AS BIGINT)
    AND bin_prop = CAST(b AS BIGINT) || ' - ' || CAST(b + sp AS BIGINT)
    AND bin_fluid = CAST(c AS BIGINT) || ' - ' || CAST(c + sf AS BIGINT)
WHERE 1e6 * (l_quantity / 1000) / lateral_length < 10""")
def batch_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Recode, composite key, fallback, scoring by fixed coefficients, costs, expected error and actuals in one plan."""
    wells = binned_input(spark, folder)
    spec = bin_spec(wells, *BIN_COLUMNS)
    errors = wells.withColumn("error", absolute_percentage_error(F.col("l_extendedprice"), F.col("pred")))
    key = composite_key(F.col("p_type"), recode_to_list(F.col("p_brand"), _LISTED))
    operator = F.col("operator")
    unit = linear_score(
        800.0,
        [(F.col("l_quantity"), 25, 12.5, 35.5), (F.col("p_retailprice"), 950, 50, -12.25)],
        [(operator, "SMALL_Brand#1", 17.5), (operator, "SMALL_miscellaneous", -4.25)],
    ) / 7.013337  # off exact halves, which decimal and binary rounding treat differently
    scored = wells.withColumn("operator", unknown_fallback(key, _KNOWN)).withColumn(
        "unit", F.when(operator.isin(*_KNOWN), unit)
    )
    costs = cost_breakdown(F.col("unit") * F.col("lateral_length") / 1e6)
    scored = expected_error(scored, error_table(errors, spec, "error"), spec.steps, BIN_COLUMNS)
    actual = unit_cost(F.col("l_quantity") / 1000, F.col("lateral_length"))
    return scored.where(actual < 10).select(
        "l_orderkey", "l_linenumber", "operator", key_suffix(operator).alias("operator_name"),
        F.round("unit", 2).alias("Cost_USDPerFT"),
        total_from_unit_cost(F.col("unit"), F.col("lateral_length")).alias("TotalCost_USDMM"),
        F.round(costs["Drilling_USDMM"], 6).alias("Drilling_USDMM"),
        "expected_cost_variance_%",
        F.round(actual, 6).alias("ActualcostPerFT"),
    )


@check("""
WITH o AS (SELECT l_orderkey, l_linenumber, p_type || '_' || p_brand AS k FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT k, count(*) AS n FROM o GROUP BY k), t AS (SELECT count(*) // 150 AS threshold FROM o)
SELECT l_orderkey, l_linenumber, CASE WHEN n >= threshold THEN k ELSE split_part(k, '_', 1) || '_miscellaneous' END AS operator
FROM o JOIN n USING (k), t""")
def fallback_to_trained_operators(spark: SparkSession, folder: str) -> DataFrame:
    """Composite operators with enough rows count as trained, all others fall back to their reservoir's rest."""
    wells = binned_input(spark, folder).withColumn("operator", composite_key(F.col("p_type"), F.col("p_brand")))
    trained = group_rare(wells, "operator", wells.count() // 150).retained
    fallen = unknown_fallback(F.col("operator"), trained)
    return wells.select("l_orderkey", "l_linenumber", fallen.alias("operator"))


# Wells of the customers, in the columns of a well table: the paths and areas of the spatial queries, a length, two
# completion properties and a unit cost from the balance. One in 97 has no cost.
_WELLS_SQL = f"""{PAIRS_SQL},
wells AS (SELECT c_custkey, 'p' || (c_custkey % 1000) AS api10, 3000 + c_custkey % 9001 AS len_ft, 500 + c_custkey % 3001 AS proppant,
    10 + c_custkey % 71 AS fluid, 400 + c_acctbal / 100 AS unit, c_mktsegment AS seg, 'R' || (c_nationkey % 3) AS res,
    (y1 + y2) / 2 AS lat, (x1 + x2) / 2 AS lon FROM customer JOIN w USING (c_custkey)),
complete AS (SELECT * FROM wells WHERE c_custkey % 97 > 0),
fit AS (SELECT regr_slope(unit, len_ft) AS s, regr_intercept(unit, len_ft) AS i FROM complete),
priced AS (SELECT complete.*, i + s * len_ft AS pred FROM complete, fit),
{nested_sql("priced", "len_ft", "proppant", "fluid")},
errors AS (SELECT bin_ll, bin_prop, bin_fluid, round(quantile_cont(100 * abs(unit - pred) / unit, 0.5), 2) AS m FROM labelled GROUP BY ALL),
keyed AS (SELECT x.*, "Area", res || '_' || CASE WHEN seg IN ('BUILDING', 'MACHINERY') THEN seg ELSE 'miscellaneous' END AS k
          FROM x JOIN pairs USING (c_custkey)),
known AS (SELECT *, CASE WHEN k IN ('R0_BUILDING', 'R0_miscellaneous', 'R1_MACHINERY', 'R1_miscellaneous') THEN k ELSE res || '_miscellaneous' END AS op FROM keyed),
scored AS (SELECT *, CASE WHEN res <> 'R2' THEN pred END AS price FROM known
    LEFT JOIN errors ON bin_ll = CAST(a AS BIGINT) || ' - ' || CAST(a + 1000 AS BIGINT)
    AND bin_prop = CAST(b AS BIGINT) || ' - ' || CAST(b + sp AS BIGINT) AND bin_fluid = CAST(c AS BIGINT) || ' - ' || CAST(c + sf AS BIGINT))"""


def _customer_wells(spark: SparkSession, folder: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    lateral = (3000 + key % 9001).cast("double")
    cost = F.when(key % 97 > 0, lateral * (400 + balance / 100) / 1e6)
    x, y = balance / 1000, F.col("c_nationkey") + (key % 100) / 100.0
    return add_midpoints(spread(table(spark, folder, "customer")).select(
        F.concat(F.lit("p"), key % 1000).alias("API10"), key.cast("string").alias("API14"), cost.alias("TotalWellCost_USDMM"),
        lateral.alias("LateralLength_FT"), (500 + key % 3001).cast("double").alias("Proppant_LBSPerFT"), (10 + key % 71).cast("double").alias("Fluid_BBLPerFT"),
        F.col("c_mktsegment").alias("OperatorGold"), F.concat(F.lit("R"), F.col("c_nationkey") % 3).alias("ReservoirGoldConsolidated"),
        x.alias("LongitudeSHWGS84"), y.alias("LatitudeSHWGS84"),
        (x + (key % 7 - 3) * 0.1).alias("LongitudeBHWGS84"), (y + (key % 5 - 2) * 0.2).alias("LatitudeBHWGS84"),
    ))


def _scored_wells(spark: SparkSession, folder: str) -> DataFrame:
    """Package a least-squares model of the unit cost with its error table, then locate and score all wells with it."""
    wells = _customer_wells(spark, folder)
    unit = F.col("TotalWellCost_USDMM") * 1e6 / F.col("LateralLength_FT")
    complete = wells.dropna("any").withColumn("unit", unit).persist()
    assembler = VectorAssembler(inputCols=["LateralLength_FT"], outputCol=FEATURES, handleInvalid="keep")
    model = LinearRegression(featuresCol=FEATURES, labelCol="unit", solver="normal").fit(assembler.transform(complete))
    columns = ("LateralLength_FT", "Proppant_LBSPerFT", "Fluid_BBLPerFT")
    spec = bin_spec(complete, *columns)
    predicted = model.transform(assembler.transform(complete))
    errors = error_table(predicted.withColumn("error", absolute_percentage_error(F.col("unit"), F.col("prediction"))), spec, "error")
    complete.unpersist()
    package = Package(
        PipelineModel([assembler, model]), {"OperatorGold": ["R0_BUILDING", "R0_miscellaneous", "R1_MACHINERY", "R1_miscellaneous"]},
        ["BUILDING", "MACHINERY"], errors, spec.steps,
    )
    located, _ = locate_wells(wells, nation_areas(spark, folder).select("Area", "ring"), cell=0.5)
    return score_wells(located, package)


@check(f"""
WITH {_WELLS_SQL.removeprefix(chr(10)).removeprefix("WITH ")}
SELECT api10 AS "API10", "Area" AS "Type Curve Area", proppant::DOUBLE AS "Proppant_LBSPerFT", fluid::DOUBLE AS "Fluid_BBLPerFT",
       round(lat, 6) AS "LatitudeMP", round(lon, 6) AS "LongitudeMP", len_ft::DOUBLE AS "LateralLength_FT", op AS "OperatorGold",
       res AS "ReservoirGoldConsolidated", round(price * len_ft / 1e6, 2) AS "TotalCost_USDMM", round(price, 2) AS "Cost_USDPerFT",
       round(price * len_ft / 1e6 * 0.325, 2) AS "Drilling_USDMM", round(price * len_ft / 1e6 * 0.05, 2) AS "Facilities_USDMM",
       round(price * len_ft / 1e6 * 0.625, 2) AS "Completions_USDMM", m AS "expected_cost_variance_%",
       round(unit * len_ft / 1e6, 6) AS "Actualcost_USDMM", round(unit, 6) AS "ActualcostPerFT",
       CASE WHEN res = 'R2' THEN 'unknown value in OperatorGold' END AS score_note
FROM scored""")
def wells_scored(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way from wells and areas to the scored table, every column compared."""
    scored = _scored_wells(spark, folder)
    digits = {"LatitudeMP": 6, "LongitudeMP": 6, "Actualcost_USDMM": 6, "ActualcostPerFT": 6}
    return scored.withColumns({c: F.round(c, d) for c, d in digits.items()})


@check(f"""
WITH {_WELLS_SQL.removeprefix(chr(10)).removeprefix("WITH ")}
SELECT "Area" AS "Type Curve Area", split_part(op, '_', -1) AS "OperatorGold", count(*) AS wells FROM scored WHERE unit < 450 GROUP BY ALL""")
def scored_wells_in_range(spark: SparkSession, folder: str) -> DataFrame:
    """Scored wells below a ceiling of the actual unit cost, with the plain operator name."""
    rows = validation_rows(_scored_wells(spark, folder), ceiling=450.0)
    return rows.groupBy("Type Curve Area", "OperatorGold").agg(F.count(F.lit(1)).alias("wells"))


@check(f"""
WITH {_WELLS_SQL.removeprefix(chr(10)).removeprefix("WITH ")},
v AS (SELECT "Area", unit AS y, round(price, 2) AS p FROM scored WHERE unit < 480 AND price IS NOT NULL)
SELECT "Area" AS "Type Curve Area", round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 4) AS r2, round(avg((y - p) * (y - p)), 3) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(p - y) * 100 / y), 4) AS mape
FROM v GROUP BY "Area" HAVING count(*) > 1""")
def scored_wells_validated(spark: SparkSession, folder: str) -> DataFrame:
    """Validation of the scored wells per area that has several."""
    scored = _scored_wells(spark, folder).persist()
    several = scored.where((F.col("ActualcostPerFT") < 480) & F.col("Cost_USDPerFT").isNotNull()).groupBy("Type Curve Area").count().where("count > 1")
    found = validate(scored, ["Type Curve Area"], ceiling=480.0).join(several.drop("count"), "Type Curve Area")
    return found.withColumns({c: F.round(c, d) for c, d in (("r2", 4), ("mse", 3), ("rmse", 3), ("mape", 4))})
