"""Derived columns, transforms, category keys and cost arithmetic."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.registry import check, table
from lateralis.functions.columns import (
    composite_key,
    cost_breakdown,
    key_prefix,
    key_suffix,
    linear_score,
    midpoint,
    total_from_unit_cost,
    unit_cost,
)
from lateralis.functions.transforms import apply_transforms, invert_transforms
from lateralis.operators.categories import collect_values, recode_to_list, unknown_fallback
from lateralis.operators.derive import derive_well_columns, keep_columns

IDS = ["l_orderkey", "l_linenumber"]


@check("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE (a + b) / 2 END AS midpoint
FROM (SELECT *, nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b FROM lineitem)""")
def nullable_midpoint(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax"))
    return table(spark, folder, "lineitem").select(*IDS, midpoint(a, b).alias("midpoint"))


@check("""
SELECT l_orderkey, l_linenumber, l_extendedprice AS "TotalWellCost_USDMM", l_quantity AS "LateralLength_FT",
       CASE WHEN la IS NULL THEN lb WHEN lb IS NULL THEN la ELSE round((la + lb) / 2, 6) END AS "LatitudeMP",
       round((l_quantity + l_linenumber) / 2, 6) AS "LongitudeMP", CAST(year(l_shipdate) AS INTEGER) AS "CompletionYear",
       round(1e6 * l_extendedprice / l_quantity, 2) AS "cost/ft_Lateral"
FROM (SELECT *, nullif(l_discount, 0) AS la, nullif(l_tax, 0) AS lb FROM lineitem)""")
def derived_well_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Midpoints, year and unit cost, with their raw inputs dropped."""
    lines = table(spark, folder, "lineitem")
    wells = lines.select(
        *IDS, F.col("l_extendedprice").alias("TotalWellCost_USDMM"), F.col("l_quantity").alias("LateralLength_FT"),
        F.nullif("l_discount", F.lit(0.0)).alias("LatitudeBHWGS84"), F.nullif("l_tax", F.lit(0.0)).alias("LatitudeSHWGS84"),
        F.col("l_quantity").alias("LongitudeBHWGS84"), F.col("l_linenumber").cast("double").alias("LongitudeSHWGS84"),
        F.col("l_shipdate").alias("CompletionDate"),
    )
    derived = derive_well_columns(wells)
    rounded = {"LatitudeMP": 6, "LongitudeMP": 6, "cost/ft_Lateral": 2}
    return derived.withColumns({c: F.round(F.col(f"`{c}`"), d) for c, d in rounded.items()})


@check("SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS completion_year FROM lineitem")
def completion_year(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*IDS, F.year("l_shipdate").alias("completion_year"))


@check("""
SELECT l_orderkey, l_linenumber, round(1e6 * l_extendedprice / nullif(l_discount, 0), 2) AS unit_cost FROM lineitem""")
def unit_cost_per_foot(spark: SparkSession, folder: str) -> DataFrame:
    """A zero length gives NULL."""
    cost = unit_cost(F.col("l_extendedprice"), F.col("l_discount"))
    return table(spark, folder, "lineitem").select(*IDS, F.round(cost, 2).alias("unit_cost"))


@check("SELECT * EXCLUDE (l_discount, l_tax, l_shipdate) FROM lineitem")
def redundant_columns_dropped(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").drop("l_discount", "l_tax", "l_shipdate")


@check("SELECT l_extendedprice, l_quantity, l_returnflag FROM lineitem")
def validated_projection(spark: SparkSession, folder: str) -> DataFrame:
    return keep_columns(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity", "l_returnflag"])


@check("""
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS l_extendedprice,
       round(sqrt(l_quantity), 6) AS l_quantity, round(l_tax * l_tax, 6) AS l_tax
FROM lineitem""")
def unary_transforms(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*IDS, "l_extendedprice", "l_quantity", "l_tax")
    spec = {"l_tax": "square", "l_discount": "log", "l_extendedprice": "log", "l_quantity": "sqrt"}
    done = apply_transforms(lines, spec, order=["l_extendedprice", "l_quantity", "l_tax"])
    return done.select(*IDS, *[F.round(c, 6).alias(c) for c in ("l_extendedprice", "l_quantity", "l_tax")])


@check("""
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS l_extendedprice,
       round(l_quantity * ln(l_extendedprice), 6) AS l_quantity
FROM lineitem""")
def binary_transform(spark: SparkSession, folder: str) -> DataFrame:
    """The product sees the logarithm taken before it."""
    lines = table(spark, folder, "lineitem").select(*IDS, "l_extendedprice", "l_quantity")
    done = apply_transforms(lines, {"l_extendedprice": "log", "l_quantity": {"multiply": ["l_extendedprice"]}})
    return done.select(*IDS, *[F.round(c, 6).alias(c) for c in ("l_extendedprice", "l_quantity")])


@check("""
SELECT l_orderkey, l_linenumber, round(exp(l_discount), 6) AS l_discount, round(sqrt(l_quantity), 6) AS l_quantity,
       round(l_tax * l_tax, 6) AS l_tax
FROM lineitem""")
def inverse_transforms(spark: SparkSession, folder: str) -> DataFrame:
    """Columns the frame lacks are skipped."""
    lines = table(spark, folder, "lineitem").select(*IDS, "l_discount", "l_quantity", "l_tax")
    done = invert_transforms(lines, {"l_discount": "log", "l_quantity": "square", "l_tax": "sqrt", "absent": "log"})
    return done.select(*IDS, *[F.round(c, 6).alias(c) for c in ("l_discount", "l_quantity", "l_tax")])


@check("""
SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(l_discount, 0), 4) AS l_extendedprice FROM lineitem""")
def inverse_binary_transform(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*IDS, "l_extendedprice", "l_discount")
    done = invert_transforms(lines, {"l_extendedprice": {"multiply": ["l_discount"]}})
    return done.select(*IDS, F.round("l_extendedprice", 4).alias("l_extendedprice"))


@check("""
SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_type || '_' || p_brand END AS composite FROM part""")
def composite_category(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.when(F.col("p_size") != 1, F.col("p_brand"))
    return table(spark, folder, "part").select("p_partkey", composite_key(F.col("p_type"), brand).alias("composite"))


@check("""
SELECT p_partkey, split_part(k, '_', 1) AS reservoir, split_part(k, '_', -1) AS operator
FROM (SELECT p_partkey, p_type || '_' || p_brand || '_' || p_size AS k FROM part)""")
def composite_parts(spark: SparkSession, folder: str) -> DataFrame:
    key = composite_key(F.col("p_type"), F.col("p_brand"), F.col("p_size").cast("string"))
    return table(spark, folder, "part").select(
        "p_partkey", key_prefix(key).alias("reservoir"), key_suffix(key).alias("operator")
    )


@check("""
SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#7', 'Brand#11') THEN p_brand ELSE 'miscellaneous' END AS operator
FROM part""")
def whitelist_recode(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", recode_to_list(F.col("p_brand"), ["Brand#1", "Brand#7", "Brand#11"]).alias("operator")
    )


@check("""
SELECT l_orderkey, l_linenumber, round(t, 2) AS "TotalCost_USDMM", round(t * 0.325, 6) AS "Drilling_USDMM",
       round(t * 0.05, 6) AS "Facilities_USDMM", round(t * 0.625, 6) AS "Completions_USDMM"
FROM (SELECT *, l_extendedprice / 7013.337 AS t FROM lineitem)""")
def cost_shares(spark: SparkSession, folder: str) -> DataFrame:
    # The divisor keeps the values off exact halves, which decimal and binary rounding treat differently.
    parts = cost_breakdown(F.col("l_extendedprice") / 7013.337)
    rounded = {n: c if n == "TotalCost_USDMM" else F.round(c, 6) for n, c in parts.items()}
    return table(spark, folder, "lineitem").select(*IDS, *[c.alias(n) for n, c in rounded.items()])


@check("""
SELECT l_orderkey, l_linenumber, round(p * l_quantity * 1000 / 1e6, 2) AS total_cost, round(p, 2) AS unit_cost
FROM (SELECT *, l_extendedprice / 7.013337 AS p FROM lineitem)""")
def total_from_unit(spark: SparkSession, folder: str) -> DataFrame:
    unit = F.col("l_extendedprice") / 7.013337
    return table(spark, folder, "lineitem").select(
        *IDS,
        total_from_unit_cost(unit, F.col("l_quantity") * 1000).alias("total_cost"),
        F.round(unit, 2).alias("unit_cost"),
    )


@check("""
SELECT l_orderkey, l_linenumber,
       round(120.5 + 3.25 * (l_quantity - 25) / 12.5 - 40.0 * (l_discount - 0.05) / 0.03
             + CASE l_returnflag WHEN 'N' THEN 7.5 WHEN 'R' THEN -2.25 ELSE 0 END, 6) AS score
FROM lineitem""")
def scoring_by_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    score = linear_score(
        120.5,
        [(F.col("l_quantity"), 25, 12.5, 3.25), (F.col("l_discount"), 0.05, 0.03, -40.0)],
        [(F.col("l_returnflag"), "N", 7.5), (F.col("l_returnflag"), "R", -2.25)],
    )
    return table(spark, folder, "lineitem").select(*IDS, F.round(score, 6).alias("score"))


@check("""
WITH known AS (SELECT DISTINCT p_type || '_' || p_brand AS k FROM part WHERE p_size <= 25)
SELECT p_partkey, CASE WHEN p_type || '_' || p_brand IN (SELECT k FROM known) THEN p_type || '_' || p_brand
                       ELSE p_type || '_miscellaneous' END AS operator
FROM part""")
def unknown_operator_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Composite keys seen among small parts are known; all others fall back."""
    parts = table(spark, folder, "part").withColumn("k", composite_key(F.col("p_type"), F.col("p_brand")))
    known = collect_values(parts.where("p_size <= 25"), "k")
    return parts.select("p_partkey", unknown_fallback(F.col("k"), known).alias("operator"))
