"""Scans, snapshots and the flagship query."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.registry import LINES_WITH_PARTS, check, lines_with_parts, table
from lateralis.functions.columns import unit_cost
from lateralis.operators.categories import group_rare
from lateralis.operators.filters import threshold_chain
from lateralis.operators.quantiles import group_quantiles
from lateralis.session import scratch_path
from lateralis.sources.tables import filtered_scan, read_snapshot, rename_costs, write_snapshot


@check("""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_returnflag
FROM lineitem
WHERE l_shipdate > DATE '1998-01-01' AND l_linestatus = 'F' AND l_returnflag IN ('A', 'N')
  AND l_extendedprice IS NOT NULL""")
def completions_scan(spark: SparkSession, folder: str) -> DataFrame:
    return filtered_scan(
        table(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_returnflag"],
        after={"l_shipdate": "1998-01-01"},
        equal={"l_linestatus": "F"},
        one_of={"l_returnflag": ["A", "N"]},
        present=["l_extendedprice"],
    )


@check("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate > DATE '1998-01-01' AND o_orderpriority = '1-URGENT' AND o_totalprice IS NOT NULL""")
def reference_costs_scan(spark: SparkSession, folder: str) -> DataFrame:
    return filtered_scan(
        table(spark, folder, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice"],
        after={"o_orderdate": "1998-01-01"},
        equal={"o_orderpriority": "1-URGENT"},
        present=["o_totalprice"],
    )


@check("SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def snapshot_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Working set written as Parquet, laid out by one low-cardinality column, and read back."""
    path = scratch_path(spark, "snapshot")
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    write_snapshot(table(spark, folder, "lineitem").select(*columns), path, partition_by=["l_returnflag"])
    return read_snapshot(spark, path)


@check("SELECT l_orderkey, l_extendedprice AS total_cost, l_discount AS drill_cost, l_tax AS facilities_cost FROM lineitem")
def batch_rename(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_tax")
    return rename_costs(
        lines, {"l_extendedprice": "total_cost", "l_discount": "drill_cost", "l_tax": "facilities_cost"}
    )


FLAGSHIP_SQL = f"""
WITH wells AS (SELECT p_brand, l_quantity, l_extendedprice / l_quantity AS unit_cost FROM {LINES_WITH_PARTS}),
b1 AS (SELECT trunc(quantile_cont(unit_cost, 0.025)) AS lo, trunc(quantile_cont(unit_cost, 0.975)) AS hi FROM wells),
s1 AS (SELECT wells.* FROM wells, b1 WHERE (lo = 0 OR unit_cost > lo) AND (hi = 0 OR unit_cost <= hi)),
b2 AS (SELECT trunc(quantile_cont(l_quantity, 0.05)) AS lo, trunc(quantile_cont(l_quantity, 0.95)) AS hi FROM s1),
s2 AS (SELECT s1.* FROM s1, b2 WHERE (lo = 0 OR l_quantity > lo) AND (hi = 0 OR l_quantity <= hi)),
n AS (SELECT p_brand, count(*) AS n FROM s2 GROUP BY p_brand),
kept AS (
    SELECT CASE WHEN n >= (SELECT count(*) / 25 FROM s2) THEN p_brand ELSE 'miscellaneous' END AS operator_group, unit_cost
    FROM s2 JOIN n USING (p_brand))
SELECT operator_group, count(*) AS wells, round(quantile_cont(unit_cost, 0.5), 4) AS median_unit_cost
FROM kept GROUP BY operator_group"""


@check(FLAGSHIP_SQL)
def unit_cost_by_operator(spark: SparkSession, folder: str) -> DataFrame:
    """Scan, unit cost, percentile chain, rare-operator grouping, then count and median per group."""
    wells = lines_with_parts(spark, folder).select(
        "p_brand", "l_quantity", unit_cost(F.col("l_extendedprice") / 1e6, F.col("l_quantity")).alias("unit_cost")
    ).dropna("any")
    chain = threshold_chain(wells, {"unit_cost": (0.025, 0.975), "l_quantity": (0.05, 0.95)}, percentile=True)
    rows = chain.df.count()
    grouped = group_rare(chain.df, "p_brand", -(-rows // 25)).df.withColumnRenamed("p_brand", "operator_group")
    counts = grouped.groupBy("operator_group").agg(F.count(F.lit(1)).alias("wells"))
    medians = group_quantiles(grouped, {"unit_cost": [0.5]}, ["operator_group"], rows_at_most=rows)
    medians = medians.select("operator_group", F.round(F.col("unit_cost")[0], 4).alias("median_unit_cost"))
    return counts.join(medians, "operator_group")
