"""Row and cell filters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.registry import check, table
from lateralis.config import StatisticalFilter
from lateralis.operators.filters import (
    filter_range,
    grouped_threshold_chain,
    ratio_filter,
    statistical_mask,
    threshold_chain,
)
from lateralis.operators.repair import flag_cost_anomalies

KEPT = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*KEPT)


@check("""
SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b FROM lineitem
WHERE l_discount <> 0 AND l_tax <> 0""")
def incomplete_rows_dropped(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    nullable = [F.nullif(F.col(c), F.lit(0.0)).alias(n) for c, n in (("l_discount", "a"), ("l_tax", "b"))]
    return lines.select("l_orderkey", "l_linenumber", *nullable).dropna("any")


@check(f"""
SELECT {', '.join(KEPT)} FROM lineitem WHERE l_quantity > 5 AND l_quantity <= 40 AND l_extendedprice <= 90000""")
def absolute_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds of None and 0 are off."""
    lines = filter_range(_lines(spark, folder), "l_quantity", 5, 40)
    lines = filter_range(lines, "l_extendedprice", None, 90_000)
    return filter_range(lines, "l_discount", 0, 0)


@check(f"""
WITH b AS (SELECT trunc(quantile_cont(l_extendedprice, 0.025)) AS plo, trunc(quantile_cont(l_extendedprice, 0.975)) AS phi
           FROM lineitem)
SELECT {', '.join(KEPT)} FROM lineitem, b WHERE l_extendedprice > plo AND l_extendedprice <= phi""")
def percentile_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """The percentiles of the discount truncate to 0, which switches its bounds off."""
    lines = threshold_chain(_lines(spark, folder), {"l_extendedprice": (0.025, 0.975)}, percentile=True).df
    return threshold_chain(lines, {"l_discount": (0.025, 0.975)}, percentile=True).df


_CHAIN = {"l_extendedprice": (0.025, 0.975), "l_quantity": (0.1, 0.9), "l_discount": (0.025, 0.975)}

_CHAIN_SQL = f"""
b1 AS (SELECT trunc(quantile_cont(l_extendedprice, 0.025)) AS lo, trunc(quantile_cont(l_extendedprice, 0.975)) AS hi FROM lineitem),
s1 AS (SELECT {', '.join(KEPT)} FROM lineitem, b1 WHERE (lo = 0 OR l_extendedprice > lo) AND (hi = 0 OR l_extendedprice <= hi)),
b2 AS (SELECT trunc(quantile_cont(l_quantity, 0.1)) AS lo, trunc(quantile_cont(l_quantity, 0.9)) AS hi FROM s1),
s2 AS (SELECT s1.* FROM s1, b2 WHERE (lo = 0 OR l_quantity > lo) AND (hi = 0 OR l_quantity <= hi)),
b3 AS (SELECT trunc(quantile_cont(l_discount, 0.025)) AS lo, trunc(quantile_cont(l_discount, 0.975)) AS hi FROM s2),
s3 AS (SELECT s2.* FROM s2, b3 WHERE (lo = 0 OR l_discount > lo) AND (hi = 0 OR l_discount <= hi))"""


@check(f"WITH {_CHAIN_SQL} SELECT * FROM s3")
def percentile_chain(spark: SparkSession, folder: str) -> DataFrame:
    return threshold_chain(_lines(spark, folder), _CHAIN, percentile=True).df


@check(f"""
WITH {_CHAIN_SQL}
SELECT CAST(1 AS INTEGER) AS step, 'percentile' AS kind, 'l_extendedprice' AS "column", lo AS lower, hi AS upper,
       (SELECT count(*) FROM lineitem) AS rows_in, (SELECT count(*) FROM s1) AS rows_out FROM b1
UNION ALL SELECT 2, 'percentile', 'l_quantity', lo, hi, (SELECT count(*) FROM s1), (SELECT count(*) FROM s2) FROM b2
UNION ALL SELECT 3, 'percentile', 'l_discount', lo, hi, (SELECT count(*) FROM s2), (SELECT count(*) FROM s3) FROM b3""")
def filter_log_of_chain(spark: SparkSession, folder: str) -> DataFrame:
    return threshold_chain(_lines(spark, folder), _CHAIN, percentile=True).log()


@check("""
WITH b1 AS (SELECT l_returnflag, trunc(quantile_cont(l_extendedprice, 0.025)) AS lo, trunc(quantile_cont(l_extendedprice, 0.975)) AS hi
            FROM lineitem GROUP BY l_returnflag),
s1 AS (SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_quantity, l.l_extendedprice
       FROM lineitem l JOIN b1 USING (l_returnflag)
       WHERE (lo = 0 OR l_extendedprice > lo) AND (hi = 0 OR l_extendedprice <= hi)),
b2 AS (SELECT l_returnflag, trunc(quantile_cont(l_quantity, 0.1)) AS lo, trunc(quantile_cont(l_quantity, 0.9)) AS hi
       FROM s1 GROUP BY l_returnflag)
SELECT s1.* FROM s1 JOIN b2 USING (l_returnflag) WHERE (lo = 0 OR l_quantity > lo) AND (hi = 0 OR l_quantity <= hi)""")
def percentile_chain_per_basin(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    return grouped_threshold_chain(lines, "l_returnflag", {"l_extendedprice": (0.025, 0.975), "l_quantity": (0.1, 0.9)})


def _mad_sql(kept: bool) -> str:
    def cell(c: str, m: str, d: str) -> str:
        test = f"abs({c} - {m}) <= 1.5 * {d}"
        return f"CASE WHEN {test if kept else f'NOT ({test})'} THEN {c} END AS {c}"

    ids = "l_orderkey, l_linenumber" if kept else "CAST(NULL AS BIGINT) AS l_orderkey, CAST(NULL AS INTEGER) AS l_linenumber"
    return f"""
WITH m AS (SELECT quantile_cont(l_quantity, 0.5) AS mq, quantile_cont(l_extendedprice, 0.5) AS mp FROM lineitem),
d AS (SELECT quantile_cont(abs(l_quantity - mq), 0.5) AS dq, quantile_cont(abs(l_extendedprice - mp), 0.5) AS dp FROM lineitem, m)
SELECT {ids}, {cell('l_quantity', 'mq', 'dq')}, {cell('l_extendedprice', 'mp', 'dp')} FROM lineitem, m, d"""


_MASKED = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@check(_mad_sql(kept=True))
def mad_mask(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*_MASKED)
    return statistical_mask(lines, StatisticalFilter(("l_quantity", "l_extendedprice"), 1.5, "mad"))[0]


@check(_mad_sql(kept=False))
def outlier_cells(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*_MASKED)
    return statistical_mask(lines, StatisticalFilter(("l_quantity", "l_extendedprice"), 1.5, "mad"))[1]


@check("""
WITH m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN abs((l_quantity - mq) / sq) <= 1.3 THEN l_quantity END AS l_quantity,
       CASE WHEN abs((l_tax - mt) / st) <= 1.3 THEN l_tax END AS l_tax
FROM lineitem, m""")
def zscore_mask(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return statistical_mask(lines, StatisticalFilter(("l_quantity", "l_tax"), 1.3, "z-score"))[0]


@check(f"SELECT {', '.join(KEPT)} FROM lineitem WHERE round_even(l_tax / nullif(l_discount, 0), 3) = 0.667")
def ratio_equality(spark: SparkSession, folder: str) -> DataFrame:
    return ratio_filter(_lines(spark, folder), "l_tax", "l_discount", 0.667)


@check("""
SELECT l_orderkey, l_linenumber, l_extendedprice, 3.5 * l_quantity - 20 AS pred FROM lineitem
WHERE 3.5 * l_quantity - 20 > 0 AND l_extendedprice < 50000""")
def scored_row_range(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (3.5 * F.col("l_quantity") - 20).alias("pred")
    )
    return scored.where((F.col("pred") > 0) & (F.col("l_extendedprice") < 50_000))


@check("""
SELECT l_orderkey, l_linenumber,
       (round_even(l_tax / nullif(l_discount, 0), 3) IS DISTINCT FROM 0.5
        OR round_even(l_discount / nullif(l_discount, 0), 3) IS DISTINCT FROM 1.0) AS cost_filter
FROM lineitem""")
def cost_anomaly_flag(spark: SparkSession, folder: str) -> DataFrame:
    """A ratio that cannot be formed is an anomaly."""
    lines = table(spark, folder, "lineitem")
    flagged = flag_cost_anomalies(lines, "l_discount", {"l_tax": 0.5, "l_discount": 1.0})
    return flagged.select("l_orderkey", "l_linenumber", "cost_filter")
