"""Cost repair, fan-out and spatial joins, areas and well paths."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.registry import check, table
from lateralis.operators.repair import impute_from_reference
from lateralis.operators.skew import skew_join
from lateralis.operators.spatial import basin_areas, spatial_join, well_paths, wells_per_area
from lateralis.session import checkpointed


@check("""
WITH ref AS (SELECT l_orderkey, sum(l_extendedprice) AS total, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, (o_totalprice < 250000) AS flagged,
       round(CASE WHEN o_totalprice < 250000 AND l_orderkey IS NOT NULL THEN total ELSE o_totalprice END, 4) AS o_totalprice,
       round(CASE WHEN o_totalprice < 250000 AND l_orderkey IS NOT NULL THEN quantity ELSE 0 END, 4) AS quantity
FROM orders LEFT JOIN ref ON o_orderkey = l_orderkey""")
def conditional_imputation(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged orders take their totals from the sums of their lines, if they have any."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_totalprice") < 250_000).alias("flagged"), "o_totalprice", F.lit(0.0).alias("quantity")
    )
    reference = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_extendedprice").alias("total"), F.sum("l_quantity").alias("amount"))
    )
    columns = {"o_totalprice": "total", "quantity": "amount"}
    repaired = impute_from_reference(orders, reference, "o_orderkey", columns, "flagged")
    return repaired.withColumns({c: F.round(c, 4) for c in columns})


@check("""
SELECT o_orderkey, o_totalprice, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def fan_out_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return skew_join(orders, lines, "o_orderkey")


@check("""
SELECT o_orderpriority, l_orderkey, l_linenumber, l_quantity
FROM lineitem JOIN (SELECT o_orderkey, o_orderpriority FROM orders) ON l_orderkey = o_orderkey""")
def fan_out_join_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The same kind of join with a limit low enough that keys of both sides are salted."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return skew_join(lines, orders, "l_orderkey", hot_rows=5)


@check("""
SELECT k, l_orderkey, l_linenumber, o_orderpriority
FROM (SELECT *, CASE WHEN l_linenumber % 3 > 0 THEN l_orderkey % 500 END AS k FROM lineitem)
LEFT JOIN (SELECT o_orderkey, o_orderpriority FROM orders) ON k = o_orderkey""")
def left_join_of_many_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Hundreds of keys above the limit, and a third of the rows without a key."""
    key = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_orderkey") % 500)
    lines = table(spark, folder, "lineitem").select(key.alias("k"), "l_orderkey", "l_linenumber")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    return skew_join(lines, orders, "k", "left", hot_rows=lines.count() // 2000)


# Well paths from customers: a start point and a short step away from it.
PATHS_SQL = """
SELECT c_custkey, c_acctbal / 1000 AS x1, c_nationkey + (c_custkey % 100) / 100.0 AS y1,
       c_acctbal / 1000 + (c_custkey % 7 - 3) * 0.1 AS x2,
       c_nationkey + (c_custkey % 100) / 100.0 + (c_custkey % 5 - 2) * 0.2 AS y2
FROM customer"""

# One box per nation; the fractions keep edges off the grid of the path points.
BOXES_SQL = """
SELECT n_name, n_regionkey, (n_nationkey % 5) * 2 - 6.0 / 7 AS bx1, n_nationkey - 0.253 AS by1,
       (n_nationkey % 5) * 2 + 15.0 / 7 AS bx2, n_nationkey + 0.757 AS by2
FROM nation"""


def customer_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Surface and bottom hole of each customer's well."""
    key = F.col("c_custkey")
    x, y = F.col("c_acctbal") / 1000, F.col("c_nationkey") + (key % 100) / 100.0
    return table(spark, folder, "customer").select(
        "c_custkey", x.alias("x1"), y.alias("y1"),
        (x + (key % 7 - 3) * 0.1).alias("x2"), (y + (key % 5 - 2) * 0.2).alias("y2"),
    )


def nation_areas(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    boxes = table(spark, folder, "nation").select(
        "n_name", "n_nationkey", F.col("n_regionkey").cast("string").alias("Basin"),
        ((key % 5) * 2 - 6.0 / 7).alias("bx1"), (key - 0.253).alias("by1"),
        ((key % 5) * 2 + 15.0 / 7).alias("bx2"), (key + 0.757).alias("by2"),
    )

    def corner(x: str, y: str):
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))

    corners = [("bx1", "by1"), ("bx2", "by1"), ("bx2", "by2"), ("bx1", "by2"), ("bx1", "by1")]
    return boxes.select(
        F.col("n_name").alias("Area"), "Basin", F.col("n_nationkey").cast("string").alias("NAME"),
        F.array(*[corner(*c) for c in corners]).alias("ring"),
    )


# Clip each path to each box: the path meets the box when a piece of the parameter range 0..1 is left.
PAIRS_SQL = f"""
WITH w AS ({PATHS_SQL}), a AS ({BOXES_SQL}),
c AS (SELECT n_name, c_custkey,
    CASE WHEN x2 = x1 THEN CASE WHEN x1 BETWEEN bx1 AND bx2 THEN 0 ELSE 2 END
         ELSE least((bx1 - x1) / nullif(x2 - x1, 0), (bx2 - x1) / nullif(x2 - x1, 0)) END AS tx1,
    CASE WHEN x2 = x1 THEN 1 ELSE greatest((bx1 - x1) / nullif(x2 - x1, 0), (bx2 - x1) / nullif(x2 - x1, 0)) END AS tx2,
    CASE WHEN y2 = y1 THEN CASE WHEN y1 BETWEEN by1 AND by2 THEN 0 ELSE 2 END
         ELSE least((by1 - y1) / nullif(y2 - y1, 0), (by2 - y1) / nullif(y2 - y1, 0)) END AS ty1,
    CASE WHEN y2 = y1 THEN 1 ELSE greatest((by1 - y1) / nullif(y2 - y1, 0), (by2 - y1) / nullif(y2 - y1, 0)) END AS ty2
  FROM w, a),
pairs AS (SELECT n_name AS "Area", c_custkey FROM c WHERE greatest(0, tx1, ty1) <= least(1, tx2, ty2))"""


@check(f"{PAIRS_SQL} SELECT * FROM pairs")
def wells_in_areas(spark: SparkSession, folder: str) -> DataFrame:
    return spatial_join(nation_areas(spark, folder), customer_paths(spark, folder), ["Area"], ["c_custkey"], cell=0.5)


@check(f"{PAIRS_SQL} SELECT * FROM pairs")
def wells_in_areas_salted(spark: SparkSession, folder: str) -> DataFrame:
    """Areas shuffled instead of broadcast, and the wells of crowded cells spread over salts."""
    return spatial_join(
        nation_areas(spark, folder), customer_paths(spark, folder), ["Area"], ["c_custkey"],
        cell=0.5, hot_rows=5, broadcast_points=0,
    )


@check(f"""
{PAIRS_SQL} SELECT "Area", count(*) AS wells FROM pairs GROUP BY "Area" ORDER BY wells DESC, "Area" LIMIT 20""")
def busiest_areas(spark: SparkSession, folder: str) -> DataFrame:
    return wells_per_area(wells_in_areas(spark, folder), key="c_custkey").withColumnRenamed("c_custkey", "wells")


@check(f"""
{PAIRS_SQL} SELECT "Area", c_custkey, c_name, c_mktsegment FROM customer JOIN pairs USING (c_custkey)""")
def wells_with_area(spark: SparkSession, folder: str) -> DataFrame:
    """A well that crosses several areas appears once per area."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    pairs = checkpointed(wells_in_areas(spark, folder))
    return skew_join(customers, pairs, "c_custkey").select("Area", "c_custkey", "c_name", "c_mktsegment")


@check("""
SELECT l_orderkey, p.a AS x1, p.b AS y1, round(p.c, 6) AS x2, p.d AS y2
FROM (SELECT l_orderkey, min({'a': l_quantity, 'b': l_tax, 'c': l_quantity + 1, 'd': l_discount}) AS p FROM lineitem GROUP BY l_orderkey)""")
def well_path_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """One segment per key out of many rows; the smallest start point is taken."""
    positions = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_tax", (F.col("l_quantity") + 1).alias("bx"), "l_discount"
    )
    paths = well_paths(positions, "l_orderkey", ["l_quantity", "l_tax", "bx", "l_discount"])
    return paths.select("l_orderkey", "x1", "y1", F.round("x2", 6).alias("x2"), "y2")


@check("""
SELECT n_name AS "Area", n_regionkey::VARCHAR AS "Basin", n_nationkey AS "NAME",
       round(n_nationkey + 0.252, 6) AS latitude, round((n_nationkey % 5) * 2 + 4.5 / 7, 6) AS longitude
FROM nation WHERE n_regionkey = 1""")
def area_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Centroids of the areas of one basin, with their names as integers."""
    centred = basin_areas(nation_areas(spark, folder), basin="1")
    return centred.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})


@check("""
SELECT c_custkey, round(y + CASE WHEN c_nationkey = 0 THEN 0.5 ELSE (1.0 + c_nationkey) / 3 END, 6) AS latitude,
       round(x + CASE WHEN c_nationkey = 0 THEN 1.0 ELSE (2.0 + c_nationkey) / 3 END, 6) AS longitude
FROM (SELECT *, c_acctbal / 1000 AS x, c_custkey / 100.0 AS y FROM customer)""")
def triangle_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Centroids of one triangle per customer; those of nation 0 have no area."""
    x, y = F.col("c_acctbal") / 1000, F.col("c_custkey") / 100.0

    def corner(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    zero = F.lit(0.0)
    ring = F.array(
        corner(zero, zero), corner(F.lit(2.0), F.lit(1.0)), corner(F.col("c_nationkey"), F.col("c_nationkey")), corner(zero, zero)
    )
    areas = table(spark, folder, "customer").select("c_custkey", ring.alias("ring"))
    found = basin_areas(areas)
    return found.select("c_custkey", *[F.round(c, 6).alias(c) for c in ("latitude", "longitude")])
