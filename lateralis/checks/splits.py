"""Splits, encodings and scalers."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.registry import check, table
from lateralis.operators.categories import add_dummies, fit_encoders, onehot_column, onehot_names, trained_values
from lateralis.operators.scaling import RobustColumnScaler, StandardColumnScaler
from lateralis.operators.split import split_label

SPLIT_SQL = """CASE WHEN h < 1000 THEN 'test' WHEN h < 2800 THEN 'valid' ELSE 'train' END"""
BUCKET_SQL = "('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 10000"


@check(f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM (SELECT *, {BUCKET_SQL} AS h FROM orders)")
def three_way_split(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", split_label(F.col("o_orderkey")).alias("split"))


@check("""
SELECT p_partkey, CAST(p_type = 'STANDARD' AS DOUBLE) AS "p_type=STANDARD", CAST(p_type = 'SMALL' AS DOUBLE) AS "p_type=SMALL",
       CAST(p_type = 'PROMO' AS DOUBLE) AS "p_type=PROMO", CAST(p_type = 'MEDIUM' AS DOUBLE) AS "p_type=MEDIUM",
       CAST(p_type = 'LARGE' AS DOUBLE) AS "p_type=LARGE"
FROM part""")
def one_hot_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """The alphabetically first type has no column of its own."""
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    model = PipelineModel(fit_encoders(parts, ["p_type"]))
    slots = vector_to_array(F.col(onehot_column("p_type")))
    names = onehot_names("p_type", trained_values(model.stages)["p_type"])
    return model.transform(parts).select("p_partkey", *[slots[i].alias(n) for i, n in enumerate(names)])


@check("""
SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_returnflag = 'A' AS INTEGER) AS "l_returnflag_A",
       CAST(l_returnflag = 'N' AS INTEGER) AS "l_returnflag_N", CAST(l_returnflag = 'R' AS INTEGER) AS "l_returnflag_R"
FROM lineitem""")
def dummy_columns(spark: SparkSession, folder: str) -> DataFrame:
    return add_dummies(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag")


_ROBUST = ["o_totalprice", "o_custkey", "flat"]


@check(f"""
WITH o AS (SELECT *, 7.0 AS flat, {BUCKET_SQL} AS h FROM orders), t AS (SELECT * FROM o WHERE h >= 2800),
f AS (SELECT quantile_cont(o_totalprice, 0.5) AS c1, quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS s1,
             quantile_cont(o_custkey, 0.5) AS c2, quantile_cont(o_custkey, 0.75) - quantile_cont(o_custkey, 0.25) AS s2 FROM t)
SELECT o_orderkey, {SPLIT_SQL} AS split, round((o_totalprice - c1) / s1, 6) AS o_totalprice,
       round((o_custkey - c2) / s2, 6) AS o_custkey, round((flat - 7.0) / 1, 6) AS flat
FROM o, f""")
def robust_scaling(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the training split, applied to all three; a constant column is only centred."""
    orders = table(spark, folder, "orders").withColumn("flat", F.lit(7.0)).withColumn("split", split_label(F.col("o_orderkey")))
    scaler = RobustColumnScaler(inputCols=_ROBUST, outputCols=_ROBUST).fit(orders.where("split = 'train'"))
    return scaler.transform(orders).select("o_orderkey", "split", *[F.round(c, 6).alias(c) for c in _ROBUST])


@check("""
WITH f AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS scaled, round(o_totalprice, 4) AS restored FROM orders, f""")
def standard_scaling(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled with the population deviation, and brought back."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    scaler = StandardColumnScaler(inputCols=["o_totalprice"], outputCols=["scaled"]).fit(orders)
    scaled = scaler.transform(orders).withColumn("restored", F.col("scaled"))
    restored = scaler.inverse(scaled, {"restored": "o_totalprice"})
    return restored.select("o_orderkey", F.round("scaled", 6).alias("scaled"), F.round("restored", 4).alias("restored"))
