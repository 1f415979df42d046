"""Equi joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.session import broadcast_if_small, checkpointed

HOT_ROWS = 2_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(_hot, _salts): every key with more than ``hot_rows`` rows and the salts that bring it below that.

    An exact count, combined map-side; there are at most ``rows / hot_rows`` such keys, however they are spread.
    """
    counts = df.where(col(key).isNotNull()).groupBy(col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > hot_rows).select("_hot", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    hot = checkpointed(hot)
    return hot if hot.head(1) else None


def _salted(df: DataFrame, key: str, hot: DataFrame, name: str) -> DataFrame:
    """A salt for rows of hot keys, 0 for the rest. Rows without a key meet nothing and are spread too."""
    joined = df.join(broadcast_if_small(hot), col(key) == F.col("_hot"), "left")
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.when(col(key).isNull(), spread).otherwise(F.coalesce("_salts", F.lit(1)))
    return joined.withColumn(name, F.pmod(_row_hash(df), salts).cast("int")).drop("_hot", "_salts")


def _copied(df: DataFrame, key: str, hot: DataFrame, name: str) -> DataFrame:
    """Rows of a hot key once per salt, so that they meet every salted partner."""
    joined = df.join(broadcast_if_small(hot), col(key) == F.col("_hot"), "left")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return joined.withColumn(name, F.explode(salts)).drop("_hot", "_salts")


def skew_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` inner or left, with the hot keys of both sides salted.

    Rows of a hot left key are spread over salts and the right rows of that key are copied to every
    salt. For an inner join the same is done the other way round; a left join copies no left row.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join does inner and left joins")
    hot_left = hot_keys(left, key, hot_rows)
    if hot_left is None and how == "left" and left.where(col(key).isNull()).limit(hot_rows + 1).count() > hot_rows:
        hot_left = left.select(col(key).alias("_hot"), F.lit(1).alias("_salts")).limit(0)  # only rows without a key are many
    hot_right = hot_keys(right, key, hot_rows) if how == "inner" else None
    salts = []
    if hot_left is not None:
        salts.append("_left_salt")
        left, right = _salted(left, key, hot_left, "_left_salt"), _copied(right, key, hot_left, "_left_salt")
    if hot_right is not None:
        salts.append("_right_salt")
        left, right = _copied(left, key, hot_right, "_right_salt"), _salted(right, key, hot_right, "_right_salt")
    return left.join(right, [key, *salts], how).drop(*salts)


def _row_hash(df: DataFrame) -> Column:
    """Spreads the rows of one key; the partition id also separates exact copies."""
    hashable = [col(f.name) for f in df.schema if "map" not in f.dataType.simpleString()]
    return F.xxhash64(F.spark_partition_id(), *hashable)
