import pytest
from pyspark.sql import functions as F

from lateralis.operators.repair import impute_from_reference
from lateralis.operators.skew import hot_keys, skew_join
from lateralis.operators.spatial import basin_areas, spatial_join, well_paths, wells_per_area
from tests.wells import areas


def test_imputation_rules(spark):
    wells = spark.createDataFrame(
        [("a", 1.0, True), ("b", 2.0, True), ("c", 3.0, False), ("d", 4.0, True), (None, 5.0, True)],
        "API14 string, cost double, cost_filter boolean",
    )
    reference = spark.createDataFrame([("a", 10.0), ("c", 30.0), ("d", None), (None, 50.0)], "API14 string, cost double")
    got = {r["API14"]: r["cost"] for r in impute_from_reference(wells, reference, columns={"cost": "cost"}).collect()}
    # a is replaced, b has no match, c is not flagged, d takes the NULL, a missing key never matches.
    assert got == {"a": 10.0, "b": 2.0, "c": 3.0, "d": None, None: 5.0}


def test_duplicate_reference_rows_fail_only_when_used(spark):
    reference = spark.createDataFrame([("a", 10.0), ("a", 11.0), ("c", 1.0), ("c", 2.0)], "API14 string, cost double")
    unused = spark.createDataFrame([("c", 3.0, False)], "API14 string, cost double, cost_filter boolean")
    assert impute_from_reference(unused, reference, columns={"cost": "cost"}).head()["cost"] == 3.0
    used = spark.createDataFrame([("a", 1.0, True)], "API14 string, cost double, cost_filter boolean")
    with pytest.raises(Exception, match="several reference rows for API14 a"):
        impute_from_reference(used, reference, columns={"cost": "cost"}).collect()
    with pytest.raises(Exception, match="several reference rows for API14 a"):
        impute_from_reference(used, reference, columns={"cost": "cost"}).select("API14").collect()


def test_skew_join_equals_join(spark):
    left = spark.range(0, 900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(0, 600).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    assert [tuple(r) for r in hot_keys(left, "k", 100).collect()] == [(7, 4)] and hot_keys(left, "k", 1000) is None
    for how in ("inner", "left"):
        want = left.join(right, "k", how)
        got = skew_join(left, right, "k", how, hot_rows=100).select(want.columns)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        skew_join(left, right, "k", "full")


def test_skew_join_of_many_hot_keys_and_rows_without_a_key(spark):
    left = spark.range(0, 6000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 300).alias("k"), F.col("id").alias("l"))
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    assert hot_keys(left, "k", 15).count() == 150
    for how, limit in (("inner", 15), ("left", 15), ("left", 2500)):
        want = left.join(right, "k", how)
        got = skew_join(left, right, "k", how, hot_rows=limit).select(want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert (skew_join(left, right, "k", "left", hot_rows=2500).where("k IS NULL").select(F.spark_partition_id()).distinct().count()) > 1


PATHS = [
    ("inside", -98.3, 35.7, -98.2, 35.8, {"NW"}),
    ("crossing", -98.1, 35.7, -97.9, 35.7, {"NW", "NE"}),
    ("outside", -99.5, 34.0, -99.4, 34.1, set()),
    ("touching", -98.6, 36.1, -98.4, 35.9, {"NW"}),
    ("corner", -98.5, 36.0, -98.5, 36.5, {"NW"}),
    ("along edge", -98.4, 35.0, -98.3, 35.0, {"SW"}),
    ("in the notch", -97.95, 35.3, -97.8, 35.4, set()),
    ("through the notch", -97.95, 35.3, -97.6, 35.4, {"L"}),
    ("point", -98.2, 35.2, -98.2, 35.2, {"SW"}),
    ("point on edge", -98.5, 35.2, -98.5, 35.2, {"SW"}),
    ("across everything", -99.0, 35.6, -97.0, 35.7, {"NW", "NE"}),
]


@pytest.mark.parametrize("options", [{}, {"cell": 1.0}, {"cell": 0.03}, {"broadcast_points": 0, "hot_rows": 2, "cell": 0.25}])
def test_spatial_join_cases(spark, options):
    rows = [p[:5] for p in PATHS] + [("no position", None, 35.0, -98.0, 35.0)]
    paths = spark.createDataFrame(rows, "API14 string, x1 double, y1 double, x2 double, y2 double")
    found = {}
    pairs = spatial_join(areas(spark), paths, **options).collect()
    for r in pairs:
        found.setdefault(r["API14"], set()).add(r["Area"])
    assert len(pairs) == sum(len(a) for a in found.values())  # no pair twice
    assert found == {name: expected for name, *_, expected in PATHS if expected}


def test_spatial_join_of_huge_and_impossible_shapes(spark):
    box = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    shapes = [("huge", box(-1e8, -1e8, 2e8)), ("small", box(0.0, 0.0, 1.0)), ("bad", box(0.0, 0.0, float("inf"))), ("far", box(1e300, 0.0, 1.0))]
    rings = spark.createDataFrame(shapes, "Area string, ring array<struct<x double, y double>>")
    rows = [("in", 0.5, 0.5, 0.6, 0.6), ("long", -5e7, 0.25, 5e7, 0.25), ("nan", float("nan"), 0.0, 1.0, 1.0), ("out", 3e8, 0.0, 3e8, 1.0), ("beyond", 1e300, 0.5, 1e300, 0.5)]
    paths = spark.createDataFrame(rows, "API14 string, x1 double, y1 double, x2 double, y2 double")
    for options in ({}, {"broadcast_points": 0, "hot_rows": 1}):
        found = sorted(tuple(r) for r in spatial_join(rings, paths, cell=0.1, **options).collect())
        assert found == [("huge", "in"), ("huge", "long"), ("small", "in"), ("small", "long")]


def test_wells_per_area(spark):
    pairs = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3), ("C", 4)], "Area string, API14 int")
    assert [tuple(r) for r in wells_per_area(pairs, top=2).collect()] == [("B", 2), ("A", 1)]


def test_well_path_is_repeatable(spark):
    rows = [("a", 2.0, 1.0, 3.0, 1.0), ("a", 1.0, 9.0, 3.0, 1.0), ("a", 1.0, 9.0, 3.0, 1.0)]
    df = spark.createDataFrame(
        rows, "API14 string, LongitudeSHWGS84 double, LatitudeSHWGS84 double, LongitudeBHWGS84 double, LatitudeBHWGS84 double"
    )
    assert [tuple(r) for r in well_paths(df).collect()] == [("a", 1.0, 9.0, 3.0, 1.0)]


def test_centroids(spark):
    centres = {r["Area"]: r for r in basin_areas(areas(spark), "Anadarko").collect()}
    assert centres["NW"]["longitude"] == pytest.approx(-98.25) and centres["NW"]["latitude"] == pytest.approx(35.75)
    assert centres["SW"]["NAME"] == 2
    # The L is a 0.5 x 0.2 box below a 0.25 x 0.3 box.
    a, b = 0.5 * 0.2, 0.25 * 0.3
    assert centres["L"]["longitude"] == pytest.approx((a * -97.75 + b * -97.625) / (a + b))
    assert centres["L"]["latitude"] == pytest.approx((a * 35.1 + b * 35.35) / (a + b))
    assert basin_areas(areas(spark), "Midland").count() == 0
