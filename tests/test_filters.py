import pytest
from pyspark.sql import functions as F

from lateralis.config import FilterConfig, StatisticalFilter
from lateralis.operators.filters import (
    apply_filters, filter_range, grouped_threshold_chain, mad_conditions, mask_cells, percentile_bounds, ratio_filter,
    statistical_mask, threshold_chain,
)
from lateralis.operators.quantiles import group_quantiles, quantiles


def frame(spark, xs, name="x"):
    return spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], f"{name} double")


def xs(df, name="x"):
    return sorted(r[name] for r in df.collect() if r[name] is not None)


def test_bounds_strict_below_inclusive_above(spark):
    assert xs(filter_range(frame(spark, [1, 2, 3, 4]), "x", 1, 3)) == [2, 3]


def test_zero_bound_is_off_unless_strict(spark):
    df = frame(spark, [-2, 0, 2])
    assert xs(filter_range(df, "x", 0, None)) == [-2, 0, 2]
    assert xs(filter_range(df, "x", 0, None, strict=True)) == [2]


def test_unknown_column(spark):
    with pytest.raises(KeyError):
        filter_range(frame(spark, [1]), "y", 1, 2)


def test_percentile_bounds_truncate(spark):
    df = frame(spark, range(1, 12))
    assert percentile_bounds(df, "x", 0.025, 0.975) == (1, 10)
    assert percentile_bounds(df.where("x > 100"), "x", 0.025, 0.975) == (None, None)
    small = frame(spark, [0.1, 0.5, 0.9])
    assert xs(threshold_chain(small, {"x": (0.025, 0.975)}, percentile=True).df) == [0.1, 0.5, 0.9]
    assert percentile_bounds(df, "x", 0.1, 0.9, accuracy=10_000) == (2, 10)


def test_chain_uses_the_survivors(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("double").alias("a"), (1000 - F.col("id")).cast("double").alias("b"))
    chain = threshold_chain(df, {"a": (0.1, 0.9), "b": (0.1, 0.9)}, percentile=True)
    kept = df.where("a > 99 and a <= 899")
    low, high = (int(v) for v in quantiles(kept, {"b": [0.1, 0.9]})["b"])
    assert chain.df.count() == kept.where(f"b > {low} and b <= {high}").count()
    log = [tuple(r) for r in chain.log().collect()]
    assert log[0] == (1, "percentile", "a", 99.0, 899.0, 1000, 800)
    assert log[1][3:] == (float(low), float(high), 800, chain.df.count())


def test_log_of_a_statistical_step(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None), (3.0, 3.0), (4.0, 4.0), (900.0, 5.0)], "a double, b double")
    done = apply_filters(df, FilterConfig(keep=("a", "b"), statistical=StatisticalFilter(("a",), 3.0, "mad")))
    assert [(r["kind"], r["rows_in"], r["rows_out"]) for r in done.log().collect()] == [("complete", 6, 5), ("mad", 5, 4), ("complete", 4, 4)]
    assert done.df.count() == 4


def test_percentile_bound_of_whole_numbers(spark):
    """The interpolated bound is 14 before it is truncated, however the order statistics are found."""
    df = spark.createDataFrame([(float(x),) for x in (7, 8, 9, 10, 15)], "x double")
    assert [percentile_bounds(df, "x", None, 0.95, builtin_rows=n) for n in (100, 1)] == [(None, 14)] * 2


def test_grouped_chain_equals_chain_per_group(spark):
    df = spark.range(0, 3000).select(
        F.concat(F.lit("g"), F.col("id") % 3).alias("g"), (F.rand(1) * 1000).alias("a"), (F.rand(2) * 1000).alias("b")
    ).persist()
    bounds = {"a": (0.1, 0.9), "b": (0.2, 0.8)}
    together = grouped_threshold_chain(df, "g", bounds)
    for g in ("g0", "g1", "g2"):
        alone = threshold_chain(df.where(F.col("g") == g), bounds, percentile=True).df
        assert together.where(F.col("g") == g).exceptAll(alone).count() == 0
        assert alone.count() == together.where(F.col("g") == g).count()


def test_mad_masks_cells_not_rows(spark):
    df = spark.createDataFrame([(float(x), "s") for x in [1, 2, 3, 4, 100]], "x double, s string")
    kept, outliers = statistical_mask(df, StatisticalFilter(("x",), 3.0, "mad"))
    assert kept.count() == 5 and xs(kept) == [1, 2, 3, 4]
    assert xs(outliers) == [100.0] and {r["s"] for r in outliers.collect()} == {None}


def test_zero_mad_keeps_only_the_median(spark):
    df = frame(spark, [5, 5, 5, 6])
    assert xs(mask_cells(df, mad_conditions(df, ["x"]))[0]) == [5, 5, 5]


def test_zero_deviation_masks_everything(spark):
    kept, _ = statistical_mask(frame(spark, [5, 5]), StatisticalFilter(None, 3.0, "z-score"))
    assert xs(kept) == []
    with pytest.raises(ValueError, match="unknown"):
        statistical_mask(frame(spark, [5]), StatisticalFilter(None, 3.0, "iqr"))


def test_ratio_filter_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.3245, 1.0), (0.3255, 1.0), (1.0, 0.0)], "a double, b double")
    assert [r["a"] for r in ratio_filter(df, "a", "b", 0.324).collect()] == [0.3245]


def test_filters_in_order(spark):
    rows = [("w1", 10.0, 1.0, "n"), ("w2", 20.0, 2.0, None), ("w3", 30.0, 3.0, "n"), ("w4", 40.0, 8.0, "n")]
    df = spark.createDataFrame(rows, "API14 string, a double, b double, WellName string")
    settings = FilterConfig(keep=("a", "b"), thresholds={"a": (5, 100)}, ratios={("b", "a"): 0.1})
    done = apply_filters(df, settings, carry=["API14"])
    # w2 goes for its missing name although the name is not kept, w4 for its ratio.
    assert sorted(r["API14"] for r in done.df.collect()) == ["w1", "w3"]
    assert done.df.columns == ["API14", "a", "b"]
    assert [(r["kind"], r["rows_in"], r["rows_out"]) for r in done.log().collect()] == [
        ("complete", 4, 3), ("value", 3, 3), ("ratio", 3, 2), ("complete", 2, 2),
    ]


@pytest.mark.parametrize("buckets", [64, 2048])
def test_narrowed_quantiles_equal_builtin(spark, buckets):
    """A hot group with a third of its rows on one value, extreme magnitudes and NULL keys."""
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 3 == 0, 42.0).otherwise(F.exp(F.randn(3) * 12)).alias("x"),
        F.when(F.col("id") % 5 != 0, F.randn(4)).alias("y"),
        F.lit(None).cast("double").alias("z"),
    ).persist()
    wanted = {"x": [0.0, 0.025, 0.5], "y": [0.75], "z": [0.5]}
    for by in ([], ["g"]):
        want = {tuple(r[k] for k in by): r for r in group_quantiles(df, wanted, by).collect()}
        got = {tuple(r[k] for k in by): r for r in group_quantiles(df, wanted, by, builtin_rows=300, buckets=buckets).collect()}
        assert set(want) == set(got)
        for key, row in want.items():
            for c in wanted:
                expected = row[c] or []
                assert [v for v in (got[key][c] or []) if v is not None] == pytest.approx([v for v in expected if v is not None], rel=1e-12)


def test_quantiles_skip_nan_and_survive_infinity(spark):
    xs = [float("nan"), float("inf"), float("-inf"), None] + [float(i) for i in range(9)]
    df = frame(spark, xs)
    assert quantiles(df, {"x": [0.5]}) == {"x": [4.0]}
    assert quantiles(df, {"x": [0.5, 0.2]}, builtin_rows=2, buckets=4) == {"x": [4.0, 1.0]}


def test_narrowing_of_values_too_close_for_logarithms(spark):
    df = frame(spark, [1e15 + i for i in range(50)] + [1e15])
    assert quantiles(df, {"x": [0.5]}, builtin_rows=2, buckets=4) == quantiles(df, {"x": [0.5]})
