import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lateralis.operators.categories import (
    add_dummies, collect_values, fit_encoders, group_rare, group_rare_joined, trained_values,
)
from lateralis.operators.errorbins import bin_spec, edge_lists, edge_table, edges, error_table, expected_error, nested_bins, nested_error_map, occupied_edges, step_bins
from lateralis.operators.metrics import CV_RMSE, MAPE, R2, best_models, describe, leaderboard, regression_metrics, validation_metrics
from lateralis.operators.scaling import AffineScalerModel, RobustColumnScaler, StandardColumnScaler


def test_rare_values(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbc"] + [(None,)], "o string")
    grouped = group_rare(df, "o", 2)
    assert grouped.retained == ["a", "b"]
    want = sorted(["a"] * 3 + ["b"] * 2 + ["miscellaneous"])
    for done in (grouped.df, group_rare_joined(df, "o", 2)):
        rows = [r["o"] for r in done.collect()]
        assert sorted(o for o in rows if o is not None) == want and rows.count(None) == 1
    joined = group_rare(df, "o", 2, literal_values=1)
    assert sorted(str(r["o"]) for r in joined.df.collect()) == sorted(str(r["o"]) for r in group_rare(df, "o", 2).df.collect())
    assert joined.retained == group_rare(df, "o", 2).retained
    with pytest.raises(ValueError):
        collect_values(df, "o", limit=2)


def test_dummies(spark):
    df = add_dummies(spark.createDataFrame([("b",), ("a",), (None,)], "o string"), "o")
    assert [tuple(r)[1:] for r in df.collect()] == [(0, 1), (1, 0), (0, 0)]


def test_encoder_drops_first_value_and_single_values(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "x")], "o string, r string")
    stages = fit_encoders(df, ["o", "r"])
    assert trained_values(stages) == {"o": ["a", "b", "c"], "r": ["x"]}
    rows = {r["o"]: list(r["o__onehot"].toArray()) for r in PipelineModel(stages).transform(df).collect()}
    assert rows == {"a": [0, 0], "b": [0, 1], "c": [1, 0]}
    with pytest.raises(Exception, match="Unseen label"):
        PipelineModel(stages).transform(spark.createDataFrame([("z", "x")], "o string, r string")).collect()


def test_scalers(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(9)], "a double, flat double")
    robust = RobustColumnScaler(inputCols=["a", "flat"], outputCols=["sa", "sflat"]).fit(df)
    assert robust.parameters() == [("a", "sa", 4.0, 4.0), ("flat", "sflat", 7.0, 1.0)]
    standard = StandardColumnScaler(inputCols=["a"], outputCols=["a"]).fit(df)
    assert standard.parameters()[0][3] == pytest.approx(2.5819888974716)
    back = standard.inverse(standard.transform(df)).exceptAll(df)
    assert back.count() == 0
    robust.write().overwrite().save(str(tmp_path / "scaler"))
    assert AffineScalerModel.load(str(tmp_path / "scaler")).parameters() == robust.parameters()
    with pytest.raises(ValueError, match="without values"):
        RobustColumnScaler(inputCols=["a"], outputCols=["s"]).fit(df.where("a > 100"))


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (4.0, 4.0), (None, 3.0)], "y double, p double")
    row = regression_metrics(df, "y", "p").head()
    assert row[R2] == round(1 - 0.5 / (14 / 3), 5)
    assert row[MAPE] == round((0.5 + 0.25 + 0) / 3, 5)
    assert row["residual P90/P10"] == pytest.approx(1.0)
    narrowed = regression_metrics(df, "y", "p", builtin_rows=1).head()
    assert narrowed == row
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert regression_metrics(constant, "y", "p").head()[R2] == 1.0
    v = validation_metrics(df, "y", "p").head()
    assert v["mse"] == pytest.approx(0.5 / 3) and v["mape"] == pytest.approx(25.0)


def test_grouped_metrics_when_groups_are_large(spark):
    df = spark.range(0, 600).select(F.when(F.col("id") < 500, "a").otherwise("b").alias("g"), F.randn(1).alias("y"), F.randn(2).alias("p"))
    small = {r["g"]: r for r in regression_metrics(df, "y", "p", ["g"]).collect()}
    large = {r["g"]: r for r in regression_metrics(df, "y", "p", ["g"], builtin_rows=200).collect()}
    assert small == large


def test_describe_paths_agree(spark):
    df = spark.range(0, 501).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") < 0, 1.0).alias("empty"))
    rows = [tuple(r) for r in describe(df, ["a", "empty"]).collect()]
    assert rows[0][:3] == ("a", 501, 250.0) and rows[0][4:] == (0.0, 125.0, 250.0, 375.0, 500.0)
    assert rows[1] == ("empty", 0, *[None] * 7)
    assert [tuple(r) for r in describe(df, ["a", "empty"], builtin_rows=100).collect()] == rows


def test_leaderboard(spark):
    board = leaderboard(spark, {"x": {R2: 0.5, MAPE: 0.3}, "y": {R2: 0.4, MAPE: 0.2, CV_RMSE: 1.0}})
    assert best_models(board, 1) == ["y"]
    assert board.where("models = 'x'").head()[CV_RMSE] is None


def test_lowest_edge_has_no_bin(spark):
    df = spark.createDataFrame([(1000.0,), (1500.0,), (2000.0,)], "x double")
    assert [r["b"] for r in step_bins(df, "x", 1000, "b").collect()] == [None, "1000 - 2000", "1000 - 2000"]
    assert edges(1500.0, 2000.0, 1000) == [1000, 2000, 3000]


def test_inner_bins_start_at_their_own_subset(spark):
    # In the second lateral bin the smallest proppant is an edge of the grid, in the first it is not.
    rows = [(500.0, 5.0, 12.0), (500.0, 10.0, 12.5), (1500.0, 10.0, 12.0), (1500.0, 15.0, 12.5), (1500.0, 2015.0, 212.0)]
    df = spark.createDataFrame(rows, "l double, p double, f double")
    spec = bin_spec(df, "l", "p", "f")
    assert spec.steps == (1000.0, 100.0, 20.0)
    step10 = type(spec)(spec.columns, (1000.0, 10.0, 20.0), spec.edges)
    got = sorted((r["l"], r["p"], r["bin_prop"]) for r in nested_bins(df, step10).collect())
    assert got == [
        (500.0, 5.0, "0 - 10"), (500.0, 10.0, "0 - 10"), (1500.0, 15.0, "10 - 20"), (1500.0, 2015.0, "2010 - 2020"),
    ]


def test_error_table_and_lookup(spark):
    df = spark.range(0, 2000).select(
        (F.rand(1) * 10000 + 3000).alias("l"), (F.rand(2) * 3000 + 500).alias("p"), (F.rand(3) * 70 + 10).alias("f"),
        (F.rand(4) * 20).alias("e"),
    ).persist()
    spec = bin_spec(df, "l", "p", "f")
    table = error_table(df, spec, "e")
    hot = error_table(df, spec, "e", builtin_rows=3)
    assert table.exceptAll(hot).count() == 0 and hot.count() == table.count()
    found = expected_error(df, table, spec.steps, spec.columns)
    assert found.count() == 2000 and found.where("`expected_cost_variance_%` is null").count() == 0
    beyond = df.limit(1).withColumn("l", F.lit(1e6))
    assert expected_error(beyond, table, spec.steps, spec.columns).head()["expected_cost_variance_%"] is None
    nested = nested_error_map(table)
    one = table.head()
    assert nested[one["bin_ll"]][one["bin_prop"]][one["bin_fluid"]] == one["mape_median"]
    with pytest.raises(ValueError):
        nested_error_map(table, limit=1)
    assert bin_spec(df.where("l < 0"), "l", "p", "f") is None


def test_edges_of_an_outlier(spark):
    """One lateral of 1e12 feet makes the edges long, but nobody lists them."""
    rows = [(1000.0, 10.0, 5.0, "x"), (1500.0, 10.0, 6.0, "y"), (2000.0, 20.0, 7.5, "x"), (1e12, 30.0, 30.0, "y"), (1e12, 30.0, 30.0, "y")]
    df = spark.createDataFrame(rows, "l double, p double, f double, property string")
    spec = bin_spec(df, "l", "p", "f")
    assert len(spec.edges[0]) == 10**9 + 1 and spec.edges[0][0] == 1000 and spec.edges[0][-1] == 10**12 + 1000
    assert list(spec.edges[2]) == edges(5.0, 30.0, 2) == [4, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24, 26, 28, 30, 32]
    assert edge_table(spark, spec).where("property = 'error_bins_fluid'").count() == len(edge_lists(spec)["error_bins_fluid"])
    found = {(r["property"], r["edge"]) for r in occupied_edges(df, spec).collect()}
    assert {e for p, e in found if p == "error_bins_lateral_length"} == {1000, 2000, 1e12 - 1000, 1e12}
    assert {e for p, e in found if p == "error_bins_fluid"} == {4, 6, 8, 28, 30}
    gaps = df.unionByName(spark.createDataFrame([(None, float("nan"), None, None)], df.schema))
    assert {tuple(r) for r in occupied_edges(gaps, spec).collect()} == found
    assert occupied_edges(df.where("l < 0"), spec).count() == 0
    labels = {r["bin_ll"] for r in nested_bins(df, spec).collect()}
    assert labels <= {"1000 - 2000", "999999999000 - 1000000000000"}
