"""Model fits on a cost planted in the order lines, so that the right answer is known."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.aggregates import nested_sql
from lateralis.checks.registry import check, table
from lateralis.config import FilterConfig, RunConfig
from lateralis.operators.importance import permutation_importance, ranked_features, tree_importance
from lateralis.operators.metrics import best_models, leaderboard
from lateralis.operators.models import FEATURES, LABEL, build_regressor, cross_validated_ridge, cross_validated_rmse, fit_and_evaluate, search_parameters
from lateralis.operators.split import SPLIT, split_rows
from lateralis.plans.score import score_from_coefficients
from lateralis.plans.train import Trained, modelling_frame, train_model
from lateralis.session import persisted, scratch_path, spread
from lateralis.sources.artifacts import (
    count_rows,
    load_bundle,
    load_model,
    performance_bundle,
    save_bundle,
    save_model,
)

# label = 120 + 3 * quantity + 400 * discount - 250 * tax + noise, four times that for one row in twenty.
PLANTED = {"l_quantity": 3.0, "l_discount": 400.0, "l_tax": -250.0}
INPUTS = list(PLANTED)

CLEAN_SQL = """(120 + 3 * l_quantity + 400 * l_discount - 250 * l_tax + (l_extendedprice - 53000) / 6000)"""
KEY_SQL = "(l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber)"


def planted_rows(spark: SparkSession, folder: str, outliers: bool = True) -> DataFrame:
    """Noise and outliers come from the price, which is independent of the inputs."""
    price = F.col("l_extendedprice")
    clean = 120 + sum((w * F.col(c) for c, w in PLANTED.items()), F.lit(0.0)) + (price - 53_000) / 6_000
    label = F.when(price > 100_000, 4 * clean).otherwise(clean) if outliers else clean
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return spread(table(spark, folder, "lineitem")).select(
        key.alias("row_key"), *INPUTS, "l_returnflag", "l_linestatus", label.alias(LABEL)
    )


def assembled(df: DataFrame, inputs: list[str] = INPUTS) -> DataFrame:
    ready = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(df)
    return persisted(ready.select("row_key", FEATURES, LABEL))


def _constants(columns: str, rows: list[tuple]) -> str:
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({columns})"


@check(_constants("feature, share_of_planted", [(c, 1.0) for c in PLANTED]).replace("1.0", "CAST(1.0 AS DOUBLE)"))
def robust_fit_recovers_cost(spark: SparkSession, folder: str) -> DataFrame:
    """The robust fit finds the planted weights despite the outliers."""
    rows = assembled(planted_rows(spark, folder))
    model = build_regressor("HuberRegressor", {"max_iter": 1000}, rows=rows.count()).fit(rows)
    rows.unpersist()
    found = [(c, round(float(w) / PLANTED[c], 1)) for c, w in zip(INPUTS, model.coefficients)]
    return spark.createDataFrame(found, "feature string, share_of_planted double")


@check(f"""
SELECT round(regr_slope(y, l_quantity), 4) AS slope, round(regr_intercept(y, l_quantity), 3) AS intercept
FROM (SELECT *, CASE WHEN l_extendedprice > 100000 THEN 4 * {CLEAN_SQL} ELSE {CLEAN_SQL} END AS y FROM lineitem)""")
def least_squares_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = assembled(planted_rows(spark, folder), ["l_quantity"])
    model = build_regressor("LinearRegression", rows=rows.count()).fit(rows)
    rows.unpersist()
    found = [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 3))]
    return spark.createDataFrame(found, "slope double, intercept double")


_TREES = {
    "RandomForestRegressor": {"n_estimators": 10, "max_depth": 6},
    "XGBRegressor": {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.3},
}


@check(_constants("models, fits_well", [("RandomForestRegressor", True), ("XGBRegressor", True)]))
def tree_models_fit(spark: SparkSession, folder: str) -> DataFrame:
    splits = split_rows(planted_rows(spark, folder, outliers=False), "row_key")
    train, valid = assembled(splits.train), assembled(splits.valid)
    fitted = fit_and_evaluate(train, valid, _TREES)
    found = [(name, f.performance["r2"] > 0.8) for name, f in fitted.items()]
    train.unpersist(), valid.unpersist()
    return spark.createDataFrame(found, "models string, fits_well boolean")


@check(_constants("models, position", [("HuberRegressor", 1), ("LinearRegression", 2)]))
def models_compared(spark: SparkSession, folder: str) -> DataFrame:
    """With outliers in the data the robust model has the lower percentage error."""
    splits = split_rows(planted_rows(spark, folder), "row_key")
    train, valid = assembled(splits.train), assembled(splits.valid)
    fitted = fit_and_evaluate(train, valid, {"LinearRegression": {}, "HuberRegressor": {"max_iter": 1000}})
    board = leaderboard(spark, {name: f.performance for name, f in fitted.items()})
    found = [(name, i) for i, name in enumerate(best_models(board, 2), start=1)]
    train.unpersist(), valid.unpersist()
    return spark.createDataFrame(found, "models string, position int")


_FOLD_SQL = f"""
WITH r AS (SELECT l_quantity AS x, {CLEAN_SQL} AS y, ('0x' || substr(md5('43|' || {KEY_SQL}), 1, 8))::BIGINT % 5 AS fold FROM lineitem),
folds AS (SELECT DISTINCT fold AS k FROM r),
fits AS (SELECT k, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r JOIN folds ON fold <> k GROUP BY k),
errors AS (SELECT k, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse FROM r JOIN fits ON fold = k GROUP BY k)
SELECT round(avg(rmse), 4) AS rmse FROM errors"""


@check(_FOLD_SQL)
def cross_validated_error(spark: SparkSession, folder: str) -> DataFrame:
    """Mean fold error of a one-feature least-squares fit over five hash folds."""
    rows = assembled(planted_rows(spark, folder, outliers=False), ["l_quantity"])
    rmse = cross_validated_rmse(build_regressor("LinearRegression", rows=rows.count()), rows, "row_key", 5)
    rows.unpersist()
    return spark.createDataFrame([(round(rmse, 4),)], "rmse double")


@check(_constants("method, max_depth", [("grid", 5), ("random", 5)]))
def parameter_search(spark: SparkSession, folder: str) -> DataFrame:
    """Four-fold search over the depth of a forest: the deepest of three candidates has the lowest error."""
    rows = assembled(planted_rows(spark, folder, outliers=False))
    found = []
    for method in ("grid", "random"):
        search = search_parameters(
            "RandomForestRegressor", {"max_depth": [1, 3, 5]}, rows, "row_key",
            base={"n_estimators": 5}, method=method, draws=3,
        )
        found.append((search.method, search.best_params["max_depth"]))
    rows.unpersist()
    return spark.createDataFrame(found, "method string, max_depth int")


@check(f"""
WITH r AS (SELECT l_quantity AS x, {CLEAN_SQL} AS y, ('0x' || substr(md5('43|' || {KEY_SQL}), 1, 8))::BIGINT % 4 AS fold FROM lineitem),
folds AS (SELECT DISTINCT fold AS k FROM r),
fits AS (SELECT k, true AS fit_intercept, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r JOIN folds ON fold <> k GROUP BY k
         UNION ALL SELECT k, false, sum(x * y) / sum(x * x), 0 FROM r JOIN folds ON fold <> k GROUP BY k),
errors AS (SELECT k, fit_intercept, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse, avg(abs(y - a - b * x) / abs(y)) AS mape
           FROM r JOIN fits ON fold = k GROUP BY k, fit_intercept)
SELECT fit_intercept, round(-avg(rmse), 4) AS rmse_score, round(-avg(mape), 6) AS mape_score FROM errors GROUP BY fit_intercept""")
def parameter_search_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The score of every candidate of a four-fold search, by two metrics."""
    rows = assembled(planted_rows(spark, folder, outliers=False), ["l_quantity"])
    grid = {"fit_intercept": [True, False]}
    found = {m: dict((p["fit_intercept"], v) for p, v in search_parameters("LinearRegression", grid, rows, "row_key", metric=m).scores) for m in ("rmse", "mape")}
    rows.unpersist()
    scores = [(k, round(found["rmse"][k], 4), round(found["mape"][k], 6)) for k in (True, False)]
    return spark.createDataFrame(scores, "fit_intercept boolean, rmse_score double, mape_score double")


_PENALTIES = [0, 1_000, 1_000_000, 100_000_000]


@check(f"""
WITH r AS (SELECT l_quantity AS x, {CLEAN_SQL} AS y, ('0x' || substr(md5('43|' || {KEY_SQL}), 1, 8))::BIGINT % 5 AS fold FROM lineitem),
p AS (SELECT unnest({_PENALTIES})::BIGINT AS penalty), folds AS (SELECT DISTINCT fold AS k FROM r),
s AS (SELECT k, count(*) * covar_pop(y, x) AS xy, count(*) * var_pop(x) AS xx, avg(x) AS mx, avg(y) AS my FROM r JOIN folds ON fold <> k GROUP BY k),
fits AS (SELECT k, penalty, xy / (xx + penalty) AS b, my - mx * xy / (xx + penalty) AS a FROM s CROSS JOIN p),
errors AS (SELECT k, penalty, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse FROM r JOIN fits ON fold = k GROUP BY k, penalty)
SELECT penalty, round(-avg(rmse), 4) AS score FROM errors GROUP BY penalty""")
def ridge_candidates_by_fold(spark: SparkSession, folder: str) -> DataFrame:
    """The five-fold score of every penalty, all from one set of fold sums."""
    rows = assembled(planted_rows(spark, folder, outliers=False), ["l_quantity"])
    found = cross_validated_ridge(rows, "row_key", _PENALTIES)
    rows.unpersist()
    return spark.createDataFrame([(p, round(score, 4)) for p, score in found], "penalty long, score double")


_RANKS = [("l_quantity", 1), ("l_discount", 2), ("l_tax", 3)]


def _ranked(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n, i) for i, n in enumerate(names, start=1)], "feature string, position int")


@check(f"""
SELECT round(2 * regr_r2(y, l_quantity), 1) AS drop FROM (SELECT l_quantity, {CLEAN_SQL} AS y FROM lineitem)""")
def permutation_importance_drop(spark: SparkSession, folder: str) -> DataFrame:
    """The mean drop of a one-feature least-squares fit: a permuted feature costs twice the variance it explains."""
    rows = assembled(planted_rows(spark, folder, outliers=False), ["l_quantity"])
    model = build_regressor("LinearRegression", rows=rows.count()).fit(rows)
    found = permutation_importance(model, rows, ["l_quantity"], key="row_key", repeats=20)
    result = [(round(found.head()["importance_mean"], 1),)]
    rows.unpersist()
    return spark.createDataFrame(result, "drop double")


@check(_constants("feature, position", _RANKS))
def permutation_importance_ranks(spark: SparkSession, folder: str) -> DataFrame:
    rows = assembled(planted_rows(spark, folder, outliers=False))
    model = build_regressor("LinearRegression", rows=rows.count()).fit(rows)
    names = ranked_features(permutation_importance(model, rows, INPUTS, key="row_key"))
    rows.unpersist()
    return _ranked(spark, names)


@check(_constants("feature, position", _RANKS))
def tree_importance_ranks(spark: SparkSession, folder: str) -> DataFrame:
    rows = assembled(planted_rows(spark, folder, outliers=False))
    model = build_regressor("RandomForestRegressor", {"n_estimators": 10, "max_depth": 6}, rows=rows.count()).fit(rows)
    names = [r["feature"] for r in tree_importance(model, INPUTS, rows).collect()]
    rows.unpersist()
    return _ranked(spark, names)


def line_config(model: str = "HuberRegressor", params: dict | None = None) -> RunConfig:
    """A run over the planted rows: percentile chain, two categories, scaled inputs, log target."""
    return RunConfig(
        reservoirs=(),
        filtering=FilterConfig(
            keep=(*INPUTS, "l_returnflag", "l_linestatus", "unit_cost", "lateral", "proppant", "fluid"),
            percentile=True,
            thresholds={"unit_cost": (0.001, 0.999)},
        ),
        features=tuple(INPUTS),
        target="unit_cost",
        categories=("l_returnflag", "l_linestatus"),
        operator_threshold=50,
        transforms={"l_quantity": "log", "unit_cost": "log"},
        models={model: params or {}},
    )


def _trained(spark: SparkSession, folder: str, flag: str | None = None, **options) -> Trained:
    rows = planted_rows(spark, folder).withColumnRenamed(LABEL, "unit_cost")
    rows = rows.withColumns(
        {"lateral": F.col("l_quantity") * 200, "proppant": F.col("l_discount") * 20_000, "fluid": F.col("l_tax") * 1000}
    )
    if flag is not None:
        rows = rows.where(F.col("l_returnflag") == flag)
    config = line_config("LinearRegression")
    frame = modelling_frame(rows, config, "row_key", operator="l_linestatus", reservoir="l_returnflag")
    try:
        return train_model(frame, config, "row_key", bin_columns=("lateral", "proppant", "fluid"), **options)
    finally:
        frame.filtered.release()


_ALL_EQUAL = f"""
WITH y AS (SELECT *, CASE WHEN l_extendedprice > 100000 THEN 4 * {CLEAN_SQL} ELSE {CLEAN_SQL} END AS y,
                  ('0x' || substr(md5('42|' || {KEY_SQL}), 1, 8))::BIGINT % 10000 AS h FROM lineitem),
b AS (SELECT trunc(quantile_cont(y, 0.001)) AS lo, trunc(quantile_cont(y, 0.999)) AS hi FROM y)
SELECT CASE WHEN h < 1000 THEN 'test' WHEN h < 2800 THEN 'valid' ELSE 'train' END AS split, count(*) AS rows, count(*) AS equal
FROM y, b WHERE y > lo AND y <= hi GROUP BY 1"""


@check(_ALL_EQUAL)
def packaged_model_equals_equation(spark: SparkSession, folder: str) -> DataFrame:
    """On every row of each split the packaged model gives what its written-out linear equation gives."""
    trained = _trained(spark, folder, cv_folds=None, importance_repeats=0)
    features = ["l_quantity__transformed", "l_discount", "l_tax"]
    equation = F.exp(score_from_coefficients(trained.pipeline, features, trained.categories))
    close = F.abs(equation - F.col("prediction")) <= 1e-9 * F.abs(equation)
    names = ("train", "valid", "test")
    inside = {name: F.col(SPLIT) == name for name in names}
    counts = trained.pipeline.transform(trained.splits.labelled).agg(
        *[F.count_if(rows).alias(f"rows_{name}") for name, rows in inside.items()],
        *[F.count_if(rows & close).alias(f"equal_{name}") for name, rows in inside.items()],
    )
    trained.release()
    found = [F.struct(F.lit(n).alias("split"), F.col(f"rows_{n}").alias("rows"), F.col(f"equal_{n}").alias("equal")) for n in names]
    return counts.select(F.inline(F.array(*found)))


@check("SELECT count(*) AS rows, count(*) AS equal FROM lineitem")
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A saved and reloaded pipeline predicts the same for every row."""
    trained = _trained(spark, folder, cv_folds=None, importance_repeats=0)
    path = scratch_path(spark, "model")
    save_model(trained.pipeline, path)
    rows = planted_rows(spark, folder).withColumn(
        "l_linestatus", F.concat_ws("_", "l_returnflag", "l_linestatus")
    )
    before = trained.pipeline.transform(rows).withColumnRenamed("prediction", "before")
    before = before.select("row_key", *INPUTS, "l_returnflag", "l_linestatus", "before")
    trained.release()
    both = load_model(path).transform(before)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") == F.col("prediction")).alias("equal"))


_PLANTED_SQL = f"""
planted AS (SELECT *, CASE WHEN l_extendedprice > 100000 THEN 4 * {CLEAN_SQL} ELSE {CLEAN_SQL} END AS y,
                   l_quantity * 200 AS lateral_ft, l_discount * 20000 AS proppant, l_tax * 1000 AS fluid,
                   ('0x' || substr(md5('42|' || {KEY_SQL}), 1, 8))::BIGINT % 10000 AS h FROM lineitem)"""


@check(f"""
WITH {_PLANTED_SQL},
b AS (SELECT trunc(quantile_cont(y, 0.001)) AS lo, trunc(quantile_cont(y, 0.999)) AS hi FROM planted),
kept AS (SELECT planted.* FROM planted, b WHERE y > lo AND y <= hi),
train AS (SELECT * FROM kept WHERE h >= 2800), {nested_sql("train", "lateral_ft", "proppant", "fluid")}
SELECT 'overall_performance' AS part, 1::BIGINT AS rows
UNION ALL SELECT 'feature_importance', 3 + (SELECT count(DISTINCT l_returnflag) - 1 FROM kept)
    + (SELECT count(DISTINCT l_returnflag || '_' || l_linestatus) - 1 FROM kept)
UNION ALL SELECT 'validation_performance', count(*) FROM kept WHERE h BETWEEN 1000 AND 2799
UNION ALL SELECT 'test_performance', count(*) FROM kept WHERE h < 1000
UNION ALL SELECT 'error_table', count(DISTINCT bin_ll || bin_prop || bin_fluid) FROM labelled
UNION ALL SELECT 'error_bin_edges', CAST(
    (floor(max(lateral_ft) / 1000) - floor(min(lateral_ft) / 1000) + 2) + (floor(max(proppant) / any_value(sp)) - floor(min(proppant) / any_value(sp)) + 2)
    + (floor(max(fluid) / any_value(sf)) - floor(min(fluid) / any_value(sf)) + 2) AS BIGINT) FROM x""")
def performance_bundle_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every part of the performance report with its row count, after a Parquet round trip."""
    trained = _trained(spark, folder, cv_folds=2, importance_repeats=2)
    parts, path = performance_bundle(trained), scratch_path(spark, "bundle")
    save_bundle(parts, path)
    trained.release()
    return count_rows(load_bundle(spark, path, list(parts)))


@check(f"""
WITH {_PLANTED_SQL},
b AS (SELECT l_returnflag, trunc(quantile_cont(y, 0.001)) AS lo, trunc(quantile_cont(y, 0.999)) AS hi FROM planted GROUP BY l_returnflag)
SELECT l_returnflag AS basin, 'LinearRegression' AS models, count_if(h >= 2800)::BIGINT AS training_rows,
       count_if(h < 1000)::BIGINT AS test_rows, true AS fits
FROM planted JOIN b USING (l_returnflag) WHERE y > lo AND y <= hi GROUP BY l_returnflag""")
def basins_trained(spark: SparkSession, folder: str) -> DataFrame:
    """One model per segment of the table; the segment predicate reaches each scan."""
    found = []
    for flag in ("A", "N", "R"):
        trained = _trained(spark, folder, flag, cv_folds=2, importance_repeats=0)
        performance = trained.performance().head()
        test_rows = trained.residuals["test"].count()
        found.append((flag, performance["models"], trained.metadata["training_rows"], test_rows, performance["r2"] > 0.1))
        trained.release()
    return spark.createDataFrame(found, "basin string, models string, training_rows long, test_rows long, fits boolean")
