"""Categories, counts, summaries, metrics, residuals and the error table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.checks.registry import LINES_WITH_PARTS, check, lines_with_parts, table
from lateralis.operators.categories import distinct_values, group_rare, group_rare_joined, retained_values
from lateralis.operators.errorbins import absolute_percentage_error, bin_spec, edge_table, error_table, expected_error, nested_bins, occupied_edges, step_bins
from lateralis.operators.metrics import RMSE, describe, leaderboard, regression_metrics, residual_frame, validation_metrics
from lateralis.operators.quantiles import group_quantiles
from lateralis.operators.spatial import drop_duplicate_rows
from lateralis.session import scratch_path
from lateralis.sources.artifacts import load_error_table, load_list, save_error_table, save_list

_RARE = """
WITH n AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
t AS (SELECT count(*) // 25 AS threshold FROM lineitem)"""


def _rare_threshold(lines: DataFrame) -> int:
    return lines.count() // 25


@check(f"""
{_RARE}
SELECT l_orderkey, l_linenumber, CASE WHEN n < threshold THEN 'miscellaneous' ELSE p_brand END AS p_brand
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN n USING (p_brand), t""")
def rare_operators_grouped(spark: SparkSession, folder: str) -> DataFrame:
    lines = lines_with_parts(spark, folder).select("l_orderkey", "l_linenumber", "p_brand")
    return group_rare(lines, "p_brand", _rare_threshold(table(spark, folder, "lineitem"))).df


@check(f"""
{_RARE}
SELECT l_orderkey, l_linenumber, CASE WHEN n < threshold THEN 'miscellaneous' ELSE p_brand END AS p_brand
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN n USING (p_brand), t""")
def rare_operators_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The variant for any number of operators."""
    lines = lines_with_parts(spark, folder).select("l_orderkey", "l_linenumber", "p_brand")
    return group_rare_joined(lines, "p_brand", _rare_threshold(table(spark, folder, "lineitem")))


@check(f"{_RARE} SELECT p_brand, n FROM n, t WHERE n >= threshold ORDER BY n DESC, p_brand")
def retained_operators(spark: SparkSession, folder: str) -> DataFrame:
    lines = lines_with_parts(spark, folder).select("p_brand")
    return retained_values(lines, "p_brand", _rare_threshold(table(spark, folder, "lineitem")))


@check("SELECT DISTINCT p_brand FROM part")
def category_list(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_values(table(spark, folder, "part"), "p_brand")


@check("SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def rows_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    return drop_duplicate_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"])


def _describe_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
        round(quantile_cont({c}, 0.75), 4) AS p75, max({c})::DOUBLE AS max FROM lineitem"""
        for c in columns
    )


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@check(_describe_sql(_DESCRIBED))
def summary_statistics(spark: SparkSession, folder: str) -> DataFrame:
    summary = describe(table(spark, folder, "lineitem"), _DESCRIBED)
    return summary.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")})


@check("""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.025), 6) AS p025, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
       round(quantile_cont(l_extendedprice, 0.975), 6) AS p975, round(quantile_cont(l_discount, 0.5), 6) AS discount
FROM lineitem GROUP BY l_returnflag""")
def quantiles_by_narrowing(spark: SparkSession, folder: str) -> DataFrame:
    """The way for groups too large for one aggregation buffer, taken here by a low limit.

    Interpolated prices have five decimals, so six are compared.
    """
    wanted = {"l_extendedprice": [0.025, 0.5, 0.975], "l_discount": [0.5]}
    found = group_quantiles(table(spark, folder, "lineitem"), wanted, ["l_returnflag"], builtin_rows=100)
    price = F.col("l_extendedprice")
    return found.select(
        "l_returnflag",
        *[F.round(price[i], 6).alias(n) for i, n in enumerate(("p025", "p50", "p975"))],
        F.round(F.col("l_discount")[0], 6).alias("discount"),
    )


# Values with NaN, infinities and NULL; order statistics from a sorted list, interpolated from the nearer end.
_ODD = """CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE WHEN l_quantity = 50 AND l_tax > 0.06 THEN 'Infinity'::DOUBLE
    WHEN l_quantity = 1 AND l_tax > 0.07 THEN '-Infinity'::DOUBLE WHEN l_discount = 0.05 THEN NULL ELSE l_extendedprice END"""
_ODD_PROBABILITIES = {"p0": 0.0, "p001": 0.001, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p999": 0.999, "p1": 1.0}


def _interpolated_sql(p: float) -> str:
    low, high = (f"v[1 + CAST({f}((len(v) - 1) * {p}::DOUBLE) AS BIGINT)]" for f in ("floor", "ceil"))
    part = f"((len(v) - 1) * {p}::DOUBLE - floor((len(v) - 1) * {p}::DOUBLE))"
    return f"""CASE WHEN {low} = {high} OR {part} = 0 THEN {low} WHEN isinf({high}) THEN {high} WHEN isinf({low}) THEN {low}
        WHEN {part} < 0.5 THEN {low} + ({high} - {low}) * {part} ELSE {high} - ({high} - {low}) * (1 - {part}) END"""


@check(f"""
WITH s AS (SELECT l_returnflag, list_sort(list(x)) AS v FROM (SELECT l_returnflag, {_ODD} AS x FROM lineitem)
           WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY l_returnflag),
q AS (SELECT l_returnflag, {", ".join(f"{_interpolated_sql(p)} AS {n}" for n, p in _ODD_PROBABILITIES.items())} FROM s)
SELECT l_returnflag, true AS same_at_any_size, {", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in ("p0", "p1"))},
       {", ".join(n for n in _ODD_PROBABILITIES if n not in ("p0", "p1"))} FROM q""")
def quantiles_of_odd_values(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted and narrowed quantiles agree to the last bit; an infinite end is shown as text."""
    value = (
        F.when(F.col("l_linenumber") == 7, float("nan")).when((F.col("l_quantity") == 50) & (F.col("l_tax") > 0.06), float("inf"))
        .when((F.col("l_quantity") == 1) & (F.col("l_tax") > 0.07), float("-inf")).when(F.col("l_discount") == 0.05, None)
        .otherwise(F.col("l_extendedprice"))
    )
    lines = table(spark, folder, "lineitem").select("l_returnflag", value.alias("x"))
    ps = list(_ODD_PROBABILITIES.values())
    ways = [group_quantiles(lines, {"x": ps}, ["l_returnflag"], builtin_rows=n).withColumnRenamed("x", f"x{n}") for n in (10**9, 100)]
    both = ways[0].join(ways[1], "l_returnflag")
    same = F.to_json(f"x{10**9}") == F.to_json("x100")
    text = {n: F.when(F.abs(F.col("x100")[i]) == float("inf"), F.when(F.col("x100")[i] > 0, "inf").otherwise("-inf")).otherwise(F.col("x100")[i].cast("string"))
            for i, n in enumerate(_ODD_PROBABILITIES)}
    return both.select(
        "l_returnflag", same.alias("same_at_any_size"),
        *[text[n].alias(n) if n in ("p0", "p1") else F.col("x100")[i].alias(n) for i, n in enumerate(_ODD_PROBABILITIES)],
    )


# A fixed formula stands in for a model's prediction of the unit cost.
PREDICTION_SQL = "53000 + 40 * (l_quantity - 25) - 20000 * l_discount + 1000 * l_tax"


def predicted_lines(spark: SparkSession, folder: str) -> DataFrame:
    prediction = 53000 + 40 * (F.col("l_quantity") - 25) - 20000 * F.col("l_discount") + 1000 * F.col("l_tax")
    return lines_with_parts(spark, folder).withColumn("pred", prediction)


def _metrics_sql(by: str = "") -> str:
    head, tail = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
WITH s AS (SELECT *, l_extendedprice AS y, {PREDICTION_SQL} AS p FROM {LINES_WITH_PARTS}), r AS (SELECT *, y - p AS r FROM s)
SELECT {head}round(1 - sum(r * r) / (var_pop(y) * count(*)), 5) AS "r2",
       round(avg(abs(r) / greatest(abs(y), 2.220446049250313e-16)), 5) AS "mean_absolute_percentage_error (%)",
       round(sqrt(avg(r * r)), 2) AS "root_mean_squared_error (USDMM)",
       round(-quantile_cont(r, 0.9) / quantile_cont(r, 0.1), 5) AS "residual P90/P10",
       round(stddev_pop(r), 5) AS "residual std (USDMM)",
       round(quantile_cont(r, 0.75) - quantile_cont(r, 0.25), 5) AS "residuals IQR (USDMM)"
FROM r {tail}"""


def _rounded(metrics: DataFrame) -> DataFrame:
    """The root of a rounded MSE of this size is not exact to the last digit in either engine."""
    return metrics.withColumn(RMSE, F.round(F.col(f"`{RMSE}`"), 2))


@check(_metrics_sql())
def regression_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(regression_metrics(predicted_lines(spark, folder), "l_extendedprice", "pred"))


@check(_metrics_sql("p_brand"))
def regression_report_by_operator(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(regression_metrics(predicted_lines(spark, folder), "l_extendedprice", "pred", ["p_brand"]))


@check(f"""
WITH s AS (SELECT p_type, l_extendedprice AS y, {PREDICTION_SQL} AS p FROM {LINES_WITH_PARTS})
SELECT p_type, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS r2, round(avg((y - p) * (y - p)), 0) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 2) AS rmse, round(avg(abs(p - y) * 100 / y), 4) AS mape
FROM s GROUP BY p_type""")
def validation_by_area(spark: SparkSession, folder: str) -> DataFrame:
    found = validation_metrics(predicted_lines(spark, folder), "l_extendedprice", "pred", ["p_type"])
    return found.withColumns({c: F.round(c, d) for c, d in (("r2", 4), ("mse", 0), ("rmse", 2), ("mape", 4))})


_MODELS = {"constant": "53000 + 0 * l_quantity", "by_quantity": "53000 + 40 * (l_quantity - 25)", "full": PREDICTION_SQL}


@check(f"""
SELECT models, CAST(row_number() OVER (ORDER BY mape, models) AS INTEGER) AS position, round(mape, 6) AS mape FROM ({
    " UNION ALL ".join(
        f"SELECT '{n}' AS models, round(avg(abs(l_extendedprice - ({p})) / l_extendedprice), 5) AS mape FROM lineitem"
        for n, p in _MODELS.items())
}) ORDER BY mape LIMIT 2""")
def model_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of three fixed models collected into a leaderboard; the best two by MAPE."""
    lines = table(spark, folder, "lineitem")
    performances = {
        name: regression_metrics(lines.withColumn("pred", F.expr(p)), "l_extendedprice", "pred").head().asDict()
        for name, p in _MODELS.items()
    }
    mape = "mean_absolute_percentage_error (%)"
    best = leaderboard(spark, performances).limit(2).select("models", F.col(f"`{mape}`").alias("mape")).collect()
    ranked = [(r["models"], i, r["mape"]) for i, r in enumerate(best, start=1)]
    return spark.createDataFrame(ranked, "models string, position int, mape double")


@check("""
SELECT p AS y_pred_full, l_extendedprice AS y_train, l_extendedprice - p AS residual_full, l_quantity, l_discount
FROM (SELECT *, round(53000 + 40 * (l_quantity - 25) - 20000 * l_discount + 1000 * l_tax, 6) AS p FROM lineitem)""")
def residual_rows(spark: SparkSession, folder: str) -> DataFrame:
    scored = predicted_lines(spark, folder).withColumn("pred", F.round("pred", 6))
    return residual_frame(scored, "l_extendedprice", {"full": "pred"}, ["l_quantity", "l_discount"], "train")


@check("""
SELECT l_orderkey, l_linenumber, CASE WHEN lo >= 4 * floor(lowest / 4) THEN lo || ' - ' || (lo + 4) END AS bin
FROM (SELECT *, CAST(4 * (ceil(l_quantity / 4) - 1) AS BIGINT) AS lo FROM lineitem),
     (SELECT min(l_quantity) AS lowest FROM lineitem)""")
def step_binning(spark: SparkSession, folder: str) -> DataFrame:
    binned = step_bins(table(spark, folder, "lineitem"), "l_quantity", 4, "bin")
    return binned.select("l_orderkey", "l_linenumber", "bin")


_BIN_INPUT = f"(SELECT *, l_extendedprice / 10 AS lateral_length, {PREDICTION_SQL} AS pred FROM {LINES_WITH_PARTS})"


def nested_sql(source: str, lateral: str, proppant: str, fluid: str) -> str:
    """Steps ``s``, rows ``x`` with their grid cells a, b, c, and rows ``labelled`` that have all three bins."""
    return f"""
s AS (SELECT greatest(10 * floor((max({proppant}) - min({proppant})) / 200), 1) AS sp,
             greatest(floor((max({fluid}) - min({fluid})) / 10), 1) AS sf FROM {source}),
x AS (SELECT i.*, sp, sf, 1000 * (ceil({lateral} / 1000) - 1) AS a, sp * (ceil({proppant} / sp) - 1) AS b,
             sf * (ceil({fluid} / sf) - 1) AS c FROM {source} i, s),
n1 AS (SELECT * FROM x WHERE a >= 1000 * floor((SELECT min({lateral}) FROM x) / 1000)),
n2 AS (SELECT * FROM n1 QUALIFY b >= sp * floor(min({proppant}) OVER (PARTITION BY a) / sp)),
n3 AS (SELECT * FROM n2 QUALIFY c >= sf * floor(min({fluid}) OVER (PARTITION BY a, b) / sf)),
labelled AS (SELECT *, CAST(a AS BIGINT) || ' - ' || CAST(a + 1000 AS BIGINT) AS bin_ll,
                    CAST(b AS BIGINT) || ' - ' || CAST(b + sp AS BIGINT) AS bin_prop,
                    CAST(c AS BIGINT) || ' - ' || CAST(c + sf AS BIGINT) AS bin_fluid FROM n3)"""


NESTED_SQL = nested_sql(_BIN_INPUT, "lateral_length", "p_retailprice", "l_quantity")


def binned_input(spark: SparkSession, folder: str) -> DataFrame:
    return predicted_lines(spark, folder).withColumn("lateral_length", F.col("l_extendedprice") / 10)


BIN_COLUMNS = ("lateral_length", "p_retailprice", "l_quantity")


@check(f"WITH {NESTED_SQL} SELECT l_orderkey, l_linenumber, bin_ll, bin_prop, bin_fluid FROM labelled")
def nested_binning(spark: SparkSession, folder: str) -> DataFrame:
    lines = binned_input(spark, folder)
    binned = nested_bins(lines.select("l_orderkey", "l_linenumber", *BIN_COLUMNS), bin_spec(lines, *BIN_COLUMNS))
    return binned.select("l_orderkey", "l_linenumber", "bin_ll", "bin_prop", "bin_fluid")


ERRORS_SQL = f"""{NESTED_SQL},
errors AS (SELECT bin_ll, bin_prop, bin_fluid, quantile_cont(100 * abs(l_extendedprice - pred) / l_extendedprice, 0.5) AS m
           FROM labelled GROUP BY ALL)"""


def _errors(lines: DataFrame) -> DataFrame:
    return lines.withColumn("error", absolute_percentage_error(F.col("l_extendedprice"), F.col("pred")))


@check(f"WITH {ERRORS_SQL} SELECT bin_ll, bin_prop, bin_fluid, round(m, 2) AS mape_median FROM errors")
def error_table_by_bins(spark: SparkSession, folder: str) -> DataFrame:
    lines = binned_input(spark, folder)
    return error_table(_errors(lines), bin_spec(lines, *BIN_COLUMNS), "error")


@check(f"""
WITH {ERRORS_SQL},
n AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
kept AS (SELECT string_agg(p_brand, ', ' ORDER BY n DESC, p_brand) AS operators FROM n WHERE n >= (SELECT count(*) // 25 FROM lineitem))
SELECT bin_ll, bin_prop, bin_fluid, round(m, 2) AS mape_median, operators FROM errors, kept""")
def error_table_and_list_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Error table and retained operators, written as JSON and read back."""
    table_path, list_path = scratch_path(spark, "errors"), scratch_path(spark, "operators")
    save_error_table(error_table_by_bins(spark, folder), table_path)
    lines = lines_with_parts(spark, folder).select("p_brand")
    save_list(spark, group_rare(lines, "p_brand", _rare_threshold(lines)).retained, list_path)
    operators = ", ".join(load_list(spark, list_path))
    return load_error_table(spark, table_path).withColumn("operators", F.lit(operators))


@check(f"""
WITH {ERRORS_SQL}
SELECT l_orderkey, l_linenumber, round(m, 2) AS expected_error
FROM x LEFT JOIN errors ON bin_ll = CAST(a AS BIGINT) || ' - ' || CAST(a + 1000 AS BIGINT)
    AND bin_prop = CAST(b AS BIGINT) || ' - ' || CAST(b + sp AS BIGINT)
    AND bin_fluid = CAST(c AS BIGINT) || ' - ' || CAST(c + sf AS BIGINT)""")
def expected_error_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that lie on the lowest edge of a subset have no entry of their own and may find a NULL."""
    lines = binned_input(spark, folder)
    spec = bin_spec(lines, *BIN_COLUMNS)
    found = expected_error(
        lines.select("l_orderkey", "l_linenumber", *BIN_COLUMNS),
        error_table(_errors(lines), spec, "error"), spec.steps, BIN_COLUMNS, "expected_error",
    )
    return found.select("l_orderkey", "l_linenumber", "expected_error")


def _edges_sql(name: str, column: str, step: str) -> str:
    return f"""SELECT '{name}' AS property, CAST(unnest(range(CAST(floor(lo / step) AS BIGINT), CAST(floor(hi / step) + 2 AS BIGINT))) * step AS DOUBLE) AS edge
    FROM (SELECT min({column}) AS lo, max({column}) AS hi, {step} AS step FROM {_BIN_INPUT})"""


@check(" UNION ALL ".join([
    _edges_sql("error_bins_lateral_length", "lateral_length", "1000"),
    _edges_sql("error_bins_proppant", "p_retailprice", "greatest(10 * floor((max(p_retailprice) - min(p_retailprice)) / 200), 1)"),
    _edges_sql("error_bins_fluid", "l_quantity", "greatest(floor((max(l_quantity) - min(l_quantity)) / 10), 1)"),
]))
def bin_edge_lists(spark: SparkSession, folder: str) -> DataFrame:
    return edge_table(spark, bin_spec(binned_input(spark, folder), *BIN_COLUMNS))


_OCCUPIED = [
    ("error_bins_lateral_length", "lateral_length", "1000"),
    ("error_bins_proppant", "p_retailprice", "(SELECT greatest(10 * floor((max(p_retailprice) - min(p_retailprice)) / 200), 1) FROM i)"),
    ("error_bins_fluid", "l_quantity", "(SELECT greatest(floor((max(l_quantity) - min(l_quantity)) / 10), 1) FROM i)"),
]


@check(f"""
WITH i AS MATERIALIZED {_BIN_INPUT}, cells AS ({" UNION ".join(
    f"SELECT '{name}' AS property, {step} AS step, ceil({column} / {step}) - 1 AS n, floor((SELECT min({column}) FROM i) / {step}) AS lowest FROM i"
    for name, column, step in _OCCUPIED)})
SELECT DISTINCT property, CAST((n + above) * step AS DOUBLE) AS edge FROM cells, (VALUES (0), (1)) AS v(above) WHERE n >= lowest""")
def occupied_bin_edges(spark: SparkSession, folder: str) -> DataFrame:
    lines = binned_input(spark, folder)
    return occupied_edges(lines, bin_spec(lines, *BIN_COLUMNS))
