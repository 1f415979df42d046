"""Exact quantiles, overall or per group, that never put one group into one task.

Every quantile is interpolated by one expression between two order statistics, so that it does not
depend on how those were found. NaN is missing like NULL; infinities, and values at the end of the range
of a double, rank beyond all others and come out as infinities.

Groups of up to ``SORTED_ROWS`` rows are sorted in one aggregation buffer. Of larger ones a mergeable rank sketch,
combined map-side, brackets each wanted order statistic; a second pass counts what lies below the brackets and adds
up equal values inside them, about one row in a hundred, and the ranks are settled there. The sketch only decides
where to look: a rank that the counts do not find in its bracket, or a bracket that is itself too full, sends its
groups to the narrowing, so the result is exact and the same, bit for bit, whatever the sketch said.

Narrowing: each round counts the values of the current interval in buckets (a map-side combined count, however hot
the group is) and keeps the bucket with the wanted rank, until the interval is a single value. Both ends of an
interval fall into different buckets, so every round makes progress. The first buckets are equally wide on a
logarithmic scale, which suits costs with a long tail. As soon as the intervals hold a small part of
the rows, those rows are set aside and later rounds read only them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.session import checkpointed

SORTED_ROWS = 20_000
SKETCH_SIZE = 2_048
MARGIN = 0.005  # of the rank, several times the sketch's usual error
BRACKETED_ROWS = 100_000_000  # a bracket of a larger group is not ordered in one task
BUCKETS = 2_048
BROADCAST_ROWS = 200_000
SET_ASIDE_SHARE = 0.05
LARGEST = 1.7976931348623157e308


def ranked(column: Column) -> Column:
    """``column`` as what is ranked: NaN is NULL, infinities are the ends of the finite range."""
    x = column.cast("double")
    return F.when(F.isnan(x), None).when(x > LARGEST, LARGEST).when(x < -LARGEST, -LARGEST).otherwise(x)


def _rank(count: Column, probability: float) -> Column:
    return (count - 1) * F.lit(float(probability))


def interpolated(low: Column, high: Column, fraction: Column) -> Column:
    """Linear interpolation from the nearer end; nothing is added to an end that is met exactly."""
    step = high - low
    between = F.when(fraction < 0.5, low + step * fraction).otherwise(high - step * (1 - fraction))
    exact = F.when((low == high) | (fraction == 0), low)
    return (
        F.when(F.coalesce(exact, high) >= LARGEST, F.lit(float("inf")))
        .when(F.coalesce(exact, low) <= -LARGEST, F.lit(float("-inf")))
        .otherwise(F.coalesce(exact, between))
    )


def sorted_quantiles(column: Column, probabilities: Sequence[float]) -> Column:
    """An aggregate: the quantiles of a group of checked size as an array, NULL without values."""
    values = F.sort_array(F.collect_list(ranked(column)))
    ranks = [_rank(F.size(values), p) for p in probabilities]
    found = [
        interpolated(F.get(values, F.floor(r).cast("int")), F.get(values, F.ceil(r).cast("int")), r - F.floor(r)) for r in ranks
    ]
    return F.when(F.size(values) > 0, F.array(*found))


def largest_group(df: DataFrame, by: Sequence[str] = ()) -> int:
    """Rows of the largest group: a count, combined map-side."""
    if not by:
        return df.count()
    counts = df.groupBy(*[col(c) for c in by]).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).head()[0] or 0


def group_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    by: Sequence[str] = (),
    *,
    builtin_rows: int = SORTED_ROWS,
    bracketed_rows: int = BRACKETED_ROWS,
    rows_at_most: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per group: the ``by`` columns and, per wanted column, an array of its quantiles.

    Linear interpolation between order statistics; NULL and NaN are skipped. The result is the same, bit for
    bit, whatever ``builtin_rows`` and ``bracketed_rows`` are. A caller that has counted the
    rows already passes ``rows_at_most`` and saves the count.
    """
    keys = [f"g{i}" for i in range(len(by))]
    values = [f"v{i}" for i in range(len(wanted))]
    narrow = df.select(
        *[col(c).alias(k) for c, k in zip(by, keys)],
        *[ranked(col(c)).alias(v) for c, v in zip(wanted, values)],
    )
    probabilities = list(wanted.values())
    if rows_at_most is None:
        rows_at_most = largest_group(narrow, keys)
    large = None
    if rows_at_most > builtin_rows:
        sizes = narrow.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("rows"),
            *[f(v).alias(f"{p}{i}") for i, v in enumerate(values) for p, f in (("n", F.count), ("lo", F.min), ("hi", F.max))],
            *([] if keys else _sketches(values)),  # of few groups all may be sketched in the pass that counts them
        )
        large = checkpointed(sizes.where(F.col("rows") > builtin_rows))
    if large is None or not large.head(1):
        result = _builtin(narrow, keys, probabilities)
    else:
        result = _bracketed(narrow, large, keys, probabilities) if large.agg(F.max("rows")).head()[0] <= bracketed_rows else None
        if result is None:
            result = _narrowed(narrow, large, keys, probabilities, buckets)
        if keys:
            rest = narrow.alias("r").join(_hinted(large).alias("b"), _same("r", "b", keys), "left_anti")
            result = _builtin(rest, keys, probabilities).unionByName(result)
    return result.select(
        *[col(k).alias(c) for c, k in zip(by, keys)], *[col(v).alias(c) for c, v in zip(wanted, values)]
    )


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], **options) -> dict[str, list[float | None]]:
    """Overall quantiles as driver numbers: one value per wanted probability."""
    row = group_quantiles(df, wanted, **options).head()
    return {c: list(row[c]) if row is not None and row[c] else [None] * len(ps) for c, ps in wanted.items()}


def medians(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    return {c: found[0] for c, found in quantiles(df, {c: [0.5] for c in columns}, **options).items()}


def _builtin(narrow: DataFrame, keys: list[str], probabilities: list[Sequence[float]]) -> DataFrame:
    aggregates = [sorted_quantiles(F.col(f"v{i}"), ps).alias(f"v{i}") for i, ps in enumerate(probabilities)]
    return narrow.groupBy(*keys).agg(*aggregates)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _hinted(groups: DataFrame) -> DataFrame:
    """Broadcast only when the row count is within the bound; otherwise Spark shuffles and splits skew."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups


def _log_scale(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def _sketches(values: Sequence[str]) -> list[Column]:
    return [F.kll_sketch_agg_double(v, SKETCH_SIZE).alias(f"s{v[1:]}") for v in values]


def _bracketed(narrow: DataFrame, large: DataFrame, keys: list[str], probabilities: list[Sequence[float]]) -> DataFrame | None:
    """The quantiles of the groups in ``large`` by sketched brackets; None if a rank lies outside of its bracket."""
    targets = [(i, j, p) for i, ps in enumerate(probabilities) for j, p in enumerate(ps)]
    sized = large
    if keys:
        held = narrow.alias("r").join(_hinted(large.select(*keys)).alias("b"), _same("r", "b", keys), "left_semi")
        sketches = held.groupBy(*keys).agg(*_sketches([f"v{i}" for i in range(len(probabilities))]))
        sized = large.alias("l").join(sketches.alias("k"), _same("l", "k", keys))

    def at(i: int, rank: float) -> Column:
        return F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(min(max(rank, 0.0), 1.0))))

    ends = []
    for t, (i, _, p) in enumerate(targets):
        ends += [
            (F.col(f"lo{i}") if p - MARGIN <= 0 else at(i, p - MARGIN)).alias(f"from{t}"),
            (F.col(f"hi{i}") if p + MARGIN >= 1 else at(i, p + MARGIN)).alias(f"to{t}"),
        ]
    counts = [F.col(f"n{i}") for i in range(len(probabilities))]
    brackets = checkpointed(sized.select(*[F.col(f"l.{k}").alias(k) if keys else F.col(k) for k in keys], *counts, *ends))
    if keys:
        rows = narrow.alias("r").join(_hinted(brackets).alias("b"), _same("r", "b", keys)).drop(*[F.col(f"r.{k}") for k in keys])
    else:  # one row of numbers
        found = brackets.head().asDict()
        rows = narrow.withColumns({c: F.lit(v).cast("double") for c, v in found.items() if c.startswith(("from", "to"))})
    value = [F.col(f"v{i}") for i, _, _ in targets]
    below = checkpointed(rows.groupBy(*keys).agg(*[F.count_if(v < F.col(f"from{t}")).alias(f"below{t}") for t, v in enumerate(value)]))
    inside = [v.between(F.col(f"from{t}"), F.col(f"to{t}")) for t, v in enumerate(value)]
    cells = F.filter(
        F.array(*[F.when(c, F.struct(F.lit(t).alias("target"), v.alias("v"))) for t, (c, v) in enumerate(zip(inside, value))]),
        lambda cell: cell.isNotNull(),
    )
    equal = rows.where(reduce(or_, inside)).select(*keys, F.explode(cells).alias("x")).groupBy(*keys, "x.target", "x.v").agg(F.count(F.lit(1)).alias("n"))
    through = F.sum("n").over(Window.partitionBy(*keys, "target").orderBy("v"))
    ordered = equal.withColumn("through", through).alias("e")
    # (keys, target, the wanted ranks counted from the bracket's lower end)
    wanted = []
    for t, (i, _, p) in enumerate(targets):
        rank = _rank(F.col(f"n{i}"), p)
        wanted.append(F.when(F.col(f"n{i}") > 0, F.struct(
            F.lit(t).alias("target"), (F.floor(rank).cast("long") - F.col(f"below{t}")).alias("low"),
            (F.ceil(rank).cast("long") - F.col(f"below{t}")).alias("high"), (rank - F.floor(rank)).alias("fraction"),
        )))
    if keys:
        joined = brackets.alias("a").join(below.alias("w"), _same("a", "w", keys))
    else:
        joined = brackets.withColumns({c: F.lit(v) for c, v in below.head().asDict().items()})
    ranks = joined.select(*[F.col(f"a.{k}").alias(k) for k in keys], F.explode(F.filter(F.array(*wanted), lambda x: x.isNotNull())).alias("x"))
    ranks = checkpointed(ranks.select(*keys, "x.*"))
    holds = lambda name: (F.col("e.through") > F.col(f"t.{name}")) & (F.col("e.through") - F.col("e.n") <= F.col(f"t.{name}"))
    met = ordered.join(_hinted(ranks).alias("t"), _same("e", "t", [*keys, "target"])).where(holds("low") | holds("high"))
    settled = checkpointed(
        met.groupBy(*[F.col(f"t.{k}").alias(k) for k in keys], F.col("t.target").alias("target")).agg(
            F.max(F.when(holds("low"), F.col("e.v"))).alias("low"), F.max(F.when(holds("high"), F.col("e.v"))).alias("high"),
            F.first("t.fraction").alias("fraction"),
        ).where(F.col("low").isNotNull() & F.col("high").isNotNull())
    )
    if settled.count() < ranks.count():
        return None
    number = {(i, j): t for t, (i, j, _) in enumerate(targets)}

    def quantile(i: int, j: int) -> Column:
        pick = lambda name: F.max(F.when(F.col("target") == number[i, j], F.col(name)))
        return interpolated(pick("low"), pick("high"), pick("fraction"))

    has = lambda i: F.count_if(F.col("target") == number[i, 0]) > 0
    arrays = [F.when(has(i), F.array(*[quantile(i, j) for j in range(len(ps))])).alias(f"v{i}") for i, ps in enumerate(probabilities)]
    # every group of ``large`` keeps a row, also one without any value
    everyone = large.select(*keys, F.lit(-1).alias("target"), *[F.lit(None).cast("double").alias(c) for c in ("low", "high", "fraction")])
    return settled.select(*keys, "target", "low", "high", "fraction").unionByName(everyone).groupBy(*keys).agg(*arrays)


def _open_columns(unresolved: DataFrame) -> list[int]:
    """Numbers of the wanted columns with open intervals: at most one row per column."""
    return sorted(r["c"] for r in unresolved.select("c").distinct().collect())


def _narrowed(
    narrow: DataFrame, large: DataFrame, keys: list[str], probabilities: list[Sequence[float]], buckets: int
) -> DataFrame:
    # One target per order statistic: interpolation needs the one below and the one above each rank.
    targets = [(i, j, side) for i, ps in enumerate(probabilities) for j in range(len(ps)) for side in (0, 1)]

    def start(number: int, i: int, j: int, side: int) -> Column:
        rank = _rank(F.col(f"n{i}"), probabilities[i][j])
        return F.struct(
            F.lit(i).alias("c"),
            F.lit(number).alias("target"),
            (F.ceil(rank) if side else F.floor(rank)).cast("long").alias("rank"),
            (rank - F.floor(rank)).alias("fraction"),
            F.lit(0).cast("long").alias("below"),
            F.col(f"lo{i}").alias("lo"),
            F.col(f"hi{i}").alias("hi"),
        )

    fixed = [*keys, "c", "target", "rank", "fraction"]
    starts = F.array(*[start(number, *target) for number, target in enumerate(targets)])
    intervals = checkpointed(
        large.select(*keys, F.explode(starts).alias("s")).select(*keys, "s.*").where(F.col("lo").isNotNull())
    )
    def cells(columns: list[int]) -> DataFrame:
        """(keys, column number, value) of the columns still needed: the others are not read."""
        pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")) for i in columns])
        return narrow.select(*keys, F.explode(pairs).alias("x")).select(*keys, "x.c", "x.v")

    inside = _same("r", "b", [*keys, "c"]) & F.col("r.v").between(F.col("b.lo"), F.col("b.hi"))
    value, low, high = F.col("r.v"), F.col("b.lo"), F.col("b.hi")
    linear = (value / 2 - low / 2) / (high / 2 - low / 2)  # halves: the range itself may overflow
    logarithmic = F.try_divide(_log_scale(value) - _log_scale(low), _log_scale(high) - _log_scale(low))
    # Intervals of one column are equal or disjoint, so a row lies in one at most. The window sees at
    # most `buckets` rows per partition.
    span = [*keys, "c", "start"]
    through = F.sum("n").over(Window.partitionBy(*span).orderBy("slot"))

    total = large.agg(F.sum("rows")).head()[0] or 0
    set_aside: DataFrame | None = None
    resolved = intervals.where("lo = hi")
    unresolved = intervals.where("lo < hi")
    columns = _open_columns(unresolved)
    while columns:
        values = cells(columns) if set_aside is None else set_aside
        place = linear if set_aside is not None else F.coalesce(logarithmic, linear)
        slot = F.least(F.floor(place * F.lit(buckets)), F.lit(buckets - 1))
        spans = unresolved.select(*keys, "c", "lo", "hi").distinct()
        histogram = (
            values.alias("r")
            .join(_hinted(spans).alias("b"), inside)
            .select(*[f"b.{k}" for k in (*keys, "c")], F.col("b.lo").alias("start"), "r.v", slot.alias("slot"))
            .groupBy(*span, "slot")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .withColumn("before", through - F.col("n"))
        )
        open_ = unresolved.select(*fixed, "below", F.col("lo").alias("start"))
        first = F.col("t.below") + F.col("h.before")
        intervals = checkpointed(
            histogram.alias("h")
            .join(_hinted(open_).alias("t"), _same("h", "t", span))
            .where((first <= F.col("t.rank")) & (F.col("t.rank") < first + F.col("h.n")))
            .select(*[f"t.{k}" for k in fixed], first.alias("below"), "h.n", "h.lo", "h.hi")
        )
        resolved = resolved.unionByName(intervals.where("lo = hi").drop("n"))
        unresolved = intervals.where("lo < hi")
        columns = _open_columns(unresolved)
        if columns and set_aside is None:
            spans = unresolved.select(*keys, "c", "lo", "hi", "n").distinct()
            if spans.agg(F.sum("n")).head()[0] <= SET_ASIDE_SHARE * total:
                set_aside = checkpointed(cells(columns).alias("r").join(_hinted(spans).alias("b"), inside, "left_semi"))

    number = {target: n for n, target in enumerate(targets)}

    def pick(name: str, target: tuple[int, int, int]) -> Column:
        return F.max(F.when(F.col("target") == number[target], F.col(name)))

    def quantile(i: int, j: int) -> Column:
        low, high = pick("lo", (i, j, 0)), pick("lo", (i, j, 1))
        return interpolated(low, high, pick("fraction", (i, j, 0)))

    found = [
        F.when(pick("lo", (i, 0, 0)).isNotNull(), F.array(*[quantile(i, j) for j in range(len(ps))])).alias(f"v{i}")
        for i, ps in enumerate(probabilities)
    ]
    return resolved.groupBy(*keys).agg(*found)
