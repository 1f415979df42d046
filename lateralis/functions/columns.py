"""Scalar expressions on wells: midpoints, unit costs, category keys, cost shares, step bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The share of the total well cost that each part takes.
DRILLING_SHARE = 0.325
FACILITIES_SHARE = 0.05
COMPLETIONS_SHARE = 0.625

OTHER = "miscellaneous"
MILLION = 1e6


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds (``cost/ft_Lateral``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ratio(a: Column, b: Column) -> Column:
    """Division that gives NULL, never infinity or an error, for a zero denominator."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def midpoint(a: Column, b: Column) -> Column:
    """Mean of those of the two values that are present."""
    zero = F.lit(0.0)
    return ratio(F.coalesce(a, zero) + F.coalesce(b, zero), a.isNotNull().cast("int") + b.isNotNull().cast("int"))


def unit_cost(total_millions: Column, length: Column) -> Column:
    return ratio(F.lit(MILLION) * total_millions, length)


def composite_key(*parts: Column) -> Column:
    """Parts joined by ``_``; NULL as soon as one part is NULL (``concat_ws`` would skip it)."""
    present = reduce(lambda x, y: x & y, [p.isNotNull() for p in parts])
    return F.when(present, F.concat_ws("_", *parts))


def key_prefix(key: Column) -> Column:
    return F.substring_index(key, "_", 1)


def key_suffix(key: Column) -> Column:
    return F.substring_index(key, "_", -1)


def cost_anomaly(total: Column, shares: Mapping[str, float]) -> Column:
    """True where a cost part is not its usual share of the total at 3 decimals.

    A ratio that cannot be formed counts as anomalous, hence the null-safe comparison.
    """
    return reduce(or_, [~F.bround(ratio(col(c), total), 3).eqNullSafe(F.lit(s)) for c, s in shares.items()])


def total_from_unit_cost(unit: Column, length: Column) -> Column:
    return F.round(unit * length / F.lit(MILLION), 2)


def cost_breakdown(
    total: Column,
    drilling: float = DRILLING_SHARE,
    facilities: float = FACILITIES_SHARE,
    completions: float = COMPLETIONS_SHARE,
) -> dict[str, Column]:
    return {
        "TotalCost_USDMM": F.round(total, 2),
        "Drilling_USDMM": total * F.lit(drilling),
        "Facilities_USDMM": total * F.lit(facilities),
        "Completions_USDMM": total * F.lit(completions),
    }


def linear_score(
    intercept: float,
    numeric: Sequence[tuple[Column, float, float, float]],
    dummies: Sequence[tuple[Column, str, float]] = (),
) -> Column:
    """``intercept + sum(coef * (x - center) / scale) + sum(coef * (category == value))``.

    ``numeric`` holds (x, center, scale, coef) and ``dummies`` (category, value, coef).
    """
    terms = [F.lit(float(w)) * (x - F.lit(float(c))) / F.lit(float(s)) for x, c, s, w in numeric]
    terms += [F.lit(float(w)) * (x == F.lit(v)).cast("double") for x, v, w in dummies]
    return reduce(add, terms, F.lit(float(intercept)))


def bin_lower(x: Column, step: Column) -> Column:
    """Lower edge of the right-closed bin ``(lo, lo + step]`` that holds ``x`` on the grid of ``step``."""
    return step * (F.ceil(x / step) - 1)


def bin_floor(x: Column, step: Column) -> Column:
    """The grid edge at or below ``x``: the first edge of a binning whose minimum is ``x``."""
    return step * F.floor(x / step)


def bin_label(lower: Column, step: Column) -> Column:
    return F.concat(lower.cast("long").cast("string"), F.lit(" - "), (lower + step).cast("long").cast("string"))


def hash_bucket(key: Column, seed: int, buckets: int = 10_000) -> Column:
    """A stable bucket of the row key: it depends on neither the partitioning nor the row order."""
    digest = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))
