"""Exact quantiles by sketched brackets, by narrowing and by sorting: the same bits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lateralis.operators import quantiles as Q

WANTED = {"x": [0.0, 0.001, 0.25, 0.5, 0.95, 1.0], "z": [0.5], "none": [0.1]}


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(11)
    out = []
    for k in range(60_000):
        x = r.choice([1.0, 2.0, 2.0, r.lognormvariate(3, 4), -r.random(), 5e-324, 1e308])
        out.append(("hot" if k % 3 else ("cold" if k % 2 else None), x if k % 97 else None, float("nan") if k % 5 == 0 else float(k % 7), None))
    out += [("tiny", 3.0, 1.0, None), ("tiny", 5.0, None, None), ("inf", float("inf"), float("-inf"), None)] + [("empty", None, None, None)] * 4
    return spark.createDataFrame(out, "g string, x double, z double, none double").repartition(6).cache()


def bits(df):
    def cell(v):
        return None if v is None else tuple(np.float64(x).tobytes() for x in v)

    return {r[0] if "g" in df.columns else 0: tuple(cell(r[c]) for c in WANTED) for r in df.collect()}


@pytest.mark.parametrize("by", [["g"], []])
def test_three_ways_agree(rows, by):
    ways = [
        bits(Q.group_quantiles(rows, WANTED, by, **options))
        for options in ({"builtin_rows": 10**9}, {"builtin_rows": 1_000}, {"builtin_rows": 3}, {"builtin_rows": 1_000, "bracketed_rows": 0, "buckets": 64})
    ]
    for way in ways[1:]:
        assert way == ways[0]
    assert len(ways[0]) == (6 if by else 1)
    if by:
        x = sorted(r.x for r in rows.where("g = 'hot' AND x IS NOT NULL").collect())
        assert ways[1]["hot"][0][3] == np.float64((x[len(x) // 2 - 1] + x[len(x) // 2]) / 2 if len(x) % 2 == 0 else x[len(x) // 2]).tobytes()


def test_a_missed_bracket_goes_to_the_narrowing(rows, monkeypatch):
    want = bits(Q.group_quantiles(rows, WANTED, ["g"], builtin_rows=10**9))
    monkeypatch.setattr(Q, "SKETCH_SIZE", 8)
    monkeypatch.setattr(Q, "MARGIN", 0.0)
    seen, narrowed = [], Q._narrowed
    monkeypatch.setattr(Q, "_narrowed", lambda *a: seen.append(1) or narrowed(*a))
    assert bits(Q.group_quantiles(rows, WANTED, ["g"], builtin_rows=1_000)) == want
    assert seen


def test_no_group_is_collected(rows):
    found = Q.group_quantiles(rows, {"x": [0.5]}, ["g"], builtin_rows=1_000)
    plan = found._jdf.queryExecution().toString()
    assert "kll_sketch" not in plan  # settled before: what is left joins a few rows a group
    assert found.where(F.col("x").isNotNull()).count() == 5
