"""Measures against plain Python, and cutoffs against sums over all documents."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lateralis.llm import quality_rules as rules
from lateralis.llm.registry import QUERIES
from tests.llm.test_texts import ROWS, words

MORE = [
    (2_000, "a b c\na b c\n a b c\n\n \t\na b c"), (2_001, "x y x y x y z"), (2_002, "#*$%&|<> é#   \x85 a\x1cb"),
    (2_003, "one\n" * 200), (2_004, "\n\n\n"), (2_005, " ".join(f"w{k}" for k in range(60)) + "\nend\nend"),
]


def measured(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    times = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if times[tuple(w[i:i + 3])] > 1 for k in range(3)}
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_measures_of_every_text(spark, documents, write):
    rows = ROWS + MORE
    labels = spark.createDataFrame([(7, 1, 0, "x"), (None, 1, 0, "x"), (8, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    got = QUERIES["op11_quality_rules"](spark, write(documents=documents(rows), labels=labels))
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(((i, *measured(t)) for i, t in rows), key=key)
    assert sorted((tuple(r[:7]) for r in got.collect()), key=key) == want
    assert got.where(F.col("kept") == F.col("base_failed")).count() == 0  # no stratum has labels enough


@pytest.mark.parametrize("k,n,p", [(0, 1, 0.5), (0, 300, 0.02), (1, 300, 0.02), (5, 1_000, 0.02), (19, 1_000, 0.02), (3, 40, 0.3)])
def test_binomial_tail_is_exact(k, n, p):
    q = Fraction(p)
    exact = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
    assert rules.binomial_tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)


def test_binomial_tail_of_many_trials():
    assert rules.binomial_tail(10, 10, 0.1) == 1 and rules.binomial_tail(500, 1_000, 0.1) == 1
    assert 0 < rules.binomial_tail(1_990_000, 100_000_000, 0.02) < 1e-12
    assert rules.binomial_tail(1_999_000, 100_000_000, 0.02) == pytest.approx(0.2376, abs=0.002)


def test_path_takes_the_best_steps_first():
    counts = {(0, 9): (0, 5), (0, 5): (1, 4), (0, 1): (100, 101), (0, 0): (9, 1), (1, 9): (0, 0), (1, 7): (2, 40), (1, 3): (0, 60), (2, 4): (30, 0)}
    path = rules.path_of(counts, 3)
    assert path == [(0, 9), (1, 7), (1, 3), (0, 5), (0, 1)]


def table_of(spark, seed, n=6_000):
    """Measured rows of known risk: good documents have symbols in one case of fifty, bad ones nearly always."""
    r, out = random.Random(seed), []
    for i in range(n):
        good = r.random() < 0.8
        stratum = r.choice(["a", "b", "c", None])
        share = r.uniform(0, 0.6) if not good else (r.uniform(0.3, 0.45) if r.random() < 0.06 else r.uniform(0, 0.2))
        out.append((i, stratum, 200, 1_000, int(1_000 * share), 10, 0, 0, i, int(good)))
        if i % 50 == 0:  # copies are one trial
            out += [(100_000 + 20 * i + k, *out[-1][1:]) for k in range(20)]
    columns = f"doc_id long, stratum string, {rules.MEASURES}, good int"
    return spark.createDataFrame(out, columns)


def walked(rows, error):
    """The cutoffs again from all rows, by plain loops."""
    distinct = {}
    for r in rows:
        step = [min(200, r.n_symbols * 200 // r.word_chars), 0, 0, min(200, r.word_chars * 10 // r.n_words)]
        distinct[r.stratum, r.text_hash] = (r.tuning, r.good, [*step, 200 - step[3]])
    found = {}
    strata = {s for (s, _), (tuning, _, _) in distinct.items() if tuning}
    for s in strata:
        counts = defaultdict(lambda: [0, 0])
        held = []
        for (of, _), (tuning, good, steps) in distinct.items():
            if of != s:
                continue
            if tuning:
                for rule, step in enumerate(steps):
                    counts[rule, step][1 - good] += 1
            elif good:
                held.append(steps)
        path, cleared = rules.path_of({k: tuple(v) for k, v in counts.items()}, 5), 0
        while cleared < len(path):
            lost = sum(any(steps[rule] >= cutoff for rule, cutoff in path[:cleared + 1]) for steps in held)
            n, p = len(held), rules.MAX_FALSE
            tail = sum(math.exp(
                math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)
            ) for i in range(lost + 1))
            if tail > error / len(strata):
                break
            cleared += 1
        found[s] = (path, cleared)
    return found


def test_cutoffs_hold_their_bound(spark):
    rows = table_of(spark, 1)
    labels = rows.select("doc_id", F.col("good").alias("quality"), F.lit("x").alias("stratum"))
    cutoffs = rules.fit_cutoffs(rows.drop("good"), labels).collect()
    labelled = rows.withColumn("tuning", F.pmod(F.xxhash64("text_hash"), F.lit(rules.TUNING_SHARE)) == 0).collect()
    want = walked(labelled, rules.ERROR)
    assert {r.stratum: ([tuple(p) for p in r.path], r.cleared) for r in cutoffs} == want
    assert any(r.cleared for r in cutoffs)
    fresh = table_of(spark, 2, 40_000)
    judged = rules.judge(fresh, spark.createDataFrame(cutoffs, "stratum string, path array<struct<rule:int,cutoff:int>>, levels array<array<int>>, cleared int, n_good long, n_false long, p_value double"))
    assert judged.columns == [*fresh.columns, "base_failed", "kept", "rules"]
    for r in judged.groupBy("stratum", "good").agg(F.avg(F.when(F.col("kept"), 0.0).otherwise(1.0)).alias("lost")).collect():
        assert r.lost <= rules.MAX_FALSE if r.good else r.lost > 0.2
    assert judged.where((F.size("rules") > 0) == F.col("kept")).count() == 0


def test_no_labels_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, lang string")
    found = rules.measure(documents(ROWS + MORE))
    cutoffs = rules.fit_cutoffs(found, none)
    assert cutoffs.count() == 0
    assert rules.judge(found, cutoffs).where(F.col("kept") == F.col("base_failed")).count() == 0
    empty = rules.measure(documents([]))
    assert rules.judge(empty, rules.fit_cutoffs(empty, none)).count() == 0


def test_windows_across_texts_do_not_count():
    text = pa.array(["a b", "c d", "a b", "c d", "a b c", "a b c", "a b c a b c"])
    assert rules._repeated_words(rules.words_of(text, lower=False)).tolist() == [0, 0, 0, 0, 0, 0, 6]
    assert np.array_equal(rules._lines(text)[0], np.ones(7))
