"""Quality rules whose cutoffs are chosen on labelled documents, with a bound on the good ones they reject.

Five measures of a text (share of symbols, of repeated lines, of words in repeated windows, and words too long or too
short on average) are put on grids of ``BINS`` steps. Documents with a label fall, by a hash of their text, into a tuning
third and a holdout. In each stratum the tuning third orders steps of the cutoffs by bad documents caught for each good
one lost: a path of rules that only get stricter, as long as they catch more bad than good. On the holdout the path is walked from its mild end. At each step the
exact binomial tail tests whether more than ``max_false`` of the good documents would be rejected; the walk stops at
the first step that the test does not clear, and the last one cleared holds. A fixed order needs no correction inside a
stratum; the strata share ``error`` evenly (Bonferroni), so with probability 1 - ``error`` no stratum loses more than
``max_false`` of its good documents to the rules. What the base rules reject is decided before and takes no part.

Copies of one text are one trial, good if any copy is labelled good; else they would count as independent. Where too
few labelled good documents are left to clear any step, nothing is rejected: the bound comes first.

Measuring is one pass without a shuffle. Labels meet the measures on the key; strata, rules and steps are small tables
from combined counts, joined back by stratum.

Defined results: a null or empty text has zero measures and fails the base rules; a null stratum is a stratum of its
own; a stratum without labels rejects by base rules alone; documents whose labels disagree count as good; labels
without a document, null labels and null keys take no part; repeated rows are judged alike.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import query, table
from lateralis.llm.text import Words, sliced, words_of
from lateralis.session import broadcast_if_small, scratch_path

#: Fixed sets of the base measures.
SYMBOLS = b"#*$%&|<>"
FEWEST_WORDS, MOST_REPEATED_PERCENT, REPEATED_WINDOW = 50, 50, 3

BINS = 200
MAX_FALSE, ERROR = 0.02, 0.05
TUNING_SHARE = 3  # one third
LEAST_PRECISION = 0.5
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, text_hash long"


class Rule(NamedTuple):
    """A measure on a grid; a document is rejected where its step reaches the cutoff."""

    name: str
    top: str  # measure over ...
    bottom: str
    scale: int  # steps for each whole of top / bottom
    turned: bool = False  # small values are the bad ones


RULES = [
    Rule("symbols", "n_symbols", "word_chars", BINS),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", BINS),
    Rule("repeated_words", "n_repeat_words", "n_words", BINS),
    Rule("long_words", "word_chars", "n_words", 10),
    Rule("short_words", "word_chars", "n_words", 10, turned=True),
]


def step_of(rule: Rule) -> Column:
    """The step of a document on the grid of a rule, 0 to ``BINS``, by whole numbers."""
    top, bottom = F.col(rule.top), F.greatest(F.col(rule.bottom), F.lit(1))
    step = F.least(F.floor(top * rule.scale / bottom), F.lit(BINS)).cast("int")
    return F.lit(BINS) - step if rule.turned else step


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])


def _repeated_words(words: Words) -> np.ndarray:
    """For each text its words in windows of three words that occur twice or more in it."""
    n, owners = len(words.codes), words.owners
    if n < REPEATED_WINDOW:
        return np.zeros(len(words.counts), np.int64)
    codes = words.codes.astype(np.int64)
    window = owners[:n - 2] * np.int64(len(words.vocabulary)) + codes[:n - 2]
    for k in range(1, REPEATED_WINDOW):  # whole numbers for windows of ever more words, in order of first sight by value
        distinct, window = np.unique(window, return_inverse=True)
        window = window * np.int64(len(words.vocabulary)) + codes[k:n - 2 + k]
    distinct, window, times = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero((times[window] > 1) & (owners[:n - 2] == owners[2:]))
    mark = np.zeros(n + 1, np.int64)
    mark[starts] += 1
    mark[starts + REPEATED_WINDOW] -= 1
    return _sums(np.cumsum(mark)[:n] > 0, words.ends)


def _lines(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them equal to an earlier line) of each text."""
    lists = pc.split_pattern(text, "\n")
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    worded = pc.not_equal(pc.ascii_trim_whitespace(encoded.dictionary), "").to_numpy(zero_copy_only=False)
    codes, owners = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(text)), counts)
    kept = worded[codes] if len(codes) else np.zeros(0, bool)
    codes, owners = codes[kept], owners[kept]
    lines = np.bincount(owners, minlength=len(text))
    first = np.unique(owners * np.int64(max(len(worded), 1)) + codes) // max(len(worded), 1)
    return lines, lines - np.bincount(first, minlength=len(text))


def _symbols(text: pa.Array) -> np.ndarray:
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    mark = np.zeros(256, np.int8)
    mark[np.frombuffer(SYMBOLS, np.uint8)] = 1
    return _sums(mark[data].astype(np.int64), offsets[1:] - offsets[0])


def measure(documents: DataFrame, key: str = "doc_id", text: str = "text", stratum: str | Column = "lang") -> DataFrame:
    """doc_id, stratum and the measures of every row."""

    def run(batches):
        for batch in sliced(batches):
            text = pc.fill_null(batch.column("text"), "")
            words = words_of(text, lower=False)
            sizes = pc.utf8_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
            lines, again = _lines(text)
            digest = [xxhash.xxh3_64_intdigest(t.as_buffer()) for t in text]
            columns = [words.counts, _sums(sizes[words.codes], words.ends), _symbols(text), lines, again, _repeated_words(words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("stratum"), *(pa.array(c, pa.int64()) for c in columns),
                    pa.array(np.array(digest, np.uint64).view(np.int64)),
                ],
                ["doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "text_hash"],
            )

    stratum = F.col(stratum) if isinstance(stratum, str) else stratum
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), stratum.cast("string").alias("stratum"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, stratum string, {MEASURES}")


def base_failed() -> Column:
    """Whether a measured row fails the fixed rules."""
    few = F.col("n_words") < FEWEST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n trials; from its largest term down, so that the sum ends after some root of n terms."""
    if k >= n:
        return 1.0
    if k >= n * p:  # at least about one half, which no test clears
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total, i = 0.0, k
    while i >= 0 and term > total * 1e-17:
        total += term
        term *= i * (1 - p) / ((n - i + 1) * p)
        i -= 1
    return total


def path_of(counts: dict[tuple[int, int], tuple[int, int]], rules: int) -> list[tuple[int, int]]:
    """The path of (rule, cutoff) from mild to strict, from (good, bad) documents at each (rule, step).

    For each rule the steps from the worst down are joined to stretches of falling worth, bad caught for a good one
    lost; the stretches of all rules are then taken by worth, each in its single steps. Steps that catch nothing are
    not taken by themselves, nor stretches of which less than ``LEAST_PRECISION`` is bad.
    """
    stretches = []
    for rule in range(rules):
        held: list[tuple[list[int], int, int]] = []  # (cutoffs that catch, good, bad), worst first
        for step in sorted((s for r, s in counts if r == rule), reverse=True):
            good, bad = counts[rule, step]
            held.append(([step] if bad else [], good, bad))
            while len(held) > 1 and held[-1][2] * held[-2][1] >= held[-2][2] * held[-1][1]:
                milder, (steps, good, bad) = held[-2], held[-1]
                held[-2:] = [(milder[0] + steps, milder[1] + good, milder[2] + bad)]
        stretches += [(good / bad, rule, steps) for steps, good, bad in held if bad and bad >= LEAST_PRECISION * (good + bad)]
    return [(rule, step) for _, rule, steps in sorted(stretches) for step in steps]


def _labelled(measured: DataFrame, labels: DataFrame, key: str, good: str) -> DataFrame:
    """One row for each labelled text and stratum: its steps, whether it is good, and whether it is for tuning."""
    known = labels.where(F.col(key).isNotNull() & F.col(good).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col(good).cast("int")).alias("good"))
    rows = measured.where(~base_failed()).join(known, "doc_id")
    steps = F.array(*(step_of(rule) for rule in RULES))
    distinct = rows.groupBy("stratum", "text_hash").agg(F.max("good").alias("good"), F.max(steps).alias("steps"))
    return distinct.withColumn("tuning", F.pmod(F.xxhash64("text_hash"), F.lit(TUNING_SHARE)) == 0)


_PATHS = "stratum string, path array<struct<rule:int,cutoff:int>>, levels array<array<int>>"


def _paths(tuning: DataFrame) -> DataFrame:
    """Per stratum the path, and for each rule and step the level from which it is rejected (none: the path's length)."""
    counts = (
        tuning.select("stratum", "good", F.posexplode("steps").alias("rule", "step")).groupBy("stratum", "rule", "step")
        .agg(F.sum("good").alias("n_good"), F.sum(1 - F.col("good")).alias("n_bad"))
    )

    def build(group):  # at most rules x (BINS + 1) rows
        import pandas as pd

        path = path_of({(r.rule, r.step): (r.n_good, r.n_bad) for r in group.itertuples()}, len(RULES))
        levels = [[len(path)] * (BINS + 1) for _ in RULES]
        for level, (rule, cutoff) in reversed(list(enumerate(path))):
            for step in range(cutoff, BINS + 1):
                levels[rule][step] = level
        return pd.DataFrame({
            "stratum": [group["stratum"].iloc[0]], "path": [[{"rule": r, "cutoff": c} for r, c in path]], "levels": [levels],
        })

    return counts.groupBy("stratum").applyInPandas(build, _PATHS)


def _level() -> Column:
    """The first level at which a row with ``steps`` and ``levels`` is rejected."""
    return F.array_min(F.transform("steps", lambda step, rule: F.get(F.get("levels", rule), step)))


_CUTOFFS = "stratum string, cleared int, n_good long, n_false long, p_value double"


def _walk(holdout: DataFrame, max_false: float, error: float) -> DataFrame:
    """Per stratum the number of levels that the exact test clears, from rows (stratum, level, good, length)."""
    at = holdout.groupBy("stratum", "length", "level").agg(F.sum("good").alias("good"))

    def walk(group):  # at most rules x (BINS + 1) + 1 rows
        import pandas as pd

        length, n = int(group["length"].iloc[0]), int(group["good"].sum())
        lost = np.bincount(group["level"], group["good"], minlength=length + 1)[:length].cumsum().astype(np.int64).tolist()
        cleared, p_value = 0, 1.0
        while cleared < length:
            tail = binomial_tail(lost[cleared], n, max_false)
            if tail > error:
                break
            cleared, p_value = cleared + 1, tail
        return pd.DataFrame({
            "stratum": [group["stratum"].iloc[0]], "cleared": [cleared], "n_good": [n],
            "n_false": [lost[cleared - 1] if cleared else 0], "p_value": [p_value],
        })

    return at.groupBy("stratum").applyInPandas(walk, _CUTOFFS)


def fit_cutoffs(
    measured: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE, error: float = ERROR, key: str = "doc_id", good: str = "quality"
) -> DataFrame:
    """Per stratum: the path, the levels, how many of them are cleared, and the figures of the last test.

    ``measured`` should be a written table; it is read for the labelled rows only.
    """
    spark = measured.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    labelled = written(_labelled(measured, labels, key, good), "labelled")
    paths = written(_paths(labelled.where("tuning")), "paths")
    strata = max(paths.count(), 1)
    holdout = _by_stratum(labelled.where(~F.col("tuning")), paths.select("stratum", "levels", F.size("path").alias("length")))
    tested = _walk(holdout.select("stratum", "length", "good", _level().alias("level")), max_false, error / strata)
    found = paths.alias("p").join(tested.alias("t"), F.col("p.stratum").eqNullSafe(F.col("t.stratum")), "left")
    return written(found.select("p.*", F.coalesce("cleared", F.lit(0)).alias("cleared"), "n_good", "n_false", "p_value"), "cutoffs")


def _by_stratum(rows: DataFrame, strata: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their stratum; strata are sent to all tasks where their number is small."""
    found = broadcast_if_small(strata, 1_000).withColumnRenamed("stratum", "of_stratum")
    return rows.join(found, F.col("stratum").eqNullSafe(F.col("of_stratum")), how).drop("of_stratum")


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with base_failed, kept, and the rules whose cutoff in force a row reaches."""
    in_force = F.slice("path", 1, F.col("cleared"))
    names = F.array(*(F.lit(rule.name) for rule in RULES))
    reached = F.array_sort(F.array_distinct(F.transform(
        F.filter(in_force, lambda p: F.get(F.col("steps"), p.rule) >= p.cutoff), lambda p: F.get(names, p.rule)
    )))
    judged = _by_stratum(
        measured.withColumn("steps", F.array(*(step_of(rule) for rule in RULES))), cutoffs.select("stratum", "path", "levels", "cleared"), "left"
    )
    rejected = F.coalesce(_level() < F.col("cleared"), F.lit(False))
    return judged.select(
        *measured.columns, base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept"),
        F.coalesce(reached, F.array().cast("array<string>")).alias("rules"),
    )


@query()
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "measured")
    measure(table(spark, folder, "documents")).write.parquet(path)
    measured = spark.read.parquet(path)
    judged = judge(measured, fit_cutoffs(measured, table(spark, folder, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "rules"
    )
