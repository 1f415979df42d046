"""Periodic runs of words, by enumeration of maximal pairs over the tree of LCP intervals.

A run is a stretch with smallest period q, as long as ``LEAST`` words and ``REPEATS`` periods at least, that no
neighbouring word extends. Words q apart that start two equal stretches of l words, with l >= 2q, which differ in
the word to the left and in the word to the right (a maximal pair at distance q) are exactly such a run of l + q
words: nothing is extended afterwards.

The suffixes of a text are sorted by prefix doubling over all texts of a slice at once, their common prefixes come
from one scan, and the intervals of common prefixes are closed bottom-up by a stack. Intervals shorter than
``LEAST`` - ``LEAST`` / ``REPEATS`` words hold no run and are never opened; a text in which no window of that many
words occurs twice is not sorted at all. An open interval keeps its places in lists by left word, and all of them in order.
When two children meet, each list of the smaller one is taken against the places of other left words in the larger
one, no farther than half the depth. Places so near are an arithmetic progression, so the least distance, which is
the period, is always that of neighbours in order (searching every list of another word would cost their product
where a passage has many left words); multiples of it name the same stretch and give way to it.

Each text is judged by itself: no shuffle, and a text of n words takes O(n log^2 n).

Defined results: a null or empty text has no words, no run, and an empty collapsed text; repeated rows are judged
each by itself; a word that belongs to several runs is dropped if any run drops it. Words are compared by their bytes.
Columns beside the key and the text are not read.
"""

from __future__ import annotations

from array import array as packed
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import free_name, query, table
from lateralis.llm.text import Words, mix, sliced, words_of

LEAST = 24
REPEATS = 3
SPACE = r"[\x20\x09-\x0D]+"
RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _ranks(symbols: np.ndarray) -> np.ndarray:
    """The place of each suffix in the order of all suffixes; ``symbols`` of different texts differ."""
    n, step = len(symbols), 1
    distinct, rank = np.unique(symbols, return_inverse=True)
    while len(distinct) < n:
        after = np.zeros(n, np.int64)
        after[:max(n - step, 0)] = rank[step:] + 1
        distinct, rank = np.unique(rank.astype(np.int64) * (n + 1) + after, return_inverse=True)
        step *= 2
    return rank


def _common_prefixes(symbols: list[int], order: list[int], rank: list[int]) -> list[int]:
    """For each suffix in order, the words it shares with the one before; one scan of the text."""
    n, shared, lcp = len(symbols), 0, [0] * len(symbols)
    for i in range(n):
        at = rank[i]
        if not at:
            shared = 0
            continue
        j = order[at - 1]
        limit = n - max(i, j)
        while shared < limit and symbols[i + shared] == symbols[j + shared]:
            shared += 1
        lcp[at] = shared
        if shared:
            shared -= 1
    return lcp


class Interval:
    """The places of an LCP interval in order, and the same places in lists by the word to their left."""

    __slots__ = ("places", "lists")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.lists = {left: [place]}


def _insert(into: list[int], more: list[int]) -> None:
    if len(more) * 16 < len(into):
        for place in more:
            into.insert(bisect_left(into, place), place)
    else:
        into += more
        into.sort()


def _meet(one: Interval, other: Interval, depth: int, left: list[int], found: dict[tuple[int, int], int]) -> Interval:
    """Join two children of an interval of ``depth`` words; the maximal pairs between them go to ``found``."""
    if len(one.places) < len(other.places):
        one, other = other, one
    places, reach = one.places, depth // (REPEATS - 1)
    for word, listed in other.lists.items():
        if len(one.lists) == 1 and word in one.lists:
            continue  # no list of another left word
        for place in listed:
            at = bisect_left(places, place)
            for near in places[max(at - 1, 0):at + 1]:
                distance = abs(near - place)
                if distance <= reach and left[near] != word and depth + distance >= LEAST:
                    stretch = min(near, place), depth + distance
                    found[stretch] = min(distance, found.get(stretch, distance))
    _insert(places, other.places)
    for word, listed in other.lists.items():
        held = one.lists.get(word)
        if held is None:
            one.lists[word] = listed
        else:
            _insert(held, listed)
    return one


def runs_of(symbols: list[int], order: list[int], rank: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one text, by start and period, from its sorted suffixes."""
    n = len(symbols)
    shallow = LEAST - LEAST // REPEATS
    lcp = _common_prefixes(symbols, order, rank) + [0]
    left = [-1] + symbols
    found: dict[tuple[int, int], int] = {}
    open_: list[tuple[int, Interval]] = []
    child = None
    for k in range(1, n + 1):
        depth = lcp[k]
        if child is None:
            if depth < shallow:
                continue
            child = Interval(order[k - 1], left[order[k - 1]])
        while open_ and open_[-1][0] >= depth:
            above, interval = open_.pop()
            child = _meet(interval, child, above, left, found)
            if above == depth:
                break
        if depth < shallow:
            child = None
        else:
            open_.append((depth, child))
            child = Interval(order[k], left[order[k]])
    return sorted((start, length, period) for (start, length), period in found.items())


def _suspects(words: Words) -> np.ndarray:
    """Texts in which some window as long as the shallowest interval occurs twice."""
    owners, size = words.owners, LEAST - LEAST // REPEATS
    h = mix(words.codes.astype(np.uint64) + np.uint64(1))
    have = 1
    while have < size:
        step = min(have, size - have)
        h = mix(h[:len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + h[step:]) if len(h) > step else h[:0]
        have += step
    if not len(h):
        return np.zeros(0, np.int64)
    inside = owners[:len(h)] == owners[size - 1:]
    h, owners = h[inside] ^ mix(owners[:len(inside)][inside].astype(np.uint64)), owners[:len(inside)][inside]
    order = np.argsort(h)
    return np.unique(owners[order[1:]][h[order[1:]] == h[order[:-1]]])


def find_runs(words: Words) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of each text that has any, by the text's index."""
    ends, out = words.ends, {}
    texts = _suspects(words)
    if not len(texts):
        return out
    sizes = words.counts[texts]
    at = np.repeat(ends[texts] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
    owner = np.repeat(np.arange(len(texts)), sizes)
    rank = _ranks(owner * np.int64(len(words.vocabulary) + 1) + words.codes[at])
    order = np.empty(len(rank), np.int64)
    order[rank] = np.arange(len(rank))
    symbols, start = words.codes[at], 0
    for text, n in zip(texts.tolist(), sizes.tolist()):
        stop = start + n  # suffixes of a text stand together, as its symbols are its own
        found = runs_of(
            packed("q", symbols[start:stop].astype(np.int64).tobytes()).tolist(),
            (order[start:stop] - start).tolist(), (rank[start:stop] - start).tolist(),
        )
        if found:
            out[text] = found
        start = stop
    return out


def _collapsed(words: Words, runs: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """The texts' words without those that a run repeats after its first period, joined by one space."""
    begins = words.ends - words.counts
    mark = np.zeros(len(words.codes) + 1, np.int64)
    for text, found in runs.items():
        for start, length, period in found:
            mark[begins[text] + start + period] += 1
            mark[begins[text] + start + length] -= 1
    kept = np.cumsum(mark)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], words.ends])]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.vocabulary.take(pa.array(words.codes[kept])))
    return pc.binary_join(lists, " ")


def periodic_runs(documents: DataFrame, key: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """doc_id, n_words, runs and collapsed of every row."""

    def judge(batches):
        for batch in sliced(batches):
            words = words_of(batch.column("text"), lower=False)
            runs = find_runs(words)
            listed = [[{"start": s, "length": n, "period": p} for s, n, p in runs.get(k, ())] for k in range(len(batch))]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.counts), pa.array(listed, kind), _collapsed(words, runs)],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    text = F.col(text) if isinstance(text, str) else text
    return documents.select(F.col(key).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(judge, RESULT)


def with_planted_tail(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every tenth document, by the crc32 of its id, with its last words replaced by a period; others as they are."""
    h, w = free_name(documents, "id_hash"), free_name(documents, "text_words")
    g = F.floor(F.col(h) / 10)
    planted = (F.col(h) % 10 == 0) & (F.size(w) > 0)
    n = F.size(w)
    a = g % n
    p = F.floor((n - a) / (F.lit(3) + g % 8)) + 1
    words = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col(w), F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))
    )
    hashed = documents.withColumn(h, F.crc32(F.col(key).cast("string").cast("binary")))
    split = F.when(F.col(h) % 10 == 0, F.filter(F.split(F.col(text), SPACE), lambda x: x != ""))
    return hashed.withColumn(w, split).withColumn(text, F.when(planted, F.array_join(words, " ")).otherwise(F.col(text))).drop(h, w)


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_planted_tail(table(spark, folder, "documents").select("doc_id", "text")))
    weight = lambda one, other: one.length * other.period
    best = F.array_sort(
        "runs", lambda x, y: F.when(weight(x, y) > weight(y, x), -1).when(weight(x, y) < weight(y, x), 1)
        .when(x.start < y.start, -1).when(x.start > y.start, 1).otherwise(F.signum(x.period - y.period).cast("int"))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    first = F.get(best, F.lit(0))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("first"), "runs", "collapsed", listed.alias("listed")).select(
        "doc_id", "n_runs", "first.start", "first.length", "first.period",
        F.floor(1000 * F.col("first.length") / F.col("first.period")).cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
