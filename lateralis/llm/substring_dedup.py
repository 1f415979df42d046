"""Removal of repeated passages: windows of a fixed number of words, found by level-wise doubling.

Lengths double up to the window (9, 18, 35 words for 35). At the shortest length the candidates are the
positions of least hash among the starts of a full window; equal windows choose equal positions, so every
repeated window holds a repeated candidate, and one in a dozen positions is enough. Candidates that repeat
survive and are extended to both sides to twice the length; the survivors of that select the full windows to
count. Each level is one pass that sends hashes only, and tells the next level which ones repeat by a Bloom
filter of bounded size: a false positive costs a candidate, never a result.

At full length two filters are built, of windows that repeat and of windows that do not. A window in the first
alone repeats, in the second alone does not; documents with a window in both are settled by a join of just those
hashes with the exact list. So no group of copies is collected, and texts are shuffled for unsettled
documents only.

Defined results: a null or empty text has no words and keeps the empty string; a text shorter than the window
loses nothing; repeated rows repeat each other. Windows do not cross documents. Windows are compared by 64-bit
hashes of their word sequences.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm import segments as seg
from lateralis.llm.registry import query, table
from lateralis.llm.text import Words, hashes, joined_hash, sliced, words_of
from lateralis.session import scratch_path

WINDOW = 35
SHORTEST = 12
CANDIDATE_BITS, CANDIDATE_PROBES = 16, 6
WINDOW_BITS, WINDOW_PROBES = 24, 10


def lengths_of(window: int) -> list[int]:
    """The lengths of the levels, each at most twice the one before."""
    out = [window]
    while out[0] > SHORTEST:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _joined(h: np.ndarray, length: int, to: int) -> np.ndarray:
    """Hashes of windows of ``to`` words from those of ``length`` words, half as long or more."""
    size = max(len(h) - (to - length), 0)
    return joined_hash(h[:size], h[to - length:to - length + size])


def _first_hashes(word: np.ndarray, length: int) -> np.ndarray:
    h, have = word, 1
    while have * 2 <= length:
        h, have = _joined(h, have, 2 * have), 2 * have
    return h if have == length else _joined(h, have, length)


def _over(values: np.ndarray, span: int, pick) -> np.ndarray:
    """``pick`` of each run of ``span`` values."""
    have = 1
    while have * 2 <= span:
        values, have = pick(values[:len(values) - have], values[have:]), 2 * have
    more = span - have
    return pick(values[:len(values) - more], values[more:]) if more else values


def _inside(owners: np.ndarray, length: int) -> np.ndarray:
    """Whether the window that starts at each position lies in one text."""
    size = max(len(owners) - length + 1, 0)
    return owners[:size] == owners[length - 1:length - 1 + size]


class Candidates(NamedTuple):
    starts: np.ndarray
    hashes: np.ndarray


def candidates(words: Words, window: int, filters: list[seg.Filter]) -> Candidates:
    """The candidates of level ``len(filters)``; ``filters`` hold what repeats at the levels before."""
    lengths = lengths_of(window)
    word, owners = hashes(words.vocabulary)[words.codes], words.owners
    none = Candidates(np.zeros(0, np.int64), np.zeros(0, np.uint64))
    if len(word) < window:
        return none
    h = _first_hashes(word, lengths[0])
    span = window - lengths[0] + 1
    least = np.where(_inside(owners, window), _over(h, span, np.minimum), np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    starts = np.flatnonzero((_over(padded, span, np.maximum) == h) & (h > 0))
    for level, held in enumerate(filters):
        starts = starts[held.contains(h[starts])]
        length, to = lengths[level], lengths[level + 1]
        h = _joined(h, length, to)
        mark = np.zeros(len(word) + 1, np.int64)
        if level + 2 < len(lengths):
            mark[starts] = 1
            mark[np.maximum(starts - (to - length), 0)] = 1
            chosen = mark[:len(h)] > 0
        else:  # every full window around a survivor
            np.add.at(mark, np.maximum(starts - (to - length), 0), 1)
            np.add.at(mark, starts + 1, -1)
            chosen = np.cumsum(mark)[:len(h)] > 0
        starts = np.flatnonzero(chosen & _inside(owners, to))
    return Candidates(starts, h[starts])


def _count(documents: DataFrame, window: int, filters, reduce, schema: str) -> DataFrame:
    bits = seg.segment_bits(documents.sparkSession)

    def emit(batches):
        held = [f.value for f in filters]
        for batch in sliced(batches):
            found = candidates(words_of(batch.column("text"), lower=False), window, held)
            distinct, n = seg.counted(found.hashes)
            out = [(s, h.tobytes(), c.tobytes()) for s, h, c in seg.split(distinct, bits, np.minimum(n, 2).astype(np.uint8))]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], ["segment", "hashes", "counts"]
            )

    sent = documents.select("text").mapInArrow(emit, "segment int, hashes binary, counts binary")
    return seg.per_segment(sent, reduce, schema)


def _repeats(cells) -> tuple[np.ndarray, np.ndarray]:
    h, c = seg.counted(seg.numbers(cells["hashes"]), seg.numbers(cells["counts"], np.uint8))
    return h[c > 1], h[c == 1]


def _level(documents: DataFrame, window: int, filters, most_bytes: int):
    """Filter of the candidates that repeat at an inner level."""
    bits = seg.segment_bits(documents.sparkSession)

    def reduce(segment, cells):
        again, _ = _repeats(cells)
        yield segment, seg.filter_bits(again, bits, CANDIDATE_BITS, CANDIDATE_PROBES, most_bytes)

    parts = _count(documents, window, filters, reduce, "segment int, bits binary")
    return documents.sparkSession.sparkContext.broadcast(seg.collect_filter(parts, bits, CANDIDATE_PROBES))


def _last_level(documents: DataFrame, window: int, filters, most_bytes: int) -> DataFrame:
    """Per segment: the exact hashes of repeated windows, and filters of repeated and of single ones."""
    bits = seg.segment_bits(documents.sparkSession)

    def reduce(segment, cells):
        again, once = _repeats(cells)
        yield (
            segment, again.tobytes(), seg.filter_bits(again, bits, WINDOW_BITS, WINDOW_PROBES, most_bytes),
            seg.filter_bits(once, bits, WINDOW_BITS, WINDOW_PROBES, most_bytes),
        )

    return _count(documents, window, filters, reduce, "segment int, hashes binary, again binary, once binary")


def _results(words: Words, starts: np.ndarray, window: int) -> tuple[list[int], list[int], list[str]]:
    """(words, removed words, digest of the kept ones) of each text; windows at ``starts`` go."""
    total = len(words.codes)
    mark = np.zeros(total + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + window, -1)
    kept = np.cumsum(mark)[:total] == 0
    vocabulary = words.vocabulary.cast(pa.binary()).to_pylist()
    ends = words.ends
    n_kept = np.diff(np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])])
    rest = [vocabulary[c] for c in words.codes[kept].tolist()]
    digests, at = [], 0
    for n in n_kept.tolist():
        digests.append(hashlib.sha256(b" ".join(rest[at:at + n])).hexdigest())
        at += n
    return words.counts.tolist(), (words.counts - n_kept).tolist(), digests


_PARTS = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("text", pa.string()), ("unsettled", pa.list_(pa.int64())),
])
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(documents: DataFrame, window: int = WINDOW, most_bytes: int = seg.MOST_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    spark = documents.sparkSession
    context, bits = spark.sparkContext, seg.segment_bits(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    filters = []
    for _ in lengths_of(window)[1:]:
        filters.append(_level(rows, window, list(filters), most_bytes))
    path = scratch_path(spark, "windows")
    _last_level(rows, window, filters, most_bytes).write.parquet(path)
    exact = spark.read.parquet(path)
    again = context.broadcast(seg.collect_filter(exact.select("segment", F.col("again").alias("bits")), bits, WINDOW_PROBES))
    once = context.broadcast(seg.collect_filter(exact.select("segment", F.col("once").alias("bits")), bits, WINDOW_PROBES))

    def judge(words):
        found = candidates(words, window, [f.value for f in filters])
        repeats = again.value.contains(found.hashes)
        found = Candidates(found.starts[repeats], found.hashes[repeats])
        return found, once.value.contains(found.hashes)

    def first(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in sliced(batches):
            words = words_of(batch.column("text"), lower=False)
            found, unsure = judge(words)
            n, removed, digests = _results(words, found.starts[~unsure], window)
            text, unsettled = [None] * len(batch), [None] * len(batch)
            owners = words.owners[found.starts[unsure]]
            for k in np.unique(owners).tolist():
                text[k] = batch.column("text")[k].as_py()
                unsettled[k] = np.unique(found.hashes[unsure][owners == k]).view(np.int64)
            columns = [np.arange(row, row + len(batch)), batch.column("doc_id"), n, removed, digests, text, unsettled]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS
            )
            row += len(batch)

    stored = scratch_path(spark, "judged")
    rows.mapInArrow(
        first, "row long, doc_id long, n_words long, n_removed long, kept_sha256 string, text string, unsettled array<long>"
    ).write.parquet(stored)
    parts = spark.read.parquet(stored)
    open_rows = parts.where(F.col("unsettled").isNotNull())
    asked = open_rows.select("row", F.explode("unsettled").alias("hash"))
    confirmed = _confirm(asked, exact, bits).groupBy("row").agg(F.collect_list("hash").alias("confirmed"))

    def second(batches):
        for batch in batches:
            for k in range(len(batch)):
                words = words_of(batch.column("text").slice(k, 1), lower=False)
                found, unsure = judge(words)
                sure = np.array(batch.column("confirmed")[k].as_py() or [], np.int64).view(np.uint64)
                n, removed, digests = _results(words, found.starts[~unsure | np.isin(found.hashes, sure)], window)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(k, 1), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    settled = parts.where(F.col("unsettled").isNull()).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return settled.unionByName(
        open_rows.join(confirmed, "row", "left").select("doc_id", "text", "confirmed").mapInArrow(second, _RESULT)
    )


def _confirm(asked: DataFrame, exact: DataFrame, bits: int) -> DataFrame:
    """Of the rows (row, hash) those whose hash is among the exact repeated ones."""

    def emit(batches):
        for batch in batches:
            h = batch.column("hash").to_numpy().view(np.uint64)
            out = [(s, x.tobytes(), r.tobytes()) for s, x, r in seg.split(h, bits, batch.column("row").to_numpy())]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], ["segment", "hashes", "rows"]
            )

    def reduce(segment, cells):
        known = seg.numbers([h for h, r in zip(cells["hashes"], cells["rows"]) if r is None])
        here = [k for k, r in enumerate(cells["rows"]) if r is not None]
        h, rows = seg.numbers([cells["hashes"][k] for k in here]), seg.numbers([cells["rows"][k] for k in here], np.int64)
        found = np.isin(h, known)
        yield from zip(rows[found].tolist(), h[found].view(np.int64).tolist())

    sent = asked.mapInArrow(emit, "segment int, hashes binary, rows binary")
    stored = exact.select("segment", "hashes", F.lit(None).cast("binary").alias("rows"))
    return seg.per_segment(sent.unionByName(stored), reduce, "row long, hash long")


@query()
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))
