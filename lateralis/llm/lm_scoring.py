"""Language-model scoring with a log-frequency Bloom filter.

Counting is one pass over the training texts: equal n-grams of a slice are added up, n-grams meet by hash
segment, and each segment writes (a) its exact token counts and (b) its part of a Bloom filter. For an n-gram
with count c the filter holds the n-gram at every quantisation level up to that of c; a level is read back by
probing level after level until one is missing. The filter takes ``BITS_PER_ENTRY`` for each entry at any size,
so the rate of false positives does not depend on the input. Up to ``MOST_BYTES`` it is broadcast. A larger one
stays in its segments: the distinct n-grams of each slice of texts are sent to the segment's part of the filter,
and their levels and exact counts come back to the slice. Both ways read the same filter and give the same scores.

Model: outcomes are the V training tokens and one class of unknown tokens, as for the add-one base.
P(w) = (1 - u) c'(w) / Z with c' the quantised count, Z the sum of c' over all tokens and u = max(singletons, 1) / (N + 1)
for the unknown class; P(w | v) = (1 - a) P(w) + a min(1, c'(v w) / c'(v)) where v is known, P(w) elsewhere. A
start mark precedes the first word; the end is a token.

The base needs exact counts. Beside a broadcast filter, tokens with count >= N / HEAD are at most HEAD and are broadcast; all other
occurrences meet the written counts by hash segment.

Defined results: a null text is empty (its end is its only token); without training rows every token is
unknown, u is 1 and both scores are 0. Rows repeat in the counts and in the result as often as in the table. A null id is never held out.
Tokens are identified by 64-bit hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm import segments as seg
from lateralis.llm.registry import fold, query, table
from lateralis.llm.text import Words, hashes, joined_hash, mix, sliced, words_of
from lateralis.session import scratch_path

START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
HEAD = 1 << 20
BITS_PER_ENTRY = 8
PROBES = 4
WEIGHT = 0.25
MOST_BYTES = seg.MOST_BYTES  # a larger filter is not broadcast, but asked where it lies
#: Least counts of the quantisation levels 1, 2, ...: powers of the square root of two, rounded up.
LEVELS = np.unique(np.ceil(np.sqrt(2.0) ** np.arange(0, 100) - 1e-9)).astype(np.int64)
#: What a level counts as: the middle of its range, on a logarithmic scale.
VALUES = np.concatenate([[0.0], np.where(np.diff(LEVELS, append=2 * LEVELS[-1]) == 1, LEVELS, np.sqrt(LEVELS * (np.append(LEVELS[1:], 2 * LEVELS[-1]) - 1.0)))])


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, "right")


def entries(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter entries of n-grams: one per level up to that of the count."""
    levels = level_of(counts)
    gram = np.repeat(grams, levels)
    level = np.arange(len(gram)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    return mix(gram + level.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def levels_in(held: seg.Filter, grams: np.ndarray) -> np.ndarray:
    """The level of each n-gram, by probing from level 1 until a miss."""
    out = np.zeros(len(grams), np.int64)
    live, level = np.arange(len(grams)), 1
    while len(live) and level <= len(LEVELS):
        entry = mix(grams[live] + np.uint64(level * 0xA0761D6478BD642F % 2**64))
        live = live[held.contains(entry, routed=grams[live])]
        out[live] = level
        level += 1
    return out


class Model(NamedTuple):
    filter: seg.Filter | None  # None: not broadcast
    tokens: int
    distinct: int
    unknown: float
    norm: float
    head: np.ndarray
    head_counts: np.ndarray
    weight: float

    def levels(self, grams: np.ndarray) -> np.ndarray:
        return levels_in(self.filter, grams)


class Answers(NamedTuple):
    """What a slice of texts was told of its n-grams."""

    grams: np.ndarray  # sorted
    found: np.ndarray  # the level of each
    unknown: float
    norm: float
    weight: float

    def levels(self, grams: np.ndarray) -> np.ndarray:
        return self.found[np.searchsorted(self.grams, grams)].astype(np.int64)


def _stream(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts with their end, the owner of each, and the hash of the token before."""
    word = hashes(words.vocabulary)[words.codes]
    n = words.counts + 1
    ends = np.cumsum(n)
    stream = np.full(int(ends[-1]) if len(ends) else 0, END)
    keep = np.ones(len(stream), bool)
    keep[ends - 1] = False
    stream[keep] = word
    return stream, np.repeat(np.arange(len(n)), n), _before(stream, n)


def _before(stream: np.ndarray, n: np.ndarray) -> np.ndarray:
    before = np.concatenate([[START], stream[:-1]]).astype(np.uint64)
    before[np.cumsum(n) - n] = START
    return before[:len(stream)]


def count(documents: DataFrame, train: Column) -> DataFrame:
    """One row per segment: exact token counts, and the filter part of its tokens and bigrams."""
    bits = seg.segment_bits(documents.sparkSession)
    rows = documents.where(train).select(F.col("text").alias("text"))

    def emit(batches):
        for batch in sliced(batches):
            stream, owners, before = _stream(words_of(batch.column("text"), lower=True))
            marks = np.full(len(batch), START)
            out = []
            for kind, grams in ((1, np.concatenate([stream, marks])), (2, joined_hash(before, stream))):
                distinct, n = seg.counted(grams)
                for segment, h, c in seg.split(distinct, bits, n.astype(np.uint32)):
                    out.append((segment, kind, h.tobytes(), c.tobytes()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                ["segment", "kind", "hashes", "counts"],
            )

    def reduce(segment, cells):
        parts, tokens = [], (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for kind in (1, 2):
            at = [k for k, x in enumerate(cells["kind"]) if x == kind]
            h, c = seg.counted(seg.numbers([cells["hashes"][k] for k in at]), seg.numbers([cells["counts"][k] for k in at], np.uint32))
            parts.append(entries(h, c))
            if kind == 1:
                words = h != START
                tokens = h[words], c[words]
        bits_of = seg.filter_bits(np.concatenate(parts), bits, BITS_PER_ENTRY, PROBES, None)
        h, c = tokens
        yield (
            segment, h.tobytes(), c.tobytes(), int(c.sum()), len(h), int((c == 1).sum()),
            float(VALUES[level_of(c)].sum()), bits_of,
        )

    sent = rows.mapInArrow(emit, "segment int, kind int, hashes binary, counts binary")
    return seg.per_segment(
        sent, reduce, "segment int, hashes binary, counts binary, total long, distinct_tokens long, singles long, norm double, bits binary"
    )


def model_of(counts: DataFrame, bits: int, weight: float = WEIGHT, most_bytes: int = MOST_BYTES) -> Model:
    """The broadcast part of a written table of ``count``: totals and, unless they are larger, filter and the frequent tokens."""
    n, v, singles, norm, size = counts.agg(
        F.sum("total"), F.sum("distinct_tokens"), F.sum("singles"), F.sum("norm"), F.sum(F.octet_length("bits").cast("long"))
    ).first()
    n, v = n or 0, v or 0
    unknown = max(singles or 0, 1) / (n + 1)
    if (size or 0) > most_bytes:
        return Model(None, n, v, unknown, norm or 1.0, np.zeros(0, np.uint64), np.zeros(0, np.int64), weight)
    least = n / HEAD

    def frequent(batches):
        for batch in batches:
            h, c = seg.numbers(batch.column("hashes").to_pylist()), seg.numbers(batch.column("counts").to_pylist(), np.int64)
            keep = c >= least
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64), pa.int64()), pa.array(c[keep], pa.int64())], ["h", "c"])

    head = counts.select("hashes", "counts").mapInArrow(frequent, "h long, c long").toArrow()
    h, c = head["h"].to_numpy().view(np.uint64), head["c"].to_numpy()
    order = np.argsort(h)
    return Model(
        seg.collect_filter(counts, bits, PROBES), n, v, unknown, norm or 1.0, h[order], c[order], weight
    )


def _log_probabilities(model: Model | Answers, stream: np.ndarray, before: np.ndarray) -> np.ndarray:
    tokens, token_at = np.unique(stream, return_inverse=True)
    value = VALUES[model.levels(tokens)]
    single = np.where(value > 0, (1 - model.unknown) * value / model.norm, model.unknown)
    grams = joined_hash(before, stream)
    pairs, first, pair_at = np.unique(grams, return_index=True, return_inverse=True)
    context_tokens, context_at = np.unique(before[first], return_inverse=True)
    context = VALUES[model.levels(context_tokens)][context_at]
    together = np.zeros(len(pairs))
    seen = np.flatnonzero((context > 0) & (value[token_at[first]] > 0))  # a pair of known tokens only
    together[seen] = VALUES[model.levels(pairs[seen])]
    p = single[token_at[first]]
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(context > 0, (1 - model.weight) * p + model.weight * np.minimum(1.0, together / context), p)
    return np.log10(p)[pair_at]


_ASKED = pa.schema([
    ("segment", pa.int32()), ("slice", pa.int64()), ("kind", pa.int32()), ("hashes", pa.binary()), ("more", pa.binary()),
    ("bits", pa.binary()), ("docs", pa.list_(pa.int64())), ("lengths", pa.binary()),
])


def _score_where_counted(rows: DataFrame, counts: DataFrame, bits: int, model: Model) -> DataFrame:
    """The scores of ``rows`` without a broadcast filter. Kinds of rows: 0 the stored segment, 1 tokens and 2 bigrams that a
    slice asks for, 3 the slice itself, as codes of its tokens."""

    def emit(batches):
        at = TaskContext.get().partitionId() << 40
        for batch in sliced(batches):
            stream, owners, before = _stream(words_of(batch.column("text"), lower=True))
            tokens, codes = np.unique(stream, return_inverse=True)
            out = []
            for kind, grams in ((1, np.unique(np.append(tokens, START))), (2, np.unique(joined_hash(before, stream)))):
                out += [(segment, at, kind, h.tobytes(), None, None, None, None) for segment, h in seg.split(grams, bits)]
            own = int(seg.segment_of(mix(np.array([at], np.uint64)), bits)[0])
            lengths = np.bincount(owners, minlength=len(batch)).astype(np.uint32).tobytes()
            codes = codes.astype(np.uint16 if len(tokens) <= 1 << 16 else np.uint32)
            out.append((own, at, 3, tokens.tobytes(), codes.tobytes(), None, batch.column("doc_id").to_pylist(), lengths))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ASKED)], schema=_ASKED)
            at += 1

    stored = counts.select(
        "segment", F.lit(None).cast("long").alias("slice"), F.lit(0).alias("kind"), "hashes", F.col("counts").alias("more"), "bits",
        F.lit(None).cast("array<bigint>").alias("docs"), F.lit(None).cast("binary").alias("lengths"),
    )

    def answer(segment, cells):
        token, number, part = np.zeros(0, np.uint64), np.zeros(0, np.int64), b""
        asked = {1: [], 2: []}
        for k, kind in enumerate(cells["kind"]):
            if kind == 0:
                token, number, part = seg.numbers([cells["hashes"][k]]), seg.numbers([cells["more"][k]], np.int64), cells["bits"][k]
            elif kind == 3:
                yield cells["slice"][k], 3, -1, cells["hashes"][k], cells["more"][k], cells["docs"][k], cells["lengths"][k]
            else:
                asked[kind].append(k)
        held = seg.Filter.of(bits, PROBES, pa.table({"segment": pa.array([segment], pa.int32()), "bits": pa.array([part], pa.binary())}))
        for kind, places in asked.items():
            if not places:
                continue
            grams, back = np.unique(seg.numbers([cells["hashes"][k] for k in places]), return_inverse=True)
            level, number_of = levels_in(held, grams).astype(np.uint8), np.zeros(len(grams) if kind == 1 else 0, np.int64)
            if kind == 1 and len(token):
                at = np.minimum(np.searchsorted(token, grams), len(token) - 1)
                number_of = np.where(token[at] == grams, number[at], 0)
            start = 0
            for k in places:
                own = back[start:start + len(cells["hashes"][k]) // 8]
                yield cells["slice"][k], kind, segment, level[own].tobytes(), number_of[own].tobytes() if kind == 1 else b"", None, None
                start += len(own)

    def settle(_, cells):
        order = sorted(range(len(cells["kind"])), key=lambda k: cells["part"][k])  # sorted hashes are in the order of their segments
        told = {kind: [k for k in order if cells["kind"][k] == kind] for kind in (1, 2, 3)}
        k, = told[3]
        docs, n = cells["docs"][k], np.frombuffer(cells["lengths"][k], np.uint32).astype(np.int64)
        tokens = seg.numbers([cells["hashes"][k]])
        stream = tokens[np.frombuffer(cells["more"][k], np.uint16 if len(tokens) <= 1 << 16 else np.uint32)]
        before, owners = _before(stream, n), np.repeat(np.arange(len(n)), n)
        words = np.unique(np.append(tokens, START))
        grams = np.concatenate([words, np.unique(joined_hash(before, stream))])
        found = seg.numbers([cells["hashes"][k] for kind in (1, 2) for k in told[kind]], np.uint8)
        order = np.argsort(grams, kind="stable")
        answers = Answers(grams[order], found[order], model.unknown, model.norm, model.weight)
        logs = np.bincount(owners, _log_probabilities(answers, stream, before), len(n))
        c = seg.numbers([cells["more"][k] for k in told[1]], np.int64)[np.searchsorted(words, stream)]
        base = np.bincount(owners, np.log10(c + 1.0), len(n)) - n * np.log10(model.tokens + model.distinct + 1)
        known = np.bincount(owners, c > 0, len(n)).astype(np.int64)
        yield from zip(docs, n.tolist(), known.tolist(), base.tolist(), logs.tolist())

    asked = rows.mapInArrow(emit, "segment int, slice long, kind int, hashes binary, more binary, bits binary, docs array<bigint>, lengths binary")
    told = seg.per_segment(
        asked.unionByName(stored), answer,
        "segment long, kind int, part int, hashes binary, more binary, docs array<bigint>, lengths binary",
    )
    return seg.per_segment(told, settle, "doc_id long, n_tokens long, n_known long, base_score double, score double").select(
        "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def score(documents: DataFrame, counts: DataFrame, bits: int, weight: float = WEIGHT, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of ``documents``."""
    spark = documents.sparkSession
    model = model_of(counts, bits, weight, most_bytes)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model.filter is None:
        return _score_where_counted(rows, counts, bits, model)
    shared = spark.sparkContext.broadcast(model)
    schema = (
        "segment int, row long, doc_id long, n_tokens long, known long, base double, score double, "
        "hashes binary, rows binary, times binary"
    )

    def emit(batches):
        model = shared.value
        row = TaskContext.get().partitionId() << 40
        scale = np.log10(model.tokens + model.distinct + 1)
        for batch in sliced(batches):
            size = len(batch)
            stream, owners, before = _stream(words_of(batch.column("text"), lower=True))
            logs = np.bincount(owners, _log_probabilities(model, stream, before), size)
            n = np.bincount(owners, minlength=size)
            at = np.minimum(np.searchsorted(model.head, stream), max(len(model.head) - 1, 0))
            in_head = model.head[at] == stream if len(model.head) else np.zeros(len(stream), bool)
            c = np.zeros(len(stream))
            c[in_head] = model.head_counts[at[in_head]]
            known = np.bincount(owners[in_head], minlength=size)
            base = np.bincount(owners, np.log10(c + 1), size) - n * scale
            ids = row + np.arange(size)
            nothing = [None] * size
            kinds = [f.type for f in _EMITTED]
            columns = [seg.segment_of(mix(ids.astype(np.uint64)), bits), ids, batch.column("doc_id"), n, known, base, logs, nothing, nothing, nothing]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) if not isinstance(x, pa.Array) else x for x, k in zip(columns, kinds)], schema=_EMITTED)
            rest = np.flatnonzero(~in_head)
            order = rest[np.lexsort((owners[rest], stream[rest]))]
            h, o = stream[order], owners[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]) if len(h) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            times = np.diff(np.append(starts, len(h))).astype(np.uint32)
            packed = [
                (segment, row, x.tobytes(), y.tobytes(), z.tobytes())
                for segment, x, y, z in seg.split(h[starts], bits, o[starts].astype(np.uint32), times)
            ]
            columns = list(zip(*packed)) or [()] * 5
            blank = [None] * len(packed)
            columns = [columns[0], columns[1], blank, blank, blank, blank, blank, columns[2], columns[3], columns[4]]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], schema=_EMITTED)
            row += size

    stored = counts.select(
        "segment", F.lit(-1).cast("long").alias("row"), *[F.lit(None).cast(t).alias(c) for c, t in
        (("doc_id", "long"), ("n_tokens", "long"), ("known", "long"), ("base", "double"), ("score", "double"))],
        "hashes", F.lit(None).cast("binary").alias("rows"), F.col("counts").alias("times"),
    )

    def reduce(segment, cells):
        token, number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        wanted = []
        for k, row in enumerate(cells["row"]):
            if row == -1:
                token, number = seg.numbers([cells["hashes"][k]]), seg.numbers([cells["times"][k]], np.int64)
            elif cells["hashes"][k] is None:
                yield row, cells["doc_id"][k], cells["n_tokens"][k], cells["known"][k], cells["base"][k], cells["score"][k]
            else:
                wanted.append(k)
        if not len(token) or not wanted:
            return
        h = seg.numbers([cells["hashes"][k] for k in wanted])
        owner = np.concatenate([np.frombuffer(cells["rows"][k], np.uint32).astype(np.int64) + cells["row"][k] for k in wanted])
        times = seg.numbers([cells["times"][k] for k in wanted], np.uint32)
        at = np.minimum(np.searchsorted(token, h), len(token) - 1)
        found = token[at] == h
        rows, back = np.unique(owner[found], return_inverse=True)
        known = np.bincount(back, times[found], len(rows)).astype(np.int64)
        base = np.bincount(back, times[found] * np.log10(number[at[found]] + 1.0), len(rows))
        yield from zip(rows.tolist(), [None] * len(rows), [None] * len(rows), known.tolist(), base.tolist(), [None] * len(rows))

    partial = seg.per_segment(
        rows.mapInArrow(emit, schema).unionByName(stored), reduce,
        "row long, doc_id long, n_tokens long, known long, base double, score double",
    )
    return partial.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"), F.max("score").alias("score"),
    ).select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


_EMITTED = pa.schema([
    ("segment", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()),
    ("base", pa.float64()), ("score", pa.float64()), ("hashes", pa.binary()), ("rows", pa.binary()), ("times", pa.binary()),
])


def score_corpus(documents: DataFrame, train: Column, weight: float = WEIGHT, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Count over the rows where ``train`` holds, then score all rows."""
    spark = documents.sparkSession
    bits = seg.segment_bits(spark)
    path = scratch_path(spark, "ngrams")
    count(documents, train).write.parquet(path)
    return score(documents, spark.read.parquet(path), bits, weight, most_bytes)


@query()
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold("doc_id", 7) == 2
    scored = score_corpus(table(spark, folder, "documents"), train=~held_out)
    return scored.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
