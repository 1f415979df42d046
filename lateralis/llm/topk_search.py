"""Exact top-k search by integer inner product: columnar branch and bound.

Queries are broadcast in chunks of bounded size; every task turns its candidates into blocks in vertical
layout (a row of the block is one dimension) and accumulates scores a few dimensions at a time, the heaviest
first. After each step, what the remaining dimensions can still add is bounded by the product of the norms
left on either side; candidates that no query of the group can use are compacted away, and, once few pairs
are left, only surviving (query, candidate) pairs go on. Bounds and comparisons keep ties. Tasks return at most
``k`` rows a query; one window ranks them.

Arithmetic is exact: components are integers held in doubles while all sums stay below 2**52, in 64-bit integers
below 2**62, with the same bounds widened by their rounding; larger ones are added up in Python integers. A score
beyond the range of a long counts as the nearest long, in ranking too.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows
without an id; vectors only compare with vectors of their own length; equal scores rank by smaller id.
A repeated candidate row takes a rank of its own; a query's own rows (same id) never count; exact repeats of a
query row are asked once. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lateralis.llm.registry import query, table
from lateralis.session import scratch_path

CHUNK = 16_384  # queries broadcast at once
CHUNK_BYTES = 32 << 20
GROUP = 128  # queries that share a pass over a block
BLOCK = 4_096  # candidates of a block
STEP = 16  # dimensions a step
FOUND = "q long, query_id long, vec_id long, score long"


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _scaled(m: np.ndarray) -> np.ndarray:
    """floor(256 * x); infinite where a double cannot hold it."""
    with np.errstate(over="ignore"):
        return np.floor(256 * m)


#: floor(256 * x) of any finite double, as a Python integer.
_whole = np.frompyfunc(lambda x: int(x) * 256 if abs(x) >= 2.0**53 else math.floor(256 * x), 1, 1)
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def _by_length(ids: pa.Array, vectors: pa.Array):
    """(length, ids, matrix) of the vectors of each length."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = pa.array(np.flatnonzero(lengths == length))
        yield int(length), ids.take(rows).to_numpy(), _matrix(vectors.take(rows))


class _Group:
    """Some queries of one length, with the best found so far."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, raw: np.ndarray, k: int):
        self.rows, self.ids, self.k, self.raw = rows, ids, k, raw
        vectors = _scaled(raw)
        with np.errstate(over="ignore"):
            self.order = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
        self.vectors = np.ascontiguousarray(vectors[:, self.order])
        self.steps = list(range(0, vectors.shape[1], STEP)) + [vectors.shape[1]]
        self.rest = self._rest(self.vectors)
        self.largest = np.abs(vectors).max(initial=0.0)
        self.scores = np.empty((len(ids), 0), np.int64)
        self.found = np.empty((len(ids), 0), np.int64)

    def _rest(self, m: np.ndarray) -> np.ndarray:
        """Norm of the dimensions after each step."""
        with np.errstate(over="ignore"):
            left = np.cumsum((m**2)[:, ::-1], axis=1)[:, ::-1]
        left = np.concatenate([left, np.zeros((len(m), 1))], axis=1)
        return np.sqrt(left[:, self.steps[1:]]) * (1 + 1e-9) if len(self.steps) > 1 else np.zeros((len(m), 0))

    def offer(self, ids: np.ndarray, raw: np.ndarray) -> None:
        vectors = _scaled(raw)
        largest_sum = self.largest * np.abs(vectors).max(initial=0.0) * max(vectors.shape[1], 1)
        alive = self.ids[:, None] != ids[None, :]
        if not largest_sum < 2**62:
            qi, ci = np.nonzero(alive)
            exact = _whole(self.raw) @ _whole(raw).T if raw.shape[1] else np.zeros(alive.shape, object)
            self._keep(qi, ids[ci], np.clip(exact[qi, ci], LEAST_LONG, MOST_LONG).astype(np.int64))
            return
        kind, slack = (np.float64, 0.0) if largest_sum < 2**52 else (np.int64, largest_sum * 2.0**-50)
        own = self.vectors.astype(kind, copy=False)
        columns = np.ascontiguousarray(vectors[:, self.order].T.astype(kind, copy=False))  # vertical: a row per dimension
        rest = self._rest(vectors[:, self.order])
        full = self.found[:, -1:] > np.iinfo(np.int64).min if self.scores.shape[1] else np.zeros((len(self.ids), 1), bool)
        least = np.where(full, self.scores[:, -1:] if self.scores.shape[1] else 0, -np.inf)[:, 0] - slack
        total = np.zeros((len(self.ids), len(ids)), kind)
        kept = np.arange(len(ids))
        pairs = None
        for step, (a, b) in enumerate(zip(self.steps, self.steps[1:])):
            if pairs is None:
                total += own[:, a:b] @ columns[a:b, kept]
                alive &= total + self.rest[:, step, None] * rest[None, kept, step] >= least[:, None]
                stay = np.flatnonzero(alive.any(axis=0))
                if len(stay) < 0.7 * len(kept):  # compact candidates that no query of the group can use
                    total, alive, kept = total[:, stay], alive[:, stay], kept[stay]
                if np.count_nonzero(alive) < 0.05 * alive.size:
                    pairs = np.nonzero(alive)
                    part = total[pairs]
            else:
                qi, ci = pairs
                part = part + np.einsum("ij,ij->i", own[qi, a:b], columns[a:b, kept[ci]].T)
                stay = part + self.rest[qi, step] * rest[kept[ci], step] >= least[qi]
                pairs, part = (qi[stay], ci[stay]), part[stay]
        if pairs is None:
            pairs = np.nonzero(alive)
            part = total[pairs]
        self._keep(pairs[0], ids[kept[pairs[1]]], part.astype(np.int64))

    def _keep(self, qi: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(qi):
            return
        have = self.scores.shape[1]
        real = self.found.ravel() >= np.iinfo(np.int64).min + 1
        owner = np.concatenate([np.repeat(np.arange(len(self.ids)), have)[real], qi])
        score = np.concatenate([self.scores.ravel()[real], scores])
        found = np.concatenate([self.found.ravel()[real], ids])
        order = np.lexsort((found, ~score, owner))  # the complement falls as the score rises, without overflow
        owner, score, found = owner[order], score[order], found[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
        top = place < self.k
        self.scores = np.full((len(self.ids), self.k), LEAST_LONG)
        self.found = np.full((len(self.ids), self.k), np.iinfo(np.int64).min)
        self.scores[owner[top], place[top]] = score[top]
        self.found[owner[top], place[top]] = found[top]


def _search(vectors: DataFrame, shared: Broadcast, k: int) -> DataFrame:

    def run(batches):
        asked = shared.value.combine_chunks()
        groups: dict[int, list[_Group]] = {}
        if len(asked):
            q, ids, lists = (asked[c].combine_chunks() for c in ("q", "vec_id", "embedding"))
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                for at in range(0, len(rows), GROUP):
                    part = pa.array(rows[at:at + GROUP])
                    groups.setdefault(int(length), []).append(
                        _Group(q.take(part).to_numpy(), ids.take(part).to_numpy(), _matrix(lists.take(part)), k)
                    )
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                block = batch.slice(at, BLOCK)
                for length, ids, matrix in _by_length(block.column("vec_id"), block.column("embedding")):
                    for group in groups.get(length, ()):
                        group.offer(ids, matrix)
        for parts in groups.values():
            for g in parts:
                row, place = np.nonzero(g.found > np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(g.rows[row], pa.int64()), pa.array(g.ids[row], pa.int64()), pa.array(g.found[row, place], pa.int64()),
                        pa.array(g.scores[row, place], pa.int64()),
                    ],
                    ["q", "query_id", "vec_id", "score"],
                )

    return vectors.mapInArrow(run, FOUND)


def top_k(embeddings: DataFrame, asked: Column, k: int = 5, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all other rows for each row where ``asked`` holds."""
    vector = F.col("embedding")
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector).where(
        F.col("vec_id").isNotNull() & _usable(vector)
    )
    queries = embeddings.where(asked).select(F.col("vec_id").cast("long").alias("vec_id"), vector).where(
        F.col("vec_id").isNotNull() & _usable(vector)
    ).distinct()
    size = queries.agg(F.count("*").alias("n"), F.sum(8 * F.size("embedding").cast("long")).alias("bytes")).first()
    # queries are dealt to chunks by a hash: about ``chunk`` rows and ``CHUNK_BYTES`` each
    chunks = max(1, -(-size.n // chunk), -(-(size.bytes or 0) // CHUNK_BYTES))
    spark, path = embeddings.sparkSession, scratch_path(embeddings.sparkSession, "nearest")
    for c in range(chunks):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c).sort("vec_id").toArrow()
        part = part.append_column("q", pa.array(np.arange(len(part)) + (c << 32), pa.int64()))
        shared = spark.sparkContext.broadcast(part)
        found = _search(usable, shared, k)
        if chunks > 1:  # one after the other, so that a single chunk is held at any time
            found.write.mode("append").parquet(path)
            shared.destroy()
    out = spark.read.parquet(path) if chunks > 1 else found
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op2_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
