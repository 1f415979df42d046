"""Hashes grouped by segment: the common shuffle of the operators that count over all of a corpus.

A segment is the top bits of a 64-bit hash. Tasks send one packed row per segment and slice of texts, not a
row per hash, after adding up equal hashes of the slice; so a hash that holds a third of the corpus reaches
its segment as one number a slice. The number of segments follows the session's shuffle partitions.

``Filter`` is a Bloom filter built segment by segment where the hashes already are, so that building needs
neither a merge nor a second shuffle. Its size follows the number of entries up to ``most_bytes``, the bound
of what is broadcast; beyond it the rate of false positives rises. Without a bound it follows at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lateralis.llm.text import give_back, mix

MOST_BYTES = 128 << 20
_EVEN = np.uint64(0x9E3779B97F4A7C15)


def segment_bits(spark: SparkSession) -> int:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(8, (4 * partitions - 1).bit_length())


def segment_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def split(hashes: np.ndarray, bits: int, *others: np.ndarray) -> Iterator[tuple]:
    """(segment, hashes, others...) of each segment present; needs no sorted input."""
    if not len(hashes):
        return
    segments = segment_of(hashes, bits)
    order = np.argsort(segments, kind="stable")
    segments = segments[order]
    cuts = np.flatnonzero(np.diff(segments)) + 1
    parts = [np.split(a[order], cuts) for a in (hashes, *others)]
    for segment, *rest in zip(segments[np.concatenate([[0], cuts])].tolist(), *parts):
        yield segment, *rest


def counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with their numbers."""
    if counts is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[starts], np.add.reduceat(counts[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)


def per_segment(rows: DataFrame, reduce: Callable[[int, dict[str, list]], Iterable[tuple]], schema: str) -> DataFrame:
    """Bring the packed rows of a segment together and reduce them; ``reduce`` gets the cells of each column.

    A task holds the packed rows of its partition: a share of the hashes that shrinks with more partitions.
    """
    from pyspark.sql.types import _parse_datatype_string

    arrow = _arrow_schema(_parse_datatype_string(schema))
    names = [c for c in rows.columns if c != "segment"]

    def run(batches):
        held: dict[int, dict[str, list]] = {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in names]
            for k, segment in enumerate(batch.column("segment").to_pylist()):
                group = held.get(segment)
                if group is None:
                    group = held[segment] = {c: [] for c in names}
                for c, column in zip(names, columns):
                    group[c].append(column[k])
        out: list[tuple] = []
        for segment in sorted(held):
            out += reduce(segment, held.pop(segment))
            if len(out) >= 2_000:
                yield _batch(out, arrow)
                out = []
        yield _batch(out, arrow)
        held.clear()
        out = []
        give_back()

    return rows.repartition("segment").mapInArrow(run, schema)


def _arrow_schema(struct) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(struct)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def numbers(blobs: list[bytes], kind=np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)


def filter_bits(hashes: np.ndarray, bits: int, per_entry: float, probes: int, most_bytes: int | None = MOST_BYTES) -> bytes:
    """The bit array of one segment of a filter that holds ``hashes``."""
    size = int(len(hashes) * per_entry if most_bytes is None else min(len(hashes) * per_entry, most_bytes * 8 >> bits))
    if not len(hashes):
        return b""
    size = max(64, size + 7 & ~7)
    spots = np.zeros(size, np.uint8)
    for at in _positions(hashes, np.uint64(size), probes):
        spots[at.astype(np.int64)] = 1
    return np.packbits(spots, bitorder="little").tobytes()


def _positions(hashes: np.ndarray, size, probes: int) -> Iterator[np.ndarray]:
    x = mix(hashes * _EVEN)
    a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    for k in range(probes):
        yield (a + np.uint64(k) * b) % size


class Filter(NamedTuple):
    bits: int
    probes: int
    base: np.ndarray  # first byte of each segment
    size: np.ndarray  # bits of each segment
    data: np.ndarray

    @classmethod
    def of(cls, bits: int, probes: int, parts: pa.Table) -> Filter:
        """From the rows (segment, bits) of all segments."""
        sizes = np.zeros(1 << bits, np.uint64)
        parts = parts.sort_by("segment")
        sizes[parts["segment"].to_numpy()] = 8 * pc.binary_length(parts["bits"]).to_numpy().astype(np.uint64)
        data = np.concatenate([_content(chunk) for chunk in parts["bits"].chunks] or [np.zeros(0, np.uint8)])
        base = (np.cumsum(sizes) - sizes) // np.uint64(8)
        return cls(bits, probes, base, sizes, data)

    def contains(self, hashes: np.ndarray, routed: np.ndarray | None = None) -> np.ndarray:
        """Membership of each hash; ``routed`` gives the hashes whose segment is probed, where they differ."""
        segment = segment_of(hashes if routed is None else routed, self.bits)
        size = self.size[segment]
        out = size > 0
        live = np.flatnonzero(out)
        if len(live) < len(hashes):
            hashes, segment, size = hashes[live], segment[live], size[live]
        base = self.base[segment]
        found = np.ones(len(live), bool)
        for at in _positions(hashes, size, self.probes):
            byte = self.data[(base + (at >> np.uint64(3))).astype(np.int64)]
            found &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        out[live] = found
        return out


def collect_filter(parts: DataFrame, bits: int, probes: int) -> Filter:
    """A filter from rows (segment, bits); its size is bounded by ``filter_bits``."""
    found = Filter.of(bits, probes, parts.select("segment", "bits").toArrow())
    pa.default_memory_pool().release_unused()
    return found


def _content(chunk: pa.Array) -> np.ndarray:
    """The bytes of a binary array, without a copy."""
    _, offsets, data = chunk.buffers()
    if data is None or not len(chunk):
        return np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int32, len(chunk) + 1, chunk.offset * 4)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
