"""Words of whole texts, by Arrow batch: what the operators that run inside tasks share.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``. A null text has no words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext

SLICE_BYTES = 4 << 20


class Words(NamedTuple):
    counts: np.ndarray  # words of each text
    codes: np.ndarray  # the words of all texts in order, as indexes into the vocabulary
    vocabulary: pa.Array  # distinct words

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.counts)

    @property
    def owners(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_kept: dict[str, tuple[int, object]] = {}


def _stage() -> int:
    context = TaskContext.get()
    return -1 if context is None else context.stageId()


def stage_cache(name: str, make: Callable[[], object]) -> object:
    """What a worker process keeps between tasks of one stage; tasks of any other stage let it go."""
    held = _kept.get(name)
    if held is None or held[0] != _stage():
        held = _kept[name] = (_stage(), make())
    return held[1]


_seen_stage = -1


def _let_go() -> None:
    """At a worker's first slice of a stage: drop what other stages kept, and give unused memory back."""
    global _seen_stage
    if _seen_stage == _stage():
        return
    _seen_stage = _stage()
    for name in [n for n, (stage, _) in _kept.items() if stage != _seen_stage]:
        del _kept[name]
    gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the C library keep it for the process otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim is not None:
        trim(0)


def slices(text: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text each; a longer text is a range of its own."""
    _let_go()
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(text):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, stop
        start = stop


def sliced(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in slices(batch.column(column), size):
            yield batch.slice(start, stop - start)
    give_back()  # the worker may stand idle through later stages


def words_of(text: pa.Array, lower: bool) -> Words:
    """All words of an array of texts; ``lower`` folds A-Z only."""
    text = pc.fill_null(text, "")
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    blank = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    if blank.any():  # before leading and after trailing white space
        owners = np.searchsorted(np.cumsum(counts), np.flatnonzero(blank), "right")
        np.subtract.at(counts, owners, 1)
        flat = flat.filter(pa.array(~blank))
    encoded = flat.dictionary_encode()
    return Words(counts, encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary)


def hashes(vocabulary: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the strings, the same in every process."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a sequence from the hashes of its two parts, in order."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(0xD1B54A32D192ED03))


def array(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)
