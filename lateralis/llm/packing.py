"""Sequence packing: concatenate all documents, cut into fixed windows.

Pass one encodes every document once and writes its ids with its offset inside the task's partition. The
partition totals (one number a task) give each partition its global offset by a prefix sum, and pass two
cuts the written ids at multiples of the window. A document that crosses a cut gives one boundary record
per window it touches, so only the last sequence of all is short. The written table is what a lost executor
is recovered from: offsets depend on it, not on a repeated run of pass one.

The tokenizer must encode white-space separated words independently (as the word-level vocabulary here does).
Then only distinct words are encoded, through a cache of bounded size. A word of characters below U+0300,
which normalisation leaves alone but for case, is folded to lower case and parted from the punctuation
that ends it first, where the tokenizer parts them too: most rare spellings are such forms.

Defined results: a null or empty text is its end id alone; repeated rows are packed each time; an empty
table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array as packed

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import query, table
from lateralis.llm.text import give_back, sliced, stage_cache, words_of
from lateralis.session import scratch_path

WINDOW = 2048
END_ID = 1
CACHED_WORDS = 300_000
SLICE = 8 << 20
#: Fixed set: punctuation that no contraction of the tokenizer starts with.
TAIL = ",.;:!?#$%&*|)]}\""
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class WordEncoder:
    """Ids of words by a tokenizer, as bytes, with two generations of cached words."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.cached = cached
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, words: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        out = list(map(young.get, words))
        missing = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            ids = old.get(words[k])
            if ids is None:
                missing.append(k)
            else:
                young[words[k]] = out[k] = ids
        code = self.kind.char
        for at in range(0, len(missing), 10_000):
            part = missing[at:at + 10_000]
            for k, found in zip(part, self.tokenizer.encode_batch_fast([words[k] for k in part], add_special_tokens=False)):
                out[k] = ids = packed(code, found.ids).tobytes()
                if len(words[k]) < 64:
                    young[words[k]] = ids
        if len(young) > self.cached:
            self.old, self.young = young, {}
        return out


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; the bytes are padded in front."""
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(strings) + 1, strings.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets + 8, np.concatenate([np.zeros(8, np.uint8), data])


def _folded(vocabulary: pa.Array) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
    """(cores, core of each word, tails, tail of each word), so that a word's ids are those of its core and its tail."""
    offsets, data = _bytes(vocabulary)
    high = np.concatenate([[0], np.cumsum(data >= 0xCC)])  # lead bytes from U+0300 on
    plain = high[offsets[1:]] == high[offsets[:-1]]
    plain &= ~pc.match_substring(vocabulary, "<|").to_numpy(zero_copy_only=False)
    lowered = pc.if_else(pa.array(plain), pc.ascii_lower(vocabulary), vocabulary)
    trimmed = pc.ascii_rtrim(lowered, characters=TAIL)
    offsets, data = _bytes(lowered)
    size = pc.binary_length(trimmed).to_numpy(zero_copy_only=False).astype(np.int64)
    tail = offsets[1:] - offsets[:-1] - size
    end = offsets[:-1] + size
    last, before = data[end - 1], data[end - 2]
    ascii_word = ((last >= 48) & (last < 58)) | ((last >= 97) & (last < 123))
    latin_letter = (last >= 0x80) & (before >= 0xC3) & (before <= 0xCA) & ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    parted = plain & (size > 0) & (tail > 0) & (tail <= 8) & (ascii_word | latin_letter)
    cores = pc.if_else(pa.array(parted), trimmed, lowered).dictionary_encode()
    code = np.zeros(len(lowered), np.uint64)  # up to eight bytes of the tail
    at = np.flatnonzero(parted)
    for k in range(8):
        more = at[tail[at] > k]
        code[more] |= data[end[more] + k].astype(np.uint64) << np.uint64(8 * k)
    distinct, of_word = np.unique(code, return_inverse=True)
    tails = [int(c).to_bytes(8, "little").rstrip(b"\0").decode() for c in distinct]
    return cores.dictionary.to_pylist(), cores.indices.to_numpy(), tails, of_word


def encode_documents(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
    slice_bytes: int = SLICE, cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """(part, local_start, doc_id, n, width, ids): the ids of each document with the end id, and its offset in its partition.

    Smaller slices and caches take less memory and more time, and give the same ids.
    """

    def encode(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = stage_cache(f"encoder {tokenizer}", lambda: WordEncoder(tokenizer, cached_words))
        part, start = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, size=slice_bytes):
            words = words_of(batch.column("text"), lower=False)
            cores, core, tails, tail = _folded(words.vocabulary)
            ids = encoder.encode(cores) + encoder.encode(tails)
            core, tail = core.astype(np.int32)[words.codes], (tail + len(cores)).astype(np.int32)[words.codes]
            lengths = np.fromiter(map(len, ids), np.int32, len(ids)) // encoder.kind.itemsize
            flat = np.frombuffer(b"".join(ids), encoder.kind)
            begins = np.cumsum(lengths, dtype=np.int32) - lengths
            ends = np.cumsum(lengths[core] + lengths[tail], dtype=np.int32)
            parts = np.stack([core, tail], axis=1).ravel()
            parts = parts[lengths[parts] > 0]
            each = lengths[parts]
            source = np.arange(each.sum(), dtype=np.int32) + np.repeat(begins[parts] - (np.cumsum(each, dtype=np.int32) - each), each)
            stream = flat[source]
            del core, tail, parts, each, source  # each as long as the slice's words or ids
            bounds = np.concatenate([[0], ends])[np.concatenate([[0], words.ends])]
            n = np.diff(bounds) + 1
            after, size = np.cumsum(n), encoder.kind.itemsize
            raw = np.insert(stream, bounds[1:], end_id).astype(encoder.kind).tobytes()
            blobs = [raw[size * (e - k):size * e] for e, k in zip(after.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), part), pa.int32()), pa.array(start + after - n, pa.int64()),
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([size] * len(n), pa.int32()), pa.array(blobs, pa.binary()),
                ],
                ["part", "local_start", "doc_id", "n", "width", "ids"],
            )
            start += int(n.sum())
            del words, ids, flat, stream, raw, blobs
            give_back()

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "part int, local_start long, doc_id long, n long, width int, ids binary")


def cut(encoded: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents of a written table of ``encode_documents``."""
    spark = encoded.sparkSession
    totals = sorted(encoded.groupBy("part").agg(F.sum("n").alias("n")).collect())
    before, at = [], 0
    for part, n in totals:
        before.append((part, at))
        at += n
    bases = F.broadcast(spark.createDataFrame(before, "part int, base long"))  # one row a task of pass one

    def pieces(batches):
        for batch in batches:
            out: list[tuple] = []
            starts = (np.asarray(batch.column("base")) + np.asarray(batch.column("local_start"))).tolist()
            widths = batch.column("width").to_pylist()
            for key, begin, width, raw in zip(batch.column("doc_id").to_pylist(), starts, widths, batch.column("ids")):
                ids = np.frombuffer(raw.as_buffer(), f"<u{width}").astype("<u4")
                n, at = len(ids), 0
                while at < n:
                    offset = (begin + at) % window
                    length = min(n - at, window - offset)
                    crc = zlib.crc32(ids[at:at + length])
                    out.append((key, at, length, crc, n, (begin + at) // window, offset))
                    at += length
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return encoded.join(bases, "part").select("base", "local_start", "doc_id", "width", "ids").mapInArrow(pieces, PIECES)


def pack(documents: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, **memory: int) -> DataFrame:
    """Pieces of all ``documents`` in sequences of ``window`` ids; only the last sequence needs padding.

    ``memory``: ``slice_bytes`` and ``cached_words`` of :func:`encode_documents`.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "encoded")
    encode_documents(documents, tokenizer, end_id=end_id, **memory).write.parquet(path)
    return cut(spark.read.parquet(path), window)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary_path())
