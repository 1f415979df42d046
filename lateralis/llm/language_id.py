"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the character n-grams inside a word, with a mark at either end of the word, hashed into
``buckets``. Training adds up one count per (label, bucket): tasks add within themselves first, Spark's
aggregate does the rest, and the driver receives ``labels x buckets`` numbers whatever the size of the
corpus. The log-probability matrix is broadcast (its size is the same product). Scoring evaluates each
distinct word of a slice of texts once and adds the words of a text up in numpy, so whole texts are read
and memory stays bound by the slice.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text when the
model has learnt no label. Rows with a null label, and those whose ``train`` is not true, teach nothing.
Equal posteriors go to the label that sorts first. Repeated rows count and are scored each time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import fold, query, table
from lateralis.llm.text import Words, slices, sliced, words_of

UNDETERMINED = "und"
SLICE = 1 << 20  # the letters of a slice's words stand in several arrays of eight bytes a letter
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)


class LanguageModel(NamedTuple):
    labels: list[str]  # sorted
    log_prior: np.ndarray
    log_prob: np.ndarray  # labels x buckets


def _grams(vocabulary: pa.Array, order: int, letters: np.ndarray, marks: np.ndarray, word: np.ndarray, buckets: int):
    """(bucket, word index) of every n-gram of one order that lies within a marked word."""
    last = len(letters) - order + 1
    if order == 1:
        inside = ~marks
    else:
        inside = np.ones(last, bool)
        for k in range(1, order - 1):
            inside &= ~marks[k:last + k]
        inside &= ~(marks[:last] & marks[order - 1:])
    start = np.flatnonzero(inside[:last])
    h = np.full(len(start), order, np.uint64)
    for k in range(order):
        h = (h ^ letters[start + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(17)) % np.uint64(buckets)).astype(np.int64), word[start]


def word_grams(vocabulary: pa.Array, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS):
    """Yield, per order, the hashed n-grams of all words and the word each belongs to."""
    if not len(vocabulary):
        return
    joined = "\n" + "\n".join(vocabulary.to_pylist()).lower() + "\n"
    letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    marks = letters == 10
    word = np.cumsum(marks) - 1
    for order in orders:
        if len(letters) >= order:
            yield _grams(vocabulary, order, letters, marks, word, buckets)


def fit(
    documents: DataFrame, train: Column, text: str = "text", label: str = "lang", buckets: int = BUCKETS,
    orders: tuple[int, ...] = ORDERS, smoothing: float = 1.0,
) -> LanguageModel:
    """Learn from all rows where ``train`` holds and the label is not null."""
    rows = documents.where(train & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label")
    )

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in sliced(batches, size=SLICE):
            words = words_of(batch.column("text"), lower=False)
            grams = list(word_grams(words.vocabulary, buckets, orders))
            names = batch.column("label").dictionary_encode()
            owner = names.indices.to_numpy(zero_copy_only=False)
            by_word = np.repeat(owner, words.counts)
            for k, name in enumerate(names.dictionary.to_pylist()):
                total = totals.setdefault(name, np.zeros(buckets + 1))
                total[buckets] += np.count_nonzero(owner == k)
                times = np.bincount(words.codes[by_word == k], minlength=len(words.vocabulary))
                for bucket, word in grams:
                    total[:buckets] += np.bincount(bucket, times[word], buckets)
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(total[used].astype(np.int64), pa.int64())],
                ["label", "bucket", "n"],
            )

    counts = rows.mapInArrow(count, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = found["label"].to_numpy(zero_copy_only=False)
    labels = sorted(set(names))
    dense = np.zeros((len(labels), buckets + 1))
    dense[np.searchsorted(labels, names) if len(labels) else [], found["bucket"].to_numpy()] = found["n"].to_numpy()
    documents_per_label, dense = dense[:, buckets], dense[:, :buckets] + smoothing
    return LanguageModel(
        labels,
        np.log(documents_per_label / max(documents_per_label.sum(), 1)),
        np.log(dense / dense.sum(axis=1, keepdims=True)),
    )


def posteriors(words: Words, model: LanguageModel, buckets: int, orders: tuple[int, ...]) -> np.ndarray:
    """texts x labels: the posterior of each label."""
    size = len(words.vocabulary)
    by_word = np.zeros((len(model.labels), size))
    for bucket, word in word_grams(words.vocabulary, buckets, orders):
        for k in range(len(model.labels)):
            by_word[k] += np.bincount(word, model.log_prob[k][bucket], size)
    texts, owners = len(words.counts), words.owners
    total = np.stack([prior + np.bincount(owners, row[words.codes], texts) for prior, row in zip(model.log_prior, by_word)], axis=1)
    total -= total.max(axis=1, keepdims=True)
    likely = np.exp(total)
    return likely / likely.sum(axis=1, keepdims=True)


def predict(spark: SparkSession, model: LanguageModel, orders: tuple[int, ...] = ORDERS):
    """A column function: text -> struct<lang string, score double>."""
    shared = spark.sparkContext.broadcast(model)
    buckets = model.log_prob.shape[1]

    def score(text: pa.Array) -> pa.Array:
        model = shared.value
        names, scores = [], []
        for start, stop in slices(text, SLICE):
            words = words_of(text.slice(start, stop - start), lower=False)
            known = np.zeros(stop - start, bool)
            if len(words.vocabulary) and model.labels:
                lettered = pc.match_substring_regex(words.vocabulary, r"\p{L}").to_numpy(zero_copy_only=False)
                known = np.bincount(words.owners, lettered[words.codes], stop - start) > 0
                chance = posteriors(words, model, buckets, orders)
                best = chance.argmax(axis=1)
                names += [model.labels[b] if k else UNDETERMINED for b, k in zip(best, known)]
                scores.append(np.where(known, chance[np.arange(len(best)), best], 0.0))
            else:
                names += [UNDETERMINED] * (stop - start)
                scores.append(np.zeros(stop - start))
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang", "score"]
        )

    return F.arrow_udf(score, "struct<lang: string, score: double>")


def corpus_model(documents: DataFrame) -> LanguageModel:
    """The model of the production query: four fifths of the documents, by a hash of the key."""
    held_out = fold("doc_id", 5)
    return fit(documents, train=(held_out != 0) & (held_out >= 0))


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = predict(spark, corpus_model(documents))
    return documents.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), found(F.col("text")).alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
