"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, masking of secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Stages but the last return the
columns of ``documents``, extra ones included. ``run`` writes each stage's rows to the shared checkpoint folder and reads
them again as the next one's input, which also cuts the lineage.

Defined results: an empty table stays empty in every stage. A null or empty text, or one without a letter, leaves at the
language stage, which can name no language for it; where no document has a label to learn from, nothing else leaves
there. Repeated rows with an id each are copies, of which the smallest id stays; rows without an id are never removed as
copies or as contaminated. Very long texts pass every stage whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm import decontamination, jaccard_join, language_id, packing, secret_scan
from lateralis.llm.registry import free_name, ship, shrink_heaps, table
from lateralis.session import scratch_path

LEAST_CONFIDENCE = 0.5


def begin(spark: SparkSession) -> None:
    """Make the session ready for a stage: the package on the executors, and their heaps free of the stage before."""
    ship(spark)
    shrink_heaps(spark)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a posterior of at least one half; the model learns from ``docs``.

    Without a label to learn from, all documents with a letter stay.
    """
    begin(spark)
    model = language_id.corpus_model(docs)
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = free_name(docs, "found_language")
    judged = docs.withColumn(found, language_id.predict(spark, model)(F.col("text")))
    kept = (F.col(f"{found}.lang") != language_id.UNDETERMINED) & (F.col(f"{found}.score") >= LEAST_CONFIDENCE)
    return judged.where(kept).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join, the document with the smallest id."""
    begin(spark)
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    begin(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the forest confirms replaced by a mark."""
    begin(spark)
    return secret_scan.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    begin(spark)
    # the stages before leave an executor little memory
    return packing.pack(docs, packing.vocabulary_path(), slice_bytes=2 << 20, cached_words=60_000)


STAGES = [
    ("language_id", keep_known_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: The stages learn models and use a tokenizer, which SQL cannot express; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
