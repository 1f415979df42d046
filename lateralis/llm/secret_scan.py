"""Secret scans: candidates by pattern, false positives removed by a random forest, in DataFrame operations only.

A candidate is a run of at least ``LEAST`` characters ``[A-Za-z0-9+/_-]`` with a digit. Its features are length,
changes of character class, shares of digits and distinct characters, the share of its letters that frequent words
of the corpus cover, whether it stands in a path or address, and what its neighbours are: a credential word before it,
an assignment sign, a quotation mark, a long number beside it. The forest is fitted on at most ``SAMPLE`` labelled
findings, chosen by a hash.

The tables bring no labelled findings, so ``labelled`` gives them: on the learning rows, a finding is a secret if it is
assigned, in quotation marks, to a credential word or carries the fixed mark of a provider, and none otherwise. The
forest sees neither rule as such and scores all rows, also where a sign of the rule is missing.

Scans are map-only: texts without a candidate leave in the scan, and only findings are shuffled. The dictionary is
one aggregate of all words of the corpus and a list of at most ``DICTIONARY`` words.

Defined results: null and empty texts have no findings; a repeated candidate in a text is one finding per place; without
labelled findings of both kinds, the score of a finding is its label by the rule; a null id is scored, and its findings
keep it.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import fold, free_name, query, table
from lateralis.session import scratch_path

LEAST = 16
SAMPLE = 20_000
DICTIONARY = 300
TREES, DEPTH = 20, 6
THRESHOLD = 0.5
MASKED = "[SECRET]"
RUN = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"
#: Words that name a credential, and marks that providers put before their keys.
CREDENTIALS = "token|secret|passw|pwd|apikey|api_key|api-key|access_key|private_key|credential|auth|bearer"
PROVIDERS = "^(AKIA|ASIA|ghp_|gho_|ghs_|glpat-|xox[abp]-|sk_live_|sk-|AIza)"
LOWERS, UPPERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FEATURES = [
    "length", "changes", "digits", "distinct_share", "covered", "in_path", "credential_before", "assigned", "quoted", "number_beside",
    "only_digits", "only_hex", "upper", "mixed_case",
]


def dictionary(documents: DataFrame, words: int = DICTIONARY) -> list[str]:
    """The most frequent words of three to twelve letters a-z, over all texts."""
    tokens = documents.select(F.explode(F.split(F.lower(F.col("text")), r"[^a-z]+")).alias("w"))
    counts = tokens.where(F.length("w").between(3, 12)).groupBy("w").count()
    return [r[0] for r in counts.orderBy(F.desc("count"), "w").limit(words).collect()]


def findings(documents: DataFrame) -> DataFrame:
    """(doc_id, place, candidate, before, after, word, previous): every candidate with its word and the two words around it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    held = rows.where(F.exists(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)), lambda c: c.rlike("[0-9]")))
    words = held.select("doc_id", F.split("text", r"[\x20\x09-\x0D]+").alias("words"))
    placed = words.select("doc_id", "words", F.posexplode("words").alias("word_at", "word"))
    runs = placed.where(F.length("word") >= LEAST).where(F.col("word").rlike(RUN)).select(
        "doc_id", "word_at", "word", F.get("words", F.col("word_at") - 1).alias("p1"), F.get("words", F.col("word_at") - 2).alias("p2"),
        F.get("words", F.col("word_at") + 1).alias("n1"),
    )
    found = runs.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(RUN), F.lit(0))).alias("run_at", "candidate"))
    at = F.expr("instr(word, candidate)")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return found.where(F.col("candidate").rlike("[0-9]")).select(
        "doc_id", "word_at", "run_at", "candidate",
        F.expr("substring(word, 1, instr(word, candidate) - 1)").alias("head"),
        F.col("word").substr(at + F.length("candidate"), F.length("word")).alias("rest"),
        blank("p1").alias("p1"), blank("p2").alias("p2"), blank("n1").alias("n1"),
    )


def _features(found: DataFrame, words: list[str]) -> DataFrame:
    c, n = F.col("candidate"), F.length("candidate")
    classes = F.translate(c, LOWERS + UPPERS + DIGITS, "a" * 26 + "A" * 26 + "0" * 10)
    letters = F.regexp_replace(F.lower(c), "[^a-z]", "")
    uncovered = F.regexp_replace(letters, "|".join(sorted(words, key=lambda w: (-len(w), w))), "") if words else letters
    context = F.concat_ws(" ", "p2", "p1", "head")
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    return found.withColumns({
        "length": n.cast("double"),
        "changes": (F.length(F.regexp_replace(classes, r"(.)\1*", "$1")) - 1) / n,
        "digits": F.length(F.regexp_replace(c, "[^0-9]", "")) / n,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "covered": F.when(F.length(letters) > 0, 1 - F.length(uncovered) / F.length(letters)).otherwise(0.0),
        "in_path": flag(F.concat("head", "candidate").rlike(r"://|/.*/|^/|\.[a-z]{2,4}/") | F.col("rest").rlike(r"^\.[A-Za-z]{2,4}\b")),
        "credential_before": flag(F.lower(context).rlike(CREDENTIALS)),
        "assigned": flag(F.concat_ws(" ", "p1", "head").rlike("[=:]")),
        "quoted": flag(F.col("head").rlike("[\"'`]$") & F.col("rest").rlike("^[\"'`]")),
        "number_beside": flag(F.col("p1").rlike("[0-9]") | F.col("n1").rlike("[0-9]")),
        "only_digits": flag(c.rlike("^[0-9]+$")),
        "only_hex": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "upper": F.length(F.regexp_replace(c, "[^A-Z]", "")) / n,
        "mixed_case": flag(c.rlike("[a-z]") & c.rlike("[A-Z]")),
    })


def labelled(found: DataFrame) -> Column:
    """Label of a finding by the rule above."""
    named = F.lower(F.concat_ws(" ", "p2", "p1", "head")).rlike(rf"({CREDENTIALS})[a-z_]*[\"']?\s*[=:]\s*[\"'`]$")
    return (F.col("candidate").rlike(PROVIDERS) | (named & F.col("rest").rlike("^[\"'`]"))).cast("double")


def scan(documents: DataFrame, learn: Column, words: int = DICTIONARY, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, word_at, run_at, candidate, score and secret of every candidate; ``learn`` marks the learning rows."""
    spark = documents.sparkSession
    path = scratch_path(spark, "findings")
    known = dictionary(documents, words)
    found = findings(documents.select("doc_id", "text")).withColumn("learns", learn)
    _features(found.withColumn("label", labelled(found)), known).write.parquet(path)
    data = spark.read.parquet(path)
    chosen = scratch_path(spark, "sample")
    order = F.xxhash64("doc_id", "word_at", "run_at", "candidate")
    # half of the sample for either label
    kinds = [
        data.where(F.col("learns") & (F.col("label") == k)).orderBy(order, "doc_id", "word_at").limit(sample // 2).select("label", *FEATURES)
        for k in (0.0, 1.0)
    ]
    kinds[0].unionByName(kinds[1]).coalesce(1).write.parquet(chosen)
    fit = spark.read.parquet(chosen)
    if fit.select("label").distinct().count() < 2:
        scored = data.withColumn("score", F.col("label"))
    else:
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt",
            predictionCol="forest_prediction", probabilityCol="forest_probability", rawPredictionCol="forest_raw",
        )
        model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(fit)
        scored = model.transform(data).withColumn("score", F.get(vector_to_array("forest_probability"), F.lit(1)))
    return scored.select(
        "doc_id", F.col("word_at").cast("long").alias("word_at"), F.col("run_at").cast("long").alias("run_at"), "candidate",
        F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("secret"),
    )


def learning_rows() -> Column:
    return ~fold("doc_id", 4).isin(2, -1)


def mask_secrets(documents: DataFrame) -> DataFrame:
    """``documents`` with every secret replaced by a mark, all columns kept; ``n_chars`` follows where there is one."""
    key, secrets = free_name(documents, "secret_id"), free_name(documents, "secret_values")
    found = scan(documents, learning_rows()).where("secret").groupBy("doc_id").agg(F.collect_set("candidate").alias(secrets))
    joined = documents.join(found.withColumnRenamed("doc_id", key), F.col("doc_id").cast("long") == F.col(key), "left")
    longest_first = F.array_sort(F.col(secrets), lambda a, b: F.length(b) - F.length(a))
    text = F.when(
        F.col(secrets).isNotNull(), F.aggregate(longest_first, F.col("text"), lambda acc, s: F.replace(acc, s, F.lit(MASKED)))
    ).otherwise(F.col("text"))
    out = joined.withColumn("text", text)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col(secrets).isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)


@query()
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"), learning_rows())
