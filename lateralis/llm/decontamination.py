"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed is the hash of the tokens at the fixed positions of a mask; the positions between are ignored. The two
masks below find every stretch of 13 aligned tokens with at most 2 substitutions (each pair of substituted
positions leaves a place for one of them), and items shorter than that are found by one seed over all their
words. Seeds of all positions of all documents are made inside one generated stage and probe the broadcast
benchmark seeds there, so only hits leave the scan. A hit that continues the hit before it on its diagonal is
dropped; around the others the aligned tokens are compared and a window of 13 with at most 2 substitutions (all
words of a shorter item) makes the document contaminated.

The benchmark is broadcast in parts of about ``SEEDS`` seeds, by a hash of the item; more parts are more scans. A seed
carries its place and the number of its item; the tokens of each item are broadcast once beside them, so a part grows
with the words of its items, at least one item, and no faster.

Defined results: a null or empty text matches nothing, nor does an item without words; A-Z are folded; tokens are the
runs of characters outside ``\\x20\\x09-\\x0D``; repeated rows and items each match; a document id that occurs more
than once is judged as one document, a null id is never removed. Tokens are identified by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import free_name, query, table

WINDOW = 13
SUBSTITUTIONS = 2
#: Fixed masks, lossless together for two substitutions in thirteen tokens.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
SEEDS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def token_hashes(text: str):
    words = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, tokens: str, mask: tuple[int, ...], keep: list[str]) -> DataFrame:
    """One row per position where the mask fits: (keep..., at, seed)."""
    span = mask[-1] + 1
    places = F.expr(f"CASE WHEN size({tokens}) >= {span} THEN sequence(0, size({tokens}) - {span}) ELSE CAST(array() AS ARRAY<INT>) END")
    placed = rows.select(*keep, F.explode(places).alias("at"))
    return placed.select(*keep, "at", F.xxhash64(*[F.expr(f"get({tokens}, at + {o})") for o in mask]).alias("seed"))


def matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, substitutions: int = SUBSTITUTIONS) -> DataFrame:
    """(doc_id, item_id, matched): the most equal tokens of a qualifying alignment of each contaminated pair."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), token_hashes("text").alias("t")).where("size(t) > 0")
    items = items.distinct().withColumn("item", F.xxhash64("item_id", "t"))
    sizes = items.select(F.size("t").alias("size"))
    short = [r[0] for r in sizes.where(F.col("size") < window).distinct().sort("size").collect()]  # below ``window`` values
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // SEEDS))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), token_hashes("text").alias("h"))
    # a seed over all words is for items of that length only; each mask is a small generated stage of its own
    masks = [(m, items) for m in MASKS] + [(tuple(range(n)), items.where(F.size("t") == n)) for n in short]
    found = []
    for mask, own in masks:
        for part in range(parts):
            chosen = own.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == part) if parts > 1 else own
            seeds = _seeds(chosen, "t", mask, ["item", "t"]).select(F.col("seed").alias("s"), F.col("at").alias("place"), "item")
            hits = _seeds(rows, "h", mask, ["doc_id", "h"]).join(F.broadcast(seeds), F.col("seed") == F.col("s"))
            found.append(_judged(hits.join(F.broadcast(chosen), "item"), mask, window, substitutions))
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def _judged(hits: DataFrame, mask: tuple[int, ...], window: int, substitutions: int) -> DataFrame:
    """(doc_id, item_id, matched) of the hits of one mask whose alignment qualifies."""
    # only the aligned parts leave the generated stage, which holds the hits of one document at a time
    low, width = "greatest(0, place - at)", f"least({window}, size(t))"
    n = f"(least(size(t), size(h) - at + place) - {low})"
    same = " AND ".join(f"get(h, at - 1 + {o}) = get(t, place - 1 + {o})" for o in mask)
    aligned = hits.where(f"{n} >= {width}").where(f"NOT coalesce(place > 0 AND at > 0 AND {same}, false)").select(
        "doc_id", "item_id", F.expr(f"slice(h, {low} + at - place + 1, {n})").alias("h"), F.expr(f"slice(t, {low} + 1, {n})").alias("part"),
        F.expr(width).alias("width"), F.expr(f"IF(size(t) < {window}, 0, {substitutions})").alias("allowed"),
    )
    # an explode of one array keeps the comparison out of the join's condition, which has to be compiled
    compared = aligned.select(
        "doc_id", "item_id", "width", "allowed", F.explode(F.expr("array(zip_with(h, part, (a, b) -> CAST(a = b AS INT)))")).alias("same")
    )
    good = "exists(sequence(1, size(same) - width + 1), s -> aggregate(slice(same, s, width), 0, (a, x) -> a + x) >= width - allowed)"
    return compared.where(good).select(
        "doc_id", "item_id", F.expr("CAST(aggregate(same, 0, (a, x) -> a + x) AS LONG)").alias("matched")
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the contaminated ones, all columns kept."""
    key = free_name(documents, "contaminated_id")
    found = matches(documents, benchmark).select(F.col("doc_id").alias(key)).distinct()
    return documents.join(found, F.col("doc_id").cast("long") == F.col(key), "left_anti")


@query("""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS h FROM documents),
i AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS t FROM benchmark),
dg AS (SELECT doc_id, unnest(range(1, len(h) + 1)) AS p, h FROM d),
ig AS (SELECT item_id, unnest(range(1, len(t) + 1)) AS q, t, least(4, len(t)) AS g FROM i WHERE len(t) > 0),
hits AS (SELECT DISTINCT doc_id, item_id, p - q AS shift FROM dg JOIN ig ON h[p] = t[q] AND
         array_to_string(h[p:p + 3], ' ') = array_to_string(t[q:q + 3], ' ') WHERE p + g - 1 <= len(h) AND q + g - 1 <= len(t)),
a AS (SELECT doc_id, item_id, len(t) AS n, list_transform(range(greatest(1, 1 - shift), least(len(t), len(h) - shift) + 1),
         lambda j: CAST(h[j + shift] = t[j] AS INTEGER)) AS same FROM hits JOIN d USING (doc_id) JOIN i USING (item_id)),
w AS (SELECT *, least(13, n) AS width, CASE WHEN n < 13 THEN 0 ELSE 2 END AS allowed FROM a),
v AS (SELECT *, list_max(list_transform(range(1, len(same) - width + 2), lambda s: list_sum(same[s:s + width - 1]))) AS best FROM w WHERE len(same) >= width)
SELECT doc_id, item_id, CAST(max(list_sum(same)) AS BIGINT) AS matched FROM v WHERE best >= width - allowed GROUP BY doc_id, item_id""")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
