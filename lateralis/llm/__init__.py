"""Operators of a training-data pipeline, with their queries."""

from lateralis.llm import decontamination, jaccard_join, language_id, lm_scoring, packing, periodic_runs, prefix_trie  # noqa: F401
from lateralis.llm import quality_rules, secret_scan, substring_dedup, topk_search, toxicity, warc  # noqa: F401
from lateralis.llm.registry import ORACLES, QUERIES  # noqa: F401
