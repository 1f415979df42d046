"""One named query per operator on the supplied star-schema tables, with an equivalent SQL where SQL can say it."""

from lateralis.checks import aggregates, basins, columns, joins, models, rows, scans, scoring, splits  # noqa: F401
from lateralis.checks.registry import all_oracles, all_queries  # noqa: F401
