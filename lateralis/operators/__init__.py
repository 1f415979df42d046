"""DataFrame operators: filters, joins, aggregates, scalers, models and spatial joins."""
