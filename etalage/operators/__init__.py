"""DataFrame operators: cleaning, joins, aggregates, ranking, marts and quality checks."""
