"""DataFrame operators: selection, joins, aggregation, windows, merges."""
