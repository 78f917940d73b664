"""DataFrame -> DataFrame operators: selection, joins, aggregates, windows, checks."""
