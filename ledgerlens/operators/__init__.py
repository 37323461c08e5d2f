"""DataFrame operators: aggregates, joins, windows, cleaning, encoding, selection, scaling."""
