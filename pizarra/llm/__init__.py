"""Training-data operators: scans, joins, dedup, filters, archives, encoding."""
