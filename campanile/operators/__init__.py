"""DataFrame-to-DataFrame operators: filters, joins, reports, state changes, extraction, inventory."""
