"""DataFrame operators: latest row, spines, as-of, joins, conforming, routing."""
