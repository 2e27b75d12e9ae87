"""DataFrame -> DataFrame operators (grouping, joins, sets, sampling, numbering)."""
