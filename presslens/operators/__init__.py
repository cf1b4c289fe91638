"""DataFrame -> DataFrame operators: filters, joins, windows, aggregates, sets,
sorts, projections, scoring, keyed store, sinks."""
