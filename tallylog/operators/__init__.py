"""DataFrame -> DataFrame operators: parse, batches, aggregates, joins, ranking, set ops."""
