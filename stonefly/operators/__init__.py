"""DataFrame operators: columns, joins, aggregates, set ops, reshape, lookups,
community metrics, validation and name matching."""
