"""Filters, joins, aggregations, ordered rows, reshaping and table maintenance on DataFrames."""
