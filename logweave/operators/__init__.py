"""Distributed operators: the three queries, batching, the global line index and
run comparison - all grouped aggregates, joins and windows on DataFrames."""
