"""Sinks: staged parsed rows, query output directories and the result store
(query results, run and batch metadata as partitioned Parquet tables)."""
