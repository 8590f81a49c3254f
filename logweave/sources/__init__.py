"""Sources: raw text logs, staged parsed rows, engine output, fixtures."""

from logweave.sources.fixtures import (event_log_lines, fixture_log_dir,
                                       order_log_lines, write_log_files)
from logweave.sources.staged import (read_query_output, read_staged_parquet,
                                     read_staged_tsv, register_external_table)
from logweave.sources.text import ORDER_COLUMNS, SEGMENT_COLUMNS, read_log_lines

__all__ = ["ORDER_COLUMNS", "SEGMENT_COLUMNS", "event_log_lines", "fixture_log_dir",
           "order_log_lines", "read_log_lines", "read_query_output",
           "read_staged_parquet", "read_staged_tsv", "register_external_table",
           "write_log_files"]
