"""Column-expression functions: parsing, batch keys, display."""

from logweave.functions.batchkeys import (batch_date, calendar_key, fixed_key,
                                          month_key, normalise_strategy, week_key)
from logweave.functions.parse import parse_line_column, parse_lines, valid_rows

__all__ = ["batch_date", "calendar_key", "fixed_key", "month_key",
           "normalise_strategy", "parse_line_column", "parse_lines", "valid_rows",
           "week_key"]
