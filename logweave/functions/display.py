"""Report display expressions (P15) and sink truncation (P10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.constants import (REPORT_PATH_KEEP, REPORT_PATH_WIDTH,
                                REPORT_RATE_DECIMALS, RESOURCE_PATH_MAX)


def display_path(path: Column) -> Column:
    """Paths longer than the report column are cut and end in '...'."""
    return F.when(F.length(path) > REPORT_PATH_WIDTH,
                  F.concat(F.substring(path, 1, REPORT_PATH_KEEP), F.lit("..."))
                  ).otherwise(path)


def display_rate(rate: Column) -> Column:
    return F.round(rate, REPORT_RATE_DECIMALS)


def sink_path(path: Column) -> Column:
    """resource_path as a database column of fixed width takes it."""
    return F.substring(path, 1, RESOURCE_PATH_MAX)
