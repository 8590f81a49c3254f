"""logweave: web access-log analytics as Spark DataFrame / SQL plans.

Raw log lines are parsed with column expressions, assigned to logical batches,
aggregated by three fixed queries, written to partitioned result tables and
compared run against run.

    from logweave import ResultStore, run_job, run_report, format_report
"""

from logweave.operators.compare import (compare_all_pairs, compare_runs,
                                        compare_summary)
from logweave.plans.job import JobResult, run_all, run_job
from logweave.plans.report import format_report, run_report
from logweave.sinks.store import ResultStore
from logweave.sources.text import read_log_lines
from logweave.functions.parse import parse_lines, valid_rows

__version__ = "0.1.0"

__all__ = ["JobResult", "ResultStore", "compare_all_pairs", "compare_runs",
           "compare_summary", "format_report", "parse_lines", "read_log_lines",
           "run_all", "run_job", "run_report", "valid_rows"]
