"""Command line: run, report on and compare access-log analytics runs.

    python -m logweave run     --store DIR [--strategy fixed|monthly|weekly]
                               [--batch-size N] [--queries 1,3] [--variant dataframe|sql|two_stage]
                               [--missing skip|fail] [--tsv-output DIR] LOG [LOG ...]
    python -m logweave run-all --store DIR [same options] LOG [LOG ...]
    python -m logweave report  --store DIR RUN_ID
    python -m logweave compare --store DIR RUN_ID [RUN_ID ...]

``run`` prints the run id and report; ``run-all`` runs every variant, prints
each report and the pairwise comparison; ``compare`` checks every pair of the
given runs.  Every pair that differs gets up to five differing keys per query.  The
master is the submitted one (``spark-submit``, ``spark-defaults.conf``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from logweave.constants import DEFAULT_BATCH_SIZE
from logweave.operators.compare import all_diffs, compare_all_pairs, compare_summary
from logweave.operators.queries import in_order
from logweave.plans.job import VARIANTS, run_all, run_job
from logweave.plans.report import report_lines, run_report
from logweave.sinks.store import ResultStore, write_tsv_output


def _batch_size(text: str) -> int:
    """A non-numeric batch size keeps the default, as in the reference."""
    try:
        return int(text)
    except ValueError:
        return DEFAULT_BATCH_SIZE


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="logweave", description=__doc__.split("\n\n")[0])
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "run-all"):
        cmd = sub.add_parser(name)
        cmd.add_argument("logs", nargs="+", help="log files, folders or globs, in order")
        cmd.add_argument("--store", required=True, help="folder of the result tables")
        cmd.add_argument("--strategy", default="fixed",
                         help="fixed (default), monthly / month, weekly / week")
        cmd.add_argument("--batch-size", type=_batch_size, default=DEFAULT_BATCH_SIZE,
                         help="lines per fixed batch (default 10000)")
        cmd.add_argument("--queries", default="a", help="a (all) or a list like 1,3")
        cmd.add_argument("--missing", choices=("skip", "fail"), default="fail",
                         help="what to do about paths that do not exist")
        if name == "run":
            cmd.add_argument("--variant", choices=VARIANTS, default="dataframe")
            cmd.add_argument("--run-id", help="default: <variant>_<8 hex digits>")
            cmd.add_argument("--tsv-output",
                             help="also write each query result to DIR/<query> as TSV")
    rep = sub.add_parser("report")
    rep.add_argument("run_id", help="run to report on")
    rep.add_argument("--store", required=True)
    cmp = sub.add_parser("compare")
    cmp.add_argument("run_ids", nargs="+", help="runs to compare pairwise")
    cmp.add_argument("--store", required=True)
    return parser


def _session() -> SparkSession:
    """The submitted session; plain ``python`` starts Spark with its own default master."""
    return (SparkSession.builder.appName("logweave")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def _print_report(store: ResultStore, run_id: str) -> None:
    for line in report_lines(run_report(store, run_id)):
        print(line)


def _print_comparison(store: ResultStore, run_ids: list[str]) -> None:
    compare_all_pairs(store, run_ids).show(len(run_ids) ** 2 * 3, truncate=False)
    if len(run_ids) == 2:
        compare_summary(store, run_ids[0], run_ids[1]).show(truncate=False)
    for run_a, run_b, query, diffs in all_diffs(store, run_ids):
        print(f"-- {run_a} / {run_b} / {query}: first differences")
        diffs.show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        return _run(args)
    except (ValueError, FileNotFoundError) as exc:
        print(f"logweave: {type(exc).__name__}: {exc}", file=sys.stderr)
        return 2


def _run(args: argparse.Namespace) -> int:
    spark = _session()
    store = ResultStore(spark, args.store)
    if args.command == "run":
        job = run_job(spark, args.logs, args.strategy, args.batch_size, args.queries,
                      args.variant, store, args.variant, args.run_id, args.missing)
        print(job.run_id)
        if args.tsv_output:
            for q, frame in job.results.items():         # the stored rows, in order
                write_tsv_output(in_order(frame, q), f"{args.tsv_output.rstrip('/')}/{q}")
        _print_report(store, job.run_id)
    elif args.command == "run-all":
        runs = run_all(spark, args.logs, store, args.strategy, args.batch_size,
                       args.queries, missing=args.missing)
        for job in runs:
            _print_report(store, job.run_id)
        for variant, error in runs.failed.items():
            print(f"logweave: {variant} failed: {error}", file=sys.stderr)
        _print_comparison(store, [job.run_id for job in runs])
        return 1 if runs.failed else 0
    elif args.command == "report":
        _print_report(store, args.run_id)
    else:
        _print_comparison(store, args.run_ids)
    return 0


if __name__ == "__main__":
    sys.exit(main())
