"""One run of the whole pipeline, and the run-all form.

``run_job`` reads the logs, parses every line once and writes the parsed rows
(valid and malformed, with their input position) to Parquet in the shared
scratch folder.  Everything after that reads the staged table: the batch
accounting reads three narrow columns, each query reads only its columns of
the valid rows (``is_malformed = false`` is pushed into the Parquet scan), and
nothing is parsed twice.  The staged table also cuts the lineage: a lost
executor re-runs a scan of Parquet, not the parse of the raw logs.

Variants (R8): ``dataframe``, ``sql`` and ``two_stage`` are three
formulations of the same queries; ``run_all`` runs them with shared settings
and appends every run to the store so the runs can be compared pairwise.  One that
fails does not stop the others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.constants import ALL_QUERIES, DEFAULT_BATCH_SIZE
from logweave.functions.batchkeys import batch_date, normalise_strategy
from logweave.functions.parse import parse_lines
from logweave.operators.batching import batch_stats, run_stats
from logweave.operators.queries import DATAFRAME_QUERIES, TWO_STAGE_QUERIES
from logweave.plans.sql import sql_query
from logweave.schemas import LOG_COLUMNS, RESULT_SCHEMAS
from logweave.session import remove_folder, scratch_dir, scratch_scope
from logweave.sinks.store import ResultStore, stage_parquet
from logweave.sources.text import ORDER_COLUMNS, read_log_lines, rebalance_lines

VARIANTS = ("dataframe", "sql", "two_stage")


def _decimal(value: float, step: str) -> Decimal:
    return Decimal(repr(float(value))).quantize(Decimal(step), rounding=ROUND_HALF_UP)


def select_queries(spec: str | Iterable[str] | None) -> tuple[str, ...]:
    """Any subset of q1, q2, q3 (``'1,3'``, ``['q2']``, ``'a'``).

    Unknown entries are ignored; an empty or unknown selection means all.
    """
    if spec is None:
        items: list[str] = []
    elif isinstance(spec, str):
        items = [] if spec.strip().lower() in ("", "a") else spec.split(",")
    else:
        items = list(spec)
    chosen = []
    for item in items:
        name = str(item).strip().lower()
        name = name if name.startswith("q") else f"q{name}"
        if name in ALL_QUERIES and name not in chosen:
            chosen.append(name)
    ordered = tuple(q for q in ALL_QUERIES if q in chosen)
    return ordered or ALL_QUERIES


def parse_for_staging(lines: DataFrame, with_batch_date: bool = True) -> DataFrame:
    """Parsed rows plus batch date, the malformed line text and input position.

    ``with_batch_date=False`` leaves ``batch_date`` NULL: fixed-size batching
    does not need it, and it is a second scan of every line.
    """
    date = batch_date(F.col("line")) if with_batch_date else F.lit(None).cast("date")
    parsed = parse_lines(lines.withColumn("batch_date", date), malformed_line="malformed_line")
    return parsed.select(*LOG_COLUMNS, "is_malformed", "batch_date", "malformed_line",
                         *ORDER_COLUMNS)


def run_query(spark: SparkSession, logs: DataFrame, query: str, variant: str = "dataframe",
              view: str | None = None, ordered: bool = True) -> DataFrame:
    """One query in one formulation over valid rows in LOG_SCHEMA layout."""
    if variant == "dataframe":
        return DATAFRAME_QUERIES[query](logs, ordered)
    if variant == "two_stage":
        return TWO_STAGE_QUERIES[query](logs, ordered)
    if variant == "sql":
        view = view or f"access_logs_{uuid.uuid4().hex[:8]}"
        logs.createOrReplaceTempView(view)
        return sql_query(spark, query, view, ordered)
    raise ValueError(f"unknown variant {variant!r}; expected one of {VARIANTS}")


@dataclass
class JobResult:
    """One run.

    Without a store the results are plans over the staged rows, and ``release``
    removes these when they are no longer wanted.  With a store the results are the
    stored rows and the staged input is removed at the end of the run, unless the
    caller keeps it.  ``staged`` holds every parsed line; its ``batch_date`` is NULL
    for a fixed-size run (not needed there, so not computed).
    """

    run_id: str
    pipeline_name: str
    strategy: str
    batch_size: int
    queries: tuple[str, ...]
    staged_path: str
    staged: DataFrame
    batches: DataFrame
    run_row: dict
    results: dict[str, DataFrame] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    batches_path: str = ""

    @property
    def valid(self) -> DataFrame:
        return _valid(self.staged)

    def release(self) -> None:
        """Remove the staged rows and the batch table of this run."""
        for path in (self.staged_path, self.batches_path):
            remove_folder(self.staged.sparkSession, path)


class Runs(list):
    """The finished runs of ``run_all``; ``failed`` maps a variant to what it raised."""

    def __init__(self):
        super().__init__()
        self.failed: dict[str, Exception] = {}


def _valid(staged: DataFrame) -> DataFrame:
    return staged.filter(~F.col("is_malformed")).select(*LOG_COLUMNS)


@dataclass(frozen=True)
class _Staged:
    """Parsed and batched input that variants share."""

    rows: DataFrame
    path: str
    batches: DataFrame
    batches_path: str
    totals: dict
    timings: dict[str, float]


def _stage(spark: SparkSession, paths, strategy: str, batch_size: int, name: str,
           missing: str) -> _Staged:
    """Parse and store the rows, then store their batches."""
    t0 = time.perf_counter()
    lines = rebalance_lines(read_log_lines(spark, paths, missing=missing))
    path = scratch_dir(spark, f"staged-{name}")
    stage_parquet(parse_for_staging(lines, with_batch_date=strategy != "fixed"), path)
    rows = spark.read.parquet(path)
    t1 = time.perf_counter()
    batches_path = scratch_dir(spark, f"batches-{name}")
    with scratch_scope(spark):                   # the tables of the line index
        batch_stats(rows, strategy, batch_size, persisted=True).write.parquet(batches_path)
    batches = spark.read.parquet(batches_path)
    totals = run_stats(batches, strategy, batch_size).first().asDict()
    return _Staged(rows, path, batches, batches_path, totals,
                   {"parse_stage": t1 - t0, "batching": time.perf_counter() - t1})


def _run_variant(spark: SparkSession, staged: _Staged, strategy: str, batch_size: int,
                 selected: tuple[str, ...], variant: str, store: ResultStore | None,
                 pipeline_name: str, run_id: str, started_at: datetime, before: float) -> JobResult:
    """Query the staged rows and store the run; ``before``: seconds that count already."""
    timings, t0 = dict(staged.timings), time.perf_counter()
    num_batches, batched_at = int(staged.totals["num_batches"]), datetime.now()
    results = {q: run_query(spark, _valid(staged.rows), q, variant, ordered=store is None)
               for q in selected}
    run_row = {
        "run_id": run_id, "pipeline_name": pipeline_name, "batch_strategy": strategy,
        "batch_size": int(batch_size), "total_records": int(staged.totals["total_records"]),
        "malformed_records": int(staged.totals["malformed_records"]), "num_batches": num_batches,
        "avg_batch_size": _decimal(staged.totals["avg_batch_size"], "0.01"),
        "started_at": started_at, "queries": ",".join(selected),
    }

    def finished() -> dict:
        run_row["runtime_seconds"] = _decimal(before + time.perf_counter() - t0, "0.001")
        run_row["completed_at"] = datetime.now()
        return run_row

    if store is None:
        finished()
    else:
        store.begin(pipeline_name, run_id)       # seen by readers as a whole, with the commit
        try:
            store.write_batch_metadata(staged.batches, pipeline_name, run_id, strategy,
                                       started_at, batched_at)
            for q, frame in results.items():
                t = time.perf_counter()
                store.write_results(q, frame, pipeline_name, run_id, num_batches, datetime.now())
                timings[q] = time.perf_counter() - t
            store.write_run_metadata(finished())
        except BaseException:
            store.abandon(run_id)
            raise
        store.commit(run_id)
        results = {q: store.results(q, run_id).select(*RESULT_SCHEMAS[q].fieldNames())
                   for q in selected}
    return JobResult(run_id=run_id, pipeline_name=pipeline_name, strategy=strategy,
                     batch_size=int(batch_size), queries=selected, staged_path=staged.path,
                     staged=staged.rows,
                     batches=store.batch_metadata(run_id) if store is not None else staged.batches,
                     run_row=run_row, results=results, timings=timings,
                     batches_path=staged.batches_path)


def _checked(strategy: str, batch_size: int, variants: Sequence[str]) -> str:
    strategy = normalise_strategy(strategy)
    if strategy == "fixed" and int(batch_size) <= 0:
        raise ValueError("batch_size must be positive")
    for variant in variants:
        if variant not in VARIANTS:
            raise ValueError(f"unknown variant {variant!r}; expected one of {VARIANTS}")
    return strategy


def run_job(spark: SparkSession, paths: str | Sequence[str], strategy: str = "fixed",
            batch_size: int = DEFAULT_BATCH_SIZE, queries=None, variant: str = "dataframe",
            store: ResultStore | None = None, pipeline_name: str | None = None,
            run_id: str | None = None, missing: str = "skip",
            keep_staged: bool = False) -> JobResult:
    """Parse, stage, batch, query and (optionally) write one run."""
    strategy = _checked(strategy, batch_size, [variant])
    pipeline_name = pipeline_name or variant
    run_id = run_id or f"{pipeline_name}_{uuid.uuid4().hex[:8]}"
    started_at, t0 = datetime.now(), time.perf_counter()
    if store is not None:
        store.claim(pipeline_name, run_id)
    staged = _stage(spark, paths, strategy, batch_size, run_id, missing)
    job = _run_variant(spark, staged, strategy, batch_size, select_queries(queries), variant, store,
                       pipeline_name, run_id, started_at, time.perf_counter() - t0)
    if store is not None and not keep_staged:
        job.release()
    return job


def run_all(spark: SparkSession, paths, store: ResultStore, strategy: str = "fixed",
            batch_size: int = DEFAULT_BATCH_SIZE, queries=None,
            variants: Sequence[str] = VARIANTS, run_prefix: str | None = None,
            missing: str = "skip", keep_staged: bool = False) -> Runs:
    """Every formulation with the same settings, each appended to ``store``.

    The logs are parsed and staged once, and a run's runtime is its queries and writes
    alone, so that runtimes compare; staging is in the timings.  A variant that fails
    is reported in ``failed`` and the others go on.
    """
    strategy = _checked(strategy, batch_size, variants)
    runs, selected = Runs(), select_queries(queries)
    staged = _stage(spark, paths, strategy, batch_size, run_prefix or "all", missing)
    for variant in variants:
        run_id = f"{run_prefix or variant}_{variant if run_prefix else uuid.uuid4().hex[:8]}"
        try:
            runs.append(_run_variant(spark, staged, strategy, batch_size, selected, variant, store,
                                     variant, run_id, datetime.now(), 0.0))
        except Exception as exc:        # whatever stops one formulation leaves the others
            runs.failed[variant] = exc
    if not keep_staged:
        for path in (staged.path, staged.batches_path):
            remove_folder(spark, path)
    return runs
