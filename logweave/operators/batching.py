"""Logical batches over the input lines.

Queries run once over all lines; batches only drive the per-batch accounting
(``batch_metadata``) and the run totals (``run_metadata``).

* FIXED: consecutive runs of ``batch_size`` lines across file boundaries, keys
  ``batch_1``, ``batch_2``, ...: batch number from the global line index.
* MONTHLY / WEEKLY: calendar key from the line's bracketed date; lines without
  one form the batch ``__malformed__``; batches are numbered in order of first
  appearance (minimum input position per key).

Every count is a grouped aggregate with map-side partial aggregation.  The
un-partitioned steps work on small derived frames only: the numbering of the
per-key frame (bounded by the number of calendar keys) and, for FIXED, the
prefix sum over the parts of the per-split frame (one row per part).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.constants import DEFAULT_BATCH_SIZE
from logweave.functions.batchkeys import calendar_key, fixed_key, normalise_strategy
from logweave.operators.lineindex import persisted_positions, with_line_index
from logweave.sources.text import ORDER_COLUMNS, SEGMENT_COLUMNS

BATCH_STATS_COLUMNS = ["batch_sequence", "batch_key", "total_records",
                       "valid_records", "malformed_records"]


def _counts():
    return [F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("is_malformed")).alias("malformed_records")]


def _finish(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("batch_sequence").cast("long").alias("batch_sequence"),
        "batch_key",
        "total_records",
        (F.col("total_records") - F.col("malformed_records")).alias("valid_records"),
        "malformed_records")


def fixed_batch_stats(parsed: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE,
                      persisted: bool = False) -> DataFrame:
    """Per fixed-size batch: total / valid / malformed line counts.

    ``persisted``: the rows are read from a stored table.  Otherwise the position
    columns are stored first (see ``lineindex``).
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    narrow = parsed.select(*ORDER_COLUMNS, "is_malformed")
    indexed = with_line_index(narrow if persisted else persisted_positions(narrow))
    number = (F.expr(f"line_index div {int(batch_size)}") + 1).cast("long")    # exact integer
    per_batch = indexed.groupBy(number.alias("batch_sequence")).agg(*_counts())
    return _finish(per_batch.withColumn("batch_key", fixed_key(F.col("batch_sequence"))))


def calendar_batch_stats(parsed: DataFrame, strategy: str) -> DataFrame:
    """Per month / ISO week (and ``__malformed__``), in first-appearance order.

    Two aggregates: per (key, input split) with numeric buffers only - a hash
    aggregate with map-side partial results - then per key over that small
    frame, where the first appearance is the minimum (split, first sequence).
    A single ``min(struct(..., file path, ...))`` over the lines would force a
    sort-based aggregate, i.e. a sort of every input row.
    """
    key = calendar_key(strategy, F.col("batch_date"))
    per_split = parsed.groupBy(key.alias("batch_key"), *SEGMENT_COLUMNS).agg(
        *_counts(), F.min("src_seq").alias("src_seq"))
    first_seen = F.min(F.struct(*ORDER_COLUMNS)).alias("first_seen")
    per_key = per_split.groupBy("batch_key").agg(
        F.sum("total_records").cast("long").alias("total_records"),
        F.sum("malformed_records").cast("long").alias("malformed_records"),
        first_seen)
    order = Window.orderBy("first_seen")
    return _finish(per_key.withColumn("batch_sequence", F.row_number().over(order)))


def batch_stats(parsed: DataFrame, strategy: str = "fixed",
                batch_size: int = DEFAULT_BATCH_SIZE, persisted: bool = False) -> DataFrame:
    """B8 for any strategy; ``parsed`` needs ``is_malformed``, ``batch_date``
    (calendar strategies) and the source order columns.  ``persisted``: see
    ``fixed_batch_stats``."""
    strategy = normalise_strategy(strategy)
    if strategy == "fixed":
        return fixed_batch_stats(parsed, batch_size, persisted)
    return calendar_batch_stats(parsed, strategy)


def run_stats(stats: DataFrame, strategy: str, batch_size: int) -> DataFrame:
    """One row of run totals from the per-batch frame."""
    total = F.coalesce(F.sum("total_records"), F.lit(0)).cast("long")
    malformed = F.coalesce(F.sum("malformed_records"), F.lit(0)).cast("long")
    batches = F.count(F.lit(1)).cast("long")
    agg = stats.agg(total.alias("total_records"), malformed.alias("malformed_records"),
                    batches.alias("num_batches"))
    avg = F.when(F.col("num_batches") > 0,
                 F.col("total_records") / F.col("num_batches")).otherwise(F.lit(0.0))
    return agg.select(
        F.lit(normalise_strategy(strategy)).alias("batch_strategy"),
        F.lit(int(batch_size)).cast("long").alias("batch_size"),
        "total_records", "malformed_records", "num_batches",
        avg.cast("double").alias("avg_batch_size"))
