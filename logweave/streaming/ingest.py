"""Incremental ingest of a log directory with Structured Streaming.

The reference loads its input batch by batch: parse a batch, load the parsed rows, record the
batch's total / valid / malformed counts.  Here a file-source stream over the log folder does
the same per micro-batch: ``maxFilesPerTrigger`` sets how many new files form one, and
``foreachBatch`` parses them with the same column expressions.

Logical batches (B1-B6, B8) do not depend on where micro-batches end.  Two pieces of state run
along: how many lines came before, which numbers the lines of an epoch on (B1: a fixed batch may
span epochs), and the least line number of every batch key (B5: order of first appearance).
Both are kept as each epoch's own small tables - its line count, and its counts and first line
per key - and never changed afterwards, so state is what earlier epochs have written.

Output goes to a folder per epoch, written with ``overwrite``: a micro-batch that is replayed
after a failure finds the same earlier epochs and replaces its own output, so the result is
exactly once.  The checkpoint lives in the output folder (the shared scratch folder on a
cluster).  The order of lines is that of the files' arrival: epoch, modification time, name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.constants import DEFAULT_BATCH_SIZE
from logweave.functions.batchkeys import batch_date, calendar_key, fixed_key, normalise_strategy
from logweave.functions.parse import parse_lines
from logweave.operators.batching import BATCH_STATS_COLUMNS
from logweave.operators.lineindex import with_line_index
from logweave.schemas import LOG_COLUMNS
from logweave.sources.text import decode_latin1

STRATEGIES = ("fixed", "monthly", "weekly")
EPOCH_POSITION = ["src_modified", "src_file", "src_block"]
PARTIAL_SCHEMA = ("strategy string, batch_key string, total_records long, malformed_records long, "
                  "first_line long")


@dataclass
class StreamResult:
    spark: SparkSession
    parsed_path: str
    batches_path: str

    def parsed(self) -> DataFrame:
        return self.spark.read.parquet(self.parsed_path)

    def valid(self) -> DataFrame:
        return self.parsed().filter(~F.col("is_malformed")).select(*LOG_COLUMNS)

    def batches(self, strategy: str | None = None) -> DataFrame:
        """B8 over everything ingested so far: the batches that the batch form gives for the
        strategy; without one, the micro-batches."""
        if strategy is None:
            return self.micro_batches()
        name = normalise_strategy(strategy)
        merged = (self.spark.read.schema(PARTIAL_SCHEMA).parquet(f"{self.batches_path}/partials")
                  .filter(F.col("strategy") == name).groupBy("batch_key").agg(
                      F.sum("total_records").cast("long").alias("total_records"),
                      F.sum("malformed_records").cast("long").alias("malformed_records"),
                      F.min("first_line").alias("first_line")))
        number = (F.substring_index("batch_key", "_", -1).cast("long") if name == "fixed"
                  else F.row_number().over(Window.orderBy("first_line")).cast("long"))   # calendar keys are few
        return merged.withColumn("batch_sequence", number).withColumn(
            "valid_records", F.col("total_records") - F.col("malformed_records")).select(*BATCH_STATS_COLUMNS)

    def micro_batches(self) -> DataFrame:
        """One row per micro-batch, numbered from 1 in processing order."""
        return (self.spark.read.parquet(f"{self.batches_path}/epochs")
                .select((F.col("batch_epoch") + 1).cast("long").alias("batch_sequence"),
                        F.concat(F.lit("stream_"), (F.col("batch_epoch") + 1).cast("string")).alias("batch_key"),
                        "total_records", "valid_records", "malformed_records")
                .orderBy("batch_sequence"))


def _lines_before(spark: SparkSession, epochs_path: str, epoch_id: int) -> int:
    """How many lines the earlier epochs hold (an epoch that is replayed does not count itself)."""
    if epoch_id == 0:
        return 0
    rows = spark.read.parquet(epochs_path).filter(F.col("batch_epoch") < epoch_id)
    return rows.agg(F.coalesce(F.sum("total_records"), F.lit(0))).first()[0]


def _partials(numbered: DataFrame, batch_size: int) -> DataFrame:
    """Counts and first line of every batch key of an epoch, for each strategy."""
    keys = {"fixed": fixed_key((F.expr(f"line_index div {int(batch_size)}") + 1).cast("long"))}
    keys |= {name: calendar_key(name, F.col("batch_date")) for name in ("monthly", "weekly")}
    return reduce(DataFrame.unionByName, [
        numbered.groupBy(key.alias("batch_key")).agg(
            F.count(F.lit(1)).alias("total_records"), F.count_if("is_malformed").alias("malformed_records"),
            F.min("line_index").alias("first_line")).withColumn("strategy", F.lit(name))
        for name, key in keys.items()])


def _process(parsed_path: str, batches_path: str, batch_size: int):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        lines = batch.select(
            decode_latin1().alias("line"), F.col("_metadata.file_modification_time").alias("src_modified"),
            F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("src_block"),
            F.monotonically_increasing_id().alias("src_seq"))
        parsed = parse_lines(lines.withColumn("batch_date", batch_date(F.col("line"))))
        position = [*EPOCH_POSITION, "src_seq"]
        epoch_path = f"{parsed_path}/batch_epoch={epoch_id}"
        parsed.select(*LOG_COLUMNS, "is_malformed", "batch_date", *position).write.mode("overwrite").parquet(epoch_path)
        # numbers and counts from the written rows: the batch is parsed once
        written = spark.read.parquet(epoch_path)
        offset = _lines_before(spark, f"{batches_path}/epochs", epoch_id)
        numbered = with_line_index(written.select("is_malformed", "batch_date", *position), EPOCH_POSITION).withColumn(
            "line_index", F.col("line_index") + F.lit(offset))
        _partials(numbered, batch_size).coalesce(1).write.mode("overwrite").parquet(
            f"{batches_path}/partials/batch_epoch={epoch_id}")
        # the line count comes last: with it the epoch counts as state for later ones
        written.agg(F.count(F.lit(1)).alias("total_records"),
                    F.count_if(~F.col("is_malformed")).alias("valid_records"),
                    F.count_if(F.col("is_malformed")).alias("malformed_records")).write.mode("overwrite").parquet(
            f"{batches_path}/epochs/batch_epoch={epoch_id}")
    return handle


def stream_ingest(spark: SparkSession, log_dir: str, out_dir: str, files_per_batch: int = 1,
                  batch_size: int = DEFAULT_BATCH_SIZE) -> StreamResult:
    """Ingest every file now in ``log_dir`` (available-now trigger) and stop.

    ``batch_size`` is that of the fixed batches; a stream keeps the size it began with.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    parsed_path, batches_path = f"{out_dir}/parsed", f"{out_dir}/batches"
    source = (spark.readStream.format("text")
              .option("maxFilesPerTrigger", files_per_batch)
              .load(log_dir).select("value", "_metadata"))
    query = (source.writeStream
             .foreachBatch(_process(parsed_path, batches_path, batch_size))
             .option("checkpointLocation", f"{out_dir}/_checkpoint")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return StreamResult(spark, parsed_path, batches_path)
