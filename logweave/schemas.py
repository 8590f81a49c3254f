"""StructTypes of parsed rows, query results and run / batch metadata."""

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampType)

# One parsed access-log line (the staged / external-table layout).
LOG_SCHEMA = StructType([
    StructField("host", StringType()),
    StructField("ts", StringType()),
    StructField("log_date", DateType()),
    StructField("log_hour", IntegerType()),
    StructField("http_method", StringType()),
    StructField("resource_path", StringType()),
    StructField("protocol_version", StringType()),
    StructField("status_code", IntegerType()),
    StructField("bytes_transferred", LongType()),
])
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]

Q1_SCHEMA = StructType([
    StructField("log_date", DateType()),
    StructField("status_code", IntegerType()),
    StructField("request_count", LongType()),
    StructField("total_bytes", LongType()),
])
Q2_SCHEMA = StructType([
    StructField("resource_path", StringType()),
    StructField("request_count", LongType()),
    StructField("total_bytes", LongType()),
    StructField("distinct_host_count", LongType()),
])
Q3_SCHEMA = StructType([
    StructField("log_date", DateType()),
    StructField("log_hour", IntegerType()),
    StructField("error_request_count", LongType()),
    StructField("total_request_count", LongType()),
    StructField("error_rate", DoubleType()),
    StructField("distinct_error_hosts", LongType()),
])
RESULT_SCHEMAS = {"q1": Q1_SCHEMA, "q2": Q2_SCHEMA, "q3": Q3_SCHEMA}
RESULT_KEYS = {"q1": ["log_date", "status_code"],
               "q2": ["resource_path"],
               "q3": ["log_date", "log_hour"]}

# the last column of output that is written with its ranks
RANK_COLUMN = "output_rank"

# Columns every stored result row carries.
RUN_TAG_SCHEMA = StructType([
    StructField("pipeline_name", StringType()),
    StructField("run_id", StringType()),
    StructField("batch_id", LongType()),
    StructField("execution_time", TimestampType()),
])

RUN_METADATA_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("pipeline_name", StringType()),
    StructField("batch_strategy", StringType()),
    StructField("batch_size", LongType()),
    StructField("total_records", LongType()),
    StructField("malformed_records", LongType()),
    StructField("num_batches", LongType()),
    # wider than the reference's DECIMAL(10,2): a monthly batch of a very large log
    # averages far more than 10^8 lines
    StructField("avg_batch_size", DecimalType(20, 2)),
    StructField("runtime_seconds", DecimalType(10, 3)),
    StructField("started_at", TimestampType()),
    StructField("completed_at", TimestampType()),
    # the queries the run executed, e.g. "q1,q3"
    StructField("queries", StringType()),
])

BATCH_METADATA_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("pipeline_name", StringType()),
    StructField("batch_sequence", LongType()),
    StructField("batch_key", StringType()),
    StructField("batch_strategy", StringType()),
    StructField("total_records", LongType()),
    StructField("valid_records", LongType()),
    StructField("malformed_records", LongType()),
    StructField("started_at", TimestampType()),
    StructField("completed_at", TimestampType()),
])
