"""Staged parsed rows and engine output read back.

Staged TSV rows are read as text and split explicitly: a row needs at least
nine tab-separated fields (trailing empty fields do not count, as with a
Java ``split``) and is skipped otherwise; fields are then cast with
``try_cast`` (a bad number becomes NULL, as a typed Pig / Hive load does).
``DROPMALFORMED`` is not used: its row filtering depends on column pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logweave.schemas import LOG_SCHEMA, RANK_COLUMN, RESULT_SCHEMAS

TSV_SEP = "\t"


def tsv_fields(line: Column) -> Column:
    """Fields of a TSV row with trailing empty fields dropped."""
    return F.split(F.regexp_replace(line, r"\t+\z", ""), TSV_SEP)


def typed_tsv(spark: SparkSession, path: str, schema: StructType,
              min_fields: int | None = None, empty_as: str | None = "") -> DataFrame:
    """Rows of tab-separated text files typed by ``schema``.

    Blank rows and rows with fewer than ``min_fields`` fields are skipped.
    Empty string fields read back as ``empty_as`` for string columns.
    """
    min_fields = len(schema.fields) if min_fields is None else min_fields
    fields = tsv_fields(F.col("value"))
    rows = (spark.read.text(path)
            .filter(F.trim(F.col("value")) != "")
            .select(fields.alias("f"))
            .filter(F.size("f") >= min_fields))
    cols = []
    for i, field in enumerate(schema.fields):
        raw = F.get(F.col("f"), i)
        if field.dataType.typeName() == "string":
            col = F.coalesce(raw, F.lit(empty_as)) if empty_as is not None else raw
        else:
            col = raw.try_cast(field.dataType)
        cols.append(col.alias(field.name))
    return rows.select(*cols)


def read_staged_tsv(spark: SparkSession, path: str) -> DataFrame:
    """S5 + S7: staged parsed rows with declared types."""
    return typed_tsv(spark, path, LOG_SCHEMA, min_fields=9)


def read_staged_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _typed_select(path_table: str) -> str:
    """The columns of a staged TSV row, typed, in SQL."""
    fields = "split(regexp_replace(value, '\\\\t+\\\\z', ''), '\\t')"
    columns = []
    for i, field in enumerate(LOG_SCHEMA.fields):
        raw = f"get(f, {i})"
        kind = field.dataType.simpleString()
        columns.append(f"coalesce({raw}, '') AS {field.name}" if kind == "string"
                       else f"try_cast({raw} AS {kind}) AS {field.name}")
    return (f"SELECT {', '.join(columns)} FROM (SELECT {fields} AS f FROM {path_table} "
            f"WHERE trim(value) <> '') WHERE size(f) >= {len(LOG_SCHEMA.fields)}")


def register_external_table(spark: SparkSession, path: str, name: str = "access_logs",
                            fmt: str = "tsv") -> DataFrame:
    """Drop and re-create a catalog table over a staged directory.

    The table outlives the session: every session of the same catalog sees it.  Parquet is one
    external table with the declared schema.  TSV is an external table of lines
    (``<name>_lines``) and a stored view ``name`` that types them, so the ``>= 9 fields`` guard
    and the TSV conventions of the staging writer hold for SQL users too.  The files are not the
    table's: dropping it leaves them.
    """
    drop_external_table(spark, name)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    if fmt == "tsv":
        spark.sql(f"CREATE TABLE {name}_lines (value STRING) USING text LOCATION '{where}'")
        spark.sql(f"CREATE VIEW {name} AS {_typed_select(name + '_lines')}")
    else:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{where}'")
    return spark.table(name)


def drop_external_table(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalog; the staged files stay."""
    kinds = {f"{name}": None, f"{name}_lines": None}
    for table in kinds:
        if spark.catalog.tableExists(table):
            view = spark.catalog.getTable(table).tableType == "VIEW"
            spark.sql(f"DROP {'VIEW' if view else 'TABLE'} {table}")


def read_query_output(spark: SparkSession, path: str, query: str) -> DataFrame:
    """A query's tab-separated output directory read back, typed.

    Output written with ranks (``write_tsv_output(..., ranked=True)``) comes back in rank
    order, whatever the order of its part files.
    """
    fields = RESULT_SCHEMAS[query].fields
    schema = StructType([*fields, StructField(RANK_COLUMN, LongType())])
    rows = typed_tsv(spark, path, schema, min_fields=len(fields))
    return rows.orderBy(F.col(RANK_COLUMN).asc_nulls_last()).drop(RANK_COLUMN)


def read_ranked_output(spark: SparkSession, path: str, query: str) -> DataFrame:
    """S8 with the rank of each row (``rank``, from 1) as a column."""
    schema = StructType([*RESULT_SCHEMAS[query].fields, StructField(RANK_COLUMN, LongType())])
    return typed_tsv(spark, path, schema).withColumnRenamed(RANK_COLUMN, "rank").orderBy("rank")
