"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import scratch_dir

#: one packed input row; every operator keeps its own columns beside it
ROW = "__row"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run there are pickled by reference to their modules, and a worker
    need not have the package on its path.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="logweave-code-"), "logweave_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join("logweave", os.path.relpath(path, package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def col(name: str) -> Column:
    """A top-level column by its exact name (dots and blanks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The whole text of a row; null counts as empty."""
    return F.coalesce(df[f"`{name}`"].cast("string"), F.lit(""))


def pack(df: DataFrame, **columns: Column) -> DataFrame:
    """All input columns in one struct, so that working columns cannot clash with them."""
    row = F.struct(*[col(c).alias(c) for c in df.columns])
    return df.select(row.alias(ROW), *[c.alias(n) for n, c in columns.items()])


def unpack(packed: DataFrame, columns: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Input columns, then the outputs; an input column named as an output gives way."""
    taken = {o.lower() for o in outputs}
    kept = [F.col(ROW).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return packed.select(*kept, *[F.col(o) for o in outputs])


def apart(df: DataFrame, outputs: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns named like an output renamed, and the columns that undo it."""
    taken = {o.lower() for o in outputs}
    renamed = {c: f"__own_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    return df.withColumnsRenamed(renamed), [col(renamed.get(c, c)).alias(c) for c in df.columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
