"""A training-corpus pipeline of five operators, each stage's output the next one's input.

quality -> SimHash near-duplicates -> benchmark decontamination -> mixing -> sharding.
Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
to the shared folder as Parquet and reads it back for the next.

Results by case, the same in every stage: a null text counts as empty, and empty, blank and
very long texts are judged like others; null and repeated ids are rows of their own (a row is
never joined back by its id alone); of equal rows all but one fall to ``near_duplicates``; its
ties go to the smallest id, a null id being the largest; a null source is a source; columns
that are named like an operator's own pass through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import decontam, quality_rules, simhash_cover
from logweave.llm.common import apart, read_table
from logweave.llm.cube_mix import mixed_rows
from logweave.llm.shards import shard_rows
from logweave.session import remove_folder, scratch_dir, scratch_scope

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts to be good."""
    own, columns = apart(docs, quality_rules.OUTPUTS)
    scored = quality_rules.score_quality(own, read_table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    own, columns = apart(docs, simhash_cover.OUTPUTS)
    return simhash_cover.near_groups(own).filter("representative").select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    own, columns = apart(docs, decontam.OUTPUTS)
    found = decontam.find_items(own, read_table(spark, sf_dir, "benchmark"))
    return found.filter("not contaminated").select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there."""
    return shard_rows(docs, SHARDS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: the stages draw, learn and hash beyond what SQL can express; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's scratch tables and its input go once its output is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        if before is not None:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
