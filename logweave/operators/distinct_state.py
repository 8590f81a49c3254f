"""Exact distinct counts as states that can be stored and merged.

A set of hosts per key is kept as rows (key, bucket, bitmap): every host has a number from a
stored dictionary, a bucket holds 32,768 numbers and its bitmap one bit for each.  Numbers are
dense, so a set of n hosts is at most n / 32,768 + (buckets it touches) rows of 4 KB, whatever
the key; no row and no aggregation buffer grows with the hosts of a key.  States of parts (days,
files, runs) are merged with ``bitmap_or_agg`` and counted with ``bitmap_count``: exact, and
without the rows they came from.

* ``HostDictionary``    host -> number from 1, in the shared folder; it only grows, so that
  numbers given once stay valid.  New hosts are numbered by parts: only one count per part
  passes an un-partitioned window.
* ``distinct_state``    rows -> states, with map-side partial bitmaps
* ``merge_states``      states of finer keys -> states of coarser keys
* ``state_counts``      states -> exact distinct counts
* ``state_members``     states -> the set itself, one row per (key, host) (A6)

A null host is in no set, as in COUNT(DISTINCT host).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.session import scratch_dir

DICTIONARY_SCHEMA = "host string, host_id long"
BITMAP_BYTES = 4096


class HostDictionary:
    """Numbers of hosts, stored as Parquet generations under ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or scratch_dir(spark, "hosts")).rstrip("/")

    def frame(self) -> DataFrame:
        """(host, host_id) of every known host."""
        try:
            return self.spark.read.schema(DICTIONARY_SCHEMA).parquet(self.path)
        except Exception as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], DICTIONARY_SCHEMA)

    def extend(self, hosts: DataFrame) -> "HostDictionary":
        """Number the hosts (column ``host``) that are not known yet."""
        known = self.frame()
        last = known.agg(F.coalesce(F.max("host_id"), F.lit(0))).first()[0]
        fresh = (hosts.select("host").filter(F.col("host").isNotNull()).distinct()
                 .join(known, "host", "left_anti"))
        # stored with their part, so that a part's numbers cannot change between the two reads
        path = scratch_dir(self.spark, "fresh-hosts")
        fresh.withColumn("part", F.spark_partition_id()).write.parquet(path)
        parts = self.spark.read.parquet(path)
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
            "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        inside = F.row_number().over(Window.partitionBy("part").orderBy("host"))
        numbered = parts.withColumn("inside", inside).join(offsets, "part").select(
            "host", (F.lit(last) + F.col("offset") + F.col("inside")).cast("long").alias("host_id"))
        numbered.write.mode("append").parquet(self.path)
        return self


def distinct_state(rows: DataFrame, keys: Sequence[str], dictionary: HostDictionary,
                   where: Column | None = None) -> DataFrame:
    """(keys, bucket, bitmap) of the hosts of each key; ``where`` keeps some rows only (A5)."""
    kept = rows if where is None else rows.filter(where)
    pairs = kept.select(*keys, "host").distinct()            # map-side first: a hot pair is one row
    return (pairs.join(dictionary.frame(), "host")
            .groupBy(*keys, F.bitmap_bucket_number("host_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("host_id")).alias("bitmap")))


def merge_states(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """States by coarser keys: the union of the sets."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def state_counts(states: DataFrame, keys: Sequence[str], name: str = "distinct_hosts") -> DataFrame:
    """The size of each key's set; (key, bucket) must be unique, as after ``merge_states``."""
    return states.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(name))


def state_members(states: DataFrame, keys: Sequence[str], dictionary: HostDictionary) -> DataFrame:
    """The sets as rows (keys, host): a bitmap is opened byte by byte, empty bytes are skipped."""
    octets = F.transform(F.sequence(F.lit(1), F.lit(BITMAP_BYTES)), lambda i: F.struct(
        i.alias("place"), F.conv(F.hex(F.substring(F.col("bitmap"), i, F.lit(1))), 16, 10).cast("int").alias("octet")))
    set_octets = states.select(*keys, "bucket", F.explode(octets).alias("o")).filter("o.octet > 0")
    bits = set_octets.select(*keys, "bucket", F.col("o.place").alias("place"), F.col("o.octet").alias("octet"),
                             F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")).filter(
        F.expr("(octet >> bit) & 1 = 1"))
    number = ((F.col("bucket") - 1) * (8 * BITMAP_BYTES) + (F.col("place") - 1) * 8 + F.col("bit") + 1).cast("long")
    return bits.select(*keys, number.alias("host_id")).join(dictionary.frame(), "host_id").select(*keys, "host")
