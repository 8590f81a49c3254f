"""Exact de-duplication through an extendible-hash index on shared files.

Only DataFrame operations.  The key of a text is its 64-bit hash.

1. *Directory doubling*: the distinct keys are counted for every prefix length.  A prefix
   longer by one bit is one doubling: an overfull bucket splits in two, until it
   holds at most ``bucket_rows`` keys or is at the deepest level.  The directory
   has a slot for each used prefix of the global depth, naming its bucket.
2. *Routing*: every row goes through the directory - the prefix of its key is a slot, the
   slot names its bucket - before anything is grouped.  A key without a slot is an error.
   *Entries* - bucket, key, id, row number, SHA-256 and length - are written once to the
   shared folder; later steps read only that file, so a row keeps its number whatever
   happens to executors or split sizes.
3. *Byte comparison* inside a bucket: texts are grouped by (bucket, key, text), which compares
   the bytes of all texts of one key.  Copies collapse inside each map task before the
   exchange, so a group holding a third of all rows sends one row per task.  Texts
   that differ under one key become a chain: positions 0, 1, ... in that key.
4. *Owner tasks*: the buckets' pages - a text's head row, group size and chain place - are
   range-partitioned by bucket and key, so that each task writes whole key ranges, and every
   entry looks its page up in its bucket.

Defined results: null text is the empty text.  Ids are integers; a null id is
smaller than any other, and if every id of a group is null, ``keep_id`` is null.
Of rows that repeat both text and id exactly one is kept.  An empty table gives
an empty result.  The other input columns come back as they are; one that is named
like an output gives way to it.  The text is not carried along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm.common import ROW, col, stored, text_of, unpack

#: keys a bucket may hold before it splits
BUCKET_ROWS = 65536
#: levels below an even spread at which a bucket stops splitting
SPARE_BITS = 4

OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256", "chain_position")


@dataclass(frozen=True)
class HashIndex:
    """Stored tables of one index: ``entries`` (a row each), ``directory``, ``pages``."""

    entries: DataFrame
    directory: DataFrame
    pages: DataFrame
    global_depth: int


def _prefix(key: Column, bits: int) -> Column:
    """The top ``bits`` (0 to 62) bits of a key, as a number that is never negative."""
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 2), 62 - bits)


def directory_of(keys: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """The directory (slot, bucket, local_depth, load) of distinct keys and its global depth."""
    total = keys.count()
    deepest = 0
    if total > bucket_rows:
        deepest = min(40, math.ceil(math.log2(total / bucket_rows)) + SPARE_BITS)
    loads = (keys.groupBy(_prefix(F.col("key"), deepest).alias("leaf"))
             .agg(F.count(F.lit(1)).alias("load"))
             .select("leaf", "load", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth"))
             .groupBy("depth", F.expr(f"shiftrightunsigned(leaf, {deepest} - depth)").alias("prefix"))
             .agg(F.sum("load").alias("load")))
    overfull = loads.filter((F.col("load") > bucket_rows) & (F.col("depth") < deepest)).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    halves = loads.withColumn("parent", F.shiftrightunsigned("prefix", 1)).join(
        overfull, ["depth", "parent"], "left_semi")
    buckets = (loads.filter("depth = 0").select("depth", "prefix", "load")
               .unionByName(halves.select("depth", "prefix", "load"))
               .filter((F.col("load") <= bucket_rows) | (F.col("depth") == deepest)))
    buckets = stored(buckets, "exact-buckets")
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    slots = buckets.select(
        F.explode(F.expr(f"sequence(shiftleft(prefix, {depth} - depth), "
                         f"shiftleft(prefix + 1, {depth} - depth) - 1)")).alias("slot"),
        F.expr(f"shiftleft(prefix, {deepest} - depth)").alias("bucket"),
        F.col("depth").alias("local_depth"), "load")
    return slots, depth


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_rows: int = BUCKET_ROWS) -> HashIndex:
    """Index every row of ``df`` by its whole text."""
    text = text_of(df, text_col)
    keys = stored(df.select(F.xxhash64(text).alias("key")).distinct(), "exact-keys")
    directory, depth = directory_of(keys, bucket_rows)
    directory = stored(directory, "exact-directory")
    others = [c for c in df.columns if c.lower() != text_col.lower()]
    entries = stored(routed(df.select(
        F.struct(*[col(c).alias(c) for c in others]).alias(ROW), col(id_col).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("number"), F.xxhash64(text).alias("key"),
        F.sha2(text, 256).alias("sha"), F.octet_length(text).cast("long").alias("bytes")),
        directory, depth), "exact-entries")
    of_text = ["bucket", "key", "sha"]
    # equal texts collapse in the map tasks, before and after the directory
    texts = df.select(F.xxhash64(text).alias("key"), text.alias("content")).groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("equal_rows"))
    compared = (routed(texts, directory, depth).groupBy("bucket", "key", "content").agg(
        F.sum("equal_rows").alias("equal_rows")).select(
        "bucket", "key", F.sha2("content", 256).alias("sha"), "equal_rows"))
    heads = entries.groupBy(*of_text).agg(
        F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "number")).alias("head"),
        F.count(F.lit(1)).alias("entry_rows"), F.max("bytes").alias("bytes"))
    group_size = F.when(F.col("entry_rows") == F.col("equal_rows"), F.col("equal_rows")).otherwise(
        F.raise_error(F.lit("exact index: two texts share a digest but not their bytes")).cast("long"))
    chain = F.row_number().over(W.partitionBy("bucket", "key").orderBy("sha")) - 1
    pages = heads.join(compared, of_text, "left").select(
        *of_text, "bytes", group_size.alias("group_size"), F.col("head.id").alias("keep_id"),
        F.col("head.number").alias("keep_number"), chain.alias("chain_position"))
    owned = stored(pages.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key"),
                   "exact-pages")
    return HashIndex(entries, directory, owned, depth)


def routed(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the bucket that the directory names for their ``key``."""
    lost = F.raise_error(F.lit("exact index: the directory has no slot for a key")).cast("long")
    found = rows.withColumn("slot", _prefix(F.col("key"), depth)).join(
        directory.select("slot", F.col("bucket").alias("named")), "slot", "left")
    return found.withColumn("bucket", F.coalesce("named", lost)).drop("slot", "named")


def look_up(index: HashIndex) -> DataFrame:
    """One row per indexed row: its input columns (without the text) and OUTPUTS."""
    pages = index.pages.select("bucket", "key", "sha", "group_size", "keep_id", "keep_number",
                               "chain_position")
    found = index.entries.join(pages, ["bucket", "key", "sha"], "left")
    columns = index.entries.schema[ROW].dataType.names
    return unpack(found.select(
        ROW, "keep_id", "group_size", (F.col("number") == F.col("keep_number")).alias("kept"),
        F.col("sha").alias("text_sha256"), "chain_position"), columns, OUTPUTS)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Group rows of equal text; of each group the row with the largest id stays."""
    return look_up(build_index(df, id_col, text_col, bucket_rows))
