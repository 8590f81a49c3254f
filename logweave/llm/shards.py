"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are stored once in blocks (the write's partitions) with their position.  If
block b holds m(b) rows and shard s shall hold c(s), the number of rows that b
sends to s in a uniform random shuffle is a multivariate hypergeometric draw.
The matrix of these numbers is never built whole: the blocks are the leaves of a
binary tree, a node splits its shards' rows between its two halves by one draw
that is seeded with the node, and a task walks from the root to its own block.
It thus gets its row of the matrix and, from the left halves it passes, the rows
that earlier blocks send to each shard.

Then: *permute locally* (a seeded permutation of the block's positions deals its
rows to the shards), *exchange* (rows move to the owner of a slice of a shard),
*permute again* (fresh random keys order every shard, cut into slices dealt by hash of the
key, so no task needs a whole shard).  Slots are gapless from 0 in each shard and
shard sizes differ by one row at most (law ``rows``).

Defined results: every row gets a place, repeated rows one each; values, nulls and
text lengths do not matter, as rows are placed by position alone; an empty table
gives an empty result; other columns come back as they are, and one that is named
like an output gives way to it.  With fewer rows than shards some shards are empty.
The same seed over the same stored blocks gives the same result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm.common import ROW, pack, ship_code, stored, unpack

#: numpy draws hypergeometric numbers exactly below this population
NUMPY_POPULATION = 10 ** 9
#: rows in one slice of a shard
SLICE_ROWS = 250_000

OUTPUTS = ("shard", "slot")


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes that differ by one at most, the larger ones first."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], dtype=np.int64)


def _log_choose_ratio(k: np.ndarray, mode: int, good: int, bad: int, draws: int) -> np.ndarray:
    """log P(k) - log P(mode) of the hypergeometric law, by summed log ratios."""
    low, high = int(k.min()), int(k.max())
    steps = np.arange(low, high, dtype=np.float64)          # ratio P(x + 1) / P(x)
    log_ratio = (np.log(good - steps) + np.log(draws - steps)
                 - np.log(steps + 1.0) - np.log(bad - draws + steps + 1.0))
    total = np.concatenate(([0.0], np.cumsum(log_ratio)))
    return (total - total[mode - low])[k - low]


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` out of good + bad, for populations of any size.

    Above numpy's bound: inversion over the whole stretch of 40 standard deviations
    around the mode; what lies outside has a probability below 1e-300.
    """
    if good + bad < NUMPY_POPULATION:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    share = good / (good + bad)
    spread = math.sqrt(draws * share * (1 - share) * (good + bad - draws) / (good + bad - 1))
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    reach = int(40 * spread) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1)
    weights = np.cumsum(np.exp(_log_choose_ratio(k, mode, good, bad, draws)))
    return int(k[np.searchsorted(weights, rng.random() * weights[-1], side="right")])


def split_draw(rng: np.random.Generator, colors: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate hypergeometric draw: marginal by marginal."""
    if int(colors.sum()) < NUMPY_POPULATION:
        return rng.multivariate_hypergeometric(colors, draws, method="marginals")
    out, rest = np.zeros_like(colors), int(colors.sum())
    for s, own in enumerate(colors):
        rest -= int(own)
        out[s] = hypergeometric(rng, int(own), rest, draws)
        draws -= int(out[s])
    return out


def matrix_row(block: int, starts: np.ndarray, sizes: np.ndarray,
               seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Row ``block`` of the communication matrix and the sum of the rows before it.

    ``starts``: rows before each block, then the number of all rows.
    """
    low, high = 0, len(starts) - 1
    own, before = sizes.astype(np.int64).copy(), np.zeros(len(sizes), dtype=np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, 0, low, high])
        left = split_draw(rng, own, int(starts[middle] - starts[low]))
        if block < middle:
            own, high = left, middle
        else:
            own, before, low = own - left, before + left, middle
    return own, before


def _placer(starts: np.ndarray, blocks: dict[int, int], sizes: np.ndarray, seed: int):
    """A pandas UDF: (block, position) -> shard and arrival number within the shard."""

    held: dict[int, tuple] = {}         # the block at hand, over the batches of a task

    def deal(number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if number not in held:
            own, before = matrix_row(number, starts, sizes, seed)
            rows = int(starts[number + 1] - starts[number])
            held.clear()
            held[number] = own, before, np.random.default_rng([seed, 1, number]).permutation(rows)
        return held[number]

    @F.pandas_udf("shard int, arrival long")
    def place(block: pd.Series, position: pd.Series) -> pd.DataFrame:
        shard = np.empty(len(block), dtype=np.int32)
        arrival = np.empty(len(block), dtype=np.int64)
        values, positions = block.to_numpy(), position.to_numpy()
        for value in np.unique(values):
            own, before, local = deal(blocks[int(value)])
            mine = values == value
            dealt = local[positions[mine]]
            edges = np.cumsum(own)
            to = np.searchsorted(edges, dealt, side="right")
            shard[mine] = to
            arrival[mine] = before[to] + dealt - (edges - own)[to]
        return pd.DataFrame({"shard": shard, "arrival": arrival})

    return place


def shard_rows(df: DataFrame, shards: int, seed: int = 1, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of ``df`` with ``shard`` (int, from 0) and ``slot`` (long, from 0)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    ship_code(df.sparkSession)
    number = F.monotonically_increasing_id()      # block in the upper 31 bits, then position
    rows = stored(pack(df, block=F.shiftright(number, 33).cast("int"),
                       position=number.bitwiseAND((1 << 33) - 1)), "shard-blocks")
    counts = sorted((r.block, r["count"]) for r in rows.groupBy("block").count().collect())
    starts = np.concatenate(([0], np.cumsum([n for _, n in counts]))).astype(np.int64)
    blocks = {b: i for i, (b, _) in enumerate(counts)}
    total = int(starts[-1])
    sizes = shard_sizes(total, shards)
    slices = max(1, math.ceil(total / shards / slice_rows))
    placed = (rows.withColumn("at", _placer(starts, blocks, sizes, seed)("block", "position"))
              .select(ROW, F.col("at.shard").alias("shard"), F.col("at.arrival").alias("arrival"))
              .withColumn("key", F.xxhash64(F.lit(seed), "shard", "arrival"))
              .withColumn("slice", F.pmod(F.shiftright("key", 32), F.lit(slices)).cast("int")))
    # sizes of the slices before a slice: from the arrival numbers alone, no text
    arrivals = df.sparkSession.range(total).select(
        F.expr(f"int(id % {shards})").alias("shard"), F.expr(f"id div {shards}").alias("arrival"))
    slice_of = F.pmod(F.shiftright(F.xxhash64(F.lit(seed), "shard", "arrival"), 32),
                      F.lit(slices)).cast("int")
    counted = arrivals.groupBy("shard", slice_of.alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    before = counted.select("shard", "slice", (F.sum("n").over(
        W.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("before"))
    order = W.partitionBy("shard", "slice").orderBy("key", "arrival")
    ranked = placed.withColumn("rank", F.row_number().over(order) - 1)
    slots = ranked.join(before, ["shard", "slice"], "left").withColumn(
        "slot", (F.col("before") + F.col("rank")).cast("long"))
    return unpack(slots, df.columns, OUTPUTS)
