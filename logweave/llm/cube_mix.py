"""Mixing sources to target weights by balanced sampling with the cube method.

A source of size S (in words) with target T gets the rate T / S for each of its
documents: the whole part as full copies, the fraction as an inclusion probability.
The cube method turns those probabilities into 0 or 1 while the source's sums of
words and of documents stay where they are: *flight* moves the probabilities of
three documents along the null space of the two balancing constraints until one of
them is 0 or 1, and takes the next document in.  At the end at most two documents
are fractional.

A document that holds much of its source's target cannot be balanced by small ones in
steps of three: it would be left to the end, and its draw would miss the target by its
size.  Documents above ``LARGE_SHARE`` of the target are therefore drawn first, from the
largest down, and what each draw adds or misses is spread evenly over the words still to
be decided: all later documents share the rate (words still wanted) / (words still there).
That keeps every document's expected copies, but where a rate would leave 0 .. most_times.
A source has at most S / (LARGE_SHARE T) such documents.

On Spark the flight runs per (source, block) of bounded size; what is left of each
block - two documents at most - meets in the blocks of the next level.  A level
divides the fractional documents by ``block_rows / 2``, so a few levels leave one
block per source: the small *landing* problem, settled by one seeded draw for both of its
documents.  A hot source is many blocks, never one task.

Targets: sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1 ... and
share all words; a target stops at three times the source's size and the excess is
shared again by weight.  That is the level L with sum(min(weight * L, 3 S)) = sum(S).

Defined results: sizes are non-negative, null counts as 0; a source of no words has
target 0 and takes nothing.  Rows that repeat in every decisive column (id, source,
size, text) are one row with a multiplicity; they are told apart by a running
number, so they are sampled like others and never share one block by force.  An
empty table gives an empty result.  All random numbers derive from the row's
values, so that reruns agree whatever the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm.common import apart, col, pack, ship_code, stored, text_of, unpack

#: weights in turn of the sources in code point order
WEIGHTS = (5.0, 2.0, 1.0)
#: most copies of a document, and most times a source's size that its target may be
MOST_TIMES = 3.0
#: share of its source's target above which a document is drawn before the flight
LARGE_SHARE = 0.02
#: documents in one flight
BLOCK_ROWS = 2048
#: inclusion probabilities this close to 0 or 1 are settled
EDGE = 1e-9

WORD = r"[^\x20\x09-\x0D]+"
OUTPUTS = ("size", "source_size", "target", "copies", "taken")
_UNIT = "source string, key long, number long, size long, p double"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   most_times: float = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source."""
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (turn % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(most_times)))
    # the sources that reach their cap first have the smallest cap for their weight
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = by_cap.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(full), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(full), F.lit(0.0))))
    leveled = capped.withColumn("level", level)
    # the first source whose cap is not below the level fixes it for all after it
    fixed = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                         F.struct((F.col("cap") / F.col("weight")).alias("at"), "level"))).over(every)
    return (leveled.withColumn("fixed", fixed)
            .select("source", "source_size",
                    F.when(F.col("fixed").isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("fixed.level")))
                    .cast("double").alias("target")))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``p`` through the null space of (words, documents) until two are fractional.

    The rows of the constraint matrix are size / p and 1 / p by the method; for equal
    rates within a source they are proportional to size and 1, which is used here.
    """
    p = p.copy()
    open_ = [int(i) for i in np.flatnonzero((p > EDGE) & (p < 1 - EDGE))]
    active, nxt, draws = open_[:3], 3, rng.random(len(open_) + 1)
    turn = 0
    while len(active) == 3:
        a, b, c = active
        # null vector of [[size], [1]]: the cross product of both rows
        u = (float(size[b] - size[c]), float(size[c] - size[a]), float(size[a] - size[b]))
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for i, d in zip(active, u):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if draws[turn] * (up + down) < down else -down
        turn += 1
        still = []
        for i, d in zip(active, u):
            p[i] = min(1.0, max(0.0, p[i] + step * d))
            if p[i] <= EDGE:
                p[i] = 0.0
            elif p[i] >= 1 - EDGE:
                p[i] = 1.0
            else:
                still.append(i)
        while len(still) < 3 and nxt < len(open_):
            still.append(open_[nxt])
            nxt += 1
        active = still
    return p


def _seed(seed: int, level: int, first_key: int) -> np.random.Generator:
    return np.random.default_rng([seed, level, first_key & 0xFFFFFFFFFFFFFFFF])


def _fly(seed: int, level: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # large documents first, so that the fractional ones at the end are small
        block = block.sort_values(["size", "key", "number"], ascending=[False, True, True])
        rng = _seed(seed, level, int(block["key"].iloc[0]))
        moved = flight(block["size"].to_numpy(), block["p"].to_numpy(), rng)
        return block.assign(p=moved)[["source", "key", "number", "size", "p"]]
    return run


def _land(seed: int):
    def run(rest: pd.DataFrame) -> pd.DataFrame:
        """At most a block of fractional documents of one source: fly, then draw the rest."""
        rest = rest.sort_values(["size", "key", "number"], ascending=[False, True, True])
        rng = _seed(seed, 99, int(rest["key"].iloc[0]))
        moved = flight(rest["size"].to_numpy(), rest["p"].to_numpy(), rng)
        # one draw for all that is left: as many of them are taken as their sum, up to one
        left = np.flatnonzero((moved > EDGE) & (moved < 1 - EDGE))
        upto = np.cumsum(moved[left]) + rng.random()
        moved[left] = np.diff(np.floor(upto), prepend=np.floor(upto[:1] - moved[left][:1]))
        return rest.assign(p=np.round(moved))[["source", "key", "number", "size", "p"]]
    return run


def balanced_sample(units: DataFrame, seed: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(source, key, number, taken 0/1) from (source, key, number, size, p in (0, 1))."""
    ship_code(units.sparkSession)
    settled, level = [], 0
    open_ = units.select("source", "key", "number", "size", "p")
    while True:
        counts = open_.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= block_rows:
            break
        spread = F.xxhash64(F.lit(seed), F.lit(level), "key", "number")
        blocks = F.ceil(F.col("n") * 2 / block_rows).cast("long")      # about half full
        dealt = open_.join(counts, open_["source"].eqNullSafe(counts["source"])).select(
            open_["*"], F.pmod(spread, blocks).alias("block"))
        flown = stored(dealt.groupBy("source", "block").applyInPandas(_fly(seed, level), _UNIT),
                       f"cube-level{level}")
        fractional = (F.col("p") > EDGE) & (F.col("p") < 1 - EDGE)
        settled.append(flown.filter(~fractional))
        open_, level = flown.filter(fractional), level + 1
    landed = open_.groupBy("source").applyInPandas(_land(seed), _UNIT)
    for part in settled:
        landed = landed.unionByName(part)
    return landed.select("source", "key", "number", F.col("p").cast("int").alias("extra"))


def mix_units(df: DataFrame, id_col: str, source_col: str, size: Column, content: Column,
              seed: int, weights: Sequence[float], most_times: float,
              block_rows: int) -> DataFrame:
    """The decision per row: (id, source, size, content, number, source_size, target, copies).

    Rows equal in id, source, size and content carry the numbers 0, 1, ...
    """
    rows = (df.select(col(id_col).alias("id"), col(source_col).cast("string").alias("source"),
                      F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                      content.alias("content"))
            .groupBy("id", "source", "size", "content").agg(F.count(F.lit(1)).alias("rows")))
    rows = stored(rows, "cube-rows")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = stored(source_targets(sizes, weights, most_times), "cube-targets")
    units = (rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))
                         .alias("number")).drop("rows")
             .withColumn("key", F.xxhash64(F.lit(seed), "id", "source", "size", "content")))
    named = units.join(targets, units["source"].eqNullSafe(targets["source"])).select(
        units["*"], "source_size", "target", (F.col("size") > F.col("target") * LARGE_SHARE).alias("large"))
    large = stored(named.filter("large AND target > 0").groupBy("source").applyInPandas(
        _draw_large(seed, most_times), "source string, key long, number long, size long, copies int"), "cube-large")
    spent = large.groupBy(F.col("source").alias("of")).agg(
        F.sum("size").alias("large_words"), F.sum(F.col("size") * F.col("copies")).alias("large_taken"))
    # words still wanted of the words still there: the rate of all other documents
    wanted = targets.join(spent, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("of"), (F.col("target") - F.coalesce("large_taken", F.lit(0))).alias("wanted"),
        (F.col("source_size") - F.coalesce("large_words", F.lit(0))).alias("there"))
    rate = F.when(F.col("there") > 0, F.greatest(F.lit(0.0), F.least(
        F.lit(float(most_times)), F.col("wanted") / F.col("there")))).otherwise(0.0)
    # a rate within 1e-9 of a whole number is that number
    whole = F.floor(F.col("rate") + EDGE).cast("int")
    rest = (named.filter("NOT (large AND target > 0)").join(wanted, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("rate", rate).withColumn("whole", whole)
            .withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))))
    fractional = (F.col("p") > EDGE) & (F.col("p") < 1 - EDGE)
    sample = balanced_sample(rest.filter(fractional), seed, block_rows)

    def decided(frame: DataFrame, decisions: DataFrame, copies: Column) -> DataFrame:
        drawn = decisions.select(F.col("source").alias("s"), F.col("key").alias("k"), F.col("number").alias("i"),
                                 F.col(decisions.columns[-1]).alias("drawn"))
        return frame.join(drawn, (F.col("key") == F.col("k")) & (F.col("number") == F.col("i"))
                          & F.col("source").eqNullSafe(F.col("s")), "left").select(
            "id", "source", "size", "content", "number", "source_size", "target", copies.cast("int").alias("copies"))

    extra = F.coalesce("drawn", F.lit(0))
    return decided(rest, sample, F.col("whole") + extra).unionByName(
        decided(named.filter("large AND target > 0"), large, extra))


def draw_large(size: np.ndarray, source_size: float, target: float, most_times: float,
               rng: np.random.Generator) -> np.ndarray:
    """Copies of the large documents of a source, given from the largest down."""
    wanted, there, copies = float(target), float(source_size), np.zeros(len(size), dtype=np.int64)
    for k, (words, draw) in enumerate(zip(size.tolist(), rng.random(len(size)).tolist())):
        rate = min(max(wanted / there, 0.0), most_times)
        whole = math.floor(rate + EDGE)
        copies[k] = whole + (draw < rate - whole)
        wanted, there = wanted - copies[k] * words, there - words
    return copies


def _draw_large(seed: int, most_times: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key", "number"], ascending=[False, True, True])
        rng = _seed(seed, 98, int(rows["key"].iloc[0]))
        copies = draw_large(rows["size"].to_numpy(), rows["source_size"].iloc[0], rows["target"].iloc[0],
                            most_times, rng)
        return rows.assign(copies=copies)[["source", "key", "number", "size", "copies"]]
    return run


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", seed: int = 7, weights: Sequence[float] = WEIGHTS,
                most_times: float = MOST_TIMES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every input row with OUTPUTS: its size in words, its source's size and target,
    the number of copies the mix takes and the words they hold."""
    text = text_of(df, text_col)
    size, content = word_count(text), F.xxhash64(text)
    decided = mix_units(df, id_col, source_col, size, content, seed, weights, most_times, block_rows)
    # rows that repeat are interchangeable: of n equal rows the first ``more`` take one copy more
    per_value = decided.groupBy("id", "source", "size", "content", "source_size", "target").agg(
        F.min("copies").alias("copies_least"),
        (F.sum("copies") - F.min("copies") * F.count(F.lit(1))).alias("more"))
    key = F.xxhash64(F.lit(seed), col(id_col), col(source_col).cast("string"), content)
    per_value = per_value.select(
        F.xxhash64(F.lit(seed), "id", "source", "content").alias("key"), "content", "size",
        "source_size", "target", "copies_least", "more")
    rows = pack(df, key=key, content=content).withColumn(
        "nth", F.row_number().over(W.partitionBy("key", "content").orderBy(F.lit(0))))
    copies = (F.col("copies_least") + (F.col("nth") <= F.col("more")).cast("int")).cast("int")
    joined = rows.join(per_value, ["key", "content"], "left").withColumn("copies", copies)
    return unpack(joined.withColumn("taken", F.col("size") * F.col("copies")), df.columns, OUTPUTS)


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as many times as it is taken, in the input's columns."""
    own, columns = apart(df, OUTPUTS)
    taken = mix_sources(own, **options).filter("copies > 0")
    return taken.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*columns)
