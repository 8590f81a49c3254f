"""SimHash near-duplicates found at the anchors of a covering code.

*Fingerprint*: bit i is 1 if it is set in more than half of the XXH64 hashes (seed
42) of the text's word shingles, repeats included.

*Anchors*: the words of a perfect binary Golay code, (23, 12) with covering radius
R = 3, on each of two 23-bit blocks of the fingerprint.  An anchor is a pair of
codewords: 2^24 of them, and every fingerprint lies within R of exactly one
codeword per block, its home.  Let d(x, y) <= t, with t1 + t2 <= t differing bits in
the blocks, and a be the home of x; then a lies within R + t1 and R + t2 of y.  So a
fingerprint that is replicated to every anchor within R + t1, R + t2 for all
t1 + t2 <= t meets each of its neighbours at the neighbour's home anchor.  Per anchor,
homes are compared with replicas by the bit count of their difference.

Only distinct fingerprints are compared: copies and near copies that share one are
a single node, and a node has a bounded number of neighbours within two bits, so
the links cannot grow with the square of a group.  Groups are the connected
components of the links.

Defined results: null text is empty; a text without words has fingerprint zero and
links like any other; fewer words than a shingle are one shingle.  A null id counts
as larger than any other.  Repeated rows are separate documents of one group; one
row of a group is the representative, the one with the smallest id.  An empty table
gives an empty result.  Other columns come back as they are; one that is named like
an output gives way to it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import ROW, col, pack, ship_code, stored, text_of, unpack
from logweave.llm.components import components

HASH_SEED = 42
#: shingles hashed at a time, which bounds the memory a very long text takes
CHUNK = 65536
#: generator polynomial of the (23, 12) Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1
GOLAY = 0b110001110101
BLOCK_BITS = 23
RADIUS = 3

OUTPUTS = ("fingerprint", "component_id", "representative")


def text_hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of every ``width``-word shingle of a text, in chunks."""
    words = text.lower().split()            # bytes: lowers A-Z, splits on \x20 \x09-\x0D
    if not words:
        return
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    count = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    for k in range(0, count, CHUNK):
        yield np.array([digest(joined[s:e - 1], HASH_SEED)
                        for s, e in zip(starts[k:min(k + CHUNK, count)], last[k:k + CHUNK])],
                       dtype=np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """The 64-bit SimHash of a text; zero for a text without words."""
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for hashes in text_hashes(text, width):
        total += len(hashes)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    if not total:
        return 0
    return int(np.packbits((2 * ones > total), bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        marks = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64)
        return pd.Series(marks.view(np.int64))
    return run


def _syndrome(word: int) -> int:
    """Remainder of a 23-bit word by the generator polynomial."""
    for bit in range(BLOCK_BITS - 1, 10, -1):
        if (word >> bit) & 1:
            word ^= GOLAY << (bit - 11)
    return word


@functools.cache
def _syndromes() -> tuple[list[int], list[int]]:
    """Syndromes of the low 12 and the high 11 bits; a word's is the xor of its two."""
    return [_syndrome(w) for w in range(1 << 12)], [_syndrome(w << 12) for w in range(1 << 11)]


def syndrome_of(word: int) -> int:
    low, high = _syndromes()
    return low[word & 0xFFF] ^ high[word >> 12]


@functools.cache
def _errors() -> list[list[list[int]]]:
    """Per syndrome and weight 0 to 5 the errors of that weight: a word's codewords at
    distance d are the word xor its syndrome's errors of weight d."""
    table = [[[] for _ in range(RADIUS + 3)] for _ in range(1 << 11)]
    for weight in range(RADIUS + 3):
        for bits in combinations(range(BLOCK_BITS), weight):
            word = sum(1 << b for b in bits)
            table[syndrome_of(word)][weight].append(word)
    return table


@functools.lru_cache(maxsize=None)
def _slack_errors(syndrome: int, threshold: int) -> list[np.ndarray]:
    """For slack 0, 1, ... the errors of the weights that this slack adds to those before."""
    by_weight = _errors()[syndrome]
    near = [e for weight in by_weight[:RADIUS + 1] for e in weight]
    return [np.array(x, dtype=np.int64) for x in (near, *by_weight[RADIUS + 1:RADIUS + 1 + threshold])]


def anchors_of(mark: int, threshold: int) -> tuple[int, np.ndarray]:
    """Home anchor of a fingerprint and all anchors within covering radius plus threshold."""
    mask = (1 << BLOCK_BITS) - 1
    low, high = mark & mask, (mark >> BLOCK_BITS) & mask
    first = _slack_errors(syndrome_of(low), threshold)
    second = _slack_errors(syndrome_of(high), threshold)
    home = ((low ^ int(first[0][0])) << BLOCK_BITS) | (high ^ int(second[0][0]))
    near = [((low ^ a)[:, None] << BLOCK_BITS | (high ^ b)[None, :]).ravel()
            for s, a in enumerate(first) for t, b in enumerate(second) if s + t <= threshold]
    return home, np.concatenate(near)


def _homes():
    @F.pandas_udf("long")
    def run(marks: pd.Series) -> pd.Series:
        return pd.Series([anchors_of(int(m) & 0xFFFFFFFFFFFFFFFF, 0)[0] for m in marks],
                         dtype="int64")
    return run


def _replicas(threshold: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 2048):
                marks = batch["mark"].to_numpy()[k:k + 2048]
                near = [anchors_of(int(m) & 0xFFFFFFFFFFFFFFFF, threshold)[1] for m in marks]
                yield pd.DataFrame({"anchor": np.concatenate(near),
                                    "replica": np.repeat(marks, [len(n) for n in near])})
    return run


def near_links(marks: DataFrame, threshold: int = 2) -> DataFrame:
    """Links (a, b), a < b, of distinct fingerprints (mark long) at ``threshold`` bits or fewer."""
    if not 0 <= threshold <= 2:
        raise ValueError("the Golay tables cover thresholds 0 to 2")
    homes = marks.select(_homes()("mark").alias("anchor"), F.col("mark").alias("home"))
    replicas = marks.mapInPandas(_replicas(threshold), "anchor long, replica long")
    near = F.bit_count(F.col("home").bitwiseXOR(F.col("replica"))) <= threshold
    met = homes.hint("shuffle_hash").join(replicas, (homes["anchor"] == replicas["anchor"]) & near
                     & (F.col("home") < F.col("replica")))
    return met.select(F.col("home").alias("a"), F.col("replica").alias("b"))


def decide(rows: DataFrame, threshold: int = 2) -> DataFrame:
    """(number, mark, component_id, representative) from stored (number, id, mark) rows."""
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "number")).alias("first")
    marks = stored(rows.groupBy("mark").agg(first), "simhash-marks")
    links = stored(near_links(marks.select("mark"), threshold), "simhash-links")
    linked = components(links, "simhash-components")
    of_mark = marks.join(linked, marks["mark"] == linked["node"], "left").select(
        "mark", "first", F.coalesce("component", "mark").alias("component"))
    groups = of_mark.groupBy("component").agg(F.min("first").alias("first"))
    named = of_mark.select("mark", "component").join(groups, "component").select(
        "mark", F.col("first.id").alias("component_id"), F.col("first.number").alias("chosen"))
    return rows.join(named, "mark").select(
        "number", "id", "mark", "component_id", (F.col("number") == F.col("chosen")).alias("representative"))


def hex_of(mark: str = "mark"):
    return F.lower(F.lpad(F.hex(F.col(mark)), 16, "0"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                threshold: int = 2) -> DataFrame:
    """Every input row with OUTPUTS: fingerprint (hex), the smallest id of its group, and
    whether the row stands for the group."""
    ship_code(df.sparkSession)
    mark = _fingerprints(shingle)(text_of(df, text_col).cast("binary"))
    rows = stored(pack(df, id=col(id_col), number=F.monotonically_increasing_id(), mark=mark),
                  "simhash-rows")
    decided = decide(rows.select("number", "id", "mark"), threshold)
    joined = rows.select("number", ROW).join(
        decided.select("number", "component_id", "representative", hex_of().alias("fingerprint")),
        "number")
    return unpack(joined, df.columns, OUTPUTS)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 threshold: int = 2) -> DataFrame:
    """(id, fingerprint, component_id, representative) of every row; texts are not carried."""
    ship_code(df.sparkSession)
    mark = _fingerprints(shingle)(text_of(df, text_col).cast("binary"))
    rows = stored(df.select(col(id_col).alias("id"), F.monotonically_increasing_id().alias("number"),
                            mark.alias("mark")), "simhash-rows")
    return decide(rows, threshold).select("id", hex_of().alias("fingerprint"), "component_id",
                                          "representative")
