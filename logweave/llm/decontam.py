"""Benchmark decontamination by Wu-Manber search for word windows.

The test strings are the windows of the benchmark: every run of ``window``
consecutive words of an item, or all words of an item that has fewer.  Strings of
one length (in words) share one set of tables over blocks of two words (one word
for strings of length 1):

* the *shift table* gives for a block its distance from the end of the strings; a
  block that is in no string allows the longest skip;
* a shift of zero leads to the *bucket* of the strings that end with this block, and
  *direct comparison* of the words there confirms the occurrence.

Documents are only scanned, never shuffled.  The benchmark goes into tables of at
most ``TABLE_WORDS`` words each, and one table after the other is sent to the tasks,
so that what is broadcast is bounded however long the benchmark is; every document
meets every table and the hits are united.

Words are runs of ASCII digits and letters (A-Z lowered) and of all non-ASCII
characters.  Defined results: null and empty texts have no words and no hits; items
without words are never found; repeated items count by item id; an empty table gives
an empty result, an empty benchmark no hit.  A null item id is left out of the list.
Other columns come back as they are; one that is named like an output gives way.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import ROW, col, pack, ship_code, stored, text_of, unpack

WINDOW = 13
#: words of benchmark items in one table that is sent to the tasks: some 130 MB in a worker
TABLE_WORDS = 200_000
#: a document is contaminated if at least one word of this many is hit
ONE_IN = 20

OUTPUTS = ("n_words", "n_hit", "items", "n_items", "items_sha256", "contaminated")

#: bytes that make up words stay (A-Z lowered), all others become blanks
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class WordSearch:
    """Wu-Manber tables of the windows of some items."""

    def __init__(self, items: Iterable[tuple[object, bytes]], window: int = WINDOW):
        strings: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            length = min(window, len(words))
            for k in range(len(words) - length + 1 if length else 0):
                strings[length][tuple(words[k:k + length])].add(item)
        self.tables = [self._tables(n, strings[n]) for n in sorted(strings)]

    @staticmethod
    def _tables(length: int, strings: dict[tuple, set]) -> tuple:
        block = min(2, length)
        shift: dict[tuple, int] = {}
        buckets: dict[tuple, dict[tuple, tuple]] = defaultdict(dict)
        for string, items in strings.items():
            for end in range(block, length + 1):
                key = string[end - block:end]
                shift[key] = min(shift.get(key, length), length - end)
            buckets[string[-block:]][string] = tuple(items)
        return length, block, length - block + 1, shift, dict(buckets)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Occurrences as (first word, word after the last), and the items they are of."""
        spans, found = [], set()
        for length, block, longest, shift, buckets in self.tables:
            at, end, skip = length, len(words), shift.get
            while at <= end:
                key = tuple(words[at - block:at])
                step = skip(key, longest)
                if not step:
                    string = tuple(words[at - length:at])
                    items = buckets[key].get(string)
                    if items is not None:
                        spans.append((at - length, at))
                        found.update(items)
                    step = 1
                at += step
        return spans, found


def covered(spans: Iterable[tuple[int, int]]) -> int:
    """Words inside at least one span."""
    total, reach = 0, 0
    for first, after in sorted(spans):
        if after > reach:
            total += after - max(first, reach)
            reach = after
    return total


def _searcher(search: WordSearch):
    @F.pandas_udf("n_words long, spans array<struct<first:long,after:long>>, items array<string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            spans, items = search.search(words)
            rows.append((len(words), [{"first": a, "after": b} for a, b in spans],
                         [str(i) for i in items]))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])
    return run


def _counter():
    @F.pandas_udf("long")
    def run(spans: pd.Series) -> pd.Series:
        return pd.Series([covered((s["first"], s["after"]) for s in some) for some in spans],
                         dtype="int64")
    return run


def _tables_of(benchmark: DataFrame, id_col: str, text_col: str, window: int,
               table_words: int) -> Iterator[WordSearch]:
    """One search per at most ``table_words`` words (one item at least) of the benchmark."""
    held, size = [], 0
    rows = benchmark.select(col(id_col), text_of(benchmark, text_col).cast("binary")).filter(
        col(id_col).isNotNull())
    for item, text in rows.toLocalIterator():
        held.append((item, bytes(text)))
        size += len(words_of(text))
        if size >= table_words:
            yield WordSearch(held, window)
            held, size = [], 0
    if held:
        yield WordSearch(held, window)


def find_items(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW,
               table_words: int = TABLE_WORDS) -> DataFrame:
    """Every row of ``df`` with OUTPUTS."""
    ship_code(df.sparkSession)
    rows = pack(df, body=text_of(df, text_col).cast("binary"))
    tables = _tables_of(benchmark, item_id, item_text, window, table_words)
    first, second = next(tables, None) or WordSearch([]), next(tables, None)
    if second is None:
        found = rows.withColumn("hits", _searcher(first)("body")).select(ROW, "hits.*")
    else:
        rows = stored(rows.withColumn("number", F.monotonically_increasing_id()), "bench-rows")
        passes = [stored(rows.select("number", _searcher(search)("body").alias("hits")), "bench-hits")
                  for search in chain((first, second), tables)]
        united = reduce(DataFrame.unionByName, passes).groupBy("number").agg(
            F.first("hits.n_words").alias("n_words"),
            F.flatten(F.collect_list("hits.spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("hits.items"))).alias("items"))
        found = rows.select("number", ROW).join(united, "number")
    counted = found.select(ROW, "n_words", F.array_sort("items").alias("items"),
                           _counter()("spans").alias("n_hit"))
    return unpack(counted.select(
        ROW, "n_words", "n_hit", "items", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))).alias("contaminated")),
        df.columns, OUTPUTS)
