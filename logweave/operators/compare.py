"""Run comparison.

Two runs are compared per query on a key: Q1 on (log_date, status_code) with
counts summed per key, Q2 on the 20 top rows (request_count desc,
resource_path asc), Q3 on (log_date, log_hour) with counts summed - and, unlike
the reference checker, also on error_rate (recomputed from the sums) and
distinct_error_hosts.  A row-count difference is a failure, as is any key with
different values or present on one side only.

* ``compare_runs``    one frame per key: both sides' values and an outcome
  (``match`` / ``mismatch`` / ``only_a`` / ``only_b``), by a full outer join on
  the key (null-safe value comparison).
* ``compare_summary`` per query: rows on each side, mismatching keys, verdict
  (``not_run`` for a query that neither run executed), plus the two runs' total / malformed line counts (R7).
* ``compare_all_pairs`` (R6) every pair of the given runs that finished (have a
  run_metadata row).  Every run is digested once, by buckets of its keys; runs of equal digests
  are compared with nothing further, and of others only the buckets that differ are read by key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.constants import ALL_QUERIES, COMPARE_DIFFS_SHOWN, TOP_RESOURCES_LIMIT
from logweave.schemas import RESULT_KEYS
from logweave.session import scratch_dir
from logweave.sinks.store import ResultStore

COMPARE_VALUES = {
    "q1": ["request_count", "total_bytes"],
    "q2": ["request_count", "total_bytes", "distinct_host_count"],
    "q3": ["error_request_count", "total_request_count", "error_rate",
           "distinct_error_hosts"],
}


def comparable(frame: DataFrame, query: str, by_run: bool = False) -> DataFrame:
    """The rows of one (or, with ``by_run``, each) run in comparable form."""
    run = ["run_id"] if by_run else []
    keys = RESULT_KEYS[query]
    if query == "q1":
        return frame.groupBy(*run, *keys).agg(
            F.sum("request_count").cast("long").alias("request_count"),
            F.sum("total_bytes").cast("long").alias("total_bytes"))
    if query == "q3":
        summed = frame.groupBy(*run, *keys).agg(
            F.sum("error_request_count").cast("long").alias("error_request_count"),
            F.sum("total_request_count").cast("long").alias("total_request_count"),
            # distinct counts do not add up: several rows of one key have none in common
            F.when(F.count(F.lit(1)) == 1, F.max("distinct_error_hosts")).alias("distinct_error_hosts"))
        rate = F.when(F.col("total_request_count") > 0,
                      F.col("error_request_count") / F.col("total_request_count")
                      ).otherwise(F.lit(0.0))
        return summed.select(*run, *keys, "error_request_count", "total_request_count",
                             rate.alias("error_rate"), "distinct_error_hosts")
    order = [F.col("request_count").desc(), F.col("resource_path").asc()]
    cols = [*run, "resource_path", *COMPARE_VALUES["q2"]]
    if not by_run:
        return frame.orderBy(*order).limit(TOP_RESOURCES_LIMIT).select(*cols)
    ranked = frame.withColumn("_rank", F.row_number().over(
        Window.partitionBy("run_id").orderBy(*order)))
    return ranked.filter(F.col("_rank") <= TOP_RESOURCES_LIMIT).select(*cols)


def _outcome(in_a, in_b, same) -> F.Column:
    return (F.when(in_a & in_b, F.when(same, F.lit("match")).otherwise(F.lit("mismatch")))
            .when(in_a, F.lit("only_a")).otherwise(F.lit("only_b")))


def compare_frames(a: DataFrame, b: DataFrame, query: str) -> DataFrame:
    """Per-key comparison of two frames already in comparable form."""
    keys = RESULT_KEYS[query]
    values = COMPARE_VALUES[query]
    side_a = a.select(*keys, *[F.col(v).alias(f"a_{v}") for v in values],
                      F.lit(True).alias("_in_a"))
    side_b = b.select(*keys, *[F.col(v).alias(f"b_{v}") for v in values],
                      F.lit(True).alias("_in_b"))
    joined = side_a.join(side_b, on=keys, how="full_outer")
    in_a = F.coalesce(F.col("_in_a"), F.lit(False))
    in_b = F.coalesce(F.col("_in_b"), F.lit(False))
    same = reduce(lambda x, y: x & y,
                  [F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}")) for v in values])
    return joined.select(*keys, *[f"a_{v}" for v in values], *[f"b_{v}" for v in values],
                         _outcome(in_a, in_b, same).alias("outcome"))


def compare_runs(store: ResultStore, run_a: str, run_b: str, query: str) -> DataFrame:
    """Per-key comparison of one query between two runs."""
    a = comparable(store.results(query, run_a), query)
    b = comparable(store.results(query, run_b), query)
    return compare_frames(a, b, query)


def diff_examples(comparison: DataFrame, query: str, n: int = COMPARE_DIFFS_SHOWN) -> DataFrame:
    """The first ``n`` differing keys (in key order)."""
    return (comparison.filter(F.col("outcome") != "match")
            .orderBy(*RESULT_KEYS[query]).limit(n))


def _verdict(executed: F.Column) -> list[F.Column]:
    """``verdict`` (match / mismatch / not_run) and ``matched`` (NULL if neither run
    executed the query; one that only one run executed is a mismatch)."""
    both, neither = executed == 2, executed == 0
    same = both & (F.col("rows_a") == F.col("rows_b")) & (F.col("mismatched_rows") == 0)
    verdict = F.when(neither, "not_run").when(same, "match").otherwise("mismatch")
    return [F.when(~neither, same).alias("matched"), verdict.alias("verdict")]


def _executed(store: ResultStore) -> DataFrame:
    """(run, query) of every query that a finished run executed."""
    return store.run_metadata().select(F.col("run_id").alias("run"),
                                       F.explode(F.split("queries", ",")).alias("ran"))


def _with_verdict(pairs: DataFrame, store: ResultStore) -> DataFrame:
    """``pairs`` (run_a, run_b, query, counts) with verdicts."""
    ran = _executed(store)
    for side in ("a", "b"):
        mine = ran.select(F.col("run").alias(f"run_{side}"), F.col("ran").alias("query"),
                          F.lit(1).alias(f"ran_{side}")).distinct()
        pairs = pairs.join(mine, [f"run_{side}", "query"], "left")
    executed = F.coalesce("ran_a", F.lit(0)) + F.coalesce("ran_b", F.lit(0))
    return pairs.select("run_a", "run_b", "query", "rows_a", "rows_b", "mismatched_rows",
                        *_verdict(executed), *[c for c in pairs.columns if c.endswith("_records")])


def compare_summary(store: ResultStore, run_a: str, run_b: str,
                    queries: Sequence[str] = ALL_QUERIES) -> DataFrame:
    """R5 + R7: one row per query with the verdict and both runs' line counts."""
    parts = []
    for q in queries:
        cmp = compare_runs(store, run_a, run_b, q)
        parts.append(cmp.agg(
            F.lit(q).alias("query"),
            F.count_if(F.col("outcome") != "only_b").alias("rows_a"),
            F.count_if(F.col("outcome") != "only_a").alias("rows_b"),
            F.count_if(F.col("outcome") != "match").alias("mismatched_rows")))
    summary = reduce(DataFrame.unionByName, parts)
    meta = store.run_metadata()

    def scalar(run: str, column: str) -> F.Column:
        # run_metadata holds one row per run id: a scalar subquery, no join
        return meta.filter(F.col("run_id") == run).select(F.max(column)).scalar()

    return _with_verdict(summary.select(
        F.lit(run_a).alias("run_a"), F.lit(run_b).alias("run_b"), "query",
        "rows_a", "rows_b", "mismatched_rows",
        scalar(run_a, "total_records").alias("a_total_records"),
        scalar(run_a, "malformed_records").alias("a_malformed_records"),
        scalar(run_b, "total_records").alias("b_total_records"),
        scalar(run_b, "malformed_records").alias("b_malformed_records")), store)


def finished_runs(store: ResultStore, run_ids: Sequence[str]) -> list[str]:
    """The given runs that have a run_metadata row, in the given order."""
    found = {r["run_id"] for r in store.run_metadata()
             .filter(F.col("run_id").isin(list(run_ids))).select("run_id").distinct().collect()}
    return [r for r in run_ids if r in found]


#: parts that a run's keys are dealt to by their hash
DIGEST_BUCKETS = 256


def _bucketed(store: ResultStore, runs: Sequence[str], query: str) -> DataFrame:
    """The comparable rows of the runs with the bucket of their key and a hash of the whole row."""
    keys, values = RESULT_KEYS[query], COMPARE_VALUES[query]
    rows = comparable(store.results(query).filter(F.col("run_id").isin(list(runs))), query, by_run=True)
    # two hashes of different kind: a row's digest has 128 bits
    text = F.to_json(F.struct(*keys, *values))
    return rows.select("run_id", *keys, *values, F.pmod(F.xxhash64(*keys), F.lit(DIGEST_BUCKETS)).alias("bucket"),
                       F.xxhash64(*keys, *values).alias("h1"),
                       F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long").alias("h2"))


def run_digests(store: ResultStore, runs: Sequence[str], query: str) -> DataFrame:
    """(run_id, bucket, rows, digest): one row per run and bucket that holds keys of it.

    Linear in the runs.  Digests are sums over the rows' hashes, so they do not depend on the
    order of rows; equal digests mean equal rows.
    """
    total = [F.sum(F.col(h).cast("decimal(20,0)")).cast("string") for h in ("h1", "h2")]
    return _bucketed(store, runs, query).groupBy("run_id", "bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws("/", F.count(F.lit(1)), *total).alias("digest"))


def _classes(digests: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query, place, run_id, class, rows) of the wanted runs: runs of equal rows have one class,
    the least of their ids."""
    signature = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "digest"))),
                                                lambda b: F.concat_ws(":", b["bucket"], b["digest"])), ","), 256)
    signed = digests.groupBy("query", "run_id").agg(signature.alias("signature"), F.sum("rows").alias("rows"))
    whole = wanted.join(signed, ["query", "run_id"], "left").select(
        "query", "place", "run_id", F.coalesce("signature", F.lit("")).alias("signature"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
    least = F.min("run_id").over(Window.partitionBy("query", "signature"))
    return whole.select("query", "place", "run_id", least.alias("class"), "rows")


def _class_differences(store: ResultStore, digests: DataFrame, classes: Sequence[str], query: str) -> DataFrame:
    """(class_a, class_b, mismatched_rows) of every two classes, a before b by id.

    Keys are read in buckets only where the two digests differ.
    """
    keys, values = RESULT_KEYS[query], COMPARE_VALUES[query]
    mine = digests.filter(F.col("run_id").isin(list(classes)))
    ranked = store.spark.createDataFrame(list(enumerate(sorted(classes))), "rank long, run_id string")
    # a class is paired with each later one; the pairs are as many as the verdicts asked for
    pairs = ranked.select(F.col("run_id").alias("class_a"), F.explode(F.sequence(
        F.col("rank") + 1, F.greatest(F.col("rank") + 1, F.lit(len(classes) - 1)))).alias("rank")).join(
        ranked.withColumnRenamed("run_id", "class_b"), "rank").drop("rank")

    def side(name: str, other: str) -> DataFrame:
        own = mine.select(F.col("run_id").alias(f"class_{name}"), "bucket", F.col("digest").alias(f"digest_{name}"),
                          "rows", F.lit(None).cast("string").alias(f"digest_{other}"))
        return pairs.join(own, f"class_{name}")

    # the buckets that either side holds; one that is missing on a side differs
    differing = side("a", "b").unionByName(side("b", "a")).groupBy("class_a", "class_b", "bucket").agg(
        F.sum("rows").alias("either"), F.max("digest_a").alias("digest_a"), F.max("digest_b").alias("digest_b")).filter(
        ~F.col("digest_a").eqNullSafe(F.col("digest_b")))
    sums = differing.groupBy("class_a", "class_b").agg(F.sum("either").alias("either"))
    rows = _bucketed(store, classes, query)
    left = rows.select(F.col("run_id").alias("class_a"), "bucket", *[F.col(k).alias(f"a_{k}") for k in keys],
                       *[F.col(v).alias(f"a_{v}") for v in values])
    right = rows.select(F.col("run_id").alias("class_b"), F.col("bucket").alias("b_bucket"),
                        *[F.col(k).alias(f"b_{k}") for k in keys], *[F.col(v).alias(f"b_{v}") for v in values])
    met = (differing.select("class_a", "class_b", "bucket").join(left, ["class_a", "bucket"]).join(
        right.withColumnRenamed("class_b", "of_b"), (F.col("class_b") == F.col("of_b")) & reduce(
            lambda x, y: x & y, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys])))
    same = reduce(lambda x, y: x & y, [F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}")) for v in values])
    shared = met.groupBy("class_a", "class_b").agg(F.count(F.lit(1)).alias("both"), F.count_if(same).alias("equal"))
    # a key of both sides counts once, and not at all where its values are equal
    return sums.join(shared, ["class_a", "class_b"], "left").select(
        "class_a", "class_b", (F.col("either") - F.coalesce("both", F.lit(0)) - F.coalesce("equal", F.lit(0)))
        .cast("long").alias("mismatched_rows"))


def compare_all_pairs(store: ResultStore, run_ids: Sequence[str],
                      queries: Sequence[str] = ALL_QUERIES) -> DataFrame:
    """Verdict for every pair (i < j) of the finished runs, per query.

    Each run is digested once; runs of equal digests are one class, and only classes are
    compared, key by key in the buckets that differ.  No expression and no read is made per pair.
    """
    runs = finished_runs(store, run_ids)
    schema = ("run_a string, run_b string, query string, rows_a long, rows_b long, "
              "mismatched_rows long, matched boolean, verdict string")
    if len(runs) < 2:
        return store.spark.createDataFrame([], schema)
    spark, path = store.spark, scratch_dir(store.spark, "digests")
    reduce(DataFrame.unionByName, [run_digests(store, runs, q).withColumn("query", F.lit(q)) for q in queries]
           ).write.parquet(path)
    digests = spark.read.parquet(path)
    wanted = spark.createDataFrame([(q, k, run) for q in queries for k, run in enumerate(runs)],
                                   "query string, place long, run_id string")
    # as many rows as the caller's runs and queries
    rows = _classes(digests, wanted).collect()
    classed = spark.createDataFrame(rows, "query string, place long, run_id string, class string, rows long")
    later = F.sequence(F.col("place") + 1, F.greatest(F.col("place") + 1, F.lit(len(runs) - 1)))
    pairs = classed.select("query", F.col("run_id").alias("run_a"), F.col("class").alias("of_a"),
                           F.col("rows").alias("rows_a"), F.explode(later).alias("place")).join(
        classed.select("query", F.col("run_id").alias("run_b"), F.col("class").alias("of_b"),
                       F.col("rows").alias("rows_b"), "place"), ["query", "place"])
    several = {q: sorted({r["class"] for r in rows if r["query"] == q}) for q in queries}
    differences = [_class_differences(store, digests.filter(F.col("query") == q), classes, q).withColumn("query", F.lit(q))
                   for q, classes in several.items() if len(classes) > 1]
    if differences:
        pairs = pairs.withColumns({"class_a": F.least("of_a", "of_b"), "class_b": F.greatest("of_a", "of_b")}).join(
            reduce(DataFrame.unionByName, differences), ["query", "class_a", "class_b"], "left")
    else:
        pairs = pairs.withColumn("mismatched_rows", F.lit(0))
    return _with_verdict(pairs.select("run_a", "run_b", "query", "rows_a", "rows_b", F.coalesce(
        "mismatched_rows", F.lit(0)).cast("long").alias("mismatched_rows")), store)


def all_diffs(store: ResultStore, run_ids: Sequence[str], queries: Sequence[str] = ALL_QUERIES,
              n: int = COMPARE_DIFFS_SHOWN) -> Iterator[tuple[str, str, str, DataFrame]]:
    """R5 for R6: (run_a, run_b, query, first ``n`` differing keys) of every pair that
    differs in a query."""
    for pair in compare_all_pairs(store, run_ids, queries).filter("verdict = 'mismatch'").collect():
        yield (pair.run_a, pair.run_b, pair["query"],
               diff_examples(compare_runs(store, pair.run_a, pair.run_b, pair["query"]),
                             pair["query"], n))
