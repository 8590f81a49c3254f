from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logweave.llm import cube_mix
from tests.llm.fixtures import doc_rows, docs, empty


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        free = [n for n in names if n not in full]
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > most * sizes[n] + 1e-9}
        if not over:
            return {**{n: most * sizes[n] for n in full}, **share}
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 7, "d": 0, None: 50},
    {"a": 10, "b": 10, "c": 1000, "é": 3, "z": 9, None: 1}, {"x": 5}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(k, v) for k, v in sizes.items()],
                                  "source string, source_size long")
    got = {r.source: r.target for r in cube_mix.source_targets(frame).collect()}
    want = water(sizes)
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == pytest.approx(want[name], rel=1e-9, abs=1e-9)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(2)
    size, p = rng.integers(0, 500, 400), np.full(400, 0.37)
    out = cube_mix.flight(size, p, rng)
    assert (out * size).sum() == pytest.approx((p * size).sum(), rel=1e-9)
    assert out.sum() == pytest.approx(p.sum(), rel=1e-9)
    assert ((out > 0) & (out < 1)).sum() <= 2
    equal = cube_mix.flight(np.full(50, 9), np.full(50, 0.5), rng)
    assert equal.sum() == pytest.approx(25) and ((equal > 0) & (equal < 1)).sum() <= 2


def test_inclusion_rates_are_kept():
    taken = np.zeros(30)
    for seed in range(600):
        taken += np.round(cube_mix.flight(np.arange(30), np.full(30, 0.3), np.random.default_rng(seed)))
    assert abs(taken.mean() / 600 - 0.3) < 0.02


@pytest.mark.parametrize("block_rows", [8, 2048])
def test_mix_of_awkward_rows(spark, block_rows):
    table = docs(spark).withColumn("copies", F.lit(-1)).withColumn("key", F.lit("mine"))
    out = cube_mix.mix_sources(table, block_rows=block_rows).toPandas()
    rows = doc_rows()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    want, taken, largest = water(sizes), defaultdict(int), defaultdict(int)
    assert len(out) == len(rows)
    for r in out.itertuples():
        assert r.size == len((r.text or "").split()) and r.taken == r.size * r.copies
        assert 0 <= r.copies <= 3 and r.key == "mine"
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for source, target in want.items():
        assert abs(taken[source] - target) <= 2 * largest[source] + 1


def _worst_misses(sizes, target, seeds):
    """Relative misses of a source over seeds, by the functions of a run on Spark, and the mean copies."""
    size = np.sort(np.array(sizes))[::-1]
    misses, copies = [], np.zeros(len(size))
    for seed in range(seeds):
        rng = np.random.default_rng([1, seed])
        large = size > target * cube_mix.LARGE_SHARE
        drawn = np.zeros(len(size))
        drawn[large] = cube_mix.draw_large(size[large], size.sum(), target, 3.0, rng)
        rest = ~large
        if rest.any():
            rate = min(max((target - (drawn * size).sum()) / size[rest].sum(), 0), 3.0)
            rows = pd.DataFrame({"source": "s", "key": rng.permutation(int(rest.sum())) + 1000 * seed, "number": 0,
                                 "size": size[rest], "p": rate - np.floor(rate)})
            landed = cube_mix._land(seed)(rows)
            extra = landed.sort_values("size", ascending=False, kind="stable")["p"].to_numpy()
            drawn[rest] = np.floor(rate) + extra
        misses.append(abs((drawn * size).sum() - target) / target)
        copies += drawn
    return np.array(misses), copies / seeds


def test_one_large_text_among_small_ones():
    """A text that holds most of the target: the sum is met and the rates are kept."""
    rng = np.random.default_rng(3)
    sizes = [5184, *rng.integers(60, 500, 74).tolist()]
    target = 0.303 * sum(sizes)
    misses, rates = _worst_misses(sizes, target, 400)
    assert misses.mean() < 0.01 and misses.max() < 0.07
    assert abs(rates[0] - 0.303) < 0.07 and abs(rates[1:].mean() - 0.303) < 0.01


@pytest.mark.parametrize("rate", [0.05, 0.4, 1.0, 1.7, 2.95])
def test_all_rates_meet_their_targets(rate):
    sizes = np.random.default_rng(4).lognormal(5, 1, 300).astype(int) + 1
    misses, rates = _worst_misses(sizes, rate * sizes.sum(), 100)
    assert misses.mean() < 0.02 and misses.max() < 0.07 and abs(rates.mean() - rate) < 0.05


def test_given_sources_meet_their_targets(spark):
    """No bound that grows with the largest document."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    misses = []
    for seed in (7, 8):
        out = cube_mix.mix_sources(table, seed=seed).groupBy("source").agg(
            F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")))
        misses += [abs(r.taken - r.target) / r.target for r in out.collect()]
        assert max(r[3] for r in out.collect()) <= 0
    assert max(misses) < 0.07 and sum(misses) / len(misses) < 0.01


def test_reruns_agree_and_rows_are_emitted(spark):
    columns = ["doc_id", "text", "source", "copies"]
    one = cube_mix.mix_sources(docs(spark)).select(*columns)
    two = cube_mix.mix_sources(docs(spark).repartition(7, "lang")).select(*columns)
    key = lambda f: sorted(map(str, f.collect()))                                    # noqa: E731
    assert key(one) == key(two)
    named = docs(spark).withColumn("size", F.lit("own"))
    emitted = cube_mix.mixed_rows(named)
    assert emitted.columns == named.columns and {r.size for r in emitted.collect()} == {"own"}
    assert emitted.count() == one.agg(F.sum("copies")).first()[0]


def test_empty_table_and_many_sizes(spark):
    assert cube_mix.mix_sources(empty(spark)).count() == 0
    assert cube_mix.mixed_rows(empty(spark)).count() == 0
    rows = [(i, "w " * (1 + i % 97), None, f"s{i % 2}", None) for i in range(3000)]
    out = cube_mix.mix_sources(docs(spark, rows), block_rows=64).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in out:
        assert abs(r.taken - r.target) <= 2 * 97
