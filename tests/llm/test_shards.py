import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import shards
from tests.llm.fixtures import doc_rows, docs, empty


def test_matrix_rows_and_columns_add_up():
    starts, sizes = np.array([0, 5, 5, 17, 40]), shards.shard_sizes(40, 7)
    rows = [shards.matrix_row(b, starts, sizes, 3) for b in range(4)]
    matrix = np.stack([own for own, _ in rows])
    assert matrix.sum(axis=1).tolist() == np.diff(starts).tolist()
    assert matrix.sum(axis=0).tolist() == sizes.tolist()
    for b, (_, before) in enumerate(rows):
        assert before.tolist() == matrix[:b].sum(axis=0).tolist()


def test_matrix_entries_are_hypergeometric():
    starts, sizes = np.array([0, 10, 30]), np.array([12, 18])
    draws = np.array([shards.matrix_row(0, starts, sizes, seed)[0][0] for seed in range(4000)])
    assert abs(draws.mean() - 4.0) < 0.1
    assert abs(draws.var() - 10 * 0.4 * 0.6 * 20 / 29) < 0.15


def test_large_populations_are_drawn_by_the_same_law():
    rng = np.random.default_rng(1)
    good, bad, n = 3 * 10 ** 9, 10 ** 10, 5 * 10 ** 8
    draws = np.array([shards.hypergeometric(rng, good, bad, n) for _ in range(30)])
    share = good / (good + bad)
    spread = (n * share * (1 - share) * (good + bad - n) / (good + bad)) ** 0.5
    assert abs(draws.mean() - n * share) < 5 * spread / 30 ** 0.5
    assert 0.5 * spread < draws.std() < 1.6 * spread
    assert shards.hypergeometric(rng, 10 ** 10, 0, 7) == 7
    assert int(shards.split_draw(rng, np.array([10 ** 10, 0, 5]), 10 ** 9).sum()) == 10 ** 9


@pytest.mark.parametrize("count", [1, 7, 200])
def test_every_row_once_and_sizes_exact(spark, count):
    table = docs(spark).withColumn("shard", F.lit("own")).withColumn("__row", F.lit(1))
    out = shards.shard_rows(table, count, slice_rows=5).toPandas()
    rows = doc_rows()
    assert len(out) == len(rows)
    key = lambda r: tuple(str(x) for x in r)                                        # noqa: E731
    got = sorted(key((None if v != v else v) for v in r) for r in
                 out[["doc_id", "text", "lang", "source"]].itertuples(index=False))
    want = sorted(key((None if r[0] is None else float(r[0]), *r[1:4])) for r in rows)
    assert got == want
    sizes = out.groupby("shard").size().reindex(range(count), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    for _, group in out.groupby("shard"):
        assert sorted(group["slot"]) == list(range(len(group)))


def test_order_is_shuffled_and_seeded(spark):
    table = spark.range(3000).repartition(4).cache()
    one, again = (shards.shard_rows(table, 10, seed=5).toPandas().set_index("id") for _ in range(2))
    other = shards.shard_rows(table, 10, seed=6).toPandas().set_index("id")
    assert one.sort_index().equals(again.sort_index())
    assert not one.sort_index().equals(other.sort_index())
    joint = one.sort_index()
    assert abs(np.corrcoef(joint.index, joint["slot"])[0, 1]) < 0.1
    assert abs(np.corrcoef(joint.index, joint["shard"])[0, 1]) < 0.1


def test_empty_and_bad_input(spark):
    assert shards.shard_rows(empty(spark), 5).count() == 0
    with pytest.raises(ValueError):
        shards.shard_rows(empty(spark), 0)
