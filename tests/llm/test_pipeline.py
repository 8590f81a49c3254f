"""The pipeline stage by stage against brute force, on a small corpus with planted cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import queries
from tests.llm.fixtures import DOC_SCHEMA, doc_rows, words
from tests.llm.test_cube_mix import water
from tests.llm.test_decontam import brute as contamination
from tests.llm.test_simhash_cover import brute_groups, brute_mark


def corpus():
    rng = random.Random(21)
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in doc_rows() if i is not None and i < 300]
    for i in range(1000, 1200):
        rows.append((i, words(rng, rng.randrange(30, 90)) + ".", "en", f"s{i % 4}", i))
    junk = [(2000 + i, " | ".join(f"w{rng.randrange(99)}" for _ in range(50)), "en", "s1", i)
            for i in range(80)]
    items = [(i, words(rng, 25)) for i in range(6)]
    dirty = [(3000 + i, words(rng, 30) + " " + items[i % 6][1] + " " + words(rng, 20), "en", "s2", i)
             for i in range(12)]
    labels = [(r[0], 1) for r in rows if r[0] >= 1000] + [(r[0], 0) for r in junk]
    return rows + junk + dirty, junk, dirty, items, labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, junk, dirty, items, labels = corpus()
    spark.createDataFrame(rows, DOC_SCHEMA).withColumn("Score", F.lit("own")).withColumn(
        "copies", F.lit("own")).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, junk, dirty, items


def test_every_stage_does_its_work(spark, tables):
    folder, rows, junk, dirty, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.columns, {r[0]: r[1] for r in rows}
    steps = dict(corpus_pipeline.STAGES)

    good = steps["quality"](spark, docs, folder).cache()
    kept = sorted(r.doc_id for r in good.collect())
    assert good.columns == columns and {r.Score for r in good.collect()} == {"own"}
    assert kept == sorted(r[0] for r in rows if r not in junk)

    unique = steps["near_duplicates"](spark, good, folder).cache()
    groups = brute_groups([brute_mark(texts[i]) for i in kept])
    first = {}
    for i, g in zip(kept, groups):
        first[g] = min(first.get(g, i), i)
    left = sorted(r.doc_id for r in unique.collect())
    assert unique.columns == columns and left == sorted(first.values())

    clean = steps["decontaminate"](spark, unique, folder).cache()
    want = [i for i in left if not contamination(texts[i], items)[-1]]
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == want
    assert not {r[0] for r in dirty} & set(want)

    mixed = steps["mix"](spark, clean, folder).cache()
    assert mixed.columns == columns
    copies, sources = Counter(r.doc_id for r in mixed.collect()), {r[0]: r[3] for r in rows}
    size = {i: len(texts[i].split()) for i in want}
    have, took = Counter(), Counter()
    for i in want:
        have[sources[i]] += size[i]
        took[sources[i]] += size[i] * copies[i]
    for source, target in water(have).items():
        assert abs(took[source] - target) <= 2 * max(size.values()) and max(copies.values()) <= 3
    assert set(copies) <= set(want)

    placed = steps["shard"](spark, mixed, folder).collect()
    assert Counter(r.doc_id for r in placed) == copies
    per_shard = Counter(r.shard for r in placed)
    sizes = [per_shard[s] for s in range(corpus_pipeline.SHARDS)]
    assert max(sizes) - min(sizes) <= 1
    for shard, n in per_shard.items():
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(n))


def test_run_returns_all_stages_rows(spark, tables):
    folder, rows, junk, dirty, _ = tables
    out = corpus_pipeline.run(spark, folder)
    found = {r.doc_id for r in out.collect()}
    assert not found & {r[0] for r in junk + dirty} and len(found) > 100
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontaminate", "mix", "shard"]


def test_awkward_rows_in_every_stage(spark, tables):
    """Null, empty, blank, very long, repeated and null-id rows as the input of each stage."""
    folder, _, _, _, items = tables
    rows = doc_rows()
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    steps, counted = dict(corpus_pipeline.STAGES), Counter(rows)

    def after(name):
        out = steps[name](spark, docs, folder)
        assert out.columns[:len(docs.columns)] == docs.columns
        return [tuple(r) for r in out.collect()]

    good = Counter(after("quality"))
    judged = {}
    for row, n in counted.items():                          # a row is judged by its text alone
        assert good[row] in (0, n) and judged.setdefault(row[1] or "", good[row] > 0) == (good[row] > 0)
    assert not set(good) - set(counted)

    groups = {}
    for row, group in zip(rows, brute_groups([brute_mark(r[1] or "") for r in rows])):
        groups.setdefault(group, []).append(row)
    unique = after("near_duplicates")
    assert len(unique) == len(groups)
    for members in groups.values():
        least = min((r[0] is None, r[0] or 0) for r in members)
        assert sum((r[0] is None, r[0] or 0) == least for r in unique if r in members) == 1

    clean = Counter(after("decontaminate"))
    assert clean == Counter(r for r in rows if not contamination(r[1] or "", items)[-1])

    mixed = Counter(after("mix"))
    assert not set(mixed) - set(counted) and all(mixed[r] <= 3 * n for r, n in counted.items())

    placed = steps["shard"](spark, docs, folder).collect()
    assert Counter(tuple(r)[:len(docs.columns)] for r in placed) == counted


def test_empty_table(spark, tables, tmp_path):
    folder = tables[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.llm_queries())
    assert numbers == list(range(1, 14))
    assert set(queries.llm_oracles()) <= set(queries.llm_queries())
