import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logweave.llm import exact_index
from tests.llm.fixtures import doc_rows, docs, empty


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    return groups


def check(out, rows):
    groups = brute(rows)
    assert len(out) == len(rows)
    kept = defaultdict(int)
    for r in out:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        known = [i for i in groups[text] if i is not None]
        assert r.doc_id in groups[text]
        assert r.keep_id == (max(known) if known else None)
        assert r.group_size == len(groups[text])
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[text] += 1
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_groups_by_brute_force(spark):
    table = docs(spark).withColumn("kept", F.lit(5)).withColumn("key", F.lit("mine"))
    out = exact_index.exact_dedup(table).collect()
    check(out, doc_rows())
    assert {r.key for r in out} == {"mine"} and {r.chain_position for r in out} == {0}


def test_directory_doubles_and_every_page_has_its_bucket(spark):
    rows = [(i, f"text {i % 500}", None, None, None) for i in range(900)]
    index = exact_index.build_index(docs(spark, rows), bucket_rows=16)
    assert index.global_depth >= 5
    check(exact_index.look_up(index).collect(), rows)
    loads = index.pages.groupBy("bucket").count().collect()
    assert sum(r["count"] for r in loads) == 500
    buckets = {r.bucket: r for r in index.directory.collect()}
    for r in loads:
        assert r["count"] == buckets[r.bucket].load <= 16
        slots = [s for s in index.directory.collect() if s.bucket == r.bucket]
        assert len(slots) == 2 ** (index.global_depth - slots[0].local_depth)
    parts = index.pages.groupBy(F.input_file_name().alias("f")).agg(
        F.min("bucket").alias("a"), F.max("bucket").alias("b")).orderBy("a").collect()
    assert all(x.b <= y.a for x, y in zip(parts, parts[1:]))        # owners hold key ranges


def test_rows_go_through_the_directory(spark, monkeypatch):
    """Without a slot for its key no row is grouped; entries and pages lie in the bucket it names."""
    rows = [(i, f"text {i % 500}", None, None, None) for i in range(900)]
    index = exact_index.build_index(docs(spark, rows), bucket_rows=16)
    slots = {r.slot: r.bucket for r in index.directory.collect()}
    depth = index.global_depth
    for frame in (index.entries, index.pages):
        for r in frame.select("key", "bucket").collect():
            assert slots[(r.key & 0xFFFFFFFFFFFFFFFF) >> (64 - depth)] == r.bucket
    real = exact_index.directory_of

    def with_a_gap(keys, bucket_rows):
        directory, depth = real(keys, bucket_rows)
        gone = directory.agg(F.min("slot")).first()[0]
        return directory.filter(F.col("slot") != gone), depth
    monkeypatch.setattr(exact_index, "directory_of", with_a_gap)
    with pytest.raises(Exception, match="no slot for a key"):
        exact_index.exact_dedup(docs(spark, rows), bucket_rows=16).collect()


def test_empty_table_and_one_hot_text(spark):
    assert exact_index.exact_dedup(empty(spark)).count() == 0
    rows = [(i, "hot" if i % 3 else f"t{i}", None, None, None) for i in range(300)]
    check(exact_index.exact_dedup(docs(spark, rows), bucket_rows=8).collect(), rows)


def test_plan_has_no_python(spark):
    plan = exact_index.exact_dedup(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
