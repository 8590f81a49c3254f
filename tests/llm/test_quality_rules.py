import math
import random
import re
import string
import unicodedata
import zlib

from pyspark.sql import functions as F

from logweave.llm import quality_rules as quality
from tests.llm.fixtures import doc_rows, docs, empty, words


def labelled(spark, count=400):
    rng, rows, labels = random.Random(1), [], []
    for i in range(count):
        good = i % 4 != 0
        text = (words(rng, rng.randrange(30, 80)).capitalize() + "." if good else
                " | ".join(f"w{rng.randrange(99)}" for _ in range(40)))
        rows.append((i, text, "en", "s", None))
        labels.append((i, int(good), 0))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart_and_never_learnt(spark):
    table, labels = labelled(spark)
    out = quality.score_ids(table, labels).toPandas().set_index("id")
    for i, r in out.iterrows():
        held = zlib.crc32(str(i).encode()) % 5 == 0
        assert r.held_out == held and r.predicted == (r.score >= 0.3) == (i % 4 != 0)
    flipped = labels.withColumn("quality", F.when(
        quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score_ids(table, flipped).toPandas().set_index("id")
    assert (again.score.sort_index() == out.score.sort_index()).all()


def plain_statistics(text):
    """The eleven statistics of a text."""
    white = " \t\n\x0b\x0c\r"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = re.findall(r"[^\n]+", text)
    share = lambda a, b: a / max(b, 1)                                               # noqa: E731
    stops = len(re.findall(r"[.,;:?!]+(?=[\x20\x09-\x0D]|\Z|\n\Z)", text))
    return (math.log1p(len(words)), share(len(text), len(words)), share(len(words), len(lines)),
            share(sum(c in string.punctuation for c in text), len(text)), share(stops, len(words)),
            share(sum(unicodedata.category(c) == "Lu" for c in text), len(text)),
            share(sum(c in string.digits for c in text), len(text)),
            share(sum(len(w) == 1 for w in words), len(words)),
            share(len(set(re.split(r"[\x20\x09-\x0D]+", text))), len(words)),
            share(len(set(text.split("\n"))), len(lines)), share(len(text.encode()), len(text)))


def test_statistics_by_plain_python(spark):
    texts = [r[1] or "" for r in doc_rows()] + ["A b, c! d.\ne; f\n\n", "...", "x\ty 1 2 33", "a\na\nb", "ÄÖ é .,"]
    table = spark.createDataFrame(list(enumerate(texts)), "nth int, text string")
    got = quality.with_statistics(table, "text", ["nth"]).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_statistics(texts[r.nth])
        for name, value in zip(quality.STATISTICS, want):
            assert abs(r[name] - value) < 1e-9, (name, texts[r.nth][:60], r[name], value)


def test_rules_are_paths_and_the_score_is_compiled(spark):
    text = """RandomForest
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 3 > 0.5)
     If (feature 3 <= 0.9)
      Predict: 1.0
     Else (feature 3 > 0.9)
      Predict: 0.0
"""
    assert quality.paths_of(text) == [
        ((3, "<=", 0.5),), ((1, "<=", 2.0), (3, "<=", 0.5)), ((1, ">", 2.0), (3, "<=", 0.5)),
        ((3, ">", 0.5),), ((3, "<=", 0.9), (3, ">", 0.5)), ((3, ">", 0.9),)]
    model = quality.RuleModel(-1.0, ((((0, "<=", 3.0), (1, ">", 1.0)), 2.5), (((1, ">", 5.0),), -4.0)),
                              ("a", "b"))
    table = spark.createDataFrame([(1.0, 2.0), (9.0, 2.0), (3.0, 6.0)], "a double, b double")
    got = [r[0] for r in table.select(model.score()).collect()]
    want = [1 / (1 + math.exp(-x)) for x in (1.5, -1.0, -2.5)]
    assert all(abs(g - w) < 1e-12 for g, w in zip(got, want))


def test_awkward_rows_labels_and_names(spark):
    table = docs(spark).withColumn("score", F.lit("own")).withColumn("chars", F.lit("mine"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (5, None), (6, 7), (None, 1), (999, 0)],
                                   "doc_id long, quality int")
    out = quality.score_quality(table, labels).collect()
    assert len(out) == len(doc_rows()) and {r.chars for r in out} == {"mine"}
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    blank = {r.score for r in out if not (r.text or "")}
    assert len(blank) == 1


def test_no_labels_one_kind_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert {r.score for r in quality.score_ids(docs(spark), none).collect()} == {0.5}
    assert min(r.score for r in quality.score_ids(docs(spark), ones).collect()) > 0.99
    assert quality.score_ids(empty(spark), ones).count() == 0
    assert quality.score_quality(empty(spark), ones).count() == 0
