"""Small tables with every awkward case: nulls, empties, long texts, ties, repeats, clashing names."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def doc_rows(seed=3):
    rng = random.Random(seed)
    rows = []
    base = words(rng, 120)
    for i in range(60):
        rows.append((i, words(rng, rng.randrange(5, 150)), "en", f"s{i % 3}", i))
    rows += [(100 + i, base, "de", "s0", 5) for i in range(12)]                 # copies
    tokens = base.split()
    for i in range(10):                                                          # near copies
        changed = list(tokens)
        changed[7 * i + 3] = f"x{i}"
        rows.append((200 + i, " ".join(changed), None, "s1", None))
    rows += [(300, None, None, None, None), (301, "", "en", None, 0), (302, " \t\n ", "en", "", 1),
             (303, "One", "en", "s2", 3), (304, "one two", "en", "s2", 7),
             (305, words(rng, 20000), "en", "s1", 1), (306, "Été naïve 日本語 \U0001f600 Z", "fr", "s1", 9)]
    rows += [(400, "twice the same row", "en", "s1", 2)] * 2
    rows += [(None, "no id here at all", "en", "s1", 2), (None, "no id here at all", "en", "s2", 2)]
    return rows


def docs(spark, rows=None):
    return spark.createDataFrame(doc_rows() if rows is None else rows, DOC_SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
