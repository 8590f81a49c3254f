import hashlib
import random
import re

from pyspark.sql import functions as F

from logweave.llm import decontam
from tests.llm.fixtures import doc_rows, docs, empty

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.decode() for w in WORD.findall(lowered.encode())]


def brute(text, items, window=13):
    words, hit, found = split(text), set(), set()
    for item, body in items:
        own = split(body)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == own[k:k + n]:
                    hit.update(range(at, at + n))
                    found.add(item)
    ids = ",".join(sorted(map(str, found)))
    return (len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(words))


def benchmark():
    rng = random.Random(8)
    texts = [t for _, t, *_ in doc_rows() if t and 20 < len(t.split()) < 200]
    items = [(i, " ".join(rng.choice(texts).split()[4:4 + rng.randrange(13, 30)])) for i in range(9)]
    items += [(20, "One"), (21, "one, TWO!"), (22, "w1 w2 w3"), (23, ""), (24, None), (25, "?!"),
              (26, items[0][1]), (2, items[1][1]), (27, "été NAÏVE 日本語"), (10, "a-b-a-b-a-b-a-b-a-b-a-b-a-b-a-b")]
    return items


def test_words():
    assert decontam.words_of("A1-b É_x\u00a0y\tz".encode()) == [
        b"a1", b"b", "É".encode(), "x\u00a0y".encode(), b"z"]


def test_search_by_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))) for i in range(4)]
        text = " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))
        search = decontam.WordSearch([(i, t.encode()) for i, t in items], 5)
        words = decontam.words_of(text.encode())
        spans, found = search.search(words)
        n_words, n_hit, n_items, _, _ = brute(text, items, 5)
        assert (len(words), decontam.covered(spans), len(found)) == (n_words, n_hit, n_items)


def run(spark, table, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return decontam.find_items(table, bench, **options)


def check(out, rows, items):
    got = sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                           for r in out)))
    assert got == sorted(map(str, ((r[0], *brute(r[1], items)) for r in rows)))


def test_rows_by_brute_force(spark):
    rows = [r for r in doc_rows() if r[0] != 305]
    rows += [(900, "x y z " * 60 + benchmark()[0][1] + " q", None, None, None),
             (901, "a b " * 12, None, None, None)]
    table = docs(spark, rows).withColumn("items", F.lit("own")).withColumn("hits", F.lit("mine"))
    items = benchmark()
    out = run(spark, table, items).collect()
    check(out, rows, items)
    assert {r.hits for r in out} == {"mine"} and sum(r.contaminated for r in out) > 5
    check(run(spark, docs(spark, rows), items, table_words=20).collect(), rows, items)


def test_empty_tables_and_a_long_text(spark):
    assert run(spark, empty(spark), benchmark()).count() == 0
    out = run(spark, docs(spark), []).collect()
    assert len(out) == len(doc_rows()) and not any(r.n_hit or r.contaminated for r in out)
    rows = [(1, "filler " * 200_000 + "w1 w2 w3", None, None, None)]
    r = run(spark, docs(spark, rows), benchmark()).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (200_003, 3, 1, False)
