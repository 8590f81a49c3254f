import random
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from logweave.llm import simhash_cover as sim
from tests.llm.fixtures import doc_rows, docs, empty


def brute_mark(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks, threshold=2):
    nodes = sorted(set(marks))
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if bin(a ^ b).count("1") <= threshold:
                parent[find(a)] = find(b)
    return [find(m) for m in marks]


def test_hash_equals_sparks(spark):
    got = spark.sql("SELECT xxhash64('a b c') AS h").first().h & 0xFFFFFFFFFFFFFFFF
    assert got == xxhash.xxh64_intdigest(b"a b c", 42)


def test_the_code_is_perfect_and_anchors_are_complete():
    rng = random.Random(1)
    for _ in range(300):
        word = rng.getrandbits(23)
        near = sim._errors()[sim.syndrome_of(word)]
        assert sum(len(w) for w in near[:4]) == 1                 # exactly one codeword within 3
        assert all(sim._syndrome(word ^ e) == 0 for w in near for e in w)
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randrange(3)):
            y ^= 1 << bit
        assert sim.anchors_of(x, 0)[0] in set(sim.anchors_of(y, 2)[1].tolist())
    home, near = sim.anchors_of(rng.getrandbits(64), 2)
    assert len(set(near.tolist())) == len(near) and home in near


def test_links_by_brute_force(spark):
    rng = random.Random(5)
    marks = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        marks.add(centre)
        for _ in range(12):
            near = centre
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                near ^= 1 << bit
            marks.add(near)
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in marks)
    got = sorted((r.a, r.b) for r in sim.near_links(
        spark.createDataFrame([(m,) for m in signed], "mark long")).collect())
    want = sorted((a, b) for i, a in enumerate(signed) for b in signed[i + 1:]
                  if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2)
    assert got == want and len(want) > 100


def test_groups_of_awkward_rows(spark):
    rows = doc_rows()
    marks = [brute_mark(r[1]) for r in rows]
    least, members = {}, defaultdict(list)
    for row, group in zip(rows, brute_groups(marks)):
        members[group].append(row[0])
        known = [i for i in members[group] if i is not None]
        least[group] = min(known) if known else None
    want = sorted((str(r[0]), f"{m:016x}", str(least[g]))
                  for r, m, g in zip(rows, marks, brute_groups(marks)))
    table = docs(spark).withColumn("mark", F.lit("own")).withColumn("fingerprint", F.lit(0))
    out = sim.near_groups(table).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in out) == want
    assert {r.mark for r in out} == {"own"}
    chosen = defaultdict(int)
    for r in out:
        chosen[r.component_id] += r.representative
        assert not r.representative or r.doc_id == r.component_id
    assert set(chosen.values()) == {1}
    slim = sim.fingerprints(docs(spark)).collect()
    assert sorted((str(r.id), r.fingerprint, str(r.component_id)) for r in slim) == want


def test_empty_table_and_long_text(spark):
    assert sim.near_groups(empty(spark)).count() == 0
    long_text = " ".join(f"w{i % 9001}" for i in range(150_000))
    assert sim.fingerprint(long_text.encode()) == brute_mark(long_text)
