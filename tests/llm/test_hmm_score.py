import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import hmm_score as hmm
from tests.llm.fixtures import doc_rows, docs, empty


def small_model(seed=1, states=3, classes=5):
    rng = np.random.default_rng(seed)
    return hmm.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states),
                     rng.dirichlet(np.ones(classes), states))


def paths(codes, model):
    """All state paths with their joint probability."""
    for path in itertools.product(range(len(model.start)), repeat=len(codes)):
        p = model.start[path[0]] * model.emit[path[0], codes[0]]
        for a, b, c in zip(path, path[1:], codes[1:]):
            p *= model.move[a, b] * model.emit[b, c]
        yield path, p


def test_likelihood_and_expectations_by_enumeration():
    model, rng = small_model(), random.Random(3)
    texts = [[rng.randrange(5) for _ in range(n)] for n in (1, 6, 3, 3, 2)]
    coded = [np.array(t, dtype=np.int16).tobytes() for t in texts]
    got = hmm.log10_likelihood(coded, model)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for text, value in zip(texts, got):
        every = list(paths(text, model))
        total = sum(p for _, p in every)
        assert value == pytest.approx(math.log10(total), rel=1e-12)
        for path, p in every:
            start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                move[a, b] += p / total
            for s, c in zip(path, text):
                emit[s, c] += p / total
    s, m, e = hmm.expected_counts(coded, model)
    assert np.allclose(s, start, atol=1e-4) and np.allclose(m, move, atol=1e-4)
    assert np.allclose(e, emit, atol=1e-4)


def test_very_long_sequences_stay_finite():
    coded = [np.zeros(60_000, dtype=np.int16).tobytes(), np.zeros(2, dtype=np.int16).tobytes()]
    assert np.isfinite(hmm.log10_likelihood(coded, small_model())).all()
    assert np.isfinite(hmm.expected_counts(coded, small_model())[1]).all()


def test_tokens():
    assert hmm.tokens_of("A b\u00a0c\x0bÉ\x1cd".encode()) == [
        b"a", "b\u00a0c".encode(), "É\x1cd".encode(), b""]


def test_columns_by_brute_force(spark):
    rows = doc_rows()
    table = docs(spark).withColumn("score", F.lit("own")).withColumn("word", F.lit("mine"))
    out = hmm.score_texts(table).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0      # noqa: E731
    counts = Counter(t for i, text, *_ in rows if not held(i)
                     for t in hmm.tokens_of((text or "").encode()))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, text, *_ in rows:
        tokens = hmm.tokens_of((text or "").encode())
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        want.append((str(i), held(i), len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in out) == sorted(want)
    assert {r.word for r in out} == {"mine"} and all(r.score < 0 for r in out)


def plain_score(text, counts, lexicon, model):
    """log10 P(text) by the forward recursion over states, token by token."""
    own = {w: i for i, w in enumerate(lexicon.words[:hmm.OWN_CLASSES])}
    of_class = Counter()
    for word, n in counts.items():
        if word not in own:
            of_class[hmm.shape_class(word)] += 1
    total, state = 0.0, list(model.start)
    for k, token in enumerate(hmm.tokens_of((text or "").encode())):
        if k:
            state = [sum(state[a] * model.move[a][b] for a in range(len(state))) for b in range(len(state))]
        c, inside = own.get(token), 1.0
        if c is None:
            c = hmm.shape_class(token)
            held = sum(n for w, n in counts.items() if w not in own and hmm.shape_class(w) == c)
            inside = (counts[token] + 0.1) / (held + 0.1 * (of_class[c] + 1))
        state = [p * model.emit[s][c] * inside for s, p in enumerate(state)]
        scale = sum(state)
        total += math.log10(scale)
        state = [p / scale for p in state]
    return total


@pytest.mark.parametrize("lookup", [131072, 60])
def test_scores_by_a_plain_forward_recursion(spark, monkeypatch, lookup):
    """The whole query: counts, classes, the join of rare words and the recursion."""
    made, real = [], hmm.baum_welch
    monkeypatch.setattr(hmm, "LOOKUP_WORDS", lookup)       # the rest goes through the join

    def training(encoded, lexicon, *rest):
        made.append((lexicon, real(encoded, lexicon, *rest)))
        return made[0][1]
    monkeypatch.setattr(hmm, "baum_welch", training)
    rows = [r for r in doc_rows() if len(r[1] or "") < 900][:60]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0      # noqa: E731
    counts = Counter(t for i, text, *_ in rows if not held(i) for t in hmm.tokens_of((text or "").encode()))
    own_table = spark.createDataFrame([(k, r[0], r[1]) for k, r in enumerate(rows)], "nth int, doc_id long, text string")
    for r in hmm.score_texts(own_table).collect():
        want = plain_score(rows[r.nth][1], counts, *made[0])
        assert r.score == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_small_lookup_gives_the_same_scores(spark, monkeypatch):
    whole = {r.doc_id: r for r in hmm.score_texts(docs(spark).filter("doc_id < 60")).collect()}
    monkeypatch.setattr(hmm, "LOOKUP_WORDS", 8200)     # the rest goes through the join
    monkeypatch.setattr(hmm, "STEP_TOKENS", 500)
    for r in hmm.score_texts(docs(spark).filter("doc_id < 60")).collect():
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score, rel=1e-9)
        assert r.n_known == whole[r.doc_id].n_known


def test_token_probabilities_add_up():
    words = tuple(f"w{i}".encode() for i in range(9000))
    counts = np.arange(9001, 1, -1)
    own = hmm.OWN_CLASSES
    n = own + hmm.SHAPE_CLASSES
    class_count, class_words = np.zeros(n), np.zeros(n)
    class_count[:own], class_words[:own] = counts[:own], 1
    for w, c in zip(words[own:], counts[own:]):
        class_count[hmm.shape_class(w)] += c
        class_words[hmm.shape_class(w)] += 1
    lexicon = hmm.Lexicon(words, counts, class_count, class_words, int(counts.sum()), 9000)
    _, classes, _, inner = lexicon.tables()
    unknown = hmm.ADD / lexicon.class_sum()[own:]
    prior = lexicon.prior()
    total = (prior[classes] * 10 ** inner).sum() + (prior[own:] * unknown).sum()
    assert total == pytest.approx(1.0, abs=1e-9) and prior.sum() == pytest.approx(1.0)


def test_two_languages_are_told_apart(spark):
    rng, rows = random.Random(2), []
    for i in range(300):
        side = i % 2
        rows.append((i, " ".join(f"{'ab'[side]}{min(rng.randrange(40), rng.randrange(40))}"
                                 for _ in range(60)), None, None, None))
    out = [r for r in hmm.score_texts(docs(spark, rows), states=2, passes=4).collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in out) / sum(r.n_tokens for r in out)
    assert gain > 0.2


def test_empty_tables(spark):
    assert hmm.score_texts(empty(spark)).count() == 0
    held_only = docs(spark).filter(hmm.held_out(F.col("doc_id")))
    for r in hmm.score_texts(held_only).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score)
