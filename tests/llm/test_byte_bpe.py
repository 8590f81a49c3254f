"""Byte-level BPE against tiktoken on the same vocabulary, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from logweave.llm import byte_bpe, pretoken, queries
from logweave.llm.byte_bpe import ByteBpe, decode, encode, ids_array, read_ranks
from tests.llm.fixtures import doc_rows, docs, empty

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ranks_of(name):
    with open(public_tokenizers.path(name), "rb") as file:
        return read_ranks(file.read())


def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(seed, ranks, n=3000):
    rng = random.Random(seed)
    signs = ["'", " ", "  ", "\n", "\t", "s", "t", "re", "ll", "d", "é", "1", "²", "!", "'s", "\x1c", " ", "\xa0",
             "日", "́", "\U0001f600", "\x85", "_", "Ⅷ", "\x00"]
    tokens = list(ranks)
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(14))) for _ in range(n)]
    texts += ["".join(rng.choice("abcdeorstnilhéüñ日") for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    texts += [b"".join(rng.choice(tokens) for _ in range(4)).decode("utf-8", "ignore") for _ in range(n)]
    texts += ["a" * k for k in range(1, 70)] + ["ab" * k for k in range(1, 50)] + [" " * k + "x" for k in range(40)]
    return texts + ["<|endoftext|>", "", "x" * 50000, "'s'S 's"]


def test_pattern_matches_are_those_of_the_pattern():
    texts = odd_texts(1, ranks_of("byte_bpe_50k.tiktoken"))
    matches, ends = pretoken.split_texts(texts)
    pattern, at = regex.compile(public_tokenizers.PATTERN), 0
    for text, end in zip(texts, ends.tolist()):
        assert matches[at:end] == pattern.findall(text), text
        at = end


def test_work_is_cut_between_texts(monkeypatch):
    texts = odd_texts(2, ranks_of("byte_bpe_50k.tiktoken"), 200)
    whole = pretoken.split_texts(texts)
    monkeypatch.setattr(pretoken, "WORK_CHARS", 30)
    parts = pretoken.split_texts(texts)
    assert parts[0] == whole[0] and (parts[1] == whole[1]).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_are_those_of_the_library(name, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_REMEMBERED", 500)         # what is forgotten is found again
    ranks = ranks_of(name)
    bpe, library = ByteBpe(ranks), reference(ranks)
    texts = odd_texts(3, ranks)
    for text, packed in zip(texts, bpe.encode_texts(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), text
        assert bpe.decode(packed) == text.encode()


def test_small_vocabularies_with_tokens_out_of_reach():
    """Random vocabularies: some tokens are made by no merges and only whole matches can be one."""
    rng = random.Random(8)
    for _ in range(60):
        tokens = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))).encode() for _ in range(12)}
        ordered = [bytes([b]) for b in range(256)] + sorted(tokens, key=lambda t: (len(t), rng.random()))
        ranks = {t: i for i, t in enumerate(ordered)}
        bpe, library = ByteBpe(ranks), reference(ranks)
        for _ in range(60):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 16)))
            assert bpe.encode_match(text.encode()) == library.encode_ordinary(text), (ordered[256:], text)


def test_columns_on_spark(spark):
    rows = doc_rows()
    library = reference(ranks_of("byte_bpe_50k.tiktoken"))
    df = docs(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("n_chars", "N_Tokens")
    coded = encode(df, VOCABULARY)
    assert coded.columns == ["doc_id", "text", "source", "n_tokens", "ids"]
    back = decode(coded, VOCABULARY).withColumn("list", ids_array())
    assert back.columns == ["doc_id", "text", "source", "n_tokens", "ids", "decoded", "list"]
    found = sorted((r.doc_id or -1, r.source or "", r.text or "", r.n_tokens, tuple(r.list), bytes(r.decoded))
                   for r in back.collect())
    expected = []
    for i, text, _, source, _ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((i or -1, source or "", text or "", len(ids), tuple(ids), (text or "").encode()))
    assert found == sorted(expected)


def test_empty_table_and_null_ids(spark):
    assert decode(encode(empty(spark), VOCABULARY), VOCABULARY).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bytes(decode(nulls, VOCABULARY).collect()[0].decoded) == b""


def test_query_digests(spark):
    path = "/root/testdata/sf0.001"
    library = reference(ranks_of("byte_bpe_50k.tiktoken"))
    expected = {}
    for r in spark.read.parquet(f"{path}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        expected[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                              hashlib.sha256((r.text or "").encode()).hexdigest())
    found = {r.doc_id: tuple(r)[1:] for r in queries.op13_backtracking_bpe(spark, path).collect()}
    assert found == expected


def test_missing_bytes_are_refused():
    with pytest.raises(ValueError):
        ByteBpe({b"a": 0})
