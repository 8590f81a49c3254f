"""Alignment of two tokenizers against an alignment token by token."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from logweave.llm import queries, token_align
from logweave.llm.token_align import EncoderA, EncoderB, align_tokens, alignment_counts
from tests.llm.fixtures import doc_rows, docs, empty

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  a  b ", "ab▁c", "<|endoftext|> hi", "\n\nx\t", " ", "日本語 テスト \U0001f600\U0001f600", "<0x41> <unk> </s>",
       "ﬁ Ⅷ é", "a" * 3000, "x" + " " * 70 + "y", "\x00\x1c\x85", "don't 'll  's"]


def tools():
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    with open(A_PATH, "rb") as a, open(B_PATH, "rb") as b:
        return library, model, EncoderA(a.read()), EncoderB(b.read())


def plain(texts):
    """(a ids, b ids, links, cuts) of each text, by the libraries and two loops."""
    library, model, a, b = tools()
    out = []
    for text in texts:
        ids_a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(e.token_bytes[i] for i in ids) != whole for e, ids in ((a, ids_a), (b, ids_b))):
            out.append(([], [], [], []))
            continue
        ends_a = np.cumsum([len(a.token_bytes[i]) for i in ids_a]).tolist()
        ends_b = np.cumsum([len(b.token_bytes[i]) for i in ids_b]).tolist()
        links, first = [], 0
        for i, end in enumerate(ends_a):
            begin = ends_a[i - 1] if i else 0
            while ends_b[first] <= begin:
                first += 1
            j = first
            while j < len(ends_b) and (ends_b[j - 1] if j else 0) < end:
                links.append((i, j))
                j += 1
        out.append((ids_a, ids_b, links, sorted(set(ends_a) & set(ends_b)), ends_a, ends_b))
    return out


def plain_rows(rows):
    """The digest of (id, text) rows over the whole corpus."""
    aligned = plain([t for _, t in rows])
    counts = Counter((x[0][i], x[1][j]) for x in aligned for i, j in x[2])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc, _), x in zip(rows, aligned):
        if not x[0]:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, links, cuts, ends_a, ends_b = x
        groups, at_a, at_b = [], 0, 0
        place_a, place_b = ({end: k + 1 for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
        for cut in cuts:
            to_a, to_b = place_a[cut], place_b[cut]
            groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        found = [counts[ids_a[i], ids_b[j]] for i, j in links]
        best = sum(n == highest[ids_b[j]] for n, (_, j) in zip(found, links))
        out.append((doc, len(ids_a), len(ids_b), len(groups), len(links), best, sum(found),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def test_query_digest_against_token_by_token(spark):
    rows = [(r[0], r[1]) for r in doc_rows()] + [(1000 + k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, chunk string, n_a long")
    found = alignment_counts(df.repartition(3), A_PATH, B_PATH)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert in_order(map(tuple, found.collect())) == in_order(plain_rows(rows))


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text").collect()]
    found = queries.op12_lockstep_alignment(spark, "/root/testdata/sf0.001")
    assert in_order(map(tuple, found.collect())) == in_order(plain_rows(rows))


@pytest.mark.parametrize("lane, tries", [(1, 1), (3, 2), (7, 1)])
def test_lanes_change_nothing(lane, tries, monkeypatch):
    monkeypatch.setattr(token_align, "LANE_TOKENS", lane)
    monkeypatch.setattr(token_align, "BORDER_TRIES", tries)
    texts = [r[1] or "" for r in doc_rows() if len(r[1] or "") < 5000] + ODD
    _, _, one, two = tools()
    a, b = token_align.encode_batch(one, two, texts)
    links_a, links_b, cuts_a, cuts_b = token_align.merge_in_lockstep(a, b)
    found, low_a, low_b, position = set(zip(links_a.tolist(), links_b.tolist())), 0, 0, 0
    assert len(found) == len(links_a)
    expected, expected_cuts = set(), set()
    for x, high_a, high_b in zip(plain(texts), a.doc_ends.tolist(), b.doc_ends.tolist()):
        assert a.ids[low_a:high_a].tolist() == x[0] and b.ids[low_b:high_b].tolist() == x[1]
        expected |= {(i + low_a, j + low_b) for i, j in x[2]}
        if x[0]:
            place = {end: k for k, end in enumerate(x[4])}
            expected_cuts |= {low_a + place[c] for c in x[3]}
        low_a, low_b = high_a, high_b
    assert found == expected and set(cuts_a.tolist()) == expected_cuts and len(cuts_a) == len(cuts_b)


def test_small_chunks_and_memory(monkeypatch):
    """Chunks of a few texts, and encoders that forget."""
    monkeypatch.setattr(token_align, "MOST_REMEMBERED", 10)
    texts = [r[1] or "" for r in doc_rows()][:40] + ODD
    _, _, one, two = tools()
    whole = token_align.encode_batch(one, two, texts)
    for k, text in enumerate(texts):
        a, b = token_align.encode_batch(one, two, [text])
        low = whole[0].doc_ends[k - 1] if k else 0
        assert a.ids.tolist() == whole[0].ids[low:whole[0].doc_ends[k]].tolist()


def test_operator_returns_tokens_links_and_cuts(spark):
    rows = [(1, "Hello world."), (2, None), (3, "  a  b ")]
    found = {r.doc_id: r for r in align_tokens(
        spark.createDataFrame(rows, "doc_id long, text string"), A_PATH, B_PATH).collect()}
    for doc, x in zip((1, 2, 3), plain([t for _, t in rows])):
        assert (found[doc].a_ids, found[doc].b_ids) == (x[0], x[1])
        assert list(zip(found[doc].link_a, found[doc].link_b)) == x[2]
        assert found[doc].cut_a == ([x[4].index(c) + 1 for c in x[3]] if x[0] else [])
        assert found[doc].cut_b == ([x[5].index(c) + 1 for c in x[3]] if x[0] else [])


def test_many_small_chunks_meet_their_counts(spark, monkeypatch):
    """Every chunk asks for its own pairs; large numbers of links and steps take the wide form."""
    rows = [(k, "the " * (400 + k) + "cat sat") for k in range(30)] + [(100, "dog " * 3)]
    found = alignment_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(12), A_PATH, B_PATH)
    assert in_order(map(tuple, found.collect())) == in_order(plain_rows(rows))


def test_empty_table(spark):
    assert alignment_counts(empty(spark), A_PATH, B_PATH).count() == 0
    assert docs(spark, [(1, None, None, None, None)]).transform(
        lambda d: alignment_counts(d, A_PATH, B_PATH)).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")
