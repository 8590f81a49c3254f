"""Repair of conversations: the search against a best-first search, the query against plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from logweave.llm import convo_repair, queries
from logweave.llm.convo_repair import (apply_edits, cheapest_edits, conversation_hashes, damage, find_repairs,
                                       repaired_rows)

SCHEMA = "conv_id long, turn long, role string, text string, audit string, conv string"
WHITE = " \t\n\x0b\x0c\r"
LEGAL, BEGUN = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")


def best_first(rows):
    """(cost, edits) of rows (must go, extra cost if it stays, initial): cheapest, then least in ASCII order."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, path, at, roles = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch(roles):
            return cost, path
        if (at, roles[-1:]) in seen:
            continue
        seen.add((at, roles[-1:]))
        ways = [(3, "I", at, roles + x) for x in "ua"]
        if at < len(rows):
            must_go, extra, initial = rows[at]
            ways.append((4, "D", at + 1, roles))
            if not must_go:
                ways.append((extra, "K", at + 1, roles + initial))
                ways += [(3 + extra, "R", at + 1, roles + x) for x in "ua"]
        for more, edit, upto, now in ways:
            if BEGUN.fullmatch(now) and (edit != "K" or rows[at][2]):
                heapq.heappush(heap, (cost + more, path + edit, upto, now))


def plain(rows):
    """The query's results of (conv_id, turn, role, text) rows."""
    blank = lambda x: " " if x is None else str(x)
    by_conv = {}
    for conv, turn, role, text in rows:
        kept = by_conv.setdefault(conv, [])
        role, text = blank(role), blank(text)
        fault = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        kept += [row] * (2 if fault == 3 else 1)
    out = {}
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, coded, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            bare = text.rstrip(WHITE)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            coded.append((fault in ("blank", "duplicate"), 3 * (fault == "truncated"), role[:1]))
        initials = [c[2] for c in coded]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        cost, audit = best_first(coded)
        lines, at, roles = [], 0, ""
        for edit in audit:
            given = "a" if roles[-1:] == "u" else "u"
            full = {"a": "assistant", "u": "user"}[given]
            if edit == "I":
                lines.append(full + ":")
                roles += given
            else:
                _, role, text = kept[at]
                at += 1
                if edit == "D":
                    continue
                lines.append(f"{full if edit == 'R' else role}:{text}")
                roles += given if edit == "R" else role[0]
        turns = {r[0] for r in kept if r[0] is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"],
                     counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, conversations=150):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "cut off", "", " \t\n", "Why?  \n", "a\nb.", "Été…", None, "Same."]
    rows = []
    for conv in range(conversations):
        roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * rng.randrange(0, 5) + ["user"]
        for turn, role in enumerate(roles):
            if rng.random() < 0.1:
                role = rng.choice(["user", "tool", "", None, "system"])
            rows.append((conv, None if rng.random() < 0.05 else turn + (rng.random() < 0.1) * 3, role,
                         rng.choice(said) if rng.random() < 0.3 else f"Text {rng.randrange(10 ** 6)}."))
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "None."), (None, None, None, None)]
    rows += [(900, t, "user" if t % 2 else "assistant", f"long {t}.") for t in range(300)]
    rows += [(901, 3, "user", "x" * 200000 + "."), (901, 4, "assistant", "ok.")]
    rows += [(902, 1, "user", "twice."), (902, 1, "user", "twice."), (902, 1, "assistant", "tie."),
             (902, 1, "assistant", "another tie.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", "theirs") for r in rows], SCHEMA).repartition(5)


def repaired(spark, monkeypatch, rows):
    monkeypatch.setattr(queries, "read_table", lambda *_: frame(spark, rows))
    result = queries.op11_repair_conversations(spark, "")
    assert [t for _, t in result.dtypes] == ["bigint"] * 7 + ["string"] * 2
    return {r[0]: tuple(r)[1:] for r in result.collect()}


def test_search_finds_the_cheapest_and_least_edits():
    rng = random.Random(4)
    for _ in range(1500):
        codes = "".join("%x" % rng.randrange(16) for _ in range(rng.randrange(0, 12)))
        rows = [(int(c, 16) // 4 in (1, 2), 3 * (int(c, 16) // 4 == 3), ("s", "u", "a", "")[int(c, 16) % 4])
                for c in codes]
        assert cheapest_edits(codes) == best_first(rows) == cheapest_edits(codes, 2), codes


def test_long_conversations_by_stretches():
    rng = random.Random(5)
    codes = "".join("12"[i % 2] if rng.random() > 0.2 else "%x" % rng.randrange(16) for i in range(300))
    assert cheapest_edits(codes) == cheapest_edits(codes, 1000) == cheapest_edits(codes, 7)


def test_query_against_plain_python(spark, monkeypatch):
    rows = random_rows(1)
    assert repaired(spark, monkeypatch, rows) == plain(rows)


def test_strings_of_codes_over_many_pieces(spark, monkeypatch):
    """A conversation that is cut by partitions and by the length of strings."""
    monkeypatch.setattr(convo_repair, "CODES_ROWS", 5)
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t // 3}.") for t in range(400)] + random_rows(2, 20)
    assert repaired(spark, monkeypatch, rows) == plain(rows)


def test_given_tables(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert repaired(spark, monkeypatch, rows) == plain(rows)


def test_empty_table_and_all_dropped(spark, monkeypatch):
    assert repaired(spark, monkeypatch, []) == {}
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(spark, monkeypatch, [(conv, 0, "user", "Gone.")]) == {
        conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_operator_returns_repaired_rows(spark):
    """Rows without damage: texts, positions and edits of what stays."""
    rows = spark.createDataFrame([(7, 0, "user", "Hi.", 1), (7, 1, "user", "More.", 1), (7, 2, "tool", "", 1),
                                  (8, 0, "tool", "", 1)],
                                 "conv long, turn long, role string, text string, copies long")
    repairs = find_repairs(rows)
    assert {(r.conv, r.cost, r.audit) for r in repairs.collect()} == {(7, 7, "KRD"), (8, 4, "D")}
    left = repaired_rows(rows, repairs)
    assert sorted(map(tuple, left.collect())) == [(7, 0, "K", "user", "Hi."), (7, 1, "R", "assistant", "More.")]
    assert conversation_hashes(left).collect()[0].repaired_sha256 == hashlib.sha256(
        b"user:Hi.\nassistant:More.").hexdigest()
    assert damage(rows, conv="conv").columns == ["conv", "turn", "role", "text", "copies"]


def test_edits_are_applied_in_order():
    rows = [("system", "S."), ("user", "U."), ("user", "V.")]
    assert list(apply_edits(iter("KKIKI"), iter(rows))) == [
        ("K", "system", "S."), ("K", "user", "U."), ("I", "assistant", ""), ("K", "user", "V."), ("I", "assistant", "")]


@pytest.mark.parametrize("codes, expected", [("", (0, "")), ("12", (0, "KK")), ("1", (3, "KI")), ("0", (4, "D")),
                                             ("5", (4, "D")), ("d2", (3, "KK")), ("3", (4, "D"))])
def test_small_cases(codes, expected):
    assert cheapest_edits(codes) == expected
