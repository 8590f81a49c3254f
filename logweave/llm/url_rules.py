"""URL allow and block rules by a bit-parallel wildcard automaton.

Every rule is a glob: literal bytes, ``?`` for one byte, ``*`` for a run without
``/``, ``**`` for any run.  All globs are packed into one Shift-And state of several
64-bit words: bit i stands for "the first i bytes of the packed globs' own part have
been read".  Reading byte c moves the state on by

    D = (((D << 1) | starts) & literal[c]) | (D & loop[c])

where ``loop[c]`` holds the positions before which a wildcard may swallow c.  A whole
batch of URLs is read column by column, so a step handles every rule and every URL.
Sorting by length lets short URLs drop out; a very long URL costs its own length only.

The canonical URL is ``.host`` + ``path``: the host follows the first ``://`` up to
``/``, ``?``, ``#`` or the end, A-Z lowered; the path goes on to ``?``, ``#`` or the
end.  A rule (host, path) is the glob ``*.host`` + ``path`` + ``**``: it fits its host
and all subdomains if the path starts with the rule's.  Of the rules that fit the
longest decides (then block before allow, then code point order); none: ``default``.

Defined results: a null URL or one without ``://`` has empty host and path and the
default verdict; repeated rows are judged each; an empty table gives an empty result;
other columns come back as they are, one that is named like an output gives way.

Rules of any number: they are packed, in deciding order, into automata of about
``AUTOMATON_STATES`` states, and a URL goes on to the next automaton only if none of the
earlier rules fits.  URLs are read in parts whose state vectors take ``STATE_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import ROW, col, pack, ship_code, unpack

#: states of an automaton; a longer glob is one by itself
AUTOMATON_STATES = 1 << 14
#: bytes of the state vectors of the URLs that are read at once
STATE_BYTES = 8 << 20
OUTPUTS = ("host", "path", "rule", "verdict")


class GlobSet:
    """Shift-And masks of several globs over bytes."""

    def __init__(self, globs: Sequence[str]):
        literal, loops, starts, accepts = [], [], [], []
        for glob in globs:
            steps, loop = self._steps(glob)
            starts.append(len(literal))          # state "nothing read": one bit per glob
            literal += [None, *steps]
            loops += loop
            accepts.append(len(literal) - 1)
        self.words = max(1, -(-len(literal) // 64))
        self.literal = np.zeros((256, self.words), dtype=np.uint64)
        self.loop = np.zeros((256, self.words), dtype=np.uint64)
        self.first = np.zeros(self.words, dtype=np.uint64)
        self.accepts = (np.array([a // 64 for a in accepts], dtype=np.int64),
                        np.array([1 << (a % 64) for a in accepts], dtype=np.uint64))
        for start in starts:
            self.first[start // 64] |= np.uint64(1 << (start % 64))
        for i, (step, loop) in enumerate(zip(literal, loops)):
            bit = np.uint64(1 << (i % 64))
            if step is not None:
                self.literal[list(step), i // 64] |= bit
            if loop:
                self.loop[list(loop), i // 64] |= bit

    @staticmethod
    def _steps(glob: str) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
        """Bytes that take each step, and bytes that each state (before a step) swallows."""
        every, no_slash = tuple(range(256)), tuple(b for b in range(256) if b != 0x2F)
        steps, loops, k, raw = [], [()], 0, glob.encode()
        while k < len(raw):
            if raw[k:k + 2] == b"**":
                loops[-1], k = every, k + 2
            elif raw[k:k + 1] == b"*":
                loops[-1], k = loops[-1] or no_slash, k + 1
            else:
                steps.append(every if raw[k:k + 1] == b"?" else (raw[k],))
                loops.append(())
                k += 1
        return steps, loops

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """(texts, globs) booleans: whether the glob fits the whole text."""
        part = max(1, STATE_BYTES // (8 * self.words + len(self.accepts[0])))
        if len(texts) > part:
            return np.concatenate([self.match(texts[k:k + part]) for k in range(0, len(texts), part)])
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(texts), len(self.accepts[0])), dtype=bool)
        state = np.tile(self.first, (len(texts), 1))
        longest = int(lengths.max(initial=0))
        sorted_lengths, one, top = -lengths[order], np.uint64(1), np.uint64(63)
        live, (words, bits) = len(texts), self.accepts
        ordered = [texts[i] for i in order]
        for at in range(longest + 1):
            more = int(np.searchsorted(sorted_lengths, -at, side="left"))   # longer than ``at``
            out[order[more:live]] = (state[more:live][:, words] & bits) != 0
            live = more
            if not live:
                break
            column = np.frombuffer(bytes([t[at] for t in ordered[:live]]), dtype=np.uint8)
            now = state[:live]
            moved = now << one
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.literal[column]) | (now & self.loop[column])
        return out


def rule_globs(rules: Iterable[tuple[str, str, str]]) -> tuple[list[str], list[tuple[str, str]]]:
    """Globs and (rule, verdict) in deciding order from (host, path, verdict)."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r[0] + r[1]))
    for host, path, _ in ordered:
        if set("*?") & set(host + path):
            raise ValueError(f"wildcards belong to globs, not to rules: {host}{path}")
    return [f"*.{h}{p}**" for h, p, _ in ordered], [(h + p, v) for h, p, v in ordered]


def packed_automata(globs: Sequence[str]) -> list[tuple[int, GlobSet]]:
    """(number of its first glob, automaton) for stretches of the globs."""
    out, start, states = [], 0, 0
    for k, glob in enumerate(globs):
        own = len(glob.encode()) + 1
        if states and states + own > AUTOMATON_STATES:
            out.append((start, GlobSet(globs[start:k])))
            start, states = k, 0
        states += own
    if globs:
        out.append((start, GlobSet(globs[start:])))
    return out


def first_fits(automata: Sequence[tuple[int, GlobSet]], texts: Sequence[bytes]) -> np.ndarray:
    """For each text the number of the first glob that fits it, else -1."""
    out = np.full(len(texts), -1, dtype=np.int64)
    for start, automaton in automata:
        left = np.flatnonzero(out < 0)
        if not len(left):
            break
        fits = automaton.match([texts[i] for i in left])
        some = fits.any(axis=1)
        out[left[some]] = start + fits[some].argmax(axis=1)
    return out


def _judge(rules: Sequence[tuple[str, str, str]], default: str):
    globs, results = rule_globs(rules)
    made: list = []                              # in the worker, so that only the rules travel

    @F.pandas_udf("rule string, verdict string")
    def run(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(packed_automata(globs))
        fits = first_fits(made[0], [f".{h}{p}".encode() for h, p in zip(hosts, paths)])
        picked = [results[k] if k >= 0 else (None, default) for k in fits.tolist()]
        return pd.DataFrame(picked, columns=["rule", "verdict"])
    return run


def judge_urls(df: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Every input row with OUTPUTS; ``rules``: (host, path, "allow" or "block")."""
    ship_code(df.sparkSession)
    url = F.coalesce(col(url_col).cast("string"), F.lit(""))
    packed = pack(df, mark=F.instr(url, "://"), url=url)
    rest = F.when(F.col("mark") > 0, F.expr("substring(url, mark + 3)")).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = packed.withColumn("rest", rest).select(
        ROW, F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), upper, lower).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    judged = parts.withColumn("judged", _judge(tuple(rules), default)("host", "path"))
    return unpack(judged.select(ROW, "host", "path", F.col("judged.rule").alias("rule"),
                                F.col("judged.verdict").alias("verdict")), df.columns, OUTPUTS)
