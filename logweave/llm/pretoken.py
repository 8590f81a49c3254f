"""Splitting of texts by the pre-token pattern of byte-level vocabularies, many texts at once.

The pattern (``public_tokenizers.PATTERN``) looks at four kinds of character only: letters,
numbers, white space and the rest.  Its matches are therefore the runs of one kind, with
three amendments: a blank before a run belongs to the run, the last character of other white
space before a run stands alone, and the listed contractions are cut out after an apostrophe
that begins a match.  ``Splitter`` finds the cuts of a whole batch with array operations.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
BLANK, APOSTROPHE = 32, 39
#: fixed values: the contractions of the pattern, without their apostrophe
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: characters that are split in one piece of work
WORK_CHARS = 1 << 20


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """The kind of every code point."""
    import regex
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for run in regex.finditer(pattern, every):
                kinds[low + run.start():low + run.end()] = kind
    return kinds


def match_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the matches of the pattern begin in joined texts.

    ``points`` are code points, ``text_starts`` is true where a text begins; no match
    reaches over such a place.
    """
    kinds = character_kinds()[points]
    starts = text_starts.copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    after = np.flatnonzero((kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~text_starts[1:]) + 1
    starts[after - 1] = True
    starts[after[points[after - 1] == BLANK]] = False
    for p in np.flatnonzero((points == APOSTROPHE) & starts).tolist():
        for letters in CONTRACTIONS:
            end = p + 1 + len(letters)
            if (end <= len(points) and not text_starts[p + 1:end].any()
                    and all(points[p + 1 + k] == ord(c) for k, c in enumerate(letters))):
                starts[p + 1] = False
                if end < len(points):
                    starts[end] = True
                break
    return starts


def split_texts(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The matches of all texts in order, and for each text where its matches end in that list.

    An empty text has no matches.
    """
    matches: list[str] = []
    ends = np.zeros(len(texts), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto, chars = at, 0
        while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= WORK_CHARS):
            chars += len(texts[upto])
            upto += 1
        joined = "".join(texts[at:upto])
        lengths = np.fromiter(map(len, texts[at:upto]), np.int64, upto - at)
        text_ends = np.cumsum(lengths)
        if joined:
            points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
            text_starts = np.zeros(len(points), dtype=bool)
            begins = text_ends - lengths
            text_starts[begins[lengths > 0]] = True
            cuts = np.flatnonzero(match_starts(points, text_starts))
            ends[at:upto] = len(matches) + np.searchsorted(cuts, text_ends)
            places = cuts.tolist() + [len(joined)]
            matches.extend([joined[i:j] for i, j in zip(places, places[1:])])
        else:
            ends[at:upto] = len(matches)
        at = upto
    return matches, ends
