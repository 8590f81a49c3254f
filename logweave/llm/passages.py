"""Repeated passages across documents by paragraph MinHash banding.

*Paragraphs*: a text is cut at line ends and, inside lines, at content-defined places:
before a word whose hash (with the next word's) is the strict minimum of the ``RADIUS``
words on either side.  So a passage that sits in the middle of a longer line is cut
alike wherever it stands, but for its first and last few words.

*Banding*: a paragraph's set is its 5-word shingles; ``tune_bands`` takes the fewest
band rows that find a pair at the threshold with the wanted probability.  One row
(band key, paragraph) per distinct paragraph and task meets the others of its key.

*Verification*: two paragraphs of one key link if the exact Jaccard index of their
shingle sets is at least the threshold.  First every paragraph is compared with the
least one of its key; then, within a key, those that are still in different
components with each other.  Pairs inside one component cannot change it, so no link
that matters is lost and a large group of near copies costs a star, not all pairs.

*Clusters*: connected components of the links.  A paragraph repeats if its component
spans two or more rows.  Repeating paragraphs that follow each other (at most ``GAP``
others between) form a passage, reported from ``LEAST_WORDS`` repeating words on: the
cuts may cost a passage of 50 words its ends, while shared short lines stay below.  Of
every component the first occurrence (by row number) stays, the others are removals.

*Exact spans*: cuts may leave a passage of ``EXACT_WORDS`` words too few linked words, so
the texts are also winnowed: of every ``EXACT_WORDS`` words the least hash of
``SEED_WORDS`` consecutive words is a seed, hence every common span of that length holds
a common seed.  Around seeds met in two rows all hashes of ``EXACT_WORDS`` words that no
reported run covers are grouped by their value; those found in two rows extend the run
they touch, or are a passage by themselves.

Only paragraphs whose key is met twice go on.  They are found again in a second scan
by a bitmap of ``BITMAP_BITS`` bits, the only thing that is broadcast; false hits of
the bitmap drop out in the joins.

Defined results: null text is empty and has no paragraph; a paragraph of fewer than
five words is one shingle; repeats inside a single row are no passages; a null id is
passed on; repeated rows are different rows; an empty table gives an empty result.
Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm.common import col, ship_code, stored, text_of
from logweave.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
#: probability with which a pair at the threshold shares a band
RECALL = 0.99
RADIUS = 6
GAP = 1
LEAST_WORDS = 25
#: a span of so many equal words is a passage wherever it is cut
EXACT_WORDS = 50
SEED_WORDS = 25
BITMAP_BITS = 27
#: paragraphs and seeds that a task holds back to send each once
HOLD = 600_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = 1) -> int:
    """Bands of ``rows`` values that find a pair at ``similarity`` with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows) - 1e-9))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler."""
    x = x ^ (x >> _S33)
    x *= _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64))


#: bytes of the texts that are worked on at once; a longer text is worked on by itself
BATCH_BYTES = 400_000
#: words of the spans that are worked on at once
BATCH_WORDS = 60_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _word_hashes(body: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 of the words at the given places, all words of a length at once."""
    padded = body + bytes(8)
    eights = np.ndarray(len(body) + 1, dtype="<u8", buffer=padded, strides=(1,))
    out = np.empty(len(starts), dtype=np.uint64)
    order = np.argsort(np.minimum(sizes, 32).astype(np.uint8), kind="stable")
    stops = np.searchsorted(sizes[order], np.arange(1, 33)).tolist()
    for size, (low, high) in enumerate(zip(stops, stops[1:]), 1):
        if low == high:
            continue
        words = order[low:high]
        at = starts[words]
        h = np.full(high - low, _P5 + np.uint64(size))
        for done in range(0, size - 7, 8):
            h ^= _rotated(eights[at + done] * _P2, 31) * _P1
            h = _rotated(h, 27) * _P1 + _P4
        if size & 7:
            rest = eights[at + (size & ~7)]
            if size & 4:
                h ^= (rest & np.uint64(0xFFFFFFFF)) * _P1
                h = _rotated(h, 23) * _P2 + _P3
                rest >>= np.uint64(32)
            for _ in range(size & 3):
                h ^= (rest & np.uint64(0xFF)) * _P5
                h = _rotated(h, 11) * _P1
                rest >>= np.uint64(8)
        h ^= h >> _S33
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
        out[words] = h
    for k in order[stops[-1]:].tolist():
        out[k] = xxhash.xxh64_intdigest(body[starts[k]:starts[k] + sizes[k]])
    return out


def _batches(texts: Iterator[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes of the words, ends of the texts, first words of lines).

    The words of many texts in one array: the steps below cost the same for ten texts as for one.
    """
    def batch():
        body = b"\n".join([*held, b""]).lower()
        codes = np.frombuffer(body, dtype=np.uint8)
        # words and blanks alternate; the last byte is a line end
        blank = _SPACE[codes]
        turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            turns = np.concatenate(([0], turns))
        starts, stops = turns[0::2], turns[1::2]
        starts = starts[:len(stops)]
        ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in held]))
        lines = np.unique(np.searchsorted(starts, np.concatenate(([0], np.flatnonzero(codes == 10)))))
        return start, _word_hashes(body, starts, stops - starts), ends, lines[lines < len(starts)]

    start, held, have = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text)
        have += len(text) + 1
        if have >= BATCH_BYTES:
            done = batch()
            if len(done[1]):
                yield done
            start, held, have = k + 1, [], 0
    if held:
        done = batch()
        if len(done[1]):
            yield done


def _words(text: bytes) -> tuple[np.ndarray, list]:
    """Hashes of the words of one text, and the first words of its lines."""
    for _, own, _, lines in _batches(iter([text])):
        return own, lines.tolist()
    return np.zeros(0, dtype=np.uint64), []


def _spans(own: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width`` consecutive words, by doubling."""
    base, total, have = 0x9E3779B97F4A7C15, np.zeros(len(own), dtype=np.uint64), 0
    for bit in f"{width:b}":
        for piece, length in ((total, have), (own, 1))[:1 + int(bit)]:
            ahead = np.zeros(len(own), dtype=np.uint64)
            ahead[:max(0, len(own) - have)] = piece[have:]
            total = total + ahead * np.uint64(pow(base, have, 1 << 64))
            have += length
    return _mix(total[:max(0, len(own) - width + 1)])


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        values = least(values[:len(values) - step], values[step:])
        have += step
    return values


def exact_seeds(own: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds: any ``EXACT_WORDS`` words of a text hold all of one."""
    if len(own) < EXACT_WORDS:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    ends = np.array([len(own)]) if ends is None else ends
    spans, width = _spans(own, SEED_WORDS), EXACT_WORDS - SEED_WORDS + 1
    least = _sliding(spans, width, np.minimum)
    # only windows inside one text count
    left = np.repeat(ends, np.diff(ends, prepend=0))[:len(least)] - np.arange(len(least))
    least[left < EXACT_WORDS] = 0
    none = np.zeros(width - 1, dtype=np.uint64)
    most = _sliding(np.concatenate((none, least, none)), width, np.maximum)
    at = np.flatnonzero((most == spans) & (most > 0))
    return at, _mix(spans[at] + np.uint64(SEED_WORDS))


def paragraphs(text: bytes, radius: int = RADIUS, width: int = SHINGLE):
    """First words and word counts of the paragraphs, their ids, and the shingle hashes.

    Shingle i starts at word i and counts for its paragraph if it ends inside; entries
    that do not are the top value.  None for a text without words.
    """
    for _, own, ends, lines in _batches(iter([text])):
        return _cut(own, ends, lines, radius, width)
    return None


def _cut(own: np.ndarray, ends: np.ndarray, lines: np.ndarray, radius: int = RADIUS, width: int = SHINGLE):
    n = len(own)
    sizes = np.diff(ends, prepend=0)
    text_of_word = np.repeat(np.arange(len(ends)), sizes)
    after = np.empty_like(own)
    after[:-1] = own[1:]
    held = sizes > 0
    after[ends[held] - 1] = own[(ends - sizes)[held]]
    place = _mix(own * np.uint64(3) + after)
    # a stretch of top values between texts: no window reaches over it
    spot = np.arange(n) + radius * (text_of_word + 1)
    padded = np.full(n + radius * (len(ends) + 1), _TOP)
    padded[spot] = place
    beside = _sliding(padded, radius, np.minimum)
    first = place < np.minimum(beside[spot - radius], beside[spot + 1])
    first[lines] = True
    first = np.flatnonzero(first)
    counts = np.diff(np.append(first, n))
    within = np.arange(n) - np.repeat(first, counts)
    ids = _mix(np.add.reduceat(own * _powers(int(counts.max()))[within], first)
               + counts.astype(np.uint64))
    shingles = np.full(n, _TOP)
    if n >= width:
        power, total = _powers(width), np.zeros(n - width + 1, dtype=np.uint64)
        for j in range(width):
            total += own[j:n - width + 1 + j] * power[j]
        inside = np.repeat(counts, counts) - within >= width
        shingles[:n - width + 1] = np.where(inside[:n - width + 1], _mix(total), _TOP)
    short = counts < width
    shingles[first[short]] = ids[short]
    return first, counts, ids, shingles


def _once(text: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the first of each id of a text."""
    order = np.lexsort((ids, text))
    text, ids = text[order], ids[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (ids[1:] != ids[:-1])
    return order[new]


def _merged(tables: list[np.ndarray]) -> np.ndarray:
    """Columns by the first row, each value once; the last row is summed."""
    table = np.concatenate(tables, axis=1)
    if not table.shape[1]:
        return table
    order = np.argsort(table[0], kind="stable")
    ids = table[0, order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    out = table[:, order[first]]
    out[-1] = np.add.reduceat(table[-1, order], first)
    return out


def _band_rows(bands: int):
    """(key, paragraph, several): each distinct paragraph of a task once per band.

    A seed is its own key and takes the place of the paragraph.
    """
    seeds = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def frame(units: np.ndarray, exact: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(
            {"key": np.concatenate((units[1:-1].ravel(), exact[0])).view(np.int64),
             "unit": np.concatenate((np.tile(units[0], bands), exact[0])).view(np.int64),
             "several": np.concatenate((np.tile(units[-1] > 1, bands), exact[-1] > 1))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # columns: id, its keys, in how many texts; seed, in how many texts
        units = [np.zeros((bands + 2, 0), dtype=np.uint64)]
        exact = [np.zeros((2, 0), dtype=np.uint64)]
        have = 0
        for _, own, ends, lines in _batches(text for batch in batches for text in batch["body"]):
            first, _, ids, shingles = _cut(own, ends, lines)
            at, spots = exact_seeds(own, ends)
            # each text's paragraphs and seeds once
            once = _once(np.searchsorted(ends, first, side="right"), ids)
            top, table = shingles == _TOP, [ids[once]]
            for s in seeds:
                marks = _mix(shingles ^ s)
                marks[top] = _TOP
                table.append(_mix(np.minimum.reduceat(marks, first)[once] + s))
            units.append(np.stack([*table, np.ones(len(once), dtype=np.uint64)]))
            spots = spots[_once(np.searchsorted(ends, at, side="right"), spots)]
            exact.append(np.stack([spots, np.ones(len(spots), dtype=np.uint64)]))
            have += len(once) + len(spots)
            if have > HOLD:
                units, exact = [_merged(units)], [_merged(exact)]
                have = units[0].shape[1] + exact[0].shape[1]
                if have > HOLD // 2:
                    yield frame(units[0], exact[0])
                    units, exact, have = [units[0][:, :0]], [exact[0][:, :0]], 0
        if have:
            yield frame(_merged(units), _merged(exact))
    return run


def _set(table: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bits of ids are set."""
    at = ids & np.uint64((1 << bits) - 1)
    return ((table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _units(bitmap: bytes, bits: int):
    """Paragraphs whose bit is set, with their shingles; the words around seeds whose bit is set."""
    held: list = []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not held:
            held.append(np.frombuffer(bitmap, dtype=np.uint8))
        for batch in batches:
            for start, hashes, ends, lines in _batches(iter(batch["body"])):
                begins = ends - np.diff(ends, prepend=0)
                first, counts, ids, shingles = _cut(hashes, ends, lines)
                wanted = np.flatnonzero(_set(held[0], ids, bits))
                text = np.searchsorted(ends, first[wanted], side="right")
                if len(wanted):
                    yield _frame(batch, start + text, wanted - np.searchsorted(first, begins)[text],
                                 first[wanted] - begins[text], counts[wanted], ids[wanted].view(np.int64),
                                 _shingle_sets(shingles, first, counts, wanted), b"")
                at, seeds = exact_seeds(hashes, ends)
                at = at[_set(held[0], seeds, bits)]
                if len(at):
                    text = np.searchsorted(ends, at, side="right")
                    apart = np.flatnonzero((np.diff(at) > EXACT_WORDS) | (np.diff(text) > 0)) + 1
                    heads, tails = np.append(0, apart), np.append(apart, len(at)) - 1
                    text = text[heads]
                    low = np.maximum(begins[text], at[heads] + SEED_WORDS - EXACT_WORDS)
                    high = np.minimum(ends[text], at[tails] + EXACT_WORDS)
                    spans = [hashes[i:j].astype("<u4").tobytes() for i, j in zip(low.tolist(), high.tolist())]
                    yield _frame(batch, start + text, -1, low - begins[text], high - low, 0, [_NO_SHINGLES] * len(text), spans)
    return run


def _shingle_sets(shingles: np.ndarray, first: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> list:
    """The distinct shingles of each wanted paragraph, in order."""
    chosen = np.zeros(len(first), dtype=bool)
    chosen[wanted] = True
    own = shingles[np.repeat(chosen, counts)]
    unit = np.repeat(np.arange(len(wanted)), counts[wanted])
    real = own != _TOP
    own, unit = own[real], unit[real]
    order = np.lexsort((own, unit))
    own, unit = own[order], unit[order]
    once = np.ones(len(own), dtype=bool)
    once[1:] = (own[1:] != own[:-1]) | (unit[1:] != unit[:-1])
    own, unit = own[once].view(np.int64), unit[once]
    stops = np.searchsorted(unit, np.arange(len(wanted)), side="right").tolist()
    return [own[i:j] for i, j in zip([0, *stops[:-1]], stops)]


def _frame(batch: pd.DataFrame, rows: np.ndarray, seq, first_word, words, unit, shingles, span) -> pd.DataFrame:
    """Units of rows of a batch, by the rows' places in it."""
    return pd.DataFrame({"number": batch["number"].to_numpy()[rows], "id": batch["id"].iloc[rows].array,
                         "seq": seq, "first_word": first_word, "words": words, "unit": unit,
                         "shingles": shingles, "span": span}, columns=_UNIT_NAMES)


_NO_SHINGLES = np.zeros(0, dtype=np.int64)
_UNIT_NAMES = ["number", "id", "seq", "first_word", "words", "unit", "shingles", "span"]


def _exact_spans(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, first words and hashes of all ``EXACT_WORDS`` words of the spans, of many rows at once."""
    spans, first_word = batch["span"].tolist(), batch["first_word"].to_numpy()
    sizes = np.array([len(span) // 4 for span in spans], dtype=np.int64)
    part = np.cumsum(sizes) // BATCH_WORDS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(spans)]
    for low, high in zip(cuts, cuts[1:]):
        ends = np.cumsum(sizes[low:high])
        row = np.repeat(np.arange(high - low), sizes[low:high])
        hashes = _spans(np.frombuffer(b"".join(spans[low:high]), dtype="<u4").astype(np.uint64), EXACT_WORDS)
        # only those inside one span count
        inside = np.flatnonzero(ends[row[:len(hashes)]] - np.arange(len(hashes)) >= EXACT_WORDS)
        row = row[inside]
        yield low + row, first_word[low + row] + inside - (ends - sizes[low:high])[row], hashes[inside]


def _uncovered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of ``EXACT_WORDS`` words that do not lie inside a run (starts and ends in order)."""
    for batch in batches:
        runs = [(k, np.asarray(starts, dtype=np.int64), np.asarray(ends, dtype=np.int64))
                for k, (starts, ends) in enumerate(zip(batch["starts"], batch["ends"])) if starts is not None]
        # places of all rows on one line, rows 2 ** 32 apart
        begins, stops = (np.concatenate([np.zeros(0, dtype=np.int64), *[(run[0] << 32) + run[side] for run in runs]])
                         for side in (1, 2))
        out = [np.zeros(0, dtype=np.uint64)]
        for row, at, hashes in _exact_spans(batch):
            at = (row << 32) + at
            if len(begins):
                k = np.searchsorted(begins, at, side="right") - 1
                hashes = hashes[(k < 0) | (at + EXACT_WORDS > stops[k])]
            out.append(hashes)
        yield pd.DataFrame({"unit": np.unique(np.concatenate(out)).view(np.int64)})


def _marked(bitmap: bytes, bits: int):
    """(span, number, at) of all hashes of ``EXACT_WORDS`` words whose bit is set."""
    held: list = []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not held:
            held.append(np.frombuffer(bitmap, dtype=np.uint8))
        for batch in batches:
            number = batch["number"].to_numpy()
            for row, at, hashes in _exact_spans(batch):
                wanted = _set(held[0], hashes, bits)
                yield pd.DataFrame({"span": hashes[wanted].view(np.int64), "number": number[row[wanted]],
                                    "at": at[wanted].astype(np.int32)})
    return run


def _bitmap(units: DataFrame, bits: int) -> bytes:
    """One bit per low bits of a paragraph id: at most 2 ** bits / 8 bytes, whatever the input."""
    at = F.col("unit").bitwiseAND((1 << bits) - 1)
    cells = (units.groupBy(F.shiftright(at, 5).cast("int").alias("cell"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, int((unit & {(1 << bits) - 1}) & 31))")).alias("set"))
             .toArrow())
    out = np.zeros(1 << (bits - 5), dtype="<u4")
    out[cells.column("cell").to_numpy()] = cells.column("set").to_numpy().astype(np.uint32)
    return out.tobytes()


def _similar(a: str, b: str, similarity: float):
    """Exact Jaccard index of two shingle arrays at least ``similarity``."""
    common = F.size(F.array_intersect(a, b))
    return common >= F.lit(similarity) * (F.size(a) + F.size(b) - common) - F.lit(1e-9)


def _exact_parts(around: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows like ``runs`` for spans of at least ``EXACT_WORDS`` words found in two rows.

    Those inside a reported run are left out; a part either stays or is a removal.
    """
    covers = (runs.select("number", "run_first", "run_after").distinct()
              .groupBy("number").agg(F.array_sort(F.collect_list(F.struct("run_first", "run_after")))
                                     .alias("runs")))
    open_spans = around.select("number", "first_word", "span").join(covers, "number", "left").select(
        "first_word", "span", F.col("runs.run_first").alias("starts"), F.col("runs.run_after").alias("ends"))
    bitmap = _bitmap(open_spans.mapInPandas(_uncovered, "unit long"), BITMAP_BITS)
    marked = stored(around.select("number", "first_word", "span").mapInPandas(
        _marked(bitmap, BITMAP_BITS), "span long, number long, at int"), "passage-spans")
    # stored, so that the join has two plain exchanges and a span of very many rows can be split
    met = stored(marked.groupBy("span").agg(F.min("number").alias("first_row"), F.max("number").alias("last_row"))
                 .filter("first_row < last_row").select("span", "first_row"), "passage-met")
    in_row = W.partitionBy("number", "removed").orderBy("at")
    apart = F.when(F.col("at") - F.lag("at").over(in_row) <= EXACT_WORDS, 0).otherwise(1)
    spans = (marked.join(met, "span").withColumn("removed", F.col("first_row") < F.col("number"))
             .withColumn("new", apart).withColumn("part", F.sum("new").over(in_row)))
    ids = around.groupBy("number").agg(F.first("id").alias("id"))
    parts = spans.groupBy("number", "removed", "part").agg(
        F.min("at").alias("first_word"), (F.max("at") + EXACT_WORDS).alias("after"),
        F.array_sort(F.collect_set("first_row")).alias("keeps"))
    return parts.join(ids, "number").select(
        "number", "id", "first_word", "after", F.lit(None).cast("long").alias("class_id"),
        "removed", "keeps", F.col("first_word").alias("run_first"), F.col("after").alias("run_after"))


def _row_links(passages: DataFrame, least_words: int) -> DataFrame:
    """Edges (a, b) from a row to the rows in which a passage's words stay.

    A row that keeps fewer than ``least_words`` of them, as a short common line does,
    is no link unless an exact span stays there or none keeps more.
    """
    shares = (passages.select("number", "run", F.explode("parts").alias("part"))
              .select("number", "run", "part.words", F.col("part.class_id").isNull().alias("exact"),
                      F.explode("part.keeps").alias("keep_row"))
              .groupBy("number", "run", "keep_row").agg(F.sum("words").alias("words"),
                                                        F.max("exact").alias("exact")))
    most = F.max("words").over(W.partitionBy("number", "run"))
    return (shares.withColumn("most", most)
            .filter(F.col("exact") | (F.col("words") >= F.least(F.lit(least_words), "most")))
            .filter("number <> keep_row")
            .select(F.col("number").alias("a"), F.col("keep_row").alias("b")).distinct())


def _met(keyed: DataFrame) -> DataFrame:
    """(key, unit, least) of the keys met twice; least: the least unit of the key.

    Both windows are over whole keys, so that rows are sorted by one column, once.
    """
    of_key = W.partitionBy("key")
    return (keyed.repartition("key")
            .withColumns({"least": F.min("unit").over(of_key), "rows": F.count(F.lit(1)).over(of_key)})
            .filter("rows > 1 or several").select("key", "unit", "least").distinct())


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      similarity: float = SIMILARITY, recall: float = RECALL,
                      least_words: int = LEAST_WORDS, gap: int = GAP) -> DataFrame:
    """One row per repeated passage of a document.

    (doc_id, first_word, words_spanned, repeated_words, paragraphs, removed_paragraphs,
    class_id, keep_ids, parts): where it is, how many of its paragraphs (and exact spans
    beyond them) are removals, the least row number of the rows that are linked through
    passages, and the ids of the documents in which its paragraphs stay.  ``parts`` holds
    (first_word, words, class_id, removed) of each: the words to remove and, but for
    exact spans, the component of the paragraph.
    """
    ship_code(df.sparkSession)
    texts = df.select(col(id_col).alias("id"), text_of(df, text_col).cast("binary").alias("body"))
    bands = tune_bands(similarity, recall)
    keyed = texts.select("body").mapInPandas(_band_rows(bands), "key long, unit long, several boolean")
    met = stored(_met(keyed), "passage-keys")
    bitmap = _bitmap(met.select("unit"), BITMAP_BITS)
    id_type = dict(texts.dtypes)["id"]
    schema = (f"number long, id {id_type}, seq int, first_word int, words int, unit long, "
              "shingles array<long>, span binary")
    scanned = stored(texts.withColumn("number", F.monotonically_increasing_id())
                   .mapInPandas(_units(bitmap, BITMAP_BITS), schema), "passage-units")
    units, around = scanned.filter("seq >= 0"), scanned.filter("seq < 0")      # paragraphs; words around seeds
    nodes = stored(units.groupBy("unit").agg(
        F.min("number").alias("from_row"), F.max("number").alias("to_row"),
        F.first("shingles").alias("shingles")), "passage-nodes")

    one, two = (nodes.select(F.col("unit").alias(f"u{s}"), F.col("shingles").alias(f"s{s}"))
                for s in "ab")
    stars = met.filter("unit <> least").select(F.col("unit").alias("ua"),
                                               F.col("least").alias("ub")).distinct()
    links = stored(stars.join(one, "ua").join(two, "ub").filter(_similar("sa", "sb", similarity))
                   .select(F.col("ua").alias("a"), F.col("ub").alias("b")), "passage-stars")
    grouped = components(links, "passage-stars")

    # keys whose paragraphs are still in several components
    member = (met.filter("key <> unit").select("key", "unit").distinct()
              .join(grouped, F.col("unit") == F.col("node"), "left")
              .select("key", "unit", F.coalesce("component", "unit").alias("component")))
    open_keys = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                          F.count(F.lit(1)).alias("n")).filter("x <> y and n > 2")
    rest = member.join(open_keys.select("key"), "key").join(
        nodes.select("unit", "shingles"), "unit")
    rest = stored(rest, "passage-rest")
    left, right = (rest.select("key", F.col("unit").alias(f"u{s}"), F.col("component").alias(f"c{s}"),
                               F.col("shingles").alias(f"s{s}")) for s in "ab")
    more = left.join(right, (left["key"] == right["key"]) & (F.col("ua") < F.col("ub"))
                     & (F.col("ca") != F.col("cb"))
                     & (F.size("sa") >= F.lit(similarity) * F.size("sb"))
                     & (F.size("sb") >= F.lit(similarity) * F.size("sa"))
                     & _similar("sa", "sb", similarity)).select(
        F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = components(stored(more.distinct(), "passage-more"), "passage-more")
    classes = (nodes.select("unit", "from_row", "to_row")
               .join(grouped, F.col("unit") == F.col("node"), "left")
               .select("unit", "from_row", "to_row", F.coalesce("component", "unit").alias("star"))
               .join(joined, F.col("star") == F.col("node"), "left")
               .select("unit", "from_row", "to_row", F.coalesce("component", "star").alias("class_id")))
    classes = stored(classes, "passage-classes")
    spans = classes.groupBy("class_id").agg(F.min("from_row").alias("first_row"),
                                            F.max("to_row").alias("last_row"))
    repeating = stored(classes.select("unit", "class_id").join(
        spans.filter("first_row < last_row"), "class_id").select("unit", "class_id", "first_row"),
        "passage-repeating")
    found = units.select("number", "id", "seq", "first_word", "words", "unit").join(repeating, "unit")
    in_row = W.partitionBy("number").orderBy("seq")
    breaks = F.when(F.col("seq") - F.lag("seq").over(in_row) <= gap + 1, 0).otherwise(1)
    in_run, after = W.partitionBy("number", "run"), F.col("first_word") + F.col("words")
    runs = stored(
        found.withColumn("new", breaks).withColumn("run", F.sum("new").over(in_row))
        .select("number", "id", "first_word", after.alias("after"), "class_id",
                (F.col("first_row") < F.col("number")).alias("removed"),
                F.array("first_row").alias("keeps"),
                F.min("first_word").over(in_run).alias("run_first"), F.max(after).over(in_run).alias("run_after"),
                F.sum("words").over(in_run).alias("run_words"))
        .filter(F.col("run_words") >= least_words).drop("run_words"), "passage-runs")
    exact = _exact_parts(around, runs)
    so_far = W.partitionBy("number").rowsBetween(W.unboundedPreceding, -1)
    reached = F.max("run_after").over(so_far.orderBy("run_first", "run_after"))
    covered = F.max("after").over(so_far.orderBy("first_word", "after"))
    grouped_parts = (
        runs.unionByName(exact)
        .withColumn("new", F.when(F.col("run_first") <= reached, 0).otherwise(1))
        .withColumn("own_words", F.greatest(F.lit(0), F.col("after") - F.greatest(
            F.col("first_word"), F.coalesce(covered, F.lit(0)))))
        .withColumn("run", F.sum("new").over(
            W.partitionBy("number").orderBy("run_first", "run_after")
            .rangeBetween(W.unboundedPreceding, W.currentRow))))
    passages = stored(
        grouped_parts.groupBy("number", "run").agg(
            F.first("id").alias("id"), F.min("first_word").alias("first_word"),
            F.max("after").alias("after"),
            F.sum("own_words").alias("repeated_words"),
            F.array_sort(F.collect_list(F.struct(
                "first_word", (F.col("after") - F.col("first_word")).alias("words"), "class_id", "removed",
                "keeps"))).alias("parts")),
        "passages")
    linked = components(_row_links(passages, least_words), "passage-rows").select(
        F.col("node").alias("number"), "component")
    ids = scanned.groupBy("number").agg(F.first("id").alias("keep_id"))
    kept = F.array_distinct(F.flatten("parts.keeps"))
    keepers = (passages.select("number", "run", F.explode(kept).alias("keep_row"))
               .join(ids.withColumnRenamed("number", "keep_row"), "keep_row")
               .groupBy("number", "run").agg(F.array_sort(F.collect_set("keep_id")).alias("keep_ids")))
    return passages.join(keepers, ["number", "run"], "left").join(linked, "number", "left").select(
        F.col("id").alias("doc_id"), "first_word",
        (F.col("after") - F.col("first_word")).alias("words_spanned"), "repeated_words",
        F.size("parts").alias("paragraphs"),
        F.size(F.filter("parts", lambda p: p["removed"])).alias("removed_paragraphs"),
        F.coalesce("component", "number").alias("class_id"), "keep_ids",
        F.transform("parts", lambda p: F.struct(
            p["first_word"].alias("first_word"), p["words"].alias("words"),
            p["class_id"].alias("class_id"), p["removed"].alias("removed"))).alias("parts"))
