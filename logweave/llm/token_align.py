"""Alignment of the tokens of two tokenizers by lockstep merging of many documents.

Each document is encoded by tokenizer A (a byte-level ``tokenizers`` file, given a blank and the
text) and by tokenizer B (a ``sentencepiece`` model, which adds the blank itself).  Two tokens
are linked if their byte ranges overlap; a place where a token of each ends is a cut, and cuts
bound groups.  Both come from one merge over the ends of the tokens, made for all documents of
a batch at once: a NumPy vector holds one pair of pointers for each lane, every step emits the
link that each lane points at and its cut if both tokens end there, advances the pointers and
drops lanes that are done.  A long document runs as many lanes, split at places that are
verified to be cuts, so the number of steps does not follow the longest text.

Corpus-wide counts: each batch (a *chunk* of documents) also emits its distinct id pairs with
their number of links.  Spark sums them, finds the highest count of each B id and sends every
chunk just the pairs it asked for, which are then met with the chunk's documents.  Nothing is
broadcast but the vocabulary files, and no key holds more rows than there are chunks.

Results by case: a text that is null, empty, or not given back by the tokens of both (such as
one with U+2581, which stands for a blank in B) has no tokens: zeros, and '' for the groups.
Texts of any length are aligned whole.  Repeated rows are documents of their own, null ids too.
Ties in a highest count all count as highest.  An empty table gives an empty table.  Other input
columns are not read, so that their names do not matter.

Encoders are fed the matches of the pre-token pattern (A) and the stretches from blank to blank
(B), which no token of theirs crosses, and remember what they have met; a model with pieces
that do cross gets whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.byte_bpe import LONGEST_REMEMBERED, MOST_REMEMBERED, share_file
from logweave.llm.common import col, stored, text_of
from logweave.llm.pretoken import split_texts

#: characters of the texts of a chunk; a longer text is a chunk of its own
CHUNK_CHARS = 2 << 20
#: tokens of A in a lane, and how many ends are tried for its border
LANE_TOKENS = 512
BORDER_TRIES = 48
UNDERLINE = "▁"
#: a pattern that leaves a piece whole
WHOLE = r"(?s:.)+"

_STRETCH = re.compile(" +[^ ]*")


class Encoded(NamedTuple):
    """Tokens of a batch: ids, where each document's tokens end, and the byte ends in the batch."""
    ids: np.ndarray
    doc_ends: np.ndarray
    byte_ends: np.ndarray


# -- the two encoders -----------------------------------------------------------

def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    for itself, the others in order from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class _Memory(dict):
    """Ids of pieces of text as packed bytes; False where the ids do not give the piece back."""

    def __init__(self, encode_many, token_bytes: list[bytes]):
        super().__init__()
        self._encode_many, self._bytes = encode_many, token_bytes

    def look_up(self, pieces: list[str]) -> list[bytes | bool]:
        found = list(map(self.get, pieces))
        places = [k for k, f in enumerate(found) if f is None]
        if places:
            missing = list({pieces[k] for k in places})
            table, fresh = self._bytes, {}
            for piece, ids in zip(missing, self._encode_many(missing)):
                whole = b"".join([table[i] for i in ids]) == piece.encode("utf-8")
                fresh[piece] = array("I", ids).tobytes() if whole else False
            for k in places:
                found[k] = fresh[pieces[k]]
            if len(self) + len(fresh) > MOST_REMEMBERED:
                self.clear()
            self.update((p, f) for p, f in fresh.items() if len(p) <= LONGEST_REMEMBERED)
        return found


class EncoderA:
    """A byte-level BPE file of the ``tokenizers`` library, special tokens as plain text.

    Where the file's ids number its merges in order, as ranks do, ``tiktoken`` makes the same
    ids from that vocabulary in a fraction of the time; any other file is read by ``tokenizers``.
    """

    def __init__(self, content: bytes):
        file = json.loads(content)
        before = file["pre_tokenizer"]
        if not (before and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]):
            raise ValueError("tokenizer A must be byte-level with its own pattern and no added blank")
        characters = byte_characters()
        vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in characters for c in token):
                self.token_bytes[i] = bytes(characters[c] for c in token)
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        ranked = all(vocabulary.get(c, 256) < 256 for c in characters) and all(
            vocabulary.get(token) == 256 + k for k, token in enumerate(joined))
        self._memory = _Memory(_ranked(self.token_bytes[:256 + len(merges)]) if ranked else _from_file(content),
                               self.token_bytes)

    def encode(self, texts: list[str]) -> list[bytes | None]:
        """Packed ids of a blank and each text; None where they do not give it back."""
        matches, ends = split_texts([" " + t for t in texts])
        return _by_document(self._memory.look_up(matches), ends.tolist())


def _from_file(content: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(content.decode("utf-8"))
    tokenizer.encode_special_tokens = True
    return lambda many: [e.ids for e in tokenizer.encode_batch_fast(many, add_special_tokens=False)]


def _ranked(token_bytes: list[bytes]):
    import tiktoken
    encoding = tiktoken.Encoding("a", pat_str=WHOLE, special_tokens={},
                                 mergeable_ranks={b: i for i, b in enumerate(token_bytes)})
    return lambda many: [encoding.encode_ordinary(m) for m in many]


class EncoderB:
    """A ``sentencepiece`` model with byte fallback that writes blanks as U+2581."""

    def __init__(self, content: bytes):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(UNDERLINE, " ").encode("utf-8")
            for i, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self._crosses = any(UNDERLINE in p.lstrip(UNDERLINE) for p in pieces)
        lone = [model.piece_to_id(UNDERLINE)]       # the model gives an empty text no blank

        def encode_many(many):
            encoded = model.encode([p[1:] for p in many], num_threads=1)
            return [lone if p == " " else ids for p, ids in zip(many, encoded)]

        self._memory = _Memory(encode_many, self.token_bytes)

    def encode(self, texts: list[str]) -> list[bytes | None]:
        """Packed ids of each text with the blank that the model adds; None where they differ."""
        pieces, ends = [], []
        for text in texts:
            if text:
                pieces.extend([" " + text] if self._crosses else _STRETCH.findall(" " + text))
            ends.append(len(pieces))
        return _by_document(self._memory.look_up(pieces), ends)


def _by_document(found: list[bytes | bool], ends: list[int]) -> list[bytes | None]:
    out, at = [], 0
    for end in ends:
        parts = found[at:end]
        out.append(None if False in parts else b"".join(parts))
        at = end
    return out


_ENCODERS: dict[str, tuple[EncoderA, EncoderB]] = {}


def _encoders(a: bytes, b: bytes) -> tuple[EncoderA, EncoderB]:
    key = hashlib.sha256(a).hexdigest() + hashlib.sha256(b).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = EncoderA(a), EncoderB(b)
    return _ENCODERS[key]


def encode_batch(a: EncoderA, b: EncoderB, texts: list[str]) -> tuple[Encoded, Encoded]:
    """Tokens of both sides; documents without tokens on one side have none on the other."""
    packed_a, packed_b = a.encode(texts), b.encode(texts)
    usable = [bool(t) and x is not None and y is not None for t, x, y in zip(texts, packed_a, packed_b)]

    def side(packed, lengths):
        kept = [p if ok else b"" for p, ok in zip(packed, usable)]
        ids = np.frombuffer(b"".join(kept), dtype="<u4").astype(np.int64)
        doc_ends = np.cumsum(np.fromiter((len(p) // 4 for p in kept), np.int64, len(kept)))
        return Encoded(ids, doc_ends, np.cumsum(lengths[ids]))

    return side(packed_a, a.lengths), side(packed_b, b.lengths)


# -- the merge ------------------------------------------------------------------

def lane_borders(a: Encoded, b: Encoded) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes end, as counts of A and of B tokens: the ends of documents and, about every
    ``LANE_TOKENS`` tokens, the first of the next places that is the end of a token of each."""
    doc_a = np.unique(a.doc_ends[a.doc_ends > 0])
    marks = np.arange(LANE_TOKENS, len(a.ids), LANE_TOKENS)
    if len(marks):
        tried = marks[:, None] + np.arange(BORDER_TRIES)[None, :]
        places = a.byte_ends[np.minimum(tried, len(a.ids)) - 1]
        at = np.minimum(np.searchsorted(b.byte_ends, places), len(b.ids) - 1)
        common = b.byte_ends[at] == places
        first = common.argmax(axis=1)
        found = common.any(axis=1)
        chosen = tried[np.arange(len(marks)), first][found]
        doc_a = np.unique(np.concatenate([doc_a, chosen[chosen < len(a.ids)]]))
    ends_b = np.searchsorted(b.byte_ends, a.byte_ends[doc_a - 1]) + 1
    return doc_a, ends_b


def merge_in_lockstep(a: Encoded, b: Encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as positions of A and B tokens, and the positions of the tokens that end at a cut."""
    empty = np.zeros(0, dtype=np.int64)
    if not len(a.ids):
        return empty, empty, empty, empty
    stop_a, stop_b = lane_borders(a, b)
    at_a, at_b = np.concatenate([[0], stop_a[:-1]]), np.concatenate([[0], stop_b[:-1]])
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(at_a):
        links_a.append(at_a)
        links_b.append(at_b)
        end_a, end_b = a.byte_ends[at_a], b.byte_ends[at_b]
        both = end_a == end_b
        cuts_a.append(at_a[both])
        cuts_b.append(at_b[both])
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        going = at_a < stop_a                    # a lane ends at a cut: both sides at once
        if not going.all():
            at_a, at_b, stop_a = at_a[going], at_b[going], stop_a[going]
    return tuple(np.concatenate(x) for x in (links_a, links_b, cuts_a, cuts_b))


class GroupTexts:
    """Writes ``a1,a2|b1;a3|b2,b3``: the ids of each group in decimals."""

    #: an id and its mark fill one eight-byte word: seven digits, of which the leading zeros are hidden
    WORD = 8

    def __init__(self, most: int):
        if most >= 10 ** (self.WORD - 1):
            raise ValueError(f"ids up to {most} are too long")
        values = np.arange(most + 1)[:, None]
        powers = 10 ** np.arange(self.WORD - 2, -1, -1)
        digits = np.zeros((most + 1, self.WORD), dtype=np.uint8)
        digits[:, :-1] = ord("0") + values // powers % 10
        shown = np.ones((most + 1, self.WORD), dtype=bool)
        shown[:, :-2] = values >= powers[:-1]
        self._digits, self._shown = digits.view("u8").ravel(), shown.view("u8").ravel()
        self._lengths = shown.sum(axis=1)

    def write(self, a: Encoded, b: Encoded, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[bytes]:
        """The text of each document; b'' for one without tokens."""
        last_a, last_b = np.zeros(len(a.ids), dtype=bool), np.zeros(len(b.ids), dtype=bool)
        last_a[cuts_a] = True
        last_b[cuts_b] = True
        groups_a, groups_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1     # tokens through each group
        place_a = np.arange(len(a.ids)) + np.concatenate([[0], upto_b])[groups_a]
        place_b = np.arange(len(b.ids)) + upto_a[groups_b]
        ids = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
        marks = np.empty(len(ids), dtype=np.uint8)
        ids[place_a], ids[place_b] = a.ids, b.ids
        marks[place_a] = np.where(last_a, ord("|"), ord(","))
        marks[place_b] = np.where(last_b, ord(";"), ord(","))
        rows = self._digits[ids].view(np.uint8)
        rows[self.WORD - 1::self.WORD] = marks
        whole = rows[self._shown[ids].view(bool)].tobytes()
        ends = np.concatenate([[0], np.cumsum(self._lengths[ids])])[a.doc_ends + b.doc_ends].tolist()
        return [whole[i:max(i, j - 1)] for i, j in zip([0, *ends[:-1]], ends)]       # without the last mark


def _document_of(positions: np.ndarray, doc_ends: np.ndarray) -> np.ndarray:
    return np.searchsorted(doc_ends, positions, side="right")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of documents, gathered to chunks of about ``CHUNK_CHARS``."""
    ids, texts, chars = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and chars + len(text) > CHUNK_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
            ids.append(i)
            texts.append(text)
            chars += len(text)
    if texts:
        yield ids, texts


# -- operators ------------------------------------------------------------------

def _narrow(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, T.DataType]:
    return docs.select(col(doc_id).alias("id"), text_of(docs, text).alias("text")), docs.schema[doc_id].dataType


def align_tokens(docs: DataFrame, vocabulary_a: str, model_b: str, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per document: ``a_ids``, ``b_ids``, the links ``link_a`` / ``link_b`` (positions of tokens
    in the document, from 0) and ``cut_a`` / ``cut_b`` (tokens before each cut)."""
    narrow, id_type = _narrow(docs, doc_id, text)
    file_a, file_b = share_file(docs.sparkSession, vocabulary_a), share_file(docs.sparkSession, model_b)
    names = ("a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b")
    schema = T.StructType([T.StructField("id", id_type),
                           *[T.StructField(n, T.ArrayType(T.LongType(), False)) for n in names]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _encoders(file_a.value, file_b.value)
        for ids, texts in _chunks(batches):
            a, b = encode_batch(one, two, texts)
            links_a, links_b, cuts_a, cuts_b = merge_in_lockstep(a, b)
            order = np.lexsort((links_b, links_a))
            links_a, links_b = links_a[order], links_b[order]
            cuts_a, cuts_b = np.sort(cuts_a), np.sort(cuts_b)
            columns = [[] for _ in names]
            low_a = low_b = 0
            for high_a, high_b in zip(a.doc_ends.tolist(), b.doc_ends.tolist()):
                lo, hi = np.searchsorted(links_a, [low_a, high_a])
                cl, ch = np.searchsorted(cuts_a, [low_a, high_a])
                for column, values in zip(columns, (
                        a.ids[low_a:high_a], b.ids[low_b:high_b], links_a[lo:hi] - low_a,
                        links_b[lo:hi] - low_b, cuts_a[cl:ch] + 1 - low_a, cuts_b[cl:ch] + 1 - low_b)):
                    column.append(values)
                low_a, low_b = high_a, high_b
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch_type), *[pa.array(c, pa.list_(pa.int64())) for c in columns]],
                names=["id", *names])

    batch_type = _arrow_type(id_type)
    return narrow.mapInArrow(work, schema).withColumnRenamed("id", doc_id)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _packed_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes, those from 255 on apart."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8), large


def _unpacked(small: bytes, large: bytes) -> np.ndarray:
    values = np.frombuffer(small, dtype=np.uint8).astype(np.int64)
    values[values == 255] = np.frombuffer(large, dtype="<u4")
    return values


def _chunk_rows(docs: DataFrame, vocabulary_a: str, model_b: str) -> DataFrame:
    """A row per document (its numbers, its pairs as places in its chunk's list) and a row per
    chunk (the sorted list of its pairs with their links)."""
    file_a, file_b = share_file(docs.sparkSession, vocabulary_a), share_file(docs.sparkSession, model_b)
    id_type = docs.schema["id"].dataType
    long, blob = T.LongType(), T.BinaryType()
    fields = [("chunk", long), ("id", id_type), ("n_a", long), ("n_b", long), ("n_groups", long),
              ("n_links", long), ("groups_sha256", T.StringType()), ("steps", blob), ("far_steps", blob),
              ("times", blob), ("many_times", blob),
              *[(n, T.ArrayType(long, False)) for n in ("pair_a", "pair_b", "pair_links")]]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow = [(n, _arrow_type(t)) for n, t in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _encoders(file_a.value, file_b.value)
        writer = GroupTexts(max(len(one.lengths), len(two.lengths)))
        width_b = len(two.lengths)
        width = len(one.lengths) * width_b
        first = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_chunks(batches)):
            a, b = encode_batch(one, two, texts)
            links_a, links_b, cuts_a, cuts_b = merge_in_lockstep(a, b)
            doc = _document_of(links_a, a.doc_ends)
            # distinct (document, pair) with their links, in order
            keys = np.sort(doc * width + a.ids[links_a] * width_b + b.ids[links_b])
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
            times = np.diff(np.concatenate([starts, [len(keys)]])) if len(keys) else keys
            own, pair = np.divmod(keys[starts], width) if len(keys) else (keys, keys)
            pairs, place = np.unique(pair, return_inverse=True)
            links = np.bincount(place, weights=times, minlength=len(pairs)).astype(np.int64)
            doc_stops = np.searchsorted(own, np.arange(len(ids)), side="right")
            before = np.concatenate([[0], place[:-1]]) if len(place) else place
            heads = np.concatenate([[0], doc_stops[:-1]])
            before[heads[heads < doc_stops]] = 0
            steps, far = _packed_runs(place - before)
            small, many = _packed_runs(times)
            far_values, many_values = (place - before)[far].astype("<u4"), times[many].astype("<u4")
            far_stops = np.concatenate([[0], np.cumsum(far)])[doc_stops]
            many_stops = np.concatenate([[0], np.cumsum(many)])[doc_stops]
            n_links = np.bincount(doc, minlength=len(ids))
            n_groups = np.bincount(_document_of(cuts_a, a.doc_ends), minlength=len(ids))
            n_a, n_b = np.diff(a.doc_ends, prepend=0), np.diff(b.doc_ends, prepend=0)
            shas = [hashlib.sha256(g).hexdigest() if g else "" for g in writer.write(a, b, cuts_a, cuts_b)]
            chunk = first + number
            cut = lambda values, stops: [values[i:j].tobytes() for i, j in zip([0, *stops[:-1].tolist()], stops.tolist())]
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip((
                [chunk] * len(ids), ids, n_a, n_b, n_groups, n_links, shas, cut(steps, doc_stops),
                cut(far_values, far_stops), cut(small, doc_stops), cut(many_values, many_stops),
                none, none, none), arrow)], names=[n for n, _ in arrow])
            pair_a, pair_b = np.divmod(pairs, width_b)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip((
                [chunk], *[[None]] * 10, [pair_a], [pair_b], [links]), arrow)], names=[n for n, _ in arrow])

    return docs.mapInArrow(work, schema)


def alignment_counts(docs: DataFrame, vocabulary_a: str, model_b: str, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Per document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair
    has the highest corpus-wide count of its B id), ``count_sum`` (sum over links of their
    pair's corpus-wide count) and ``groups_sha256``."""
    narrow, id_type = _narrow(docs, doc_id, text)
    rows = stored(_chunk_rows(narrow, vocabulary_a, model_b), "aligned")
    asked = (rows.filter(F.col("pair_a").isNotNull())
             .select("chunk", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_links")).alias("place", "p"))
             .select("chunk", "place", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"),
                     F.col("p.pair_links").alias("links")))
    totals = asked.groupBy("a", "b").agg(F.sum("links").alias("total"))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "b").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = asked.select("chunk", "place", "a", "b").join(judged, ["a", "b"]).select(
        F.col("chunk").alias("of"), "place", "total", "best")
    documents = rows.filter(F.col("pair_a").isNull()).drop("pair_a", "pair_b", "pair_links")

    def meet(documents: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("place").to_numpy())
        total = answers.column("total").to_numpy()[order]
        best = answers.column("best").to_numpy(zero_copy_only=False)[order]
        sums, bests = [], []
        for steps, far, small, many in zip(*[documents.column(c).to_pylist()
                                             for c in ("steps", "far_steps", "times", "many_times")]):
            place, times = np.cumsum(_unpacked(steps, far)), _unpacked(small, many)
            sums.append(int((total[place] * times).sum()) if len(place) else 0)
            bests.append(int(times[best[place]].sum()) if len(place) else 0)
        kept = documents.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        return (kept.append_column("n_best", pa.array(bests, pa.int64()))
                .append_column("count_sum", pa.array(sums, pa.int64()))
                .append_column("groups_sha256", documents.column("groups_sha256")))

    schema = T.StructType([T.StructField("id", id_type), *[
        T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        T.StructField("groups_sha256", T.StringType())])
    return (documents.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(meet, schema)
            .withColumnRenamed("id", doc_id))
