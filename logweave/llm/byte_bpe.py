"""Byte-level BPE encoding and decoding by longest matches and backtracking.

A text is cut by the pre-token pattern (``pretoken``); each match is encoded apart.  The bytes
of a match, read as Latin-1, run once through an Aho-Corasick automaton of all tokens, which
gives the longest token at every place.  From the left, the longest token that may follow its
predecessor is taken, else its next shorter prefix token, else the predecessor is taken back
and its place is marked dead; no place is left twice, so the work is linear in the match.  Two
tokens may stand side by side if the merges of their joined bytes would keep them apart
(``_apart``); the answer for a pair is remembered.  The result is that of the ranked merges.

Results by case: a null text counts as empty; an empty text has no tokens and empty bytes; a
text of any length is encoded whole; repeated rows give repeated results, row by row; an empty
table gives an empty table.  Input columns named as an output give way to it.

Ids travel packed, as unsigned 32-bit little-endian integers in a binary column, which is a
third of the size of an array column on the way through Python; ``ids_array`` unpacks them.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.common import apart, col, ship_code
from logweave.llm.pretoken import split_texts

#: largest vocabulary file that is sent to the workers
MOST_VOCABULARY_BYTES = 64 << 20
#: remembered matches and pairs of a worker; beyond, they are forgotten and found again
MOST_REMEMBERED = 400_000
#: longest match that is remembered
LONGEST_REMEMBERED = 64
#: rows that a worker holds in Python form at once
ROWS = 512


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a file whose lines are a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("packed ids are little-endian words of four bytes")


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"a byte-level vocabulary needs all bytes as tokens; missing {missing[:5]}")
        self.ranks = ranks
        self.token_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        #: rank -> the two tokens of its last merge; bytes have none
        self.halves: dict[int, tuple[int, int]] = {}
        #: rank -> the longest token that is a proper prefix of it
        self.shorter: dict[int, int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known = _Remembered(self)
        automaton = ahocorasick.Automaton()
        by_rank = sorted(ranks.items(), key=lambda item: item[1])
        whole = set()
        for token, rank in by_rank:
            if len(token) == 1:
                whole.add(rank)
        for token, rank in by_rank:
            if len(token) > 1:
                halves = self._last_merge(token, rank)
                if halves is None:           # merges never make it: only a whole match can be this token
                    continue
                self.halves[rank] = halves
                whole.add(rank)
        for rank in whole:
            token = self.token_bytes[rank]
            automaton.add_word(token.decode("latin-1"), rank)
            for cut in range(len(token) - 1, 0, -1):
                prefix = ranks.get(token[:cut])
                if prefix in whole:
                    self.shorter[rank] = prefix
                    break
        automaton.make_automaton()
        self._automaton = automaton
        self._lengths = [len(token) for token in self.token_bytes]

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that ranked merges below ``rank`` leave of a token's bytes."""
        parts = [bytes([b]) for b in token]
        while len(parts) > 2:
            least, at = rank, -1
            for k in range(len(parts) - 1):
                merged = self.ranks.get(parts[k] + parts[k + 1], rank)
                if merged < least:
                    least, at = merged, k
            if at < 0:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _apart(self, left: int, right: int) -> bool:
        """Whether the merges of ``left`` + ``right`` never join them over their border.

        The merges are undone from the last one made: at every moment one token ends and one
        begins at the border.  The two would have been joined if their join ranks before
        whatever took one of them away; of two equal joins, the left one comes first.
        """
        key = (left, right)
        limit = len(self.token_bytes) + 1
        answer = True
        while True:
            joined = self.ranks.get(self.token_bytes[left] + self.token_bytes[right])
            if joined is not None and joined < limit:
                answer = False
                break
            made_left = left if left in self.halves else -1
            made_right = right if right in self.halves else -1
            if made_left > made_right:
                limit, left = left, self.halves[left][1]
            elif made_right >= 0:
                limit, right = right + 1, self.halves[right][0]
            else:
                break
        if len(self._pairs) >= MOST_REMEMBERED:
            self._pairs.clear()
        self._pairs[key] = answer
        return answer

    def encode_match(self, match: bytes) -> list[int]:
        """Tokens of the bytes of one match of the pattern."""
        whole = self.ranks.get(match)
        if whole is not None:
            return [whole]
        lengths, pairs, size = self._lengths, self._pairs, len(match)
        longest = [0] * size
        for end, token in self._automaton.iter(match.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token                    # longer ones come later
        dead = bytearray(size + 1)
        path: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            end = at + lengths[token]
            if not dead[end]:
                fits = last < 0 or pairs.get((last, token))
                if fits is None:
                    fits = self._apart(last, token)
                if fits:
                    path.append(token)
                    if end == size:
                        return path
                    at, last, token = end, token, longest[end]
                    continue
            shorter = self.shorter.get(token)
            while shorter is None:           # nothing fits here: the predecessor goes back
                dead[at] = 1
                token = path.pop()
                at -= lengths[token]
                last = path[-1] if path else -1
                shorter = self.shorter.get(token)
            token = shorter

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        matches, ends = split_texts(texts)
        packed = list(map(self._known.__getitem__, matches))
        out, at = [], 0
        for end in ends.tolist():
            out.append(b"".join(packed[at:end]))
            at = end
        return out

    def decode(self, packed: bytes) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(packed, dtype="<u4").tolist()])


class _Remembered(dict):
    """Packed ids by match; what is missing is encoded, short matches are remembered.

    When full, the entries become the older half: those met again come back, the rest goes.
    """

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self._bpe, self._older = bpe, {}

    def __missing__(self, match: str) -> bytes:
        packed = self._older.get(match)
        if packed is None:
            packed = array("I", self._bpe.encode_match(match.encode("utf-8"))).tobytes()
        if len(match) <= LONGEST_REMEMBERED:
            if len(self) >= MOST_REMEMBERED // 2:
                self._older = dict(self)
                self.clear()
            self[match] = packed
        return packed


_ENCODERS: dict[str, ByteBpe] = {}


def encoder_of(content: bytes) -> ByteBpe:
    """The encoder of a vocabulary file's content, made once in a process."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteBpe(read_ranks(content))
    return _ENCODERS[key]


def share_file(spark: SparkSession, path: str) -> pyspark.Broadcast:
    """A vocabulary file's content for the workers, which need not have the file."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY_BYTES} bytes")
    ship_code(spark)
    return spark.sparkContext.broadcast(content)


def _with_columns(df: DataFrame, work, outputs: dict[str, T.DataType]) -> DataFrame:
    """``df`` and the output columns that ``work`` makes of its record batches."""
    own, undo = apart(df, list(outputs))
    schema = T.StructType([*own.schema.fields, *[T.StructField(n, t) for n, t in outputs.items()]])
    return own.mapInArrow(work, schema).select(
        *[c for c, name in zip(undo, df.columns) if name.lower() not in {o.lower() for o in outputs}],
        *outputs)


def encode(df: DataFrame, vocabulary: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``n_tokens`` (long) and ``ids`` (packed) of its text column.

    ``decoded`` adds the bytes that ``decode`` makes of the ids, in the same pass.
    """
    shared = share_file(df.sparkSession, vocabulary)
    place = df.columns.index(text)
    outputs = {"n_tokens": T.LongType(), "ids": T.BinaryType()} | ({"decoded": T.BinaryType()} if decoded else {})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder_of(shared.value)
        for batch in _small(batches):
            ids = bpe.encode_texts([t or "" for t in batch.column(place).to_pylist()])
            columns = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([bpe.decode(i) for i in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *outputs])

    return _with_columns(df, work, outputs)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes of its packed ids (null: no ids, so no bytes)."""
    shared = share_file(df.sparkSession, vocabulary)
    place = df.columns.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder_of(shared.value)
        for batch in _small(batches):
            decoded = [bpe.decode(i or b"") for i in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return _with_columns(df, work, {"decoded": T.BinaryType()})


@F.pandas_udf(T.ArrayType(T.LongType()))
def _unpacked(packed):
    return packed.map(lambda b: np.frombuffer(b, dtype="<u4").astype(np.int64) if b is not None else None)


def ids_array(name: str = "ids") -> Column:
    """Packed ids as an array of longs."""
    return _unpacked(col(name))
