"""Hidden Markov language model: Baum-Welch training and exact sequence likelihood.

A text is its words (A-Z lowered, split at ASCII blanks) and one end token.  A latent
state emits the *class* of a token and the class emits the token:

    P(token | state) = P(class | state) * P(token | class)

The ``OWN_CLASSES`` most frequent tokens are classes of their own; any other token
belongs to one of ``SHAPE_CLASSES`` classes by its first and last bytes, and within
its class has the probability (c + 0.1) / (C + 0.1 (V + 1)), with c its own count, C
the class's and V the class's distinct tokens in the training texts.  The rest, 0.1
over the same sum, is the class's unknown token.  So the model's size is bounded, the
vocabulary is not, and the probabilities of all tokens of a state add up to 1.

On Spark: token counts are combined per task and summed by word (every training text
counts); texts are encoded once as class numbers in the shared folder; every Baum-Welch
pass reads them, adds up the expected counts of its partition by the scaled
forward-backward recursion and sums them by class; scoring is the scaled forward
recursion in double precision, all texts of a batch in step.  Frequent tokens are
looked up in a table of at most ``LOOKUP_WORDS`` words that is sent to the tasks; the
others, of every text, meet their count in a join.

Defined results: null text is empty; an empty text is its end token alone; a text's
length has no bound; a null id counts as the empty text for the fold; repeated rows
are scored each.  Without training texts every token is unknown and the model knows
only its prior.  An empty table gives an empty result.  The other input columns come
back as they are, the text does not; one that is named like an output gives way.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import ROW, col, ship_code, stored, text_of, unpack

STATES = 6
PASSES = 4
OWN_CLASSES = 8192
SHAPE_CLASSES = 4096
LOOKUP_WORDS = 131_072
#: frequent classes whose company in texts tells the first states apart
SEED_CLASSES = 128
#: expected counts of a state that follow the corpus before any text is seen
PRIOR = 50.0
#: tokens handled in step, which bounds the memory of a batch
STEP_TOKENS = 250_000
ADD = 0.1
#: the end token; no word is empty
END = b""
HELD_FOLD = 10

OUTPUTS = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens_of(text: bytes) -> list[bytes]:
    """Words and the end token; bytes methods lower A-Z and split at \\x20 \\x09-\\x0D."""
    return [*text.lower().split(), END]


def shape_class(token: bytes) -> int:
    return OWN_CLASSES + xxhash.xxh32_intdigest(token[:2] + b"\0" + token[-3:]) % SHAPE_CLASSES


def held_out(identity: Column, folds: int = HELD_FOLD) -> Column:
    text = F.coalesce(identity.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


# -- counts ----------------------------------------------------------------------

def _count_tokens(most: int = 150_000):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["body"]:
                counts.update(tokens_of(text))
                if len(counts) > most:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
    return run


def token_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n) over all rows of (body binary)."""
    parts = texts.select("body").mapInPandas(_count_tokens(), "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lexicon:
    """Counts that every task needs: frequent words and class totals."""

    words: tuple[bytes, ...]          # by falling count; the first OWN_CLASSES are classes
    counts: np.ndarray
    class_count: np.ndarray           # all tokens of a class
    class_words: np.ndarray           # distinct tokens of a class
    total: int
    distinct: int

    def prior(self) -> np.ndarray:
        return (self.class_count + ADD) / (self.class_count + ADD).sum()

    def tables(self):
        """word -> position, and per position: class, log base and log inner probability."""
        at = {w: i for i, w in enumerate(self.words)}
        own = min(OWN_CLASSES, len(self.words))
        classes = np.array([i if i < own else shape_class(w) for i, w in enumerate(self.words)],
                           dtype=np.int16)
        base = np.log10((self.counts + ADD) / self.base_sum())
        inner = np.log10((self.counts + ADD) / self.class_sum()[classes])
        inner[:own] = 0.0
        return at, classes, base, inner

    def base_sum(self) -> float:
        return self.total + ADD * (self.distinct + 1)

    def class_sum(self) -> np.ndarray:
        return self.class_count + ADD * (self.class_words + 1)


def lexicon_of(vocabulary: DataFrame) -> Lexicon:
    top = (vocabulary.orderBy(F.desc("n"), "word").limit(LOOKUP_WORDS)).toArrow()
    words = tuple(top.column("word").to_pylist())
    counts = np.array(top.column("n").to_pylist(), dtype=np.int64)
    own = set(words[:OWN_CLASSES])

    def by_shape(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, distinct = Counter(), Counter()
        for batch in batches:
            for word, n in zip(batch["word"], batch["n"]):
                if word not in own:
                    c = shape_class(word)
                    count[c] += n
                    distinct[c] += 1
        if count:
            yield pd.DataFrame({"class": list(count), "n": list(count.values()),
                                "words": [distinct[c] for c in count]})

    classes = OWN_CLASSES + SHAPE_CLASSES
    class_count, class_words = np.zeros(classes), np.zeros(classes)
    class_count[:len(own)] = counts[:len(own)]
    class_words[:len(own)] = 1
    for row in (vocabulary.mapInPandas(by_shape, "class int, n long, words long")
                .groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()):
        class_count[row["class"]], class_words[row["class"]] = row.n, row.words
    total, distinct = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).first()
    return Lexicon(words, counts, class_count, class_words, int(total or 0), int(distinct))


# -- encoding --------------------------------------------------------------------

_ENCODED = "n_tokens long, n_frequent long, base_sum double, inner_sum double, codes binary, rare binary"


def _encoder(lexicon: Lexicon):
    """A pandas UDF: a text's class numbers, its sums over frequent words, its other words.

    ``inner_sum`` holds what is known here of log P(token | class): all of it for the
    frequent words, the class's sum for the others, whose count is joined later.
    """
    held: list = []

    @F.pandas_udf(_ENCODED)
    def run(bodies: pd.Series) -> pd.DataFrame:
        if not held:
            held.append((*lexicon.tables(), np.log10(lexicon.class_sum())))
        at, classes, base, inner, log_sums = held[0]
        rows = []
        for body in bodies:
            tokens = tokens_of(body)
            found = np.array([at.get(t, -1) for t in tokens], dtype=np.int32)
            known = found[found >= 0]
            codes = np.empty(len(tokens), dtype=np.int16)
            codes[found >= 0] = classes[known]
            rare = np.flatnonzero(found < 0)
            codes[rare] = [shape_class(tokens[i]) for i in rare]
            rows.append((len(tokens), len(known), float(base[known].sum()),
                         float(inner[known].sum() - log_sums[codes[rare]].sum()), codes.tobytes(),
                         b" ".join([tokens[i] for i in rare])))
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _ENCODED.split(", ")])
    return run


# -- the model -------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    start: np.ndarray      # (K,)
    move: np.ndarray       # (K, K)
    emit: np.ndarray       # (K, classes)


def _in_step(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest text first: order of the texts, all codes step by step, texts per step."""
    texts = [np.frombuffer(c, dtype=np.int16) for c in codes]
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([texts[i] for i in order])
    sorted_lengths = lengths[order]
    active = np.searchsorted(-sorted_lengths, -np.arange(1, sorted_lengths[0] + 1), side="right")
    offsets = np.concatenate(([0], np.cumsum(active)))
    step = np.concatenate([np.arange(n) for n in sorted_lengths])
    place = offsets[step] + np.repeat(np.arange(len(texts)), sorted_lengths)
    stepped = np.empty(len(flat), dtype=np.int16)
    stepped[place] = flat
    return order, stepped, offsets


def _groups(lengths: list[int], most: int) -> Iterator[list[int]]:
    group, size = [], 0
    for i, n in enumerate(lengths):
        if group and size + n > most:
            yield group
            group, size = [], 0
        group.append(i)
        size += n
    if group:
        yield group


def log10_likelihood(codes: list[bytes], model: Model) -> np.ndarray:
    """Scaled forward recursion: log10 P(classes) of every text."""
    order, stepped, offsets = _in_step(codes)
    emit = np.ascontiguousarray(model.emit.T)
    total = np.zeros(len(codes))
    state = model.start[None, :]
    for t in range(len(offsets) - 1):
        n = offsets[t + 1] - offsets[t]
        before = state if t == 0 else state[:n] @ model.move
        state = before * emit[stepped[offsets[t]:offsets[t + 1]]]
        scale = state.sum(axis=1)
        state = state / scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(codes))
    out[order] = total
    return out


def expected_counts(codes: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: expected starts (K), moves (K, K) and emissions (K, classes)."""
    _, stepped, offsets = _in_step(codes)
    steps, states = len(offsets) - 1, len(model.start)
    emit = np.ascontiguousarray(model.emit.T.astype(np.float32))[stepped]
    move = model.move.astype(np.float32)
    alpha, scale = np.empty_like(emit), np.empty(len(stepped), dtype=np.float32)
    state = model.start.astype(np.float32)[None, :]
    for t in range(steps):
        a, b = offsets[t], offsets[t + 1]
        state = (state if t == 0 else state[:b - a] @ move) * emit[a:b]
        scale[a:b] = state.sum(axis=1)
        state = state / scale[a:b, None]
        alpha[a:b] = state
    moves = np.zeros((states, states))
    a, b = offsets[steps - 1], offsets[steps]
    beta = np.ones((b - a, states), dtype=np.float32)
    for t in range(steps - 2, -1, -1):
        ahead = beta * emit[a:b] / scale[a:b, None]
        n, first = b - a, offsets[t]
        moves += alpha[first:first + n].T @ ahead
        beta = np.ones((a - first, states), dtype=np.float32)   # 1 where a text ends
        beta[:n] = ahead @ move.T
        alpha[first:a] *= beta                                  # now the state's probability
        a, b = first, a
    classes = model.emit.shape[1]
    emissions = np.stack([np.bincount(stepped, weights=alpha[:, k], minlength=classes)
                          for k in range(states)])
    return alpha[:offsets[1]].sum(axis=0, dtype=np.float64), moves * model.move, emissions


def _together(batches: Iterator[pd.DataFrame]) -> Iterator[list[bytes]]:
    """Codes of texts that are handled in step."""
    for batch in batches:
        lengths = [len(c) // 2 for c in batch["codes"]]
        for group in _groups(lengths, STEP_TOKENS):
            yield [batch["codes"].iloc[i] for i in group]


def _company(seeds: int):
    """(i, j, n): texts that hold both of the frequent classes i and j."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((seeds, seeds), dtype=np.int64)
        for codes in _together(batches):
            for part in range(0, len(codes), 4096):
                holds = np.zeros((min(4096, len(codes) - part), seeds), dtype=np.float32)
                for i, code in enumerate(codes[part:part + 4096]):
                    own = np.frombuffer(code, dtype=np.int16)
                    holds[i, own[own < seeds]] = 1
                total += np.rint(holds.T @ holds).astype(np.int64)
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": i.astype(np.int32), "j": j.astype(np.int32), "n": total[i, j]})
    return run


def first_model(encoded: DataFrame, lexicon: Lexicon, states: int = STATES) -> Model:
    """States that start from frequent classes which keep the least company.

    The first seed is the class that differs most from the average; each next one is
    the class least often found with those chosen.  A state emits the frequent classes
    as often as they accompany its seed, all others by the corpus.
    """
    seeds = SEED_CLASSES
    company = np.zeros((seeds, seeds))
    for row in (encoded.select("codes").mapInPandas(_company(seeds), "i int, j int, n long")
                .groupBy("i", "j").agg(F.sum("n").alias("n")).collect()):
        company[row.i, row.j] = row.n
    alone = np.maximum(np.diag(company), 1.0)
    likeness = (company + 0.5) / (np.minimum.outer(alone, alone) + 1.0)
    usable = [i for i in range(seeds) if company[i, i] >= 0.02 * alone.max()] or [0]
    chosen = [min(usable, key=lambda i: likeness[i, usable].mean())]
    while len(chosen) < states:
        rest = [i for i in usable if i not in chosen] or usable
        chosen.append(min(rest, key=lambda i: likeness[i, chosen].max()))
    prior = lexicon.prior()
    emit = np.tile(prior, (states, 1))
    for k, seed in enumerate(chosen):
        emit[k, :seeds] *= likeness[seed] * (1.0 + 0.01 * k)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1.0 / states), move, emit / emit.sum(axis=1, keepdims=True))


def _expect(model: Model):
    states, classes = model.emit.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((states, classes))
        for codes in _together(batches):
            s, m, e = expected_counts(codes, model)
            start, move, emit = start + s, move + m, emit + e
        table = np.concatenate((emit.T, move, start[None, :]))
        rows = np.flatnonzero(table.any(axis=1))
        yield pd.DataFrame({"row": rows.astype(np.int32),
                            **{f"s{k}": table[rows, k] for k in range(states)}})
    return run


def baum_welch(encoded: DataFrame, lexicon: Lexicon, states: int = STATES,
               passes: int = PASSES) -> Model:
    """Maximise the likelihood of all encoded texts (codes binary)."""
    model, prior = first_model(encoded, lexicon, states), lexicon.prior()
    names = [f"s{k}" for k in range(states)]
    schema = "row int, " + ", ".join(f"{n} double" for n in names)
    for _ in range(passes):
        summed = encoded.select("codes").mapInPandas(_expect(model), schema).groupBy("row").agg(
            *[F.sum(n).alias(n) for n in names]).toArrow()
        table = np.zeros((len(prior) + states + 1, states))
        table[summed.column("row").to_numpy()] = np.stack(
            [summed.column(n).to_numpy() for n in names], axis=1)
        emit = table[:len(prior)].T + PRIOR * prior
        move = table[len(prior):len(prior) + states] + 1.0
        start = table[-1] + 1.0
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True),
                      emit / emit.sum(axis=1, keepdims=True))
    return model


def _scorer(model: Model):
    """A pandas UDF: log10 likelihood of class numbers."""
    @F.pandas_udf("double")
    def run(codes: pd.Series) -> pd.Series:
        out = np.empty(len(codes))
        for group in _groups([len(c) // 2 for c in codes], STEP_TOKENS):
            out[group] = log10_likelihood([codes.iloc[i] for i in group], model)
        return pd.Series(out)
    return run


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                states: int = STATES, passes: int = PASSES, folds: int = HELD_FOLD) -> DataFrame:
    """Every input row (without its text) with OUTPUTS; fold 0 by id is not learnt from."""
    ship_code(df.sparkSession)
    others = [c for c in df.columns if c.lower() != text_col.lower()]
    body, fold = text_of(df, text_col).cast("binary"), held_out(col(id_col), folds)
    vocabulary = stored(token_counts(df.filter(~fold).select(body.alias("body"))), "hmm-counts")
    lexicon = lexicon_of(vocabulary)
    numbered = df.select(
        F.struct(*[col(c).alias(c) for c in others]).alias(ROW), fold.alias("held_out"),
        F.monotonically_increasing_id().alias("number"), _encoder(lexicon)(body).alias("e"))
    encoded = stored(numbered.select(ROW, "held_out", "number", "e.*")
                     .sortWithinPartitions("n_tokens"), "hmm-encoded")
    model = baum_welch(encoded.filter("not held_out"), lexicon, states, passes)

    least = int(lexicon.counts[-1]) if len(lexicon.counts) else 0
    # words hold no blank, so a text's rare words travel as one value
    rare = encoded.filter("rare <> X''").select(
        "number", F.explode(F.split(F.col("rare").cast("string"), " ")).alias("token"))
    counts = vocabulary.filter(F.col("n") <= least).select(F.col("word").cast("string").alias("token"), "n")
    of_rare = rare.join(counts, "token", "left").groupBy("number").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("rare_log"),
        F.count("n").alias("rare_known"), F.count(F.lit(1)).alias("rare_tokens"))
    scored = encoded.select(ROW, "held_out", "number", "n_tokens", "n_frequent", "base_sum",
                            "inner_sum", _scorer(model)("codes").alias("states_log"))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    of_base = F.coalesce("rare_tokens", F.lit(0)) * F.lit(math.log10(lexicon.base_sum()))
    done = scored.join(of_rare, "number", "left").select(
        ROW, "held_out", "n_tokens",
        (F.col("n_frequent") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("base_sum") + rare_log - of_base).alias("base_score"),
        (F.col("states_log") + F.col("inner_sum") + rare_log).alias("score"))
    return unpack(done, others, OUTPUTS)
