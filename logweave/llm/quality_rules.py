"""Text quality by a sparse ensemble of rules.

1. *Statistics*: columns over the whole text (``STATISTICS``), none of them an id, a
   language tag, a source or a label.
2. *Rules*: a small random forest is grown on the labelled rows; every path from a
   root to a node is a conjunction of ``statistic <= t`` and ``statistic > t`` terms.
3. *Weights*: a logistic regression with the lasso penalty over the rules' truth
   values; most weights become zero and their rules are dropped.
4. *Compiled*: score = sigmoid(intercept + sum of the weights of the rules that
   hold), one Spark column expression.

Both fits run on Spark over all labelled rows given; nothing is collected but the
trees and the weights.

Defined results: null text is empty; a text without words has all statistics 0 and
gets their score; labels other than 0 and 1 and labels of unknown ids are ignored; a
label that repeats counts each time.  Without labels, or with labels of one kind, the
score is that kind's share (0.5 without any).  An empty table gives an empty result.
Other columns come back as they are; one that is named like an output gives way.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import ROW, col, pack, stored, text_of, unpack

TREES, DEPTH, BINS, SEED = 12, 3, 64, 11
#: lasso penalty of the logistic weights
PENALTY = 0.0005
#: scores from here on mean label 1
THRESHOLD = 0.3

OUTPUTS = ("score", "predicted")

#: (statistic index, "<=" or ">", threshold)
Term = tuple[int, str, float]


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1)).cast("double")


def _statistics() -> dict[str, Column]:
    """Statistics over the counts of ``_counts``."""
    c = F.col
    return {
        "log_words": F.log1p(c("words").cast("double")),
        "chars_per_word": _share(c("chars"), c("words")),
        "words_per_line": _share(c("words"), c("lines")),
        "symbols_per_char": _share(c("symbols"), c("chars")),
        "stops_per_word": _share(c("stops"), c("words")),
        "upper_per_char": _share(c("upper"), c("chars")),
        "digits_per_char": _share(c("digits"), c("chars")),
        "short_per_word": _share(c("short"), c("words")),
        "distinct_per_word": _share(c("distinct"), c("words")),
        "distinct_per_line": _share(c("distinct_lines"), c("lines")),
        "bytes_per_char": _share(c("bytes"), c("chars")),
    }


STATISTICS = ("log_words", "chars_per_word", "words_per_line", "symbols_per_char",
              "stops_per_word", "upper_per_char", "digits_per_char", "short_per_word",
              "distinct_per_word", "distinct_per_line", "bytes_per_char")


def _counts(text: Column) -> dict[str, Column]:
    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    words = F.split(text, r"[\x20\x09-\x0D]+")
    return {
        "chars": F.length(text).cast("long"), "bytes": F.octet_length(text).cast("long"),
        "words": count(r"[^\x20\x09-\x0D]+"), "lines": count(r"[^\n]+"),
        "symbols": count(r"[!-/:-@\[-`{-~]"), "stops": count(r"[.,;:?!]+(?=[\x20\x09-\x0D]|$)"),
        "upper": count(r"\p{Lu}"), "digits": count(r"[0-9]"),
        "short": count(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D](?![^\x20\x09-\x0D])"),
        "distinct": F.size(F.array_distinct(words)).cast("long"),
        "distinct_lines": F.size(F.array_distinct(F.split(text, "\n"))).cast("long"),
    }


def with_statistics(packed: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of ``packed`` and the statistics of its ``text`` column."""
    counts = packed.select(*[F.col(k) for k in keep],
                           *[c.alias(n) for n, c in _counts(F.col(text)).items()])
    return counts.select(*[F.col(k) for k in keep],
                         *[c.alias(n) for n, c in _statistics().items()])


@dataclass(frozen=True)
class RuleModel:
    """Rules with their weights; ``names`` are the statistics the terms refer to."""

    intercept: float
    rules: tuple[tuple[tuple[Term, ...], float], ...]
    names: tuple[str, ...] = STATISTICS

    def score(self) -> Column:
        """The compiled score over statistic columns."""
        total = F.lit(self.intercept)
        for terms, weight in self.rules:
            total = total + F.when(holds(terms, self.names), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(terms: Sequence[Term], names: Sequence[str] = STATISTICS) -> Column:
    """The conjunction as a column."""
    out = F.lit(True)
    for index, sign, at in terms:
        value = F.col(names[index])
        out = out & ((value <= at) if sign == "<=" else (value > at))
    return out


def paths_of(description: str) -> list[tuple[Term, ...]]:
    """Every distinct root-to-node path in a forest's text description, simplified:
    per statistic and sign only the tightest bound stays."""
    line_of = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    path: list[tuple[int, Term]] = []
    found: dict[tuple[Term, ...], None] = {}
    for line in description.splitlines():
        if re.match(r"^\s*Tree \d+", line):
            path = []
        if not (match := line_of.match(line)):
            continue
        depth, index, sign, at = len(match[1]), int(match[2]), match[3], float(match[4])
        while path and path[-1][0] >= depth:
            path.pop()
        path.append((depth, (index, sign, at)))
        tight: dict[tuple[int, str], float] = {}
        for _, (i, s, t) in path:
            pick = min if s == "<=" else max
            tight[i, s] = pick(tight.get((i, s), t), t)
        found[tuple(sorted((i, s, t) for (i, s), t in tight.items()))] = None
    return list(found)


def fit_rules(labelled: DataFrame, names: Sequence[str] = STATISTICS) -> RuleModel:
    """Grow, extract and weigh rules on rows of statistics and ``label`` (0 or 1)."""
    rows = labelled.select(F.col("label").cast("double").alias("label"), *names)
    kinds = {int(r.label): r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(kinds.values())
    if len(kinds) < 2:
        share = kinds.get(1, 0) / total if total else 0.5
        return RuleModel(40.0 if share == 1 else -40.0 if share == 0 else 0.0, (), tuple(names))
    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED,
                                    featureSubsetStrategy="sqrt").fit(vectors)
    paths = paths_of(forest.toDebugString)
    if not paths:
        share = kinds[1] / total
        return RuleModel(math.log(share / (1 - share)), (), tuple(names))
    truths = rows.select("label", array_to_vector(F.array(
        *[holds(p, names).cast("double") for p in paths])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, standardization=False,
                               maxIter=60).fit(truths)
    weights = [float(w) for w in lasso.coefficients.toArray()]
    return RuleModel(float(lasso.intercept),
                     tuple((p, w) for p, w in zip(paths, weights) if w != 0.0), tuple(names))


def is_held_out(identity: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0 (a null id: the empty text)."""
    text = F.coalesce(identity.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def labelled_statistics(statistics: DataFrame, labels: DataFrame, label_col: str,
                        folds: int) -> DataFrame:
    """Statistics and label of the rows that may be learnt from, and nothing else of them."""
    known = labels.select(col("doc_id").alias("label_id"), col(label_col).alias("label")).filter(
        F.col("label").isin(0, 1))
    able = statistics.select("id", *STATISTICS).filter(~is_held_out(F.col("id"), folds))
    return able.join(known, F.col("id") == F.col("label_id")).select("label", *STATISTICS)


def _scored(statistics: DataFrame, labels: DataFrame, label_col: str, folds: int,
            threshold: float) -> DataFrame:
    """Stored statistics (with ``id``) plus score and predicted."""
    learnt = stored(labelled_statistics(statistics, labels, label_col, folds), "quality-labelled")
    return statistics.withColumn("score", fit_rules(learnt).score()).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality", folds: int = 5,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Every input row with OUTPUTS.  Fold 0 of ``folds`` (by id) is never learnt from.

    Rows and statistics are stored once; learning reads the narrow columns alone.
    """
    packed = pack(df, id=col(id_col), body=text_of(df, text_col))
    statistics = stored(with_statistics(packed, "body", [ROW, "id"]), "quality-statistics")
    return unpack(_scored(statistics, labels, label_col, folds, threshold), df.columns, OUTPUTS)


def score_ids(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", folds: int = 5,
              threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every row; texts are not carried."""
    packed = df.select(col(id_col).alias("id"), text_of(df, text_col).alias("body"))
    statistics = stored(with_statistics(packed, "body", ["id"]), "quality-statistics")
    return _scored(statistics, labels, label_col, folds, threshold).select(
        "id", is_held_out(F.col("id"), folds).alias("held_out"), "score", "predicted")
