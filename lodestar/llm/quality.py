"""Quality classifier: a sparse rule ensemble over text statistics.

Fit (bounded sample of labelled rows): a random forest of shallow trees gives
paths; every path is a conjunction of threshold conditions on statistics of
the text; a lasso logistic regression weighs the rules and drops most of them.
Use: the remaining rules are compiled into one Spark column expression, so
scoring is a projection over the statistics, read once from the whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import crc_remainder, hash60, materialize, ship, source_name

TRAIN_ROWS = 12_000  # bound of the training sample (labelled documents, smallest hashes)
HOLD_OUT = (4, 2)  # crc32(doc_id) mod 4 = 2 is never learned from
ACCEPT = 0.7
TREES, DEPTH, LASSO = 40, 3, 0.002

FEATURES = (
    "words", "mean_word", "upper_share", "caps_words", "digit_share", "symbol_share", "symbol_words",
    "shout_words", "bar_words", "stop_words", "same_as_last", "distinct_share", "top_word_share",
    "lines", "repeated_lines", "words_per_line", "longest_word", "other_share", "short_words", "markup_words",
)
_UPPER, _LOWER, _DIGIT = (bytes(range(a, b + 1)) for a, b in ((65, 90), (97, 122), (48, 57)))
_SPACE, _COMMON = b" \t\n\r\x0b\x0c", b".,;:'\"()?-"
_SYMBOL = bytes(c for c in range(33, 127) if c not in _UPPER + _LOWER + _DIGIT + _COMMON)


def _without(data: bytes, chars: bytes) -> int:
    """How many bytes of ``data`` are in ``chars``."""
    return len(data) - len(data.translate(None, chars))


def text_statistics(text: str | None) -> list[float]:
    """The statistics named in ``FEATURES`` of one whole text (zeros if null or blank)."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))
    upper, lower = _without(data, _UPPER), _without(data, _LOWER)
    digit, symbol = _without(data, _DIGIT), _without(data, _SYMBOL)
    counts = Counter(words)
    joined = b" ".join(words) + b" "
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbol_words = sum(c for w, c in counts.items() if w.translate(None, _SYMBOL) != w)
    caps = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    high = len(data) - upper - lower - digit - symbol - _without(data, _SPACE + _COMMON)
    return [
        float(n), size / n, upper / max(1, upper + lower), caps / n, digit / size, symbol / size, symbol_words / n,
        joined.count(b"!") / n, joined.count(b"|") / n, joined.count(b". ") / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, len(counts) / n, max(counts.values()) / n,
        float(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)),
        float(max(map(len, counts))), high / size, sum(c for w, c in counts.items() if len(w) <= 2) / n,
        (joined.count(b"<") + joined.count(b"{") + joined.count(b"=")) / n,
    ]


def statistics_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def statistics(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(text_statistics(t)) for t in texts], dtype=object)

    return statistics(text)


Condition = tuple[int, bool, float]  # feature, is "<=" (else ">"), threshold


@dataclass(frozen=True)
class RuleModel:
    """Intercept plus weighted conjunctions; ``score`` compiles it for Spark."""

    intercept: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...] = ()

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.when(_holds(stats, rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.4f} if " + " and ".join(f"{FEATURES[f]} {'<=' if le else '>'} {t:g}" for f, le, t in rule)
                for w, rule in self.rules]


def _holds(stats: Column, rule: tuple[Condition, ...]) -> Column:
    out = None
    for feature, at_most, threshold in rule:
        value = F.get(stats, F.lit(feature))
        part = value <= F.lit(threshold) if at_most else value > F.lit(threshold)
        out = part if out is None else out & part
    return out


_BRANCH = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def tree_paths(debug_string: str) -> set[tuple[Condition, ...]]:
    """Every path from the root of a printed tree, as a simplified conjunction."""
    found, path = set(), []
    for line in debug_string.splitlines():
        m = _BRANCH.match(line)
        if not m:
            continue
        depth = len(m[1])
        path = [(d, c) for d, c in path if d < depth] + [(depth, (int(m[2]), m[3] == "<=", float(m[4])))]
        tight: dict[tuple[int, bool], float] = {}
        for _, (feature, at_most, t) in path:
            key = (feature, at_most)
            tight[key] = t if key not in tight else min(t, tight[key]) if at_most else max(t, tight[key])
        found.add(tuple(sorted((f, le, t) for (f, le), t in tight.items())))
    return found


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label, stats) of at most ``rows`` labelled documents outside the held-out part.

    The sample is chosen on the label side (smallest hashes of doc_id), so at
    most ``rows`` ids are broadcast and only their texts are read into
    statistics.  A doc_id with several labels takes the majority (a tie: 0);
    one with several texts, one of them; null labels are ignored.
    """
    mod, out = HOLD_OUT
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .filter(crc_remainder("doc_id", mod) != out)
             .groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("double").alias("label")))
    picked = materialize(known.orderBy(hash60(F.col("doc_id")), "doc_id").limit(rows), "quality-ids")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stats = (texts.join(F.broadcast(picked), "doc_id")  # at most ``rows`` ids
             .select("doc_id", "label", statistics_column(F.col("text")).alias("stats")))
    return stats.groupBy("doc_id", "label").agg(F.min("stats").alias("stats"))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        rows: int = TRAIN_ROWS, seed: int = 7) -> RuleModel:
    """Learn the rule ensemble.  No training rows: a constant score of one half;
    labels of one class only: a constant near that class.

    The sample (at most ``rows`` short rows of numbers) is learned from in one
    partition, by rising hash of doc_id, so the model depends neither on how
    the tables are stored nor on the number of tasks or cores."""
    ship(docs.sparkSession)
    sample = materialize(training_sample(docs, labels, doc_id, text, rows), "quality-sample")
    sample = sample.repartition(1).sortWithinPartitions(hash60(F.col("doc_id")), "doc_id")
    seen = sample.agg(F.count("label"), F.sum("label")).first()
    if not seen[0]:
        return RuleModel(0.0)
    if seen[1] in (0, seen[0]):
        return RuleModel(3.0 if seen[1] else -3.0)
    base = sample.select("label", array_to_vector("stats").alias("features")).persist()
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=seed,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird").fit(base)
    base.unpersist()
    rules = sorted(set().union(*(tree_paths(t.toDebugString) for t in forest.trees)))
    if not rules:
        return RuleModel(float(np.log(seen[1] / (seen[0] - seen[1]))))
    design = sample.select("label", array_to_vector(F.array(
        *[_holds(F.col("stats"), r).cast("double") for r in rules])).alias("features")).persist()
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60,
                               standardization=True).fit(design)
    design.unpersist()
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             rows: int = TRAIN_ROWS, accept: float = ACCEPT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Scores depend on the text alone.  Null and empty texts have zero
    statistics and a score like any other; a null doc_id counts as the empty
    id for ``held_out``.  Repeated rows get equal scores; a text of any length
    is read whole; other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    model = fit(docs, labels, doc_id, text, rows)
    mod, out = HOLD_OUT
    stats = docs.select(F.col(doc_id).alias("doc_id"), statistics_column(F.col(text)).alias("stats"))
    scored = stats.select("doc_id", (crc_remainder("doc_id", mod) == out).alias("held_out"),
                          model.score(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             rows: int = TRAIN_ROWS, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns unchanged.

    Null, empty and very long texts are scored as ``classify`` scores them;
    repeated rows stay or go together; an empty table gives an empty one.
    """
    model = fit(docs, labels, doc_id, text, rows)
    stats = source_name(docs, "stats")
    kept = docs.withColumn(stats, statistics_column(F.col(text))).filter(model.score(F.col(stats)) >= accept)
    return kept.drop(stats)
