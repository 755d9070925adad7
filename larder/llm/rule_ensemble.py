"""Quality classifier: a sparse ensemble of rules.

Trees grown on text statistics give conjunctive rules (every path from a root to a node); an
L1-penalised logistic regression over the rules' indicators keeps the few that matter; these and
their weights are compiled into one column expression, so scoring is a plain projection.

Labels are used from a bounded sample: the ``max_rows`` labelled ids with the least hash, none of
them held out. Everything else, statistics and scores, covers all rows and whole texts.

Defined results: a null or empty text has all statistics 0 and gets a score like any other; ids
labelled more than once count once, by their lowest quality; null labels and null ids are not
learned from, and a null id is held out; without labels of both kinds the score is the share of
label 1 (0.5 without labels); repeated rows get equal scores; an empty table gives no rows. Only
the id and text columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored
from larder.llm.quality_rules import measured

STATISTICS = ["log_words", "word_length", "symbols", "upper", "repeated_lines", "repeated_words",
              "line_length"]


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and :data:`STATISTICS`; ratios are 0 where there is nothing to divide by."""
    m = measured(docs, doc_id, text)
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return m.select(
        "doc_id", F.log1p(F.col("n_words").cast("double")).alias("log_words"),
        ratio("word_chars", "n_words").alias("word_length"),
        ratio("n_symbols", "n_words").alias("symbols"),
        ratio("n_upper", "word_chars").alias("upper"),
        ratio("n_dup_lines", "n_lines").alias("repeated_lines"),
        ratio("n_repeat_words", "n_words").alias("repeated_words"),
        ratio("n_words", "n_lines").alias("line_length"))


def held_out(doc_id: str | Column) -> Column:
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


@dataclass(frozen=True)
class Rule:
    """All of ``conditions`` hold; each is (statistic, is at most, bound)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, below, bound in self.conditions:
            holds = holds & ((F.col(name) <= bound) if below else (F.col(name) > bound))
        return holds


def path_rules(trees: str, names: list[str]) -> list[Rule]:
    """The path to every node but the roots, from a printed tree model."""
    found: dict[Rule, None] = {}
    path: list[tuple[str, bool, float]] = []
    for line in trees.splitlines():
        part = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if line.strip().startswith("Tree"):
            path, margin = [], None
        elif part:
            margin = len(part[1]) if margin is None else margin
            depth = len(part[1]) - margin
            path = path[:depth] + [(names[int(part[3])], part[4] == "<=", float(part[5]))]
            found[Rule(tuple(sorted(set(path))))] = None
    return list(found)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        z = F.lit(self.bias)
        for rule, weight in self.weights:
            z = z + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int, label: str = "quality",
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """label and statistics of the learning sample, written once. Ids are chosen first, so only
    the chosen texts are measured."""
    chosen = labels.where(F.col(label).isNotNull() & ~held_out("doc_id")).groupBy(
        F.col("doc_id").alias("_chosen")).agg(F.min(label).cast("double").alias("_label")) \
        .orderBy(F.xxhash64("_chosen"), "_chosen").limit(max_rows)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_chosen"))
    rows = statistics(texts.select(F.struct("_id", "_label").alias("doc_id"), "text"))
    return stored(rows.select(F.col("doc_id._label").alias("label"), *STATISTICS), "rule-sample")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000,
        trees: int = 20, depth: int = 3, penalty: float = 0.002, doc_id: str = "doc_id",
        text: str = "text") -> Model:
    """Learn from at most ``max_rows`` labelled rows (more only where ids repeat)."""
    rows = sample(docs, labels, max_rows, label, doc_id, text)
    seen = rows.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    n, ones = seen["n"], seen["ones"] or 0.0
    if not 0 < ones < n:
        rate = min(max(ones / n if n else 0.5, 1e-6), 1 - 1e-6)
        return Model(-_log(1 / rate - 1), ())
    # The sample is bounded, so a few partitions hold it.
    rows = rows.coalesce(4).select("label", array_to_vector(F.array(*STATISTICS)).alias("x"),
                                   *STATISTICS).cache()
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees,
                                    maxDepth=depth, seed=7).fit(rows)
    rules = path_rules(forest.toDebugString, STATISTICS)
    indicators = rows.select("label", array_to_vector(F.array(*[
        rule.column().cast("double") for rule in rules])).alias("x")).cache()
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0,
                               regParam=penalty, standardization=False, maxIter=60)
    fitted = lasso.fit(indicators)
    weights = tuple((rule, float(w)) for rule, w in zip(rules, fitted.coefficients) if w)
    indicators.unpersist()
    rows.unpersist()
    return Model(float(fitted.intercept), weights)


def _log(x: float) -> float:
    from math import log
    return log(x)


def scored(docs: DataFrame, model: Model, threshold: float = 0.3, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    return statistics(docs, doc_id, text).select(
        "doc_id", held_out("doc_id").alias("held_out"), model.score().alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted"))
