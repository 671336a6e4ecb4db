"""Operator 7 — quality classifier: a sparse rule ensemble compiled into columns.

1. Statistics of every document (``text_stats``) become ratios — never labels,
   language, source or id.
2. A small random forest is grown on the labelled training rows; every path from
   a root to a node is a conjunctive rule over the ratios.
3. Logistic regression with a lasso penalty weighs the rules; most get weight zero.
4. The surviving rules compile into one Spark expression, ``1 / (1 + exp(-(b + sum
   of weights of the rules that hold)))``, evaluated in one projection: no user
   function, no shuffle, linear in the text.

The fit uses at most about ``MAX_TRAIN`` labelled rows, chosen by a hash of doc_id;
scoring covers every row. Labels of one doc_id that disagree count as 0.

Cases: NULL or empty text has all ratios 0 and is scored like any other; NULL
labels are ignored; a NULL doc_id is never trained on and is not held out;
repeated rows get equal scores; with no labels, one class only, or training texts whose
ratios are all equal, the score is the share of label 1 (0.5 without labels); an empty table gives an empty result; extra
columns are ignored by ``score`` and kept by ``filter_documents``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import fresh, save, settled
from churnlens.llm.text_stats import text_stats

MAX_TRAIN = 200_000
TREES, DEPTH, SEED = 12, 3, 11
LASSO = 0.002
CUT = 0.3
FOLDS, HELD_OUT = 5, 0


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0D END"


#: Feature → SQL over the statistics.
FEATURES = {
    "log_words": "log1p(CAST(n_words AS DOUBLE))",
    "word_length": _ratio("word_chars", "n_words"),
    "symbols": _ratio("n_symbols", "n_words"),
    "duplicate_lines": _ratio("n_dup_lines", "n_lines"),
    "repeats": _ratio("n_repeat_words", "n_words"),
    "stop_words": _ratio("n_stop", "n_words"),
    "upper_case": _ratio("n_upper", "word_chars"),
    "line_words": _ratio("n_words", "n_lines"),
}


def ratios(stats: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the features."""
    return stats.select(*keep, *[F.expr(sql).alias(name) for name, sql in FEATURES.items()])


#: A rule: sorted (feature, above or not, bound); it holds if all its bounds do.
Rule = tuple[tuple[str, bool, float], ...]


def rule_sql(rule: Rule) -> str:
    return " AND ".join(f"{name} {'>' if above else '<='} {bound!r}D"
                        for name, above, bound in rule)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Score as a column over the features."""
        terms = [f"{self.intercept!r}D"] + [
            f"CASE WHEN {rule_sql(r)} THEN {w!r}D ELSE 0D END" for r, w in self.weights]
        return F.expr(f"1D / (1D + exp(-({' + '.join(terms)})))")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT,
                      F.lit(False))


def _tighten(path: list[tuple[str, bool, float]]) -> Rule:
    """One bound per feature and side."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, above, bound in path:
        old = bounds.get((name, above))
        bounds[name, above] = bound if old is None else (max if above else min)(old, bound)
    return tuple(sorted((n, a, b) for (n, a), b in bounds.items()))


def forest_rules(forest, names: list[str]) -> list[Rule]:
    """Every path to a node below a root, once, in a fixed order."""
    rules: set[Rule] = set()

    def walk(node, path: list) -> None:
        if path:
            rules.add(_tighten(path))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), [*path, (name, False, bound)])
        walk(node.rightChild(), [*path, (name, True, bound)])

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), [])
    return sorted(rules)


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> RuleModel:
    """``stats``: doc_id and statistics; ``labels``: doc_id, quality (0 or 1)."""
    known = labels.where("doc_id is not null and quality in (0, 1)") \
        .groupBy("doc_id").agg(F.min("quality").cast("double").alias("label")) \
        .where(~held_out(F.col("doc_id")))
    total = known.count()
    if total > max_train:
        share = F.lit(int(max_train / total * 1_000_000))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    names = list(FEATURES)
    rows = save(ratios(stats.join(known, "doc_id"), "label", "doc_id"), "train")
    shares = {r["label"]: r["n"] for r in rows.groupBy("label").agg(
        F.count("*").alias("n")).collect()}
    share = (shares.get(1.0, 0) + 1e-9) / (sum(shares.values()) + 2e-9)
    share = min(max(share, 1e-6), 1 - 1e-6)
    constant = RuleModel(math.log(share / (1 - share)), ())
    if len(shares) < 2:
        return constant
    # a fixed order: the sample of a tree depends on it
    few = save(rows.orderBy("doc_id").withColumn("ratios", array_to_vector(F.array(*names))),
               "ordered")
    forest = RandomForestClassifier(
        featuresCol="ratios", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        subsamplingRate=0.8, featureSubsetStrategy="sqrt", maxBins=64).fit(few)
    rules = forest_rules(forest, names)
    if not rules:                   # no ratio tells any two training rows apart
        return constant
    hold = array_to_vector(F.expr(
        "array(" + ", ".join(f"CAST({rule_sql(r)} AS DOUBLE)" for r in rules) + ")"))
    fired = save(few.select("label", hold.alias("fired")), "fired")
    lasso = LogisticRegression(featuresCol="fired", labelCol="label", regParam=LASSO,
                               elasticNetParam=1.0, maxIter=60, standardization=False).fit(fired)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if abs(w) > 1e-9]
    return RuleModel(float(lasso.intercept), tuple(weights))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted — one row per input row."""
    stats = save(text_stats(docs), "stats")
    return scored(stats, fit(stats, labels), ("doc_id",))


def scored(stats: DataFrame, model: RuleModel, keep: tuple[str, ...]) -> DataFrame:
    """``stats`` must hold doc_id beside ``keep``."""
    out = ratios(stats, *dict.fromkeys((*keep, "doc_id"))).select(
        *keep, held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted 1, with all their columns."""
    row, = fresh(docs, "row")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                        "doc_id", "text")
    training = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    model = fit(text_stats(training), labels)
    good = settled(F.col("predicted") == 1).alias("good")
    return scored(text_stats(whole, (row, "doc_id")), model, (row,)).select(row, good) \
        .where("good").select(f"{row}.*")
