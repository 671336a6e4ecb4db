"""Question triage from the semantic view's instruction rules.

The hosted service applies 14 written rules through a language model; this
reproduces the *rules* as an ordered keyword classifier (the first matching
rule wins). Most rules are lists of example phrases. Two are conditions on what a question
lacks: one that compares churn without naming a measure has to be asked back, and one
that names nothing the data cover is out of scope. The classifier labels a question
with a category and whether answering it needs SQL at all. It is a column
expression (``rlike`` chain), so a table of a billion questions is classified
in one projection.

Matching is on the lower-cased whole text with explicit word edges
(``[^a-z]`` or the text's start/end) rather than ``\\b``, whose meaning for
non-ASCII letters differs between regex engines. A trailing plural 's' of a
phrase is optional.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed rule table: (category, needs_sql, example phrases of the rule), in rule order.
RULES = [
    ("ambiguous_measure", False, [
        "biggest churn problem", "worst churn problem", "main churn issue",
        "largest churn issue"]),
    ("forward_revenue_risk", False, [
        "revenue at risk", "revenue is at risk", "future revenue loss", "expected revenue loss",
        "forecasted churn revenue", "future churn impact", "revenue we may lose"]),
    ("cohort_retention", False, [
        "historical cohort retention", "cohort retention curves", "cohort retention",
        "cohort survival", "survival analysis", "retention by acquisition cohort",
        "churn by acquisition cohort", "longitudinal retention",
        "historical month-over-month churn progression", "true historical retention curve"]),
    ("historical_period", False, [
        "last year", "last quarter", "previous month", "year over year", "month over month",
        "before vs after", "trend over time"]),
    ("churn_prediction", False, [
        "will churn", "likely to churn", "future churn probability", "churn prediction",
        "churn risk score", "expected future churn"]),
    ("cltv_methodology", False, [
        "how cltv was calculated", "how is cltv calculated", "what model produced cltv",
        "what future revenue cltv predicts", "cltv formula"]),
    ("product_cancellation", False, [
        "product cancellation", "product-level discontinuation", "canceling", "cancelling"]),
    ("causal", True, [
        "causes", "drives", "reduces", "reduce", "increases", "increase", "prevents", "prevent"]),
    ("meta_question", False, [
        "request id", "internal logs", "system behavior"]),
    ("reported_reasons", True, [
        "why customers churned", "why did customers churn", "churn reasons", "churn reason"]),
    ("lifecycle_small_sample", True, [
        "highest churn rate by tenure", "lifecycle month", "tenure month"]),
]
DEFAULT = ("supported", True)

# Fixed word lists of the two conditions.
CHURN_TERMS = ["churn", "churned", "churning", "attrition"]
COMPARISONS = ["highest", "lowest", "most", "least", "top", "worst", "best", "biggest", "largest",
               "rank", "ranked", "ranking", "compare", "compared", "comparison", "which", "where"]
MEASURES = ["rate", "rates", "percentage", "percentages", "percent", "share", "shares",
            "contribution", "contributions", "contribute", "contributes", "number", "numbers",
            "count", "counts", "volume", "volumes", "how many", "churned customers", "charge",
            "charges", "revenue", "revenues", "cltv", "lifetime value", "gap", "gaps"]
DOMAIN_TERMS = [
    "customer", "customers", "churn", "churned", "churning", "attrition", "status", "product",
    "products", "service", "services", "adoption", "adopted", "contract", "contracts", "payment",
    "payments", "offer", "offers", "revenue", "revenues", "charge", "charges", "cltv",
    "lifetime value", "tenure", "lifecycle", "segment", "segments", "satisfaction", "reason",
    "reasons", "age", "gender", "city", "cities", "location", "locations", "zip", "internet",
    "phone", "streaming", "referral", "referrals"]

#: (category, needs SQL, a term of each list occurs, no term of the list occurs)
CONDITIONS = [
    ("unclear_measure", False, [CHURN_TERMS, COMPARISONS], MEASURES),
    ("out_of_scope", False, [], DOMAIN_TERMS),
]


def _phrase(p: str) -> str:
    e = re.escape(p.lower()).replace("\\ ", " ")
    return e[:-1] + "s?" if p.endswith("s") else e


def rule_pattern(phrases: list[str]) -> str:
    alts = "|".join(_phrase(p) for p in phrases)
    return f"(^|[^a-z])({alts})([^a-z]|$)"


def _words(terms: list[str]) -> str:
    return f"(^|[^a-z])({'|'.join(re.escape(t).replace(chr(92) + ' ', ' ') for t in terms)})([^a-z]|$)"


def category(text: str | Column) -> Column:
    """NULL is an empty question, which is out of scope."""
    t = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    conditions = [(name, t.rlike(rule_pattern(phrases))) for name, _, phrases in RULES]
    for name, _, wanted, unwanted in CONDITIONS:
        holds = ~t.rlike(_words(unwanted))
        for terms in wanted:
            holds = holds & t.rlike(_words(terms))
        conditions.append((name, holds))
    expr = None
    for name, cond in conditions:
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(DEFAULT[0])


def needs_sql(cat: str | Column) -> Column:
    c = F.col(cat) if isinstance(cat, str) else cat
    no_sql = [rule[0] for rule in (*RULES, *CONDITIONS) if not rule[1]]
    return ~c.isin(*no_sql)


def triage(df: DataFrame, text_col: str = "text") -> DataFrame:
    out = df.withColumn("category", category(text_col))
    return out.withColumn("needs_sql", needs_sql("category"))


def triage_summary(questions: DataFrame) -> DataFrame:
    """Questions per category, over the whole texts.

    The rules cost far more than reading the texts, and a table of short rows is one file split
    for millions of them, so the texts are dealt out first.
    """
    n = int(questions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = triage(questions.repartition(n))
    return q.groupBy("category", "needs_sql").agg(F.count(F.lit(1)).alias("questions"))
