"""Business questions derived from the star tables: stand-in input of the triage.

Every customer asks one question; which one follows from its key, its wording names the
customer's market segment and nation. Only texts are made here; no rule is applied.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: question texts; $s is a market segment, $n a nation
TEMPLATES = (
    "What is the churn rate of $s customers, and how many customers churned?",
    "What is the biggest churn problem in $n?",
    "How much revenue is at risk from $s customers?",
    "Show the cohort retention curves of $n.",
    "How many customers did $n lose last quarter?",
    "Which $s customers are likely to churn?",
    "Explain how CLTV was calculated for $n.",
    "Which products are $s customers cancelling?",
    "Does the contract type cause or reduce churn in $n? What drives it?",
    "Which segments like $s have the highest churn rate by tenure?",
    "Where is churn highest, in $n or elsewhere?",
    "Why did customers churn in $n?",
    "What will the weather in $n be tomorrow?",
    "Which request id answered the question about $s?",
    "Compare average monthly charges of $s by payment method.",
    "Rank the segments of $n by churn.",
)


def question_rows(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """(question_id, text), one row per customer."""
    c = customer.select(F.col("c_custkey").alias("question_id"), F.col("c_nationkey").alias("n_nationkey"),
                        F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment"))
    n = nation.select("n_nationkey", F.col("n_name").alias("nation"))
    kind = F.pmod(F.col("question_id"), F.lit(len(TEMPLATES)))
    text = reduce(lambda acc, x: acc.when(kind == x[0], F.lit(x[1])), enumerate(TEMPLATES[1:], 1),
                  F.when(kind == 0, F.lit(TEMPLATES[0])))
    text = F.replace(F.replace(text, F.lit("$s"), F.col("segment")), F.lit("$n"),
                     F.coalesce("nation", F.lit("an unknown nation")))
    return c.join(n, "n_nationkey", "left").select("question_id", text.alias("text"))
