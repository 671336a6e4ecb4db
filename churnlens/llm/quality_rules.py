"""Operator 6 — quality rules: a threshold table compiled into one projection.

``RULES`` lists (name, numerator, denominator, low, high): a document passes a
rule when ``low * denominator <= numerator <= high * denominator`` (products, so
a zero denominator needs no special case). ``compile_rules`` turns the table
into one Spark expression per rule; ``judge`` adds ``kept`` and ``failed_rules``.
No user function and no shuffle: the statistics of ``text_stats`` and the rules
are projections over the scan, so cost is linear in the text and rows are
independent (hot sources and copies change nothing).

Cases: NULL or empty text has all counts 0 and is not kept (fewer than ten
words); NULL in other columns is passed through; repeated rows are judged alike;
an empty table gives an empty result; extra columns of the input are ignored by
``judge`` and kept by ``filter_documents``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import fresh, settled
from churnlens.llm.text_stats import COUNTS, text_stats

#: (name, numerator, denominator, lowest ratio, highest ratio); None: no bound.
BASE_RULES = (
    ("length", "n_words", None, 10, None),
    ("repeated_windows", "n_repeat_words", "n_words", None, 0.20),
)
RULES = (
    ("mean_word_length", "word_chars", "n_words", 2, 12),
    ("symbols_per_word", "n_symbols", "n_words", None, 0.10),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 0.50),
    ("stop_words", "n_stop", "n_words", 0.05, None),
    ("upper_case", "n_upper", "word_chars", None, 0.40),
)
#: Stop words prove little in a handful of words.
STOP_RULE_MIN_WORDS = 40


def _passes(numerator: str, denominator: str | None, low, high) -> Column:
    n, d = F.col(numerator), F.col(denominator) if denominator else F.lit(1)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.lit(100) * n >= F.lit(round(100 * low)) * d)
    if high is not None:
        ok = ok & (F.lit(100) * n <= F.lit(round(100 * high)) * d)
    return ok


def compile_rules(rules) -> dict[str, Column]:
    """Rule name → boolean column (true: the document passes). Ratios are whole
    percents, compared in integers."""
    out = {name: _passes(*rest) for name, *rest in rules}
    if "stop_words" in out:
        out["stop_words"] = out["stop_words"] | (F.col("n_words") < STOP_RULE_MIN_WORDS)
    return out


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the statistics, base_failed, kept and the failed rules."""
    base, more = compile_rules(BASE_RULES), compile_rules(RULES)
    every = {**base, **more}
    return text_stats(docs, keep).select(
        *keep, *COUNTS,
        (~reduce(lambda a, b: a & b, base.values())).alias("base_failed"),
        reduce(lambda a, b: a & b, every.values()).alias("kept"),
        F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in every.items()]),
                 lambda x: x.isNotNull()).alias("failed_rules"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass every rule, with all their columns."""
    row, = fresh(docs, "row")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), "text")
    judged = judge(whole, (row,)).select(row, settled(F.col("kept")).alias("kept"))
    return judged.where("kept").select(f"{row}.*")
