"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import materialize

WORD_BREAK = r"[\x20\x09-\x0D]+"        # what separates words, as a Java / Python pattern
WHITESPACE = " \t\n\x0b\x0c\r"          # the same characters, for translate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh table under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage on shared storage, so a lost executor recomputes nothing
    before this point and a plan that is used twice runs once.
    """
    return materialize(df, f"llm-{label}-{uuid.uuid4().hex[:12]}")


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-whitespace; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        new = name
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


def settled(decision: Column) -> Column:
    """The same boolean, evaluated where it stands: the optimiser neither pushes a filter
    on it below the projection nor repeats the expressions it is made of."""
    return decision & (F.monotonically_increasing_id() >= 0)
