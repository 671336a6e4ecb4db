"""The corpus pipeline: documents in, packed sequences out.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
``run`` writes each stage's result as Parquet under ``spark.checkpoint.dir`` and
reads it back as the next one's documents. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import minhash, packing, quality_classifier, quality_rules, substring_dedup
from churnlens.llm.common import read_table, save

#: The stage's own threshold; 85 is that of the query op10.
NEAR_PCT = 80


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality_rules.filter_documents(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted 0 go; labels come from the table of labels."""
    return quality_classifier.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (word shingles, similarity 0.8 or
    more) stays: the smallest doc_id."""
    return minhash.keep_one(docs, pct=NEAR_PCT)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; n_chars follows the text, and a
    document of which nothing is left goes."""
    cut = substring_dedup.remove_repeats(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0))
                             .cast(docs.schema["n_chars"].dataType))
    return cut.where("text is null or trim(text) != ''")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("minhash near-dedup", minhash_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


#: Tokens, learned rules and content-defined chunks cannot be said in SQL.
ORACLE_SQL = None
