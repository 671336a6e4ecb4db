"""Registered queries of the training-data operators: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from churnlens.llm import (chat_format, conversation_repair, cover_tree, language_id, minhash,
                           packing, periodic_runs, quality_classifier, quality_rules, sentencepiece_lattice, sharding,
                           substring_dedup, url_filter)
from churnlens.llm.common import read_table, words_of


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(read_table(spark, sf_dir, "documents"))


def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_format.rotate(read_table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(
        s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))), ",")
    return out.withColumn("spans", spans)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read_table(spark, sf_dir, "pages"))
    base = F.col("tier") == 1
    return judged.select("page_id", "host", "path", F.when(base, F.col("rule")).alias("rule"),
                         "verdict", F.when(~base, F.col("rule")).alias("pattern_rule"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.encode(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return sharding.place(docs.select("doc_id", "source", "n_chars"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def _looped(docs: DataFrame) -> DataFrame:
    """Texts whose h = crc32(doc_id) ends in 0 go round in their words from word a on:
    word i >= a becomes original word a + (i - a) % p, words joined by one space."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def again(ws):
        n, g = F.size(ws).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(
            F.get(ws, (a + (i - a) % p).cast("int")))), " ")

    # an array of one element binds the words once
    text = F.transform(F.array(words_of(F.col("text"))),
                       lambda ws: F.when(F.size(ws) > 0, again(ws)).otherwise(F.lit("")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(_looped(read_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"),
        F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.expr("1000 * best.length div -best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped (0), emptied (1), without sentence ends (2), repeated (3) or made the
    user's (4) by crc32(`conv_id:turn`) % 20; NULLs are one space."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(shown("text"), "[.!?]", "")) \
        .otherwise(shown("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1)))
    return conversations.where(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"), copies.alias("copy")).drop("copy")


def _joined_sha256(batches):
    """Digest of the newline-joined lines of each conversation; rows come sorted, and a
    conversation may go on in the next batch."""
    import hashlib

    import pyarrow as pa

    def row(key, digest):
        return pa.RecordBatch.from_arrays(
            [key, pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "sha256"])

    key, shown, digest = None, None, None
    for batch in batches:
        for k, line in zip(batch.column("conv_id"), batch.column("line"), strict=True):
            if digest is not None and k.as_py() == shown:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield row(key, digest)
                key, shown, digest = pa.array([k.as_py()], k.type), k.as_py(), hashlib.sha256()
            digest.update(line.as_py().encode())
    if digest is not None:
        yield row(key, digest)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair(_damaged(conversations))
    # a digest reads a conversation in order, so in one task, line by line
    lines = repaired.edits.where("edit <> 'D'").select(
        "conv_id", "at", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "place") \
        .select("conv_id", "line").mapInArrow(
            _joined_sha256, f"conv_id {lines.schema['conv_id'].dataType.simpleString()}, sha256 string")
    ids = conversations.select("conv_id").distinct()
    s, d = repaired.summary.alias("s"), digests.alias("d")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.alias("i").join(s, F.col("i.conv_id").eqNullSafe(F.col("s.conv_id")), "left") \
        .join(d, F.col("i.conv_id").eqNullSafe(F.col("d.conv_id")), "left").select(
            "i.conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.label(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_chat_rotation, op3_best_fit_packing, op4_url_filters,
        op5_sentencepiece, op6_quality_rules, op7_quality_classifier, op8_sharding,
        op9_embedding_near_dedup, op10_minhash_near_dedup, op11_periodic_runs,
        op12_conversation_repair, op13_language_id)}
QUERIES["pipeline"] = corpus_pipeline.run
