"""Per-document text statistics as Spark column expressions (no user functions).

``text_stats(docs)`` adds nothing to the input rows: it returns ``doc_id`` and
the statistics below, one row per input row, from a chain of projections (no
shuffle). NULL and empty texts have zero counts.

n_words, word_chars (code points inside words), n_symbols (characters of
``#*$%&|<>``), n_lines (\\n-split lines with a word), n_dup_lines (such lines
equal to an earlier one), n_repeat_words (words inside 5-word windows that occur
twice or more, the first occurrence included), n_stop (words that are a
lower-case stop word of four languages), n_upper (upper-case letters).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import WHITESPACE, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "her", "his", "in", "is",
    "it", "not", "of", "on", "or", "that", "the", "their", "this", "to", "was", "with",
    "au", "aux", "avec", "ce", "dans", "des", "du", "elle", "est", "et", "il", "la", "le", "les",
    "ne", "ou", "par", "pas", "pour", "que", "qui", "se", "son", "sur", "un", "une",
    "auf", "aus", "bei", "das", "dem", "den", "der", "die", "ein", "eine", "einer", "für", "ich",
    "im", "ist", "mit", "nicht", "sich", "sie", "und", "von", "zu",
    "al", "como", "con", "de", "del", "el", "en", "las", "lo", "los", "no", "o", "para", "por",
    "su", "una", "y",
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
          "n_stop", "n_upper")


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def covered_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in ``hashes``.

    ``hashes`` must be a materialised array column (one hash per window start).
    Windows are sorted by (hash, start), so equal ones are neighbours; the starts
    that have an equal neighbour are put in order and each adds the words up to
    the next start, at most the window length. O(n log n) per document.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def starts(sorted_pairs: Column) -> Column:
        kept = F.filter(sorted_pairs, lambda x, i: (
            F.coalesce(F.get(sorted_pairs, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(sorted_pairs, i + 1)["h"] == x["h"], F.lit(False))))
        return F.sort_array(F.transform(kept, lambda x: x["p"]))

    def covered(sorted_starts: Column) -> Column:
        steps = F.transform(sorted_starts, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(sorted_starts, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    # an array of one element binds an intermediate value once inside the expression
    bound = F.transform(F.array(pairs), starts)
    return F.transform(bound, covered)[0]


def text_stats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    t, w, k = F.col("_t"), F.col("_w"), F.col("_k")
    base = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_t"),
                       words_of(F.col("text")).alias("_w"))
    # one projection per step: a later step reads the arrays of the one before
    hashed = base.select(
        *keep, "_t", "_w",
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
        F.transform(w, lambda x: F.xxhash64(x)).alias("_k"))
    counted = hashed.select(
        *keep, "_l",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _removed(t, f"[{SYMBOLS}]+").alias("n_symbols"),
        F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop"),
        _removed(t, r"\p{Lu}+").alias("n_upper"),
        F.transform(F.slice(k, 1, F.greatest(F.size(k) - (WINDOW - 1), F.lit(0))),
                    lambda x, i: F.xxhash64(x, *[F.get(k, i + j) for j in range(1, WINDOW)]))
        .alias("_h"))
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    return counted.select(
        *keep, "n_words", "word_chars", "n_symbols",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(repeated, covered_words(F.col("_h")))
        .otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        "n_stop", "n_upper")
