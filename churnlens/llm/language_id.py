"""Operator 13 — language identification: spans of one language by Viterbi over words.

1. Words are maximal runs of letters, cut after ``MAX_WORD`` letters (so text without
   spaces has words, too). A word's script is that of most of its letters, by ranges of
   code points.
2. The model, counted on labelled texts: for each language the share of its letters in
   each script, and a smoothed distribution over hashed features of words (the word
   itself and its trigrams with both edges).
3. A word's script narrows its candidates to the languages that write at least
   ``MIN_SHARE`` of their letters in it (to all, where none does). Candidates score the
   log probability of the word's features, relative to the best one and not below
   -``FLOOR``; the others score twice that.
4. Viterbi over the words of a whole text: the best sequence of languages, each change
   of language costs ``SWITCH``. Its runs of one language are the spans.
5. The text's language is the one of most letters; its score is the share of the
   letters in words of that language.

``fit`` reads about ``MAX_PER_LANGUAGE`` texts of each language, chosen by a hash of doc_id,
one text per doc_id and language; the counts are summed by Spark and the model takes
256 KB per language, whatever the input. ``label`` is one narrow stage: no shuffle, nothing
grouped by id, source or copy. A task holds the back pointers of about ``CELLS`` words x
languages at a time, or those of one text if that alone has more (one byte per word and
language beside the text).

Cases: NULL texts and texts without a letter are `und` with score 0 and no spans; so is
every text if nothing could be learned; ties go to staying in a language, then to the
first language by name; repeated rows get equal rows; NULL doc_ids are labelled, but
never learned from; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
MAX_WORD = 24
FEATURES = 1 << 16
SMOOTHING = 0.1
MIN_SHARE = 0.005
FLOOR = 8.0
SWITCH = 16.0
MAX_PER_LANGUAGE = 4_000
CELLS = 8_000_000
_CACHED_WORDS = 200_000

# fixed values: first code point of a block of scripts, and the script; "" ends a block
_BLOCKS = (
    (0x0041, "Latin"), (0x0250, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"),
    (0x0780, "Thaana"), (0x07C0, ""), (0x08A0, "Arabic"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x13A0, ""), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, ""), (0x1C80, "Cyrillic"),
    (0x1C90, "Georgian"), (0x1CC0, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""),
    (0x2D00, "Georgian"), (0x2D30, ""), (0x2DE0, "Cyrillic"), (0x2E00, ""), (0x3040, "Kana"),
    (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, ""), (0x31F0, "Kana"), (0x3200, ""),
    (0x3400, "Han"), (0xA000, ""), (0xA640, "Cyrillic"), (0xA6A0, ""), (0xA720, "Latin"),
    (0xA800, ""), (0xAC00, "Hangul"), (0xD800, ""), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, ""), (0x20000, "Han"), (0x40000, ""))
_FIRST = np.array([b[0] for b in _BLOCKS])
SCRIPTS = ("", *dict.fromkeys(b[1] for b in _BLOCKS if b[1]))
_SCRIPT_OF = np.array([0, *(SCRIPTS.index(b[1]) for b in _BLOCKS)])

_LETTERS = re.compile(r"[^\W\d_]{1,%d}" % MAX_WORD)
_CHUNK = 20_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def n_letters(word: str) -> int:
    return len(word) if word.isalpha() else sum(map(str.isalpha, word))


def _bucket(x: np.ndarray) -> np.ndarray:
    """The upper 16 bits of a multiplicative hash."""
    return ((x * _MIX) >> np.uint64(48)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of non-empty words: the bucket of each word, the buckets of their trigrams (a space
    stands at both edges), where each word's trigrams begin, and letters per word and script."""
    codes = np.frombuffer(f" {' '.join(words)} ".lower().encode("utf-32-le"), dtype=np.uint32)
    codes = codes.astype(np.uint64)
    middle = np.flatnonzero(codes != 32)
    before, at, after = codes[middle - 1], codes[middle], codes[middle + 1]
    begin = np.flatnonzero(before == 32)
    word = np.cumsum(before == 32) - 1
    place = (np.arange(len(middle)) - begin[word]).astype(np.uint64)
    whole = np.add.reduceat(at * (np.uint64(2) * place + np.uint64(1)) ** np.uint64(5), begin)
    grams = _bucket(before | (at << np.uint64(21)) | (after << np.uint64(42)))
    script = _SCRIPT_OF[np.searchsorted(_FIRST, at, side="right")]
    scripts = np.bincount(word * len(SCRIPTS) + script, minlength=len(words) * len(SCRIPTS))
    return _bucket(whole), grams, begin, scripts.reshape(len(words), len(SCRIPTS))


# --- the model -----------------------------------------------------------------------------

@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]        # by name
    log_p: np.ndarray                 # FEATURES x languages
    writes: np.ndarray                # scripts x languages: is a candidate

    @classmethod
    def of_counts(cls, languages: list[str], counts: np.ndarray, letters: np.ndarray) -> LanguageModel:
        """``counts``: languages x FEATURES; ``letters``: languages x scripts."""
        p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * FEATURES)
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        writes = (share >= MIN_SHARE).T
        writes[~writes.any(axis=1)] = True
        return cls(tuple(languages), np.log(p).T.astype(np.float32), writes)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A score <= 0 per word and language; 0 for words without a letter."""
        out = [np.zeros((0, len(self.languages)))]
        for low in range(0, len(words), _CHUNK):
            chunk = words[low:low + _CHUNK]
            whole, grams, begin, scripts = features(chunk)
            s = self.log_p[whole] + np.add.reduceat(self.log_p[grams], begin, axis=0)
            candidate = self.writes[scripts.argmax(axis=1)]
            best = np.where(candidate, s, -np.inf).max(axis=1, keepdims=True)
            s = np.where(candidate, np.maximum(s - best, -FLOOR), -2 * FLOOR)
            s[[n_letters(w) == 0 for w in chunk]] = 0
            out.append(s)
        return np.concatenate(out)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per language: features below FEATURES, letters per script above."""
    for batch in batches:
        words: dict[str, Counter[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            words.setdefault(lang, Counter()).update(_LETTERS.findall(text.as_py() or ""))
        for lang, counter in words.items():
            sums = np.zeros(FEATURES + len(SCRIPTS), dtype=np.int64)
            lettered = [w for w in counter if n_letters(w)]
            for low in range(0, len(lettered), _CHUNK):
                chunk = lettered[low:low + _CHUNK]
                n = np.array([counter[w] for w in chunk])
                whole, grams, begin, scripts = features(chunk)
                lengths = np.diff(np.append(begin, len(grams)))
                np.add.at(sums, whole, n)
                np.add.at(sums, grams, np.repeat(n, lengths))
                sums[FEATURES:] += n @ scripts
            where = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(where), pa.string()), pa.array(where, pa.int32()),
                 pa.array(sums[where])], names=["lang", "feature", "n"])


def training_texts(docs: DataFrame, per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """lang, text: about ``per_language`` texts of each language, one per doc_id."""
    known = docs.where("doc_id is not null and lang is not null")
    # one number per language, as a literal: the texts are filtered where they are read
    shares = {r["lang"]: min(1.0, per_language / r["n"])
              for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return known.select("lang", "text")
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    return known.select("doc_id", "lang", "text") \
        .where((F.xxhash64("doc_id") / F.lit(2.0 ** 64) + 0.5) <= share) \
        .groupBy("doc_id", "lang").agg(F.max("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, per_language: int = MAX_PER_LANGUAGE) -> LanguageModel:
    """Learns from doc_id, text and lang of the given rows."""
    sums = training_texts(docs, per_language).mapInArrow(_count, "lang string, feature int, n long") \
        .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    names = sums.column("lang").to_pylist()
    languages = sorted(set(names))
    counts = np.zeros((len(languages), FEATURES + len(SCRIPTS)))
    row = {lang: i for i, lang in enumerate(languages)}
    counts[[row[x] for x in names], sums.column("feature").to_numpy()] = sums.column("n").to_numpy()
    return LanguageModel.of_counts(languages, counts[:, :FEATURES], counts[:, FEATURES:])


# --- labelling -----------------------------------------------------------------------------

def viterbi(scores: np.ndarray, texts: list[np.ndarray]) -> list[np.ndarray]:
    """Best language of every word of every text (arrays of rows of ``scores``).

    All texts advance together, the longest first, so a step is a few array operations on
    the texts that have not ended."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], dtype=np.int64)
    words = np.concatenate([texts[i] for i in order]) if order else np.empty(0, dtype=np.int64)
    start = np.cumsum(lengths) - lengths
    steps = int(lengths.max(initial=0))
    running = len(order) - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
    changed = np.zeros((len(words), scores.shape[1]), dtype=bool)   # came from another language
    best = np.zeros(len(words), dtype=np.int16)                     # the best one up to the word
    total = np.zeros((len(order), scores.shape[1]), dtype=np.float64)
    for t in range(steps):
        k = running[t]
        at, value = start[:k] + t, total[:k]
        if t:
            before = at - 1
            top = value[np.arange(k), best[before]][:, None]
            value -= top
            changed[at] = value < -SWITCH
            np.maximum(value, -SWITCH, out=value)
        value += scores[words[at]]
        best[at] = value.argmax(axis=1)
    labels = np.zeros(len(words), dtype=np.int16)
    now = best[start + lengths - 1].copy() if steps else np.zeros(0, dtype=np.int16)
    for t in range(steps - 1, -1, -1):
        k = running[t]
        at = start[:k] + t
        labels[at] = now[:k]
        if t:
            moves = changed[at, now[:k]]
            now[:k][moves] = best[at[moves] - 1]
    out: list[np.ndarray] = [labels[:0]] * len(order)
    for i, s, n in zip(order, start.tolist(), lengths.tolist(), strict=True):
        out[i] = labels[s:s + n]
    return out


class Labeller:
    """Labels texts with a model; scores of words are kept between calls, up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self._ids: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.model.languages)))
        self._letters = np.zeros(0)

    def _words(self, text: str | None) -> np.ndarray:
        ids = self._ids
        return np.fromiter((ids.setdefault(w, len(ids)) for w in _LETTERS.findall(text or "")),
                           dtype=np.int64)

    def _score_new(self) -> None:
        new = list(islice(self._ids, len(self._scores), None))
        self._scores = np.concatenate([self._scores, self.model.word_scores(new)])
        self._letters = np.concatenate([self._letters, [n_letters(w) for w in new]])

    def _spans(self, text: str, labels: np.ndarray) -> list[tuple[int, int, str]]:
        """(start, end, language) in characters, from one end of the text to the other."""
        firsts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist()]
        begins = [0]
        if len(firsts) > 1:
            starts = [m.start() for m in _LETTERS.finditer(text)]
            begins += [starts[i] for i in firsts[1:]]
        ends = [*begins[1:], len(text)]
        return [(b, e, self.model.languages[labels[f]])
                for b, e, f in zip(begins, ends, firsts, strict=True)]

    def label(self, texts: list[str | None]) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans) per text, in order."""
        if not self.model.languages:
            yield from ((UNKNOWN, 0.0, []) for _ in texts)
            return
        width, first = len(self.model.languages), 0
        while first < len(texts):
            if len(self._ids) > _CACHED_WORDS:
                self._forget()
            group: list[np.ndarray] = []
            size = 0
            while first + len(group) < len(texts) and size * width < CELLS:
                group.append(self._words(texts[first + len(group)]))
                size += len(group[-1])
            self._score_new()
            for words, labels in zip(group, viterbi(self._scores, group), strict=True):
                text = texts[first]
                first += 1
                share = np.bincount(labels, weights=self._letters[words], minlength=width)
                if not share.any():
                    yield UNKNOWN, 0.0, []
                    continue
                top = int(share.argmax())
                yield (self.model.languages[top], float(share[top] / share.sum()),
                       self._spans(text, labels))


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def _label(model: LanguageModel) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            found = list(labeller.label(batch.column("text").to_pylist()))
            spans = [[{"start": s, "end": e, "lang": g} for s, e, g in f[2]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array(spans, pa.list_(_SPAN))],
                names=["doc_id", "lang_pred", "score", "spans"])
    return run


def label(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, spans (start, end in characters, lang) per input row; reads
    nothing else of ``docs`` than doc_id (passed on) and text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _label(model), f"doc_id {kind}, lang_pred string, score double, "
                       "spans array<struct<start:long,end:long,lang:string>>")
