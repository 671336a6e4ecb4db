"""Operator 11 — periodic run detection: seeds on diagonals, extended once each.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4q) words that no neighbouring word extends with the same period. Its words
agree with those q further on over a stretch of at least max(5, 3q) positions: a
stretch of the diagonal of lag q.

1. Lags are taken by octaves 2^j <= q < 2^(j+1). All diagonal stretches of an octave
   hold a k-gram of the guaranteed overlap: k = 5 for lag 1, 3 * 2^j above. The k-grams
   of a document are named by doubling (equal names: equal words, no hashing), and only
   positions whose shorter gram is repeated are looked at again, so a text without
   repeats ends at its 3-grams.
2. The seeds of an octave are the pairs of an occurrence of a k-gram and the next one in
   the same document, if their distance lies in the octave. As k >= 1.5 q (5 for lag 1), the
   next occurrence inside a run of smallest period q is exactly q further, and a next occurrence
   never has a multiple of the smallest period as its lag: linear in the text, no
   seed lost, however often a k-gram occurs.
3. A seed that the table of the furthest covered position per lag already reaches is
   dropped; any other one is extended both ways in blocks and enters the table.

A document is worked on in one task (runs never cross documents) with memory linear in
its text; documents are never shuffled, and ids, copies or sources that hold many rows
make no group. Time is O(n log n) per document.

Cases: NULL or empty text has no words and no runs; repeated rows give equal rows; a
NULL doc_id is kept; runs of one start or length are all listed (by start, then
period); an empty table gives an empty result; extra columns are ignored, their names may
be anything but doc_id and text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MIN_LENGTH, MIN_EXPONENT = 6, 4

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLOCK = 64


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Names of pairs of names: equal pairs get equal names."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second,
                     return_inverse=True)[1].reshape(-1)


class _Grams:
    """Named k-grams at the positions where they occur twice or more."""

    def __init__(self, at: np.ndarray, names: np.ndarray):
        often = np.bincount(names)[names] > 1 if len(names) else np.zeros(0, dtype=bool)
        self.at, self.names = at[often], names[often]

    def joined(self, other: _Grams, shift: int) -> _Grams:
        """Grams that begin as one of these and go on, ``shift`` later, as one of ``other``."""
        where = np.searchsorted(other.at, self.at + shift)
        where[where == len(other.at)] = 0
        both = other.at[where] == self.at + shift if len(other.at) else \
            np.zeros(len(self.at), dtype=bool)
        return _Grams(self.at[both], _pairs(self.names[both], other.names[where[both]]))

    def next_occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, distance to the next occurrence of its gram), by position."""
        order = np.argsort(self.names, kind="stable")
        at, names = self.at[order], self.names[order]
        same = names[1:] == names[:-1]
        at, lag = at[:-1][same], (at[1:] - at[:-1])[same]
        order = np.argsort(at, kind="stable")
        return at[order], lag[order]


def _reach(words: np.ndarray, start: int, lag: int, step: int) -> int:
    """How many positions from ``start`` on (step 1) or down (step -1) agree with those
    ``lag`` further."""
    limit = len(words) - lag - start if step > 0 else start + 1
    done, block = 0, _BLOCK
    while done < limit:
        n = min(block, limit - done)
        low = start + done if step > 0 else start - done - n + 1
        equal = words[low:low + n] == words[low + lag:low + lag + n]
        if step < 0:
            equal = equal[::-1]
        if not equal.all():
            return done + int(np.argmin(equal))
        done += n
        block *= 2
    return limit


def _octaves(words: np.ndarray) -> Iterator[tuple[int, int, _Grams]]:
    """(lowest lag, highest lag, grams of the guaranteed overlap) while any is repeated."""
    n = len(words)
    one = _Grams(np.arange(n), words)
    two = one.joined(one, 1)
    three = two.joined(one, 2)
    if not len(three.at):
        return
    yield 1, 1, three.joined(three, 2)
    low, grams = 2, three.joined(three, 3)
    while len(grams.at):
        yield low, 2 * low - 1, grams
        grams = grams.joined(grams, 3 * low)
        low *= 2


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``words`` are
    small integers, equal for equal words."""
    runs = []
    for low, high, grams in _octaves(words):
        at, lags = grams.next_occurrences()
        inside = (lags >= low) & (lags <= high)
        at, lags = at[inside], lags[inside]
        # a seed right after one of the same lag lies in that one's extension
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = (at[1:] == at[:-1] + 1) & (lags[1:] == lags[:-1])
        covered: dict[int, int] = {}
        for i, q in zip(at[~follows].tolist(), lags[~follows].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            start = i - (_reach(words, i - 1, q, -1) if i else 0)
            end = i + _reach(words, i, q, 1)         # end of the diagonal stretch
            covered[q] = end
            length = end - start + q
            if length >= max(MIN_LENGTH, MIN_EXPONENT * q):
                runs.append((start, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def analyse(text: str | None) -> tuple[int, list[tuple[int, int, int]], str]:
    """Number of words, runs, and the words that stay when every run is cut to its first
    period, joined by one space."""
    words = _WORD.findall(text) if text else []
    ids: dict[str, int] = {}
    coded = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64,
                        count=len(words))
    runs = find_runs(coded) if len(ids) < len(words) else []
    if runs:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, q in runs:
            edge[start + q] += 1
            edge[start + length] -= 1
        kept = np.cumsum(edge[:-1]) == 0
        words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
    return len(coded), runs, " ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ROWS = 256


def _analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("start", "length", "period")
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            part = batch.slice(low, _ROWS)
            found = [analyse(t.as_py()) for t in part.column("text")]
            runs = [[dict(zip(names, r, strict=True)) for r in f[1]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                 pa.array(runs, pa.list_(_RUN)), pa.array([f[2] for f in found], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period: by start, then period) and
    collapsed (the text without the repetitions of its runs) — one row per input row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _analyse, f"doc_id {kind}, n_words long, "
                  "runs array<struct<start:long,length:long,period:long>>, collapsed string")
