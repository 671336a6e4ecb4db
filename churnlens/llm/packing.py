"""Operator 3 — best-fit packing by a configuration linear program.

1. Documents are tokenised once (byte-level BPE, then the end id) and cut into
   pieces of at most ``CAPACITY`` tokens; only the first piece of a longer
   document may be shorter. The pieces are written to shared storage.
2. Their length histogram (at most ``CAPACITY`` rows, whatever the corpus) goes to
   the driver. The covering program "fewest sequences so that the configurations
   (multisets of lengths that fit) cover every length as often as it occurs" is
   solved by multiplicative weights, until every length is covered. A length starts at
   the price of its tokens, which falls exponentially with the share of it that is
   covered; a knapsack dynamic program finds the configuration of most value, and from
   the same table those of nearly that value that start with another length that lags.
   Each is used until its scarcest length has gained a step, so the rounds are bounded by
   lengths / step, whatever the counts. Prices over the value of the best configuration are a dual
   solution: the largest one met bounds the sequences of any plan from below.
3. Rounding: scaled to the tokens of the histogram, configurations of at least the plan's
   mean filling that hold a piece over half a sequence (which needs one of its own in any
   plan) are rounded to whole numbers, the longest pieces first and never beyond the pieces
   there are. What they leave, mostly fractions of configurations and small pieces, is
   repaired by best fit decreasing over its histogram. The largest share of the program's
   plan (``SHARES``) is kept that needs no more sequences than a smaller share of it.
4. Assignment is distributed: pieces get their rank within their length from counts
   per (partition, length), and the plan, as one interval table per length, tells
   each rank its sequence and offset. No sort, no group that holds a length's
   pieces: a length shared by a third of all rows stays spread.

Cases: NULL or empty text is one piece of one token; several rows with one doc_id
are packed as so many documents; a NULL doc_id keeps NULL; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import save

CAPACITY = 1024
END_ID = 2
#: The share of its scarcest length that a use of a configuration covers is lengths / ``PACE``,
#: at most 1 and at least ``FINEST``: few lengths are priced finely, many in bounded time.
PACE = 1000
FINEST = 0.05
#: Parts of the program's plan that are tried as whole configurations.
SHARES = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)
#: Configurations tried from one knapsack table, and the least value of theirs, relative
#: to the best one's.
STARTS = 24
NEARLY = 0.98
_CACHE_UNITS = 400_000
_PIECES = ("part int, local long, doc_id long, piece int, start long, length long, "
           "ids_crc32 long")


# --- tokens --------------------------------------------------------------------------------

#: The byte-level pre-tokenizer's pattern (fixed value of the vocabulary).
_PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
             r"|\s+(?!\S)|\s+")


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the others from U+0100 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of texts, with a bounded cache of word units.

    The pre-tokenizer always ends a token before a single space or line break that
    stands between two other characters, so a text is the concatenation of the
    units cut there and equal units have equal ids. Any other text (runs of white
    space, other white space, special token strings) is encoded whole."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        # the same vocabulary, ranked by id: faster on single units, equal ids (tested)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        byte_of = {c: b for b, c in enumerate(_byte_characters())}
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in model["model"]["vocab"].items() if token not in special}
        self._units = tiktoken.Encoding("units", pat_str=_PRETOKEN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self._cache: dict[str, bytes] = {}

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<u4")
        # all characters are in words or are spaces and line breaks (no other white space),
        # and there are as many words as these allow if each stands alone between two words
        breaks, words = text.count(" ") + text.count("\n"), text.split()
        if len(words) != breaks + 1 or len("".join(words)) + breaks != len(text) \
                or "<|" in text or "\x00" in text:
            return np.array(self._tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
        cache = self._cache
        out = []
        for unit in text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00"):
            ids = cache.get(unit)
            if ids is None:
                ids = array("I", self._units(unit)).tobytes()
                if len(cache) < _CACHE_UNITS:
                    cache[unit] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<u4")


def pieces_of(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n >= 1 tokens."""
    first = n % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def _tokenise(path: str, capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = Encoder(path), TaskContext.get().partitionId()
        local: Counter[int] = Counter()      # rank among the task's pieces of one length
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                    strict=True):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(END_ID)).astype("<u4")
                for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    rows.append((part, local[length], doc_id, k, start, length,
                                 zlib.crc32(ids[start:start + length].tobytes())))
                    local[length] += 1
            cols = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["part", "local", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


# --- the plan ------------------------------------------------------------------------------

class Knapsack:
    """Bounded knapsack over lengths, dynamic program: the most valuable multiset of lengths for
    every capacity up to ``capacity``.

    ``value[l]`` is the worth of length l (0: not offered); a length is used at most
    ``most[l]`` times (its copies are offered in bundles of 1, 2, 4, ...)."""

    def __init__(self, value: np.ndarray, capacity: int, most: np.ndarray):
        self._bundles = []
        for length in np.flatnonzero(value > 0).tolist():
            copies, k = min(int(most[length]), capacity // length), 1
            while copies > 0:
                self._bundles.append((length, min(k, copies)))
                copies -= k
                k *= 2
        self.best = np.zeros(capacity + 1)
        self._taken = np.zeros((len(self._bundles), capacity + 1), dtype=bool)
        for row, (length, k) in zip(self._taken, self._bundles, strict=True):
            size = length * k
            worth = self.best[:capacity + 1 - size] + value[length] * k
            np.greater(worth, self.best[size:], out=row[size:])
            np.maximum(self.best[size:], worth, out=self.best[size:])

    def configuration(self, room: int) -> dict[int, int]:
        """length → items of the best multiset that fits ``room``."""
        out: dict[int, int] = {}
        below = len(self._bundles)
        while (rows := np.flatnonzero(self._taken[:below, room])).size:
            below = int(rows[-1])
            length, k = self._bundles[below]
            out[length] = out.get(length, 0) + k
            room -= length * k
        return out


def best_configuration(value: np.ndarray, capacity: int, most: np.ndarray) -> dict[int, int]:
    """Most valuable multiset of lengths that fits."""
    return Knapsack(value, capacity, most).configuration(capacity)


def fractional_plan(counts: np.ndarray, capacity: int) -> tuple[dict[tuple, float], float]:
    """Configurations (longest length first) with fractional multiplicities that cover all
    counts, and the program's dual bound on the number of sequences."""
    need = counts.astype(float)
    tokens = np.arange(capacity + 1) / capacity
    cover = np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    bound = 0.0
    step = min(1.0, max(FINEST, np.count_nonzero(counts) / PACE))
    while True:
        done = np.where(need > 0, cover / np.maximum(need, 1), 1.0)
        lags = done < 1 - 1e-9
        if not lags.any():
            return used, bound
        low = done[lags].min()
        value = np.where(lags, tokens * np.exp((low - done) / step), 0.0)
        priced = Knapsack(value, capacity, counts)
        worth = priced.best[capacity]
        bound = max(bound, float((value * need).sum() / worth))
        # the first of them is the best configuration; the others must earn their use
        starts = np.flatnonzero(lags & (done <= low + step / 2))[::-1][:STARTS].tolist()
        for first in [0, *starts]:
            config = priced.configuration(capacity - first)
            if first:
                config[first] = config.get(first, 0) + 1
                if config[first] > counts[first] \
                        or sum(value[x] * n for x, n in config.items()) < NEARLY * worth \
                        or any(cover[x] >= need[x] * min(1.0, low + 2 * step) for x in config):
                    continue
            amount = min(step * min(need[x] / n for x, n in config.items()),
                         max((need[x] - cover[x]) / n for x, n in config.items()))
            key = tuple(sorted(config.items(), reverse=True))
            used[key] = used.get(key, 0.0) + amount
            for x, n in config.items():
                cover[x] += amount * n


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> dict[tuple, int]:
    """Best fit decreasing on a histogram: configuration → how many sequences.

    Open sequences of equal contents are handled as one entry, so the work depends
    on the number of lengths and not on the number of pieces."""
    room: dict[int, dict[tuple, int]] = {}
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for space in sorted(r for r in room if r >= length):
            per = space // length
            for config in list(room[space]):
                if not left:
                    break
                n = room[space][config]
                full, rest = divmod(left, per)
                whole = min(n, full)
                moves = [(whole, per)]
                if whole < n and rest and whole == full:
                    moves.append((1, rest))
                for sequences, items in moves:
                    if not sequences:
                        continue
                    left -= sequences * items
                    room[space][config] -= sequences
                    new = (*config, (length, items))
                    to = room.setdefault(space - items * length, {})
                    to[new] = to.get(new, 0) + sequences
                if not room[space].get(config, 1):
                    del room[space][config]
        if left:
            per = capacity // length
            full, rest = divmod(left, per)
            for sequences, items in ((full, per), (1 if rest else 0, rest)):
                if sequences:
                    to = room.setdefault(capacity - items * length, {})
                    key = ((length, items),)
                    to[key] = to.get(key, 0) + sequences
    out: dict[tuple, int] = {}
    for configs in room.values():
        for config, n in configs.items():
            if n:
                out[config] = out.get(config, 0) + n
    return out


def _tokens(config: tuple) -> int:
    return sum(length * n for length, n in config)


def rounded_plan(counts: np.ndarray, fractional: dict[tuple, float], share: float,
                 filled: float) -> tuple[dict[tuple, int], np.ndarray]:
    """Whole configurations from a share of the program's plan, those that hold ``filled`` tokens
    or more, and the counts that they leave."""
    rounded: dict[tuple, int] = {}
    left = counts.copy()
    capacity = len(counts) - 1
    held = sum(x * _tokens(config) for config, x in fractional.items())
    # the size at which the plan holds as many tokens as the pieces have
    scale = share * float((left * np.arange(capacity + 1)).sum()) / held
    for config, x in sorted(fractional.items(), reverse=True):
        if 2 * config[0][0] < capacity or _tokens(config) < filled:
            continue
        times = min([round(x * scale), *[int(left[length]) // n for length, n in config]])
        if times > 0:
            rounded[config] = times
            for length, n in config:
                left[length] -= n * times
    return rounded, left


def solve(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[dict[tuple, int], dict[tuple, int]]:
    """(configurations from the program, repair of what they leave): together they cover
    exactly the counts."""
    left = counts.astype(np.int64).copy()
    # a full-size piece has one configuration; it needs no program
    whole = {((capacity, 1),): int(left[capacity])} if left[capacity] else {}
    left[capacity] = 0
    if not left.any():
        return whole, {}
    fractional, _ = fractional_plan(left, capacity)
    mean = int(sum(x * _tokens(config) for config, x in fractional.items())
               / sum(fractional.values()))
    fullest = max(map(_tokens, fractional))
    found, fewest = None, 0
    for filled in sorted({mean, fullest}):
        for share in SHARES:
            rounded, rest = rounded_plan(left, fractional, share, filled)
            repair = best_fit_decreasing(rest, capacity)
            n = sum(rounded.values()) + sum(repair.values())
            if found is None or n < fewest:
                found, fewest = (rounded, repair), n
    return {**whole, **found[0]}, found[1]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """(configuration as ((length, items), ...), sequences) covering exactly the counts."""
    planned, repair = solve(counts, capacity)
    for config, n in repair.items():
        planned[config] = planned.get(config, 0) + n
    return sorted(planned.items())


def intervals(planned: list[tuple[tuple, int]], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """length → rows (first rank, items per sequence, first sequence, first offset):
    rank r of the interval that holds it goes to sequence + (r - first) // items at
    offset + ((r - first) % items) * length."""
    rows: dict[int, list] = {}
    ranks = np.zeros(capacity + 1, dtype=np.int64)
    sequence = 0
    for config, n in planned:
        offset = 0
        for length, items in config:
            rows.setdefault(length, []).append((ranks[length], items, sequence, offset))
            ranks[length] += n * items
            offset += length * items
        sequence += n
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def _assign(table: dict[int, np.ndarray]) -> Callable:
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.empty(len(length), dtype=np.int64)
            offset = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                rows = table[int(value)]
                first, items, base, start = rows[
                    np.searchsorted(rows[:, 0], rank[at], side="right") - 1].T
                sequence[at] = base + (rank[at] - first) // items
                offset[at] = start + (rank[at] - first) % items * value
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = save(rows.mapInArrow(_tokenise(path or tokenizer_path(), capacity), _PIECES),
                  "pieces")
    counted = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counted = save(counted, "lengths")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    # at most ``capacity`` rows
    for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    bases = save(counted.select("part", "length",
                                (F.sum("n").over(before) - F.col("n")).alias("base")), "bases")
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(
        _assign(intervals(plan(counts, capacity), capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
        "offset long")
