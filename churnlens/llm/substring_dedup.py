"""Operator 1 — substring deduplication by content-defined chunking.

A gear rolling hash runs over the UTF-8 bytes; a chunk ends after a space or line
break where the hash falls below a bound (about one in ``WORDS_PER_CHUNK``). Beyond the
first ``BYTES_PER_WORD`` bytes of a word it may end at any character, about one in
``BYTES_PER_CUT`` bytes, so texts without spaces are cut too. The hash sees only the last
16 bytes and there is no minimum or maximum length: a cut depends on nothing but the bytes
just before it, so chunks line up again right after an insertion.

What is compared are passages: from each chunk on, and back from each chunk, the fewest
neighbouring chunks that hold ``MIN_WORDS`` words, where a word (or what a cut leaves of it
in a chunk) counts once more for each further ``BYTES_PER_WORD`` bytes: about 640 bytes without
a space are 20 words. A passage gets a 64-bit digest of
its chunks' digests. A digest found in more than one document is a repeat; so is a
second occurrence inside a document that does not overlap the first one. The copy in
the document with the smallest doc_id (there the first one) is the original. In all
other places the chunks of repeated passages are removed. Any repeat of whole chunks
with ``MIN_WORDS`` words is covered by its passages from both ends, and every chunk
that goes stands in a passage of that size that is repeated as a whole: chance repeats
of shorter pieces (common lines, stock phrases), even side by side, stay.

Scale: a document yields each of its digests once (at most two a chunk); smallest and
largest document per digest are pre-aggregated before the shuffle; repeats return to
their documents by an equi-join AQE can split, then by document id — a document
never receives more than its own digests. A passage shared by a third of all
documents costs a few rows per document. Texts are shuffled once, to meet their
own repeats. Nothing goes through the driver.

Cases: NULL and empty texts have no chunks and stay as they are; a text without
repeats is returned unchanged, byte by byte; equal doc_ids count as one document
when originals are chosen (each row is then cut on its own); a NULL doc_id never
holds an original but its repeats are removed; an empty table gives an empty
result; extra columns are ignored by ``repeats`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import save

WORDS_PER_CHUNK = 5
MIN_WORDS = 20
_WINDOW = 16
#: A word of so many bytes or more counts as several and can be cut.
BYTES_PER_WORD = 32
#: There, about one cut in so many bytes.
BYTES_PER_CUT = 128

#: Gear table: one 16-bit value per byte, from a hash of the byte.
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 7) & 0xFFFF for i in range(256)],
                 dtype=np.uint16)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i-1] << 1) + gear[byte i] mod 2^16, for all i.

    A byte's value has left the 16-bit hash after 16 shifts, so h[i] is the sum of
    the last 16 table values, each shifted by its distance; sums of doubled
    spans give it in four vector steps."""
    h = _GEAR[data]
    span = 1
    while span < _WINDOW:
        older = np.zeros_like(h)
        older[span:] = h[:-span]
        h = h + (older << np.uint16(span))
        span *= 2
    return h


def cut_points(data: bytes, words_per_chunk: int = WORDS_PER_CHUNK) -> np.ndarray:
    """Ends (exclusive) of the chunks, the last one being len(data)."""
    if not data:
        return np.empty(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    h = gear_hash(raw)
    after = np.empty(len(raw), dtype=np.uint8)      # the byte that would start a chunk
    after[:-1], after[-1] = raw[1:], 0
    boundary = (after & 0xC0) != 0x80
    at = np.arange(len(raw))
    in_word = at - np.maximum.accumulate(np.where(_SPACE[raw], at, -1))     # bytes since a space
    # a cut after the last of several spaces, so a chunk starts with a word
    word_end = _SPACE[raw] & ~_SPACE[after]
    cut = (word_end & (h < np.uint16(2 ** 16 // words_per_chunk))) | (
        boundary & (in_word >= BYTES_PER_WORD) & (h < np.uint16(2 ** 16 // BYTES_PER_CUT)))
    cut[-1] = True
    return np.flatnonzero(cut) + 1


def _passages(data: bytes, ends: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """(first, last) chunk of the passages: for each chunk the shortest one of at least
    ``min_words`` words that starts with it and the shortest one that ends with it."""
    if not len(ends):
        return []
    raw = np.frombuffer(data, dtype=np.uint8)
    text = ~_SPACE[raw]
    starts = np.concatenate([[0], ends[:-1]])
    first_byte = text.copy()                         # of a word or of its rest in a chunk
    first_byte[1:] &= ~text[:-1]
    first_byte[starts] = text[starts]
    at = np.arange(len(raw))
    offset = at - np.maximum.accumulate(np.where(first_byte, at, 0))
    counted = np.concatenate([[0], np.cumsum(text & (offset % BYTES_PER_WORD == 0))])
    before, until = counted[starts], counted[ends]   # words before and up to each chunk
    n = np.arange(len(ends))
    last = np.searchsorted(until, before + min_words)
    first = np.searchsorted(before, until - min_words, side="right") - 1
    return sorted({*((i, j) for i, j in zip(n.tolist(), last.tolist(), strict=True) if j < len(n)),
                   *((i, j) for i, j in zip(first.tolist(), n.tolist(), strict=True) if i >= 0)})


def _digested(text: str | None, min_words: int) -> tuple[bytes, list[int], list, list[int]]:
    """The text's bytes, the chunks' ends, the passages and their digests. White space
    around a chunk is no part of its digest, so a passage matches at the end of a line too."""
    data = (text or "").encode("utf-8", "surrogatepass")
    cuts = cut_points(data)
    spans, ends = _passages(data, cuts, min_words), cuts.tolist()
    if not spans:
        return data, ends, [], []
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(data[a:b].strip()) for a, b in zip([0, *ends[:-1]], ends, strict=True)],
                   dtype=np.uint64).tobytes()
    return data, ends, spans, [digest(own[8 * i:8 * j + 8]) for i, j in spans]


def chunks(text: str | None, min_words: int = MIN_WORDS) -> tuple[bytes, list[int], list[int]]:
    """The text's bytes, the chunks' ends and the digests of its passages."""
    data, ends, _, digests = _digested(text, min_words)
    return data, ends, digests


def _digests(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seen = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                    strict=True):
                if doc_id is not None:
                    own = list(set(chunks(text.as_py(), min_words)[2]))
                    ids.append(np.full(len(own), doc_id, dtype=np.int64))
                    seen.append(np.array(own, dtype=np.uint64).view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(np.concatenate(seen))],
                    names=["doc_id", "h"])
    return run


def _words(data: bytes) -> int:
    return len(data.split())


def cut_runs(text: str | None, repeated: dict[int, int], min_words: int) -> tuple[str, list]:
    """The text without repeated passages, and (start, length, words, original) of
    what went, in characters. ``repeated``: digest → doc_id of the original, for
    digests whose original is another document; later occurrences inside the text
    are found here."""
    if text is None:
        return None, []
    data, ends, spans, digests = _digested(text, min_words)
    kept, gone, seen = [], [], {}
    covered, of = -1, {}                # last chunk known to go; chunk → original
    for (i, j), digest in zip(spans, digests, strict=True):
        if digest not in repeated and seen.setdefault(digest, j) >= i:
            continue
        for k in range(max(i, covered + 1), j + 1):
            of[k] = repeated.get(digest)
        covered = max(covered, j)
    if not of:
        return text, []
    chars = at = 0                      # characters and bytes before
    run = None
    for k, end in enumerate([*ends, None]):
        if k in of:
            run = (at, of[k]) if run is None else run
        elif run is not None:
            part = data[run[0]:at]
            length = len(part.decode("utf-8", "surrogatepass"))
            gone.append((chars, length, _words(part), run[1]))
            chars, run = chars + length, None
        if run is None and end is not None:
            kept.append(data[at:end])
            chars += len(kept[-1].decode("utf-8", "surrogatepass"))
        at = end
    return b"".join(kept).decode("utf-8", "surrogatepass"), gone


SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("words", pa.int64()),
                  ("original", pa.int64())])
SPANS = "array<struct<start:long,length:long,words:long,original:long>>"


def _rebuild(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, known in zip(batch.column("_t"), batch.column("_r"), strict=True):
                repeated = {r["h"] & (2 ** 64 - 1): r["first"] for r in known.as_py() or ()}
                new, gone = cut_runs(text.as_py(), repeated, min_words)
                texts.append(new)
                spans.append([dict(zip(("start", "length", "words", "original"), g, strict=True))
                              for g in gone])
            rest = [n for n in batch.schema.names if n not in ("_t", "_r")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in rest], pa.array(texts, pa.string()),
                 pa.array(spans, pa.list_(SPAN))], names=[*rest, "_new", "_spans"])
    return run


def _deduplicated(docs: DataFrame, min_words: int) -> DataFrame:
    """The other columns of ``docs`` as c0, c1, ..., then _new and _spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_digests(min_words), "doc_id long, h long")
    firsts = save(found.groupBy("h").agg(F.min("doc_id").alias("first"),
                                         F.max("doc_id").alias("last"))
                  .where("first != last").select("h", "first"), "repeats")
    # a set: rows that repeat an id bring the same digests
    own = found.join(firsts, "h").where("doc_id != first").groupBy("doc_id").agg(
        F.collect_set(F.struct("h", "first")).alias("_r"))
    others = [c for c in docs.columns if c != "text"]
    keep = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
                       F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_t"))
    joined = keep.join(own, F.col("_id") == F.col("doc_id"), "left").drop("_id", "doc_id")
    fields = [f"c{i} {keep.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(others))]
    return joined.mapInArrow(_rebuild(min_words),
                             ", ".join([*fields, "_new string", f"_spans {SPANS}"]))


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, text without repeats, changed, n_removed_words,
    and the removed spans with the document that keeps the original (NULL: the same
    document, earlier)."""
    out = _deduplicated(docs.select("doc_id", "text"), min_words)
    words = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    return out.select(F.col("c0").alias("doc_id"), F.col("_new").alias("text"),
                      (F.size("_spans") > 0).alias("changed"), words.alias("n_removed_words"),
                      F.col("_spans").alias("removed"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with the same columns and the text without repeats."""
    out = _deduplicated(docs, min_words)
    place = {c: f"c{i}" for i, c in enumerate(c for c in docs.columns if c != "text")}
    return out.select(*[F.col("_new" if c == "text" else place[c]).alias(c)
                        for c in docs.columns])
