"""Operator 5 — SentencePiece encoding and decoding over a relational lattice.

The model file gives pieces and scores (read once on the driver: a fixed
vocabulary). A text gets a leading space mark and its spaces become marks, as the
model's identity normaliser does; then it is cut into words: runs of letters (and marks on them, up to
U+FFFF) with the space marks before them, other runs, line breaks. No piece of the model spans such a
cut (checked when the model is read), so words can be encoded on their own.

1. The ``COMMON_WORDS`` most frequent words of a bounded part of the documents go through the
   lattice first. They are only told beforehand: what is common stays out of the shuffles, and a
   word that is not among them takes the way below.
2. Every text is cut once and goes to its hash block (of bounded text size) as numbers of words, with the
   words that are not common beside them, packed and compressed. That shuffle is read twice: here for
   the words, grouped by word with the blocks that hold them, and in step 5 for the texts.
3. Lattice: every word explodes into its substrings of at most the longest piece
   (starts, then sizes, so both explodes and the join run as generated code);
   an equi-join with the piece table (broadcast: a fixed vocabulary of checked
   size) keeps the edges. A character without a piece is an edge of its UTF-8
   bytes with the unknown score.
4. Edges are grouped by word — the partitioning of the distinct words, no further
   shuffle — and folded by end position into the best path (highest sum of scores; ties go to the
   longer last piece), one end after another for all words of a batch.
5. Texts and the words they hold meet by block; the words of a part are looked up once, then numbers
   become ids in flat integer arrays.

The result is the best-scoring segmentation (Viterbi). The vocabulary file at hand
was made for merge-order encoding, whose segmentation can differ; ids, byte
fallback and decoding are the same, and decode(encode(text)) is the text.

Cases: NULL text gives NULL ids, an empty text no ids; a word over ``MAX_WORD``
characters is cut every ``MAX_WORD`` characters and encoded in parts; repeated rows
and NULL ids of documents are encoded like any other; an empty table gives an empty
result; extra columns are ignored. Decoding skips ids outside the vocabulary.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count, groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import save

MARK = "▁"
MAX_WORD = 2_000
MAX_PIECES = 1_000_000
NO_PIECE = -1
#: Common words, or else characters of text, for each partition of the lattice.
PARTITION_WORDS = 12_500
PARTITION_CHARS = 10_000_000
#: Characters of text in a block; a block's texts, words and ids are held by one Python worker.
BLOCK_CHARS = 16_000_000
#: Words encoded beforehand and held by every Python worker, and the characters of text they are
#: counted in, about.
COMMON_WORDS = 100_000
COUNTED_CHARS = 20_000_000
#: Rows a task works on at once.
HELD_ROWS = 1_000
#: Words (step 2) or bytes of rows a task holds before it passes them on.
HELD_WORDS = 300_000
HELD_BYTES = 32_000_000


def _letters() -> str:
    """Letters and marks up to U+FFFF, as ranges of a character class: ``re`` looks them up in a table."""
    runs = groupby(range(0x10000), key=lambda c: unicodedata.category(chr(c))[0] in "LM")
    held = [list(run) for letter, run in runs if letter]
    return "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in held)


LETTERS = _letters()
WORD = rf"\n|{MARK}*[{LETTERS}]+|{MARK}*[^{MARK}\n{LETTERS}]+|{MARK}+"


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, int, float], ...]      # piece, id, score
    byte_ids: tuple[int, ...]                       # id of each byte's piece
    unknown_score: float
    longest: int


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    if size > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    byte_ids: dict[int, int] = {}
    pieces = []
    word = re.compile(WORD)
    for i in range(size):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            if not word.fullmatch(piece):
                # it could never be reached from words cut this way
                if len(piece) > 1 and len(word.findall(piece)) > 1:
                    raise ValueError(f"piece {piece!r} spans a word cut")
            pieces.append((piece, i, float(sp.get_score(i))))
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte fallback")
    return Vocabulary(tuple(pieces), tuple(byte_ids[b] for b in range(256)),
                      min(s for _, _, s in pieces) - 10.0, max(len(p) for p, _, _ in pieces))


def _piece_table(spark: SparkSession, v: Vocabulary) -> DataFrame:
    return spark.createDataFrame(pd.DataFrame(v.pieces, columns=["piece", "id", "score"])
                                 .astype({"id": "int32"}), "piece string, id int, score double")


def cut_words(text: str | None, word) -> list[str]:
    """The words of a text: a mark in front, marks for spaces, ``MAX_WORD`` characters at most."""
    words = word.findall(MARK + text.replace(" ", MARK)) if text else []
    if words and max(map(len, words)) > MAX_WORD:
        words = [w[k:k + MAX_WORD] for w in words for k in range(0, len(w), MAX_WORD)]
    return words


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _count_words(pattern: str):
    """(word, n) of (text), once per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        word = re.compile(pattern)
        for batch in batches:
            n: Counter[str] = Counter()
            for text in batch.column("text"):
                n.update(cut_words(text.as_py(), word))
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()),
                                              pa.array(n.values(), pa.int64())], names=["word", "n"])
    return run


def _write(rows: pa.RecordBatch | pa.Table, level: int) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as w:
        w.write(rows)
    return sink.getvalue().to_pybytes()


def _packed_part(doc_ids: np.ndarray, sizes: pa.Array, numbers: np.ndarray, words: pa.Array) -> bytes:
    """One part of a block: documents, words in each (NULL text: NULL), numbers of the words by bytes of
    equal rank (they compress better) and the words of the numbers after the common ones."""
    ranks = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    lists = {"doc_id": doc_ids, "size": sizes, "word": words}
    return _write(pa.RecordBatch.from_arrays(
        [*[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists.values()],
         *[pa.array([r.tobytes()], pa.binary()) for r in ranks]],
        names=[*lists, *[f"byte{k}" for k in range(4)]]), 3)


def _cut_texts(pattern: str, common: list[str]):
    """(block, packed) of (block, doc_id, text): the texts a task holds of a block as numbers of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(pattern)
        number: dict[str, int] = {}
        held: list[pa.RecordBatch] = []

        def fresh_numbers() -> None:
            """A word that has no number yet gets the next one."""
            nonlocal number
            number = defaultdict(count(len(common)).__next__, zip(common, count(), strict=False))

        def out() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            held.clear()
            rare = pa.array(list(islice(number, len(common), None)), pa.string())
            fresh_numbers()
            table = table.take(pc.sort_indices(table.column("block"))).combine_chunks()
            blocks = table.column("block").to_numpy()
            starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
            for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
                part = table.slice(a, b - a).combine_chunks()
                lists = part.column("numbers").chunk(0)
                numbers = lists.flatten().to_numpy()
                own = numbers >= len(common)
                used, place = np.unique(numbers[own], return_inverse=True)
                # words in order compress better
                order = pc.sort_indices(rare.take(pa.array(used - len(common)))).to_numpy()
                numbers = numbers.copy()
                numbers[own] = np.argsort(order)[place] + len(common)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([blocks[a]], pa.int32()),
                     pa.array([_packed_part(part.column("doc_id").chunk(0), lists.value_lengths(), numbers,
                                            rare.take(pa.array(used[order] - len(common))))], pa.binary())],
                    names=["block", "packed"])

        fresh_numbers()
        for batch in _slices(batches, HELD_ROWS):
            made, ends, null = [], [0], []
            for text in batch.column("text"):
                text = text.as_py()
                words = cut_words(text, word)
                made.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                ends.append(ends[-1] + len(words))
                null.append(text is None)
            held.append(pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("doc_id"), pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(made)),
                    mask=pa.array(null, pa.bool_()))], names=["block", "doc_id", "numbers"]))
            if sum(x.nbytes for x in held) > HELD_BYTES or len(number) - len(common) > HELD_WORDS:
                yield from out()
        if held:
            yield from out()
        pa.default_memory_pool().release_unused()
    return run


def _told_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, block) of the packed parts, once in what a task holds."""
    held: list[pa.Table] = []

    def out() -> Iterator[pa.RecordBatch]:
        told = pa.concat_tables(held).group_by(["word", "block"], use_threads=False).aggregate([])
        held.clear()
        yield from told.select(["word", "block"]).to_batches()

    for batch in batches:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed"), strict=True):
            for part in pa.ipc.open_stream(packed.as_buffer()):
                words = part.column("word").flatten()
                held.append(pa.table({"word": words, "block": pa.array(np.full(len(words), block, np.int32))}))
        if sum(x.num_rows for x in held) > HELD_WORDS:
            yield from out()
    if held:
        yield from out()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, packed) of rows with a column ``block``: the rows a task holds of it, compressed."""
    held: list[pa.RecordBatch] = []

    def out() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        held.clear()
        table = table.take(pc.sort_indices(table.column("block")))
        blocks = table.column("block").to_numpy()
        rows = table.drop_columns(["block"])
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([blocks[a]], pa.int32()),
                 pa.array([_write(rows.slice(a, b - a).combine_chunks(), 6)], pa.binary())],
                names=["block", "packed"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.nbytes for x in held) > HELD_BYTES:
            yield from out()
    if held:
        yield from out()


def _unpack(packed: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
    for part in packed:
        yield from pa.ipc.open_stream(part.as_buffer())


def lattice(words: DataFrame, v: Vocabulary) -> DataFrame:
    """``words`` (distinct in its column ``word``, other columns kept) with the ``edges`` of each."""
    spark = words.sparkSession
    kept = [c for c in words.columns if c != "word"]
    # a number per word: edges are sorted by it where they are grouped, not by the text
    numbered = words.withColumn("_n", F.monotonically_increasing_id())
    starts = numbered.select("*", F.explode(
        F.sequence(F.lit(0), F.length("word") - 1)).alias("s"))
    spans = starts.select("*", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(v.longest), F.length("word") - F.col("s")))).alias("size"))
    edges = spans.select("_n", "word", *kept, "s", (F.col("s") + F.col("size")).alias("e"),
                         F.substring("word", F.col("s") + 1, F.col("size")).alias("piece"))
    # fixed vocabulary, size checked on reading
    edges = edges.join(F.broadcast(_piece_table(spark, v)), "piece", "left") \
        .where("id is not null or e = s + 1")
    edge = F.struct("e", "s", F.coalesce("score", F.lit(v.unknown_score)).alias("score"),
                    F.coalesce("id", F.lit(NO_PIECE)).alias("id"))
    return edges.groupBy("_n", "word").agg(
        *[F.first(c).alias(c) for c in kept], F.collect_list(edge).alias("edges")).drop("_n")


def _best_ids(words: list[str], edges: pa.ListArray, v: Vocabulary) -> pa.ListArray:
    """Ids of the best path of each word: its edges folded by end, all words side by side."""
    of = np.repeat(np.arange(len(words)), edges.value_lengths().to_numpy())
    flat = edges.flatten()
    e, s, score, ids = (flat.field(c).to_numpy() for c in ("e", "s", "score", "id"))
    order = np.lexsort((s, of, e))
    of, e, s, score, ids = of[order], e[order], s[order], score[order], ids[order]

    # state of each position of a word: score of the best path to it, last edge of that path
    length = np.fromiter(map(len, words), np.int64, len(words))
    at = np.cumsum(length + 1) - length - 1
    best, last = np.zeros((length + 1).sum()), np.zeros((length + 1).sum(), np.int64)
    ends = np.flatnonzero(np.r_[True, e[1:] != e[:-1], True])
    for a, b in zip(ends, ends[1:], strict=False):
        word = of[a:b]
        here = best[at[word] + s[a:b]] + score[a:b]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        top = np.maximum.reduceat(here, first)
        hit = np.flatnonzero(here == np.repeat(top, np.diff(np.r_[first, b - a])))
        # of equal ones the first: the longest piece
        hit = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
        best[at[word[first]] + e[a]] = top
        last[at[word[first]] + e[a]] = a + hit

    path, open_, position = [], np.arange(len(words)), length.copy()
    while len(open_):
        edge = last[at[open_] + position[open_]]
        path.append(edge)
        position[open_] = s[edge]
        open_ = open_[s[edge] > 0]
    path = np.concatenate(path)
    path = path[np.argsort(at[of[path]] + s[path])]

    # a character without a piece becomes its bytes
    found, sizes = ids[path], np.ones(len(path), np.int64)
    plain = np.flatnonzero(found == NO_PIECE)
    chars = [words[of[k]][s[k]].encode() for k in path[plain]]
    sizes[plain] = [len(c) for c in chars]
    out = np.repeat(found, sizes)
    out[out == NO_PIECE] = np.array(v.byte_ids, np.int32)[np.frombuffer(b"".join(chars), np.uint8)]
    per_word = np.bincount(of[path], weights=sizes, minlength=len(words)).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_word)], pa.int32()),
                                    pa.array(out, pa.int32()))


def _best_paths(v: Vocabulary):
    """The lattice's rows with ``ids`` for ``edges``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, HELD_ROWS):
            ids = _best_ids(batch.column("word").to_pylist(), batch.column("edges"), v)
            rows = batch.drop_columns(["edges"])
            yield pa.RecordBatch.from_arrays([*rows.columns, ids], names=[*rows.schema.names, "ids"])
    return run


def _packed_paths(v: Vocabulary):
    """(block, packed) of the lattice's rows (word, blocks, edges): words and ids, once per block."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _best_paths(v)(batches):
            blocks = batch.column("blocks")
            told = batch.drop_columns(["blocks"]).take(pc.list_parent_indices(blocks))
            yield pa.RecordBatch.from_arrays([blocks.flatten(), *told.columns],
                                             names=["block", *told.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pack(rows(batches))
        pa.default_memory_pool().release_unused()
    return run


def _encode_block(common: pa.Table):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = list(_unpack(right.column("packed")))
        own = pa.chunked_array([b.column("word") for b in told], pa.string()).combine_chunks()
        lists = [*common.column("ids").chunks, *[b.column("ids") for b in told]]
        flat = np.concatenate([np.zeros(0, np.int32), *[x.flatten().to_numpy() for x in lists]])
        size = np.concatenate([np.zeros(0, np.int32), *[x.value_lengths().to_numpy() for x in lists]])
        begin = (np.cumsum(size) - size).astype(np.int32)
        made = []
        for part in _unpack(left.column("packed")):
            place = pc.index_in(part.column("word").flatten(), value_set=own)
            if place.null_count:
                raise ValueError("a word of the texts has no ids")
            numbers = np.empty((part.column("size").flatten().sum().as_py() or 0, 4), np.uint8)
            for k in range(4):
                numbers[:, k] = np.frombuffer(part.column(f"byte{k}")[0].as_buffer(), np.uint8)
            numbers = np.r_[np.arange(len(common)), place.to_numpy() + len(common)].astype(np.int32)[
                numbers.view("<i4").ravel()]
            n = size[numbers]
            ends = np.r_[0, np.cumsum(n, dtype=np.int64)]
            at = np.repeat((begin[numbers] - ends[:-1]).astype(np.int32), n)
            at += np.arange(len(at), dtype=np.int32)
            words = part.column("size").flatten()
            offsets = ends[np.r_[0, np.cumsum(words.fill_null(0).to_numpy())]]
            made.append(pa.table({"doc_id": part.column("doc_id").flatten(), "ids": pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(flat[at]), mask=words.is_null())}))
        # a worker keeps what its tasks had: give back what is free
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(made)
    return run


def _common_words(rows: DataFrame, chars: int, v: Vocabulary) -> pa.Table:
    """word, ids of the most frequent words in every k-th document, by hash, the most frequent first; at
    most ``COMMON_WORDS``."""
    counted = rows.where(F.pmod(F.xxhash64("doc_id", "text"),
                                F.lit(chars // COUNTED_CHARS + 1)) == 0)
    top = counted.select("text").mapInArrow(_count_words(WORD), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "word").limit(COMMON_WORDS)
    words = save(top, "common")
    encoded = lattice(words.repartition(COMMON_WORDS // PARTITION_WORDS + 1, "word"), v) \
        .mapInArrow(_best_paths(v), "word string, n long, ids array<int>")
    table = encoded.toArrow().sort_by([("n", "descending")])
    return table.select(["word", "ids"]).cast(
        pa.schema({"word": pa.string(), "ids": pa.list_(pa.int32())})).combine_chunks()


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids — one row per input row."""
    v = read_vocabulary(path or model_path())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    common = _common_words(rows, chars, v)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chars // BLOCK_CHARS + 1)) \
        .cast("int").alias("block")
    packed = "block int, packed binary"
    # one exchange for both its readers: the same plan, with the same columns
    cut = rows.select(block, "doc_id", "text").mapInArrow(
        _cut_texts(WORD, common.column("word").to_pylist()), packed).repartition("block")
    told = cut.mapInArrow(_told_words, "word string, block int")
    # word partitions of bounded size: the edges of each are grouped in memory
    words = told.repartition(chars // PARTITION_CHARS + 1, "word").groupBy("word").agg(
        F.collect_set("block").alias("blocks"))
    known = lattice(words, v).mapInArrow(_packed_paths(v), packed)
    return cut.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _encode_block(common), "doc_id long, ids array<int>")


def _decode(bytes_of: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                if ids is None:
                    out.append(None)
                    continue
                text = b"".join(bytes_of.get(i, b"") for i in ids).decode("utf-8", "replace")
                out.append(re.sub("^ ", "", text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())],
                                             names=["doc_id", "text"])
    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of (doc_id, ids)."""
    v = read_vocabulary(path or model_path())
    bytes_of = {i: p.replace(MARK, " ").encode() for p, i, _ in v.pieces}
    bytes_of |= {i: bytes([b]) for b, i in enumerate(v.byte_ids)}
    return encoded.select("doc_id", "ids").mapInArrow(_decode(bytes_of), "doc_id long, text string")
