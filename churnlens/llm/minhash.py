"""Operator 10 — MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts gives each document its shingle count, a 128-bit digest
   of its shingle set and the hashes of the bands of its MinHash signature; bands and
   rows follow from the threshold (32 x 8 at 0.85, 48 x 7 at 0.80, see ``band_plan``).
   Documents with equal sets form a class; only class representatives (smallest
   doc_id) go on, so thousands of copies cost one row.
2. Representatives that share a band value meet in a bucket. Buckets are joined
   to groups over their smallest member (linear in the bucket size, no pairs).
3. Texts of groups with two or more representatives are brought together in work
   units. A group of up to ``BLOCK`` members is one unit. A larger one is dealt to
   blocks by a hash and each pair of blocks is a unit; where the buckets of the
   group are small against the group (chains of chance meetings), its buckets are
   dealt that way one by one instead — whichever copies fewer rows. Both compare
   every pair that shares a bucket, and no unit grows with the group.
4. In a unit, members that agree in a band are candidates. Their signatures are
   compared batch by batch; a candidate is dropped as soon as the posterior
   probability (uniform prior) of a similarity at or above the threshold falls
   below ``MISS``. Survivors are verified exactly on their full shingle sets,
   best agreement first, skipping pairs that verified links already connect. So
   a unit emits at most one link per member, not all its pairs.
5. Connected components over classes and links give the smallest reachable doc_id.

The only approximation is the chance that a pair at the threshold shares no band
(``NO_BAND`` at most, far less above it) or is dropped by the posterior rule (``MISS`` a
batch). Links are never wrong: they are confirmed on full sets.

Cases: NULL or word-less text has no shingles and links with nothing; texts under
five words are one shingle; rows that share a doc_id count as one node, so different texts of one id
are linked, each compared once however often it repeats (a row without shingles stays alone;
``keep_one`` leaves one of the rows with equal texts); a NULL doc_id has component NULL and is kept; exact ties of similarity need no rule as
links are unordered; an empty table gives an empty result; extra columns are
ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import save
from churnlens.llm.components import components

SHINGLE = 5
THRESHOLD_PCT = 85
BANDS, MOST_BANDS, ROWS = 32, 48, 8
BATCH = 32
MISS = 1e-6
NO_BAND = 4e-5
BLOCK = 256

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_K = MOST_BANDS * ROWS


def _odd_constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers from a hash of their number."""
    return np.array([xxhash.xxh3_64_intdigest(i.to_bytes(8, "little"), seed) | 1
                     for i in range(n)], dtype=np.uint64)


_MUL, _ADD = _odd_constants(_K, 1), _odd_constants(_K, 2)
_POS = _odd_constants(SHINGLE, 3)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    n = max(len(words) - SHINGLE + 1, 1)
    width = min(len(words), SHINGLE)
    out = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        out += _mix(h[j:j + n] * _POS[j])
    return np.unique(_mix(out))


def band_plan(pct: int) -> tuple[int, int]:
    """(bands, rows): the most rows of a band, so that few pairs below the threshold meet by chance,
    for which ``BANDS`` to ``MOST_BANDS`` bands suffice: a pair at the threshold shares no
    band with a chance of at most ``NO_BAND``."""
    for rows in range(ROWS, 0, -1):
        for bands in range(BANDS, MOST_BANDS + 1, 16):
            if (1 - (pct / 100) ** rows) ** bands <= NO_BAND:
                return bands, rows
    raise ValueError(f"{MOST_BANDS} bands are too few for a threshold of {pct} %")


def signature(hashes: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """MinHash signature (uint32) of a non-empty set, in slices of bounded memory."""
    best = np.full(k, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i:i + 4096, None] * _MUL[None, :k] + _ADD[None, :k]
        np.minimum(best, part.min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> list[int]:
    rows = len(sig) // bands
    return [xxhash.xxh3_64_intdigest(sig[b * rows:(b + 1) * rows].tobytes(), b + 1) - 2 ** 63
            for b in range(bands)]


def least_matches(threshold: float, miss: float = MISS, hashes: int = BANDS * ROWS,
                  batch: int = BATCH) -> list[int]:
    """After n = batch, 2 batch, ... compared hashes: the fewest matches for which
    P(similarity >= threshold | matches), under a uniform prior, is at least ``miss``.

    The posterior is Beta(m + 1, n - m + 1), whose upper tail at t equals
    P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, keys = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py())
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(signature(s, bands * rows), bands) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"])
    return run


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _candidates(sigs: np.ndarray, side: np.ndarray, least: list[int], n_bands: int) -> np.ndarray:
    """Pairs (i, j, matches) that share a band and pass every batch; with two
    sides, only pairs across them (a block against another one)."""
    n = len(sigs)
    bands = sigs.reshape(n, n_bands, -1)
    keep = []
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        if side.any() and not side.all():
            j = j[side[j] != side[i]]
        if not len(j):
            continue
        j = j[(bands[j] == bands[i]).all(axis=2).any(axis=1)]
        seen = np.zeros(len(j), dtype=np.int64)
        for b, need in enumerate(least):
            at = slice(b * BATCH, (b + 1) * BATCH)
            seen = seen + (sigs[j, at] == sigs[i, at]).sum(axis=1)
            j, seen = j[seen >= need], seen[seen >= need]
        keep += [(i, int(x), int(m)) for x, m in zip(j, seen, strict=True)]
    return keep


def linked(a: np.ndarray, b: np.ndarray, pct: int = THRESHOLD_PCT) -> bool:
    """100 * |intersection| >= pct * |union| on sorted distinct hashes."""
    if not len(a) or not len(b):
        return False
    if 100 * min(len(a), len(b)) < pct * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= pct * (len(a) + len(b) - common)


def _unit_links(ids: list, texts: list, sides: np.ndarray, pct: int) -> list[tuple]:
    sets = [shingle_set(t) for t in texts]
    full = [i for i, s in enumerate(sets) if len(s)]
    if len(full) < 2:
        return []
    bands, rows = band_plan(pct)
    k = bands * rows
    sigs = np.stack([signature(sets[i], k) for i in full])
    found, union = [], _Union(len(full))
    pairs = _candidates(sigs, sides[full], least_matches(pct / 100, hashes=k), bands)
    for i, j, _ in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if union.root(i) != union.root(j) and linked(sets[full[i]], sets[full[j]], pct):
            union.join(i, j)
            found.append((ids[full[i]], ids[full[j]]))
    return found


def _verify(pct: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def close(rows):
            rows = list({(r[1], r[3]): r for r in rows}.values())   # repeated rows
            out = _unit_links([r[1] for r in rows], [r[3] for r in rows],
                              np.array([r[2] for r in rows], dtype=bool), pct)
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

        unit, held = None, []
        for pdf in batches:
            for row in pdf[["unit", "doc_id", "side", "text"]].itertuples(index=False, name=None):
                if row[0] != unit:
                    if len(held) > 1:
                        yield close(held)
                    unit, held = row[0], []
                held.append(row)
        if len(held) > 1:
            yield close(held)
    return run


def _dealt(members: DataFrame, key: str, size: str) -> DataFrame:
    """(unit, doc_id, side): members of each key in blocks, one unit a pair of blocks."""
    blocks = F.ceil(F.col(size) / F.lit(BLOCK // 2)).cast("int")
    dealt = members.select(
        F.col(key).alias("key"), "doc_id", blocks.alias("blocks"),
        F.pmod(F.xxhash64("doc_id", key), blocks).cast("int").alias("block"))
    pairs = dealt.select("key", "doc_id", "block", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return pairs.select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        "doc_id", F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"))


def _units(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(unit, doc_id, side) of everything that must be compared.

    ``shared``: (band, doc_id, n) of the buckets with n > 1 members; ``groups``:
    (v, component) of their members."""
    named = groups.select(F.col("v").alias("doc_id"), F.col("component").alias("group"))
    sizes = save(named.groupBy("group").agg(F.count("*").alias("size")), "sizes")
    big = named.join(sizes.where(F.col("size") > BLOCK), "group")
    large = shared.join(big, "doc_id")
    # a bucket of n members counts n for each of them: n * n in all
    by_bucket = save(large.groupBy("group", "size").agg(F.sum("n").alias("cost")).select(
        "group", (F.col("cost") < F.col("size") * F.col("size")).alias("by_bucket")), "schemes")
    small = named.join(sizes.where(F.col("size") <= BLOCK), "group").select(
        F.xxhash64("group").alias("unit"), "doc_id", F.lit(0).alias("side"))
    whole = big.join(by_bucket.where("not by_bucket"), "group")
    single = large.join(by_bucket.where("by_bucket"), "group")
    return small.unionByName(_dealt(whole, "group", "size")).unionByName(
        _dealt(single, "band", "n"))


def near_duplicates(docs: DataFrame, pct: int = THRESHOLD_PCT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept — one row per input row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = save(rows.mapInArrow(
        _signatures(*band_plan(pct)), "doc_id long, n_shingles long, digest binary, bands array<long>"), "signed")
    classes = save(signed.where("digest is not null and doc_id is not null").groupBy("digest")
                   .agg(F.min("doc_id").alias("rep")), "classes")
    reps = signed.join(classes, (signed.doc_id == classes.rep) &
                       (signed.digest == classes.digest)).select("doc_id", "bands")
    keyed = save(reps.select("doc_id", F.explode("bands").alias("band")).distinct(), "bands")
    hubs = keyed.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")) \
        .where("n > 1")
    shared = save(keyed.join(hubs, "band"), "shared")
    groups = components(shared, "hub", "doc_id")
    units = _units(shared.select("band", "doc_id", "n"), groups)
    # an id that repeats brings each of its texts once, and links the classes of its texts
    again = save(signed.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("n > 1"), "again")
    texts, shared_ids = rows, None
    if not again.isEmpty():
        repeated = again.select("doc_id")
        texts = rows.join(repeated, "doc_id", "left_anti").unionByName(
            rows.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
        own = save(signed.join(again.where("low != high").select("doc_id"), "doc_id", "left_semi")
                   .join(classes, "digest").select("doc_id", "rep").distinct(), "own")
        shared_ids = own.join(own.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id") \
            .select("a", F.col("rep").alias("b"))
    work = save(units, "units").join(texts, "doc_id").select("unit", "side", "doc_id", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = work.repartitionByRange(n, "unit").sortWithinPartitions("unit") \
        .mapInPandas(_verify(pct), "a long, b long")
    if shared_ids is not None:
        links = links.unionByName(shared_ids)
    ends = components(links, "a", "b")
    named = classes.join(ends, classes.rep == ends.v, "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    out = signed.join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, pct: int = THRESHOLD_PCT) -> DataFrame:
    """The documents, with all columns, without those that have a smaller doc_id in
    their component; of rows with equal doc_id and text any one."""
    gone = near_duplicates(docs, pct).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
    again = save(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_again"))
                 .agg(F.count("*").alias("n")).where("n > 1").select("_again"), "again")
    if again.isEmpty():
        return kept
    # texts are only grouped where an id repeats; equal rows combine before the shuffle
    same = kept["doc_id"] == F.col("_again")
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
