"""Operator 8 — sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table (an
offset and a step from two hashes of its name, which visits every slot once as
the size is prime). Shards take turns claiming the next free slot they prefer
until the table is full, so shares differ by at most one slot (times the
weight), and adding or removing a shard moves little beyond its own share.
Placement is one hash of the key modulo the table size and one lookup.

The table has a fixed, configured size (65,537 slots by default) whatever the
data, so it is broadcast; documents are never shuffled by ``place``. All work on
rows is DataFrame functions. The claim order is inherently sequential and runs
once on the driver over the fixed table.

Cases: a NULL key is placed like the text ``<null>`` (a defined shard); repeated
rows and ties go to the same shard; an empty table gives an empty result; clashing
column names get a leading underscore; no shards or a size that is not a prime
above the number of shards raises ValueError.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import fresh

TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _hash(text: str, seed: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{text}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot → index into ``shards``."""
    names = list(shards)
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be unique and not empty")
    if not _is_prime(size) or size <= len(names):
        raise ValueError("the table size must be a prime above the number of shards")
    offset = [_hash(s, "offset") % size for s in names]
    step = [_hash(s, "step") % (size - 1) + 1 for s in names]
    # turns follow the names' own hashes, so the order of the list does not matter
    turns = sorted(range(len(names)), key=lambda i: (_hash(names[i], "turn"), names[i]))
    table, asked, free = [-1] * size, [0] * len(names), size
    while free:
        for i in turns:
            while True:
                slot = (offset[i] + asked[i] * step[i]) % size
                asked[i] += 1
                if table[slot] < 0:
                    break
            table[slot] = i
            free -= 1
            if not free:
                break
    return table


def place(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS,
          size: int = TABLE_SIZE) -> DataFrame:
    """``df`` plus ``slot`` (long) and ``shard`` (name)."""
    slot, shard, at = fresh(df, "slot", "shard", "at")
    names = F.array(*[F.lit(s) for s in shards])
    table = df.sparkSession.range(1).select(
        F.posexplode(F.from_json(F.lit(json.dumps(lookup_table(shards, size))), "array<int>"))
        .alias(at, shard))
    table = table.select(F.col(at).cast("long").alias(at),
                         F.element_at(names, F.col(shard) + 1).alias(shard))
    hashed = F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("<null>")))
    # size rows by construction: a proven bound for the broadcast
    return (df.withColumn(slot, F.pmod(hashed, F.lit(size)))
            .join(F.broadcast(table), F.col(slot) == F.col(at), "left").drop(at))


def write_shards(df: DataFrame, path: str, key: str = "doc_id",
                 shards: Sequence[str] = SHARDS, files_per_shard: int = 8) -> None:
    """Write one folder per shard. Rows of a shard are dealt over several files by
    a hash of the key and the text length, so no task receives a whole shard."""
    placed = place(df, key, shards)
    shard = placed.columns[-1]
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_shard))
    placed.repartition(len(shards) * files_per_shard, F.col(shard), deal) \
        .write.partitionBy(shard).mode("overwrite").parquet(path)
