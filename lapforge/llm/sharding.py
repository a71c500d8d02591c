"""Sharding by a permutation-filled lookup table.

Each shard owns a preference order of the slots of a table of prime size: an
offset and a step, both hashed from its name, visit every slot once. Shards take
turns (as many turns a round as their weight) and claim the next free slot of
their order until the table is full. A key goes to the shard in slot ``hash mod
size``: one broadcast lookup, whatever the number of shards, and removing a shard
leaves nearly all other keys where they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 65_537
MOST_SLOTS = 1 << 20


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=salt.encode()).digest(), "little")


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], size: int = SIZE, weights: dict[str, int] | None = None) -> list[int]:
    """Slot -> position in ``shards``. The size is prime, at most ``MOST_SLOTS``, not under the number of shards."""
    if not shards or len(set(shards)) != len(shards) or not _prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError("shards must be distinct, and the size a prime between their number and 2**20")
    step = [_hash(s, "step") % (size - 1) + 1 for s in shards]
    at = [_hash(s, "offset") % size for s in shards]
    turns = [(weights or {}).get(s, 1) for s in shards]
    if min(turns) < 0 or max(turns) < 1:
        raise ValueError("weights must not be negative, and one must be positive")
    slots, left = [-1] * size, size
    while left:
        for k, n in enumerate(turns):
            for _ in range(min(n, left)):
                while slots[at[k]] >= 0:
                    at[k] = (at[k] + step[k]) % size
                slots[at[k]] = k
                left -= 1
    return slots


def place(df: DataFrame, key: str, shards: list[str], size: int = SIZE, weights: dict[str, int] | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` to each row.

    Placement depends on the key alone, so repeated rows and ties go together; a
    null key is placed as the empty text. The lookup table has ``size`` rows, at
    most 2**20, and is therefore broadcast; rows of ``df`` are not shuffled.
    """
    rows = [(i, shards[k]) for i, k in enumerate(fill(shards, size, weights))]
    slots = df.sparkSession.createDataFrame(rows, "slot int, shard string")
    slot = F.pmod(F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), F.lit(size)).cast("int")
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")])
    return kept.withColumn("slot", slot).join(F.broadcast(slots), "slot").select(*kept.columns, "slot", "shard")


def write(placed: DataFrame, path: str, files_per_shard: int = 16) -> None:
    """One folder a shard; each shard is dealt over several tasks, so that a heavy one isn't a single file."""
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns if c not in ("slot", "shard")]), F.lit(files_per_shard))
    placed.repartition("shard", part).write.partitionBy("shard").mode("overwrite").parquet(path)
