"""Shard placement by a permutation-filled lookup table.

Each shard has its own preference order over the slots of a prime-sized
table (an offset and a skip taken from hashes of its name). Shards take turns
claiming their next free slot until the table is full, so every shard owns
its fair number of slots and adding or removing a shard moves few keys. The
table's size is a parameter, not a function of the data: it is built on the
driver and broadcast, and a row is placed by one hash and one lookup.

The placement itself uses DataFrame functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537  # prime; at least 100 slots a shard for up to 655 shards


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _preference(name: str, size: int) -> tuple[int, int]:
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def fill_table(shards: dict[str, int] | list[str], size: int = TABLE_SIZE) -> list[str]:
    """Owner of each slot.

    ``shards``: names, or names with integer weights (claims per turn). Turns
    go in name order, so the order in which shards are listed is irrelevant.
    Raises ``ValueError`` if there is no shard, a weight is below 1, the size
    is not prime, or there are fewer slots than claims in one turn.
    """
    weights = dict(shards) if isinstance(shards, dict) else {name: 1 for name in shards}
    if not weights or min(weights.values()) < 1:
        raise ValueError("at least one shard, each of weight 1 or more, is needed")
    if not _is_prime(size) or size < sum(weights.values()):
        raise ValueError("the table size must be a prime no smaller than the claims of one turn")
    names = sorted(weights)
    walk = {n: list(_preference(n, size)) for n in names}
    owner: list[str | None] = [None] * size
    free = size
    while True:
        for name in names:
            at, skip = walk[name]
            for _ in range(weights[name]):
                while owner[at] is not None:
                    at = (at + skip) % size
                owner[at] = name
                free -= 1
                if not free:
                    return owner
            walk[name][0] = at


def place(df: DataFrame, shards: dict[str, int] | list[str], key: str = "doc_id", fallback: str | None = "text",
          size: int = TABLE_SIZE) -> DataFrame:
    """Adds ``slot`` (int) and ``shard`` (string) to every row.

    The slot is a hash of the key as text. A null key is placed by its
    ``fallback`` column instead (so many null keys still spread), or by the
    empty string if that is null too. Equal keys share a slot; an empty table
    stays empty; columns already named ``slot`` or ``shard`` are replaced.
    """
    spark = df.sparkSession
    owners = fill_table(shards, size)
    lookup = spark.createDataFrame(list(enumerate(owners)), "slot int, shard string")
    keys = [F.col(key).cast("string")] + ([F.col(fallback).cast("string")] if fallback else []) + [F.lit("")]
    placed = df.drop("slot", "shard").withColumn("slot", F.pmod(F.xxhash64(F.coalesce(*keys)), F.lit(size)).cast("int"))
    # bounded: ``size`` rows whatever the data
    return placed.join(F.broadcast(lookup), "slot", "left").select(*[c for c in placed.columns if c != "slot"],
                                                                   "slot", "shard")


def write_shards(df: DataFrame, path: str) -> None:
    """Placed rows as Parquet, one folder a shard; a shard's rows may spread
    over several writers (a rebalance splits large ones)."""
    df.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
