"""Placement of keys on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: offset, offset + skip,
offset + 2 skip, ... The shards take turns, each claiming the first slot of its order that is still free, until the table
is full. So shards get equal shares (or shares by weight, as turns), and when one goes, few of the others' slots move.
A key's slot is its hash modulo the size; the table is broadcast and the slot looked up.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm.staging import documents

#: Production parameters: a prime about a thousand times the number of shards. The broadcast has SLOTS rows whatever the data.
SLOTS = 65_537
SHARDS = tuple(f"shard-{k:02d}" for k in range(64))


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and skip of a shard's order over the slots."""
    digest = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill_table(shards: tuple[str, ...], slots: int, weights: dict[str, int] | None = None) -> list[int]:
    """The shard, by number, of every slot. ``weights`` are turns per round, 1 where not given."""
    if not is_prime(slots):
        raise ValueError(f"{slots} is not a prime")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("one shard or more is needed, no name twice, and a slot for each")
    orders = [preference(name, slots) for name in shards]
    turns = [max(1, (weights or {}).get(name, 1)) for name in shards]
    tried = [0] * len(shards)
    table = [-1] * slots
    free = slots
    while True:
        for k, (offset, skip) in enumerate(orders):
            for _ in range(turns[k]):
                slot = (offset + tried[k] * skip) % slots
                while table[slot] >= 0:
                    tried[k] += 1
                    slot = (offset + tried[k] * skip) % slots
                table[slot] = k
                tried[k] += 1
                free -= 1
                if not free:
                    return table


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key: the first 60 bits of the MD5 of its text, modulo the size; null counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` added; columns of these names in ``rows`` are replaced.

    Equal keys share a shard, null keys share one too; an empty table stays empty. No shuffle of ``rows``.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame([(s, shards[k]) for s, k in enumerate(fill_table(shards, slots, weights))], "slot long, shard string")
    kept = rows.drop(*(c for c in rows.columns if c.lower() in ("slot", "shard")))
    return kept.withColumn("slot", slot_of(kept[key], slots)).join(F.broadcast(table), "slot").select(*(kept[c] for c in kept.columns), "slot", "shard")


def op2_permutation_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return place(documents(spark, folder).select("doc_id"), "doc_id")


def op2_sql() -> str:
    table = ", ".join(map(str, fill_table(SHARDS, SLOTS)))
    return f"""
        WITH placed AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents),
        owners AS (SELECT [{table}] AS owner)
        SELECT doc_id, slot, 'shard-' || lpad(owner[slot + 1]::VARCHAR, 2, '0') AS shard FROM placed, owners
    """
