"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the table's slots (offset and skip from
a hash of its name; the table's size is prime, so each skip reaches every
slot). Shards take turns, each claiming the next slot of its permutation that
is free, until the table is full: all hold the same number of slots, give or
take one, and a shard that leaves moves hardly any slot of the others. The table
has a fixed size, so it is broadcast, and a row's place is one look-up of its
key's hash, without shuffle or Python. Only writing shards moves rows.

Defined cases: a null key is placed like the empty string. Equal keys share a
shard; name further key columns (such as doc_id) to spread a hot key. Rows may
repeat; no rows give no rows. Columns named ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equilibra.llm._work import run_dir


def shard_names(count: int) -> list[str]:
    return [f"shard-{k:03d}" for k in range(count)]


def lookup_table(shards: list[str], size: int) -> list[int]:
    """Which shard (its number) each slot belongs to; ``size`` must be prime."""
    if size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError(f"{size} is not prime")
    if not 0 < len(shards) <= size:
        raise ValueError("from one shard up to as many as there are slots")
    number = lambda name, salt: int(hashlib.md5(f"{salt}|{name}".encode()).hexdigest()[:15], 16)
    turn = [[number(s, "offset") % size, number(s, "skip") % (size - 1) + 1] for s in shards]
    table, left = [-1] * size, size
    while left:
        for k, state in enumerate(turn):
            while table[state[0]] >= 0:
                state[0] = (state[0] + state[1]) % size
            table[state[0]] = k
            left -= 1
            if not left:
                break
    return table


def assign_shards(df: DataFrame, keys: list[str], shards: list[str], size: int = 65_537) -> DataFrame:
    """``df`` with ``slot`` and ``shard``."""
    table = ",".join(shards[k] for k in lookup_table(shards, size))
    slots = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(table), ",")).alias("__slot", "__shard"))
    key = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    slot = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long") % size
    rest = [c for c in df.columns if c not in ("slot", "shard")]
    placed = df.select(*rest, slot.alias("slot"))
    return placed.join(F.broadcast(slots), F.col("slot") == F.col("__slot")).select(*rest, "slot", F.col("__shard").alias("shard"))


def write_shards(df: DataFrame, keys: list[str], shards: list[str], path: str, size: int = 65_537) -> None:
    """One folder per shard, in files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``:
    rows meet by shard first, and adaptive execution (on by default, needed here) splits a
    shard that is larger and joins what is smaller, so that no shard goes through one task
    and the number of files follows the size of the data, not tasks times shards."""
    placed = assign_shards(df, keys, shards, size)
    placed.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)


def round_trip(df: DataFrame, keys: list[str], shards: list[str], size: int = 65_537) -> DataFrame:
    """Write all columns of ``df`` into shards and read them back from there."""
    path = f"{run_dir(df.sparkSession, 'sharding')}/shards"
    write_shards(df, keys, shards, path, size)
    rest = [f for f in df.schema.fields if f.name not in ("slot", "shard")]
    schema = T.StructType([*rest, T.StructField("slot", T.LongType()), T.StructField("shard", T.StringType())])
    return df.sparkSession.read.schema(schema).parquet(path)
