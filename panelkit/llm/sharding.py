"""Sharding by a permutation-filled lookup table (DataFrame functions only).

Every shard has its own order of preference over the slots of a table of prime size (an
offset and a step, both from a hash of its name). Shards take turns; at its turn a shard
claims the first slot of its order that is still free. A key is placed by one look into
the table: slot = hash(key) mod size. Shards own equal shares to within one slot, and
when a shard comes or goes few slots outside its own share change owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import table

TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(24))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def preference(shard: str, size: int) -> tuple[int, int]:
    """(offset, step) of a shard's order of preference; the step is never 0 mod ``size``."""
    h = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Owner (index into ``shards``) of every slot. Depends on the parameters alone."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime not below the number of shards")
    order = [preference(s, size) for s in shards]
    turn = [0] * len(shards)
    owner = [-1] * size
    free = size
    while free:
        for i, (offset, step) in enumerate(order):
            slot = (offset + turn[i] * step) % size
            while owner[slot] >= 0:
                turn[i] += 1
                slot = (offset + turn[i] * step) % size
            owner[slot] = i
            turn[i] += 1
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text (null: the empty text)."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size).cast("int")


def slots(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """The lookup table as ``size`` rows (slot, shard)."""
    names = F.split(F.lit("\n".join(shards)), "\n")
    owners = F.split(F.lit(" ".join(map(str, fill_table(shards, size)))), " ")
    return (spark.range(1).select(F.posexplode(owners).alias("_slot", "_owner"))
            .select("_slot", F.element_at(names, F.col("_owner").cast("int") + 1).alias("shard")))


def assign_shards(docs: DataFrame, key_col: str = "doc_id", shards: Sequence[str] = SHARDS,
                  size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard`` (replaced where they exist).

    The table has ``size`` rows whatever the data, so it is broadcast; rows never move.
    Equal keys share a shard; a null key is placed as the empty text. All other columns come
    along as they are, whatever their names and length; repeated rows stay. Empty tables give
    empty results.
    """
    rows = docs.select(*[docs[c] for c in docs.columns if c not in ("slot", "shard")],
                       slot_of(docs[key_col], size).alias("slot"))
    lookup = F.broadcast(slots(docs.sparkSession, shards, size))
    return rows.join(lookup, rows["slot"] == lookup["_slot"], "inner").drop(lookup["_slot"])


def write_shards(docs: DataFrame, path: str, files_per_shard: int = 1, **options) -> None:
    """Write one folder per shard; each shard is cut into ``files_per_shard`` files by slot, each
    written by one task, so choose them by the size of a shard. Rows of a null key and empty
    texts are written like others; an empty table gives an empty folder."""
    out = assign_shards(docs, **options)
    part = F.pmod(F.col("slot"), F.lit(files_per_shard))
    out.repartition("shard", part).drop("slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def oracle() -> str:
    owners = " ".join(map(str, fill_table(SHARDS)))
    return f"""
WITH lookup AS (SELECT str_split('{owners}', ' ') AS owner, str_split('{" ".join(SHARDS)}', ' ') AS name),
d AS (SELECT *, (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {TABLE_SIZE})::INTEGER AS slot
      FROM documents)
SELECT d.*, name[owner[slot + 1]::INTEGER + 1] AS shard FROM d, lookup
"""
