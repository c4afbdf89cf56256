"""Per-key source fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import cut_lineage


def fallback_by_key(sources: Sequence[DataFrame], key: Sequence[str] | str,
                    priority_col: str | None = None) -> DataFrame:
    """Each key takes all its rows from the first source that has any for it.

    Later sources are ignored for that key. Plan: union all sources tagged with their
    rank, one partially aggregated ``min(rank)`` per key (a hot key is pre-aggregated on
    the map side), then a left-semi join on (key, rank). AQE splits a skewed key on the
    big side of that join or broadcasts the per-key table when it is small at run time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    tagged = None
    for i, src in enumerate(sources):
        part = src.withColumn("_prio", F.lit(i))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    chosen = tagged.groupBy(*keys).agg(F.min("_prio").alias("_prio"))
    out = tagged.join(chosen, on=[*keys, "_prio"], how="left_semi")
    if priority_col:
        return out.withColumnRenamed("_prio", priority_col)
    return out.drop("_prio")


def fallback_for_keys(sources: Sequence[DataFrame], wanted: DataFrame, key: Sequence[str] | str,
                      priority_col: str | None = None) -> DataFrame:
    """S4 for the keys of ``wanted``: as :func:`fallback_by_key`, but a later source is read
    only for keys without rows in an earlier one, and not at all if no key is left.

    The source of each key is found source by source and kept in a written table (one row per
    key). Every read of a source is a semi-join with the keys that this table still leaves to
    it, by a filter on a scan: Spark broadcasts those keys if they are few, else its runtime Bloom
    filter (``spark.sql.optimizer.runtime.bloomFilter.*``) drops rows of other keys before the
    shuffle. Null keys, and keys that no source has, give no rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    found = cut_lineage(wanted.select(*keys).dropna().distinct().withColumn("_source", F.lit(-1)))
    out = None
    for i, src in enumerate(sources):
        left = found.filter("_source = -1").select(*keys)
        if i and left.isEmpty():
            part = src.limit(0)      # its columns only
        else:
            has = src.join(left, keys, "left_semi").select(*keys).distinct().withColumn("_has", F.lit(i))
            found = cut_lineage(found.join(has, keys, "left").select(
                *keys, F.when(F.col("_source") == -1, F.coalesce("_has", "_source"))
                .otherwise(F.col("_source")).alias("_source")))
            part = src.join(found.filter(F.col("_source") == i).select(*keys), keys, "left_semi")
        if priority_col:
            part = part.withColumn(priority_col, F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
