"""Exact dedup by skew-safe combining: local, then salted, then global, on full content.

1. *Local*: Spark's map-side aggregate folds equal texts of one input partition into one
   row before anything is shuffled, so a text that fills a third of the table leaves each
   partition once.
2. *Salted*: those rows meet by (digest, salt, content), the salt naming a set of input
   partitions, so even a text that occurs in every partition is spread over ``salts`` tasks.
3. *Global*: the at most ``salts`` winners of a text meet by digest and are combined.

Content is a grouping key in all three steps; the digest only decides where rows meet, so
two texts with one digest are never merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import table, written

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, content, keep_id, group_size, texts_of_digest."""
    rows = docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    salted = (rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "_salt", "content")
              .agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n")))
    # By digest alone, so that the texts of one digest meet and can be counted as well.
    merged = (salted.repartition("digest").groupBy("digest", "content")
              .agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size")))
    return merged.withColumn("texts_of_digest",
                             F.count(F.lit(1)).over(W.partitionBy("digest")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. A null text counts as empty. A null
    id loses to any other; where a group has only null ids, all its rows are kept. Rows
    that repeat an id and text share their decision. An empty table gives an empty result;
    other columns of ``docs`` are ignored, whatever their names.
    """
    out = [F.col("_id").alias(id_col), "keep_id", "group_size",
           F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    groups = text_groups(docs, id_col, text_col, digest, salts)
    # Only texts that share their digest with another text need their content from here on.
    groups = written(groups.withColumn(
        "content", F.when(F.col("texts_of_digest") > 1, F.col("content"))))
    ids = docs.select(F.col(id_col).alias("_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("content"))
    ids = ids.withColumn("digest", digest(F.col("content"))) \
             .withColumn("text_sha256", sha256(F.col("content")))
    alone = groups.filter("texts_of_digest = 1").select("digest", "keep_id", "group_size")
    result = ids.drop("content").join(alone, "digest").select(*out)
    shared = groups.filter("texts_of_digest > 1").select("digest", "content", "keep_id", "group_size")
    if not shared.isEmpty():
        result = result.unionByName(ids.join(shared, ["digest", "content"]).select(*out))
    return result


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, with all their columns."""
    dropped = (exact_dedup(docs, id_col, text_col).filter(~F.col("kept"))
               .select(F.col(id_col).alias("_dropped"), "text_sha256").distinct())
    same = (docs[id_col].eqNullSafe(dropped["_dropped"])
            & (sha256(F.coalesce(docs[text_col], F.lit(""))) == dropped["text_sha256"]))
    return docs.join(dropped, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""
