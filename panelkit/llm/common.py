"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import intermediate_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch at most: texts are long, and buffers of that size are kept.
BATCH_ROWS = 1_000


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, for a function of Arrow batches: the session's batches get small enough for
    whole texts (Spark's default of 10,000 rows is made for short rows)."""
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: the files outlive any executor, and what follows reads columns of
    them instead of running the plan again.
    """
    path = intermediate_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: str) -> Column:
    """Rows kept away from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def bounded_sample(rows: DataFrame, stratum: str, id_col: str, cap: int) -> DataFrame:
    """About ``cap`` rows of each stratum at most, picked by a hash of the id.

    Strata with fewer rows are taken whole. The count per stratum comes from one
    aggregate; the pick is a filter, so no stratum is gathered or sorted.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(stratum).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(stratum).eqNullSafe(F.lit(value)), F.lit(min(1.0, cap / n))).otherwise(share)
    unit = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return rows.filter(unit < share)
