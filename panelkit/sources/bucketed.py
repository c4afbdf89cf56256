"""Tables written once by firm, so that what follows does not shuffle by firm again.

A firm table is a Spark table bucketed by firm and sorted within the buckets, in the shared
checkpoint folder. Joins on (firm, date) and aggregates by (firm, year) of such tables read
the buckets side by side: no exchange. Spark uses a layout by fewer columns than a join has
only if it is told to, so the tables are read in a session of their own whose settings are
those of the caller's otherwise; the caller's session stays as it is.

A bucket is read by one task, so a firm with very many rows must not go into one. A layout
finds such firms by one aggregate (fewer than half the buckets can be that large) and keeps
their rows in a plain table beside the buckets; :func:`per_firm` runs the same work on both
parts, the hot one with Spark's usual exchanges and skew handling.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import intermediate_path, intermediate_table

#: A firm is hot if it has this many rows at least, and twice those of an average bucket.
HOT_ROWS = 100_000

_SETTINGS = {
    # Joins on (firm, date) may use buckets by firm; scans of one file per bucket are sorted.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}
_SESSIONS: dict[tuple, SparkSession] = {}


def firm_session(spark: SparkSession) -> SparkSession:
    """The session in which firm tables are read: the caller's settings and those above."""
    key = (id(spark), spark.sparkContext.applicationId)
    if key not in _SESSIONS:
        _SESSIONS[key] = spark.newSession()
    own = _SESSIONS[key]
    for name, value in {**spark.conf.getAll, **_SETTINGS}.items():
        if own.conf.isModifiable(name) and own.conf.get(name, None) != value:
            own.conf.set(name, value)
    return own


@dataclass
class FirmTable:
    """Rows of one table: ``cold`` in buckets, ``hot`` (if any) plain."""
    cold: DataFrame
    hot: DataFrame | None
    spark: SparkSession


@dataclass
class FirmLayout:
    """How tables that are joined with each other are written: key, buckets and hot firms."""
    spark: SparkSession
    by: str = "permno"
    buckets: int = 0
    hot: list = field(default_factory=list)      # fewer than half the buckets
    null_is_hot: bool = False

    def __post_init__(self):
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def of(cls, tables: Sequence[DataFrame], by: str = "permno", buckets: int = 0,
           hot_rows: int | None = None, rows_per_bucket: int = 0) -> FirmLayout:
        """A layout whose hot firms are those of any of the tables; each is scanned for its key
        column alone, all in one aggregate, so give tables that are stored, not long plans. With ``rows_per_bucket``
        the buckets grow in number, not in size."""
        layout = cls(tables[0].sparkSession, by, buckets)
        keys = None
        for i, df in enumerate(tables):
            part = df.select(F.lit(i).alias("table"), F.col(by).alias("key"))
            keys = part if keys is None else keys.union(part)
        counts = keys.groupBy("table", "key").count()
        sizes = counts.groupBy("table").agg(F.sum("count").alias("all"), F.max("count").alias("most")).collect()
        if rows_per_bucket:
            layout.buckets = max([layout.buckets, *[-(-size["all"] // rows_per_bucket) for size in sizes]])
        hot = set()
        for size in sizes:
            bound = max(HOT_ROWS if hot_rows is None else hot_rows, 2 * size["all"] / layout.buckets)
            if size["most"] >= bound:
                found = counts.filter((F.col("table") == size["table"]) & (F.col("count") >= bound))
                hot |= {r["key"] for r in found.collect()}
        layout.null_is_hot = None in hot
        layout.hot = sorted(hot - {None})
        return layout

    def is_hot(self) -> Column:
        return F.coalesce(F.col(self.by).isin(self.hot), F.lit(self.null_is_hot))

    def write(self, df: DataFrame, sort_by: Sequence[str] = ()) -> FirmTable:
        """``df`` as a table of this layout, sorted by firm and ``sort_by`` within buckets.

        One shuffle by firm, one file per bucket. Null firms have a bucket like any other;
        an empty ``df`` gives an empty table.
        """
        split = bool(self.hot) or self.null_is_hot
        if split:      # both parts read it
            path = intermediate_path(self.spark)
            df.write.parquet(path)
            df = self.spark.read.schema(df.schema).parquet(path)
        cold = df.filter(~self.is_hot()) if split else df
        name, path = intermediate_table(self.spark)
        (cold.repartition(self.buckets, self.by).write.option("path", path)
         .bucketBy(self.buckets, self.by).sortBy(self.by, *sort_by).saveAsTable(name))
        return FirmTable(firm_session(self.spark).table(name), df.filter(self.is_hot()) if split else None, self.spark)


def per_firm(work: Callable[..., DataFrame], *tables: FirmTable) -> DataFrame:
    """``work`` on the buckets of the tables, and on their hot firms if there are any.

    ``work`` takes one frame per table and must treat each firm by itself (joins and
    aggregates whose keys hold the firm): the result is the union of both parts.
    """
    out = work(*[t.cold for t in tables])
    if any(t.hot is not None for t in tables):
        out = out.unionByName(work(*[t.hot if t.hot is not None else t.cold.limit(0) for t in tables]))
    return out


def stored(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` written to the shared folder and read back in the caller's session."""
    path = intermediate_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

