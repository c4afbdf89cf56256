"""Firm-year aggregates that are stored and merged month by month.

The yearly features of a firm follow from sums that merge: counts, means with squared
deviations, moments with the month, the last value with its month, the first label with its
month. A store keeps one row of them per firm and year, partitioned by year. Adding rows sums
them up, reads the stored rows of the years that they touch, merges the two by an equality
join, and replaces those partitions; other years are neither read nor written. The features
are expressions over the stored rows: no panel row is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.functions import cleaning as C
from panelkit.operators.features import EPS, KEYS
from panelkit.session import cut_lineage

#: Place of rows without a month: after all others.
_NO_MONTH = 2**31 - 1


def firm_year_partials(rows: DataFrame, feats: Sequence[str], label: str = "delist",
                       month: str = "public_month") -> DataFrame:
    """One row per firm and year: everything that the yearly features follow from, by hash
    aggregates that are combined on the map side."""
    m = F.col(month).cast("double")
    place = F.coalesce(F.col(month).cast("int"), F.lit(_NO_MONTH))
    sums = [F.count(F.lit(1)).alias("rows"), F.count(m).alias("n_m"), F.sum(m).alias("s_m"), F.sum(m * m).alias("s_mm")]
    for c in feats:
        x = F.col(c)
        sums += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 (F.var_pop(x) * F.count(x)).alias(f"{c}__dev"), F.sum(m * x).alias(f"{c}__mv"),
                 F.sum(F.when(x.isNotNull(), m)).alias(f"{c}__m"), F.sum(F.when(x.isNotNull(), m * m)).alias(f"{c}__mm")]
    # Ties within a month: the larger value, the smaller label.
    monthly = rows.groupBy(*KEYS, place.alias("_m")).agg(
        F.min(label).alias("_label"), *[F.max(c).alias(c) for c in feats])
    seen = lambda c: F.when(F.col(c).isNotNull(), F.col("_m"))
    ends = monthly.groupBy(*KEYS).agg(
        F.min("_m").alias("first_m"), F.min_by("_label", "_m").alias("first_label"),
        *[F.max(seen(c)).alias(f"{c}__at") for c in feats], *[F.max_by(F.col(c), seen(c)).alias(f"{c}__last") for c in feats])
    return rows.groupBy(*KEYS).agg(*sums).join(ends, on=list(KEYS))


def merge_partials(old: DataFrame, new: DataFrame, feats: Sequence[str]) -> DataFrame:
    """The partials of both parts together; a firm-year may stand in either or both, once."""
    a, b = old.alias("a"), new.alias("b")
    left, right = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))

    def total(c: str) -> Column:
        return F.when(left(c).isNull(), right(c)).when(right(c).isNull(), left(c)).otherwise(left(c) + right(c))

    out = [F.coalesce(left(k), right(k)).alias(k) for k in KEYS]
    out += [total(c).alias(c) for c in ("rows", "n_m", "s_m", "s_mm")]
    earlier = right("first_m").isNull() | (left("first_m") < right("first_m"))
    tie = left("first_m") == right("first_m")
    out += [F.least("a.first_m", "b.first_m").alias("first_m"),
            F.when(tie, F.least("a.first_label", "b.first_label")).when(earlier, left("first_label"))
            .otherwise(right("first_label")).alias("first_label")]
    for c in feats:
        n, k = F.coalesce(left(f"{c}__n"), F.lit(0)), F.coalesce(right(f"{c}__n"), F.lit(0))
        away = right(f"{c}__mean") - left(f"{c}__mean")
        out += [(n + k).alias(f"{c}__n"),
                F.when(n == 0, right(f"{c}__mean")).when(k == 0, left(f"{c}__mean"))
                .otherwise(left(f"{c}__mean") + away * k / (n + k)).alias(f"{c}__mean"),
                F.when(n == 0, right(f"{c}__dev")).when(k == 0, left(f"{c}__dev"))
                .otherwise(left(f"{c}__dev") + right(f"{c}__dev") + away * away * n * k / (n + k)).alias(f"{c}__dev")]
        out += [total(f"{c}__{s}").alias(f"{c}__{s}") for s in ("mv", "m", "mm")]
        at, to = left(f"{c}__at"), right(f"{c}__at")
        out += [F.greatest(at, to).alias(f"{c}__at"),
                F.when(to.isNull() | (at > to), left(f"{c}__last")).when(at.isNull() | (to > at), right(f"{c}__last"))
                .otherwise(F.greatest(left(f"{c}__last"), right(f"{c}__last"))).alias(f"{c}__last")]
    cond = F.lit(True)
    for k in KEYS:
        cond = cond & (left(k) == right(k))
    return a.join(b, cond, "full_outer").select(*out)


def features_of(partials: DataFrame, feats: Sequence[str]) -> DataFrame:
    """The yearly features (A1-A5) and ``first_label`` (A7) of stored partials."""
    mu = F.col("s_m") / F.col("n_m")
    scale = F.sqrt(F.greatest(F.col("s_mm") / F.col("n_m") - mu * mu, F.lit(0.0))) + F.lit(EPS)

    def slope(c: str) -> Column:
        n, mean = F.col(f"{c}__n"), F.col(f"{c}__mean")
        sxy = (F.col(f"{c}__mv") - mu * n * mean) / scale
        sxx = (F.col(f"{c}__mm") - 2.0 * mu * F.col(f"{c}__m") + n * mu * mu) / (scale * scale)
        return F.when(n >= 2, sxy / (sxx + F.lit(EPS)))

    def deviation(c: str) -> Column:
        return F.when(F.col(f"{c}__n") > 1, F.sqrt(F.col(f"{c}__dev") / (F.col(f"{c}__n") - 1)))

    return partials.select(
        *KEYS, *[F.col(f"{c}__last").alias(f"{c}_last") for c in feats], *[F.col(f"{c}__mean").alias(f"{c}_mean") for c in feats],
        *[deviation(c).alias(f"{c}_std") for c in C.STD_FEATURES if c in feats],
        *[slope(c).alias(f"{c}_slope") for c in C.SLOPE_FEATURES if c in feats],
        F.col("rows").alias("obs_count_in_year"), "first_label")


class FirmYearStore:
    """Partials at ``path``, one row per firm and year, partitioned by year."""

    def __init__(self, spark: SparkSession, path: str, feats: Sequence[str], label: str = "delist"):
        self.spark, self.path, self.feats, self.label = spark, path, list(feats), label

    def _stored(self, schema: StructType | None = None) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path)

    def add(self, rows: DataFrame) -> list[int]:
        """Add panel rows (each row once, over all calls): the years they touch, whose
        partitions alone are read and replaced. Rows without a firm or year count nowhere."""
        rows = rows.filter(F.col("permno").isNotNull() & F.col("public_year").isNotNull())
        new = cut_lineage(firm_year_partials(rows, self.feats, self.label))
        years = sorted(r[0] for r in new.select("public_year").distinct().collect())
        if not years:
            return years
        stored = self._stored(new.schema)
        if stored is not None:
            # Written aside first: the partitions that are read are those that are replaced.
            old = stored.filter(F.col("public_year").isin(years)).select(*new.columns)
            new = cut_lineage(merge_partials(old, new, self.feats))
        (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("public_year")
         .parquet(self.path))
        return years

    def features(self) -> DataFrame:
        """Yearly features of all rows added so far, with ``first_label``."""
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"no firm-year table at {self.path}")
        return features_of(stored, self.feats)
