"""Quantile sketches kept per year, merged into the bands of exact quantiles.

A panel grows by years. Each year's values are summed up once as a KLL sketch per group, with
count, least and greatest value, and written to a table partitioned by year; adding a year
reads that year alone and replaces its partition. Merged sketches give a narrow band of
values around each quantile, and :func:`panelkit.operators.ordered.quantiles_in_bands` counts
the values below the bands and those inside them, so results are exact: one pass over the
values in place of two. A sketch's error is likely, not certain; a band that misses its
quantile is seen in the counts, and such groups are computed without sketches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.ordered import exact_quantiles, quantiles_in_bands
from panelkit.session import cut_lineage

#: Size of a sketch (a few tens of kB) and, for it, the part of the ranks that a band takes on
#: each side: the sketch's own error bound (2.3 / K), twice.
K = 2_048
MARGIN = 2 * 2.3 / K


class YearSketches:
    """Sketches of one value column by group, a table at ``path`` partitioned by year."""

    def __init__(self, spark: SparkSession, path: str, value: str, by: Sequence[str] = (),
                 year: str = "public_year", k: int = K):
        self.spark, self.path, self.value, self.by, self.year, self.k = spark, path, value, list(by), year, k

    def add(self, rows: DataFrame) -> None:
        """Sum up the years that ``rows`` hold, each whole; their partitions replace earlier
        ones, other years stay unread and untouched. Null values and years count nowhere."""
        x = F.col(self.value).cast("double")
        sums = (rows.select(*self.by, F.col(self.year).cast("int").alias("_year"), x.alias("_x"))
                .filter(F.col("_x").isNotNull() & F.col("_year").isNotNull())
                .groupBy(*self.by, "_year")
                .agg(F.count("_x").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"),
                     F.kll_sketch_agg_double("_x", F.lit(self.k)).alias("sketch")))
        (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_year")
         .parquet(self.path))

    def years(self) -> list[int]:
        return sorted(r[0] for r in self._table().select("_year").distinct().collect())

    def _table(self, years: Sequence[int] | None = None) -> DataFrame:
        table = self.spark.read.parquet(self.path)
        return table if years is None else table.filter(F.col("_year").isin(list(years)))

    def _merged(self, years: Sequence[int] | None) -> DataFrame:
        keys = [F.col(b).alias(f"_by{i}") for i, b in enumerate(self.by)]
        return self._table(years).groupBy(*keys).agg(
            F.sum("n").alias("n"), F.min("lo").alias("_min"), F.max("hi").alias("_max"),
            F.kll_merge_agg_double("sketch", F.lit(self.k)).alias("_sketch"))

    def bands(self, probs: Mapping[str, float], years: Sequence[int] | None = None) -> DataFrame:
        """One row per group: ``_by*``, ``n`` and the bounds of each quantile, from the sketches
        alone (no value is read)."""
        def bound(p: float, side: int, extreme: str):
            q = p + side * MARGIN * K / self.k
            if not 0 < q < 1:
                return F.col(extreme)
            got = F.kll_sketch_get_quantile_double("_sketch", F.lit(q))
            # Few values: neighbours in order may lie beyond the margin.
            return F.when(F.col("n") <= 4 * self.k, F.col(extreme)).otherwise(got)
        return self._merged(years).select(
            *[f"_by{i}" for i in range(len(self.by))], "n",
            *[bound(p, -1, "_min").alias(f"_lo{i}") for i, p in enumerate(probs.values())],
            *[bound(p, 1, "_max").alias(f"_hi{i}") for i, p in enumerate(probs.values())])

    def approx_quantiles(self, probs: Mapping[str, float], years: Sequence[int] | None = None) -> DataFrame:
        """Group columns, ``n`` and approximate quantiles from the sketches alone."""
        return self._merged(years).select(
            *[F.col(f"_by{i}").alias(b) for i, b in enumerate(self.by)], "n",
            *[F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias(name) for name, p in probs.items()])

    def exact_quantiles(self, rows: DataFrame, probs: Mapping[str, float],
                        years: Sequence[int] | None = None) -> DataFrame:
        """Group columns, ``n`` and exact quantiles (linear interpolation) of ``rows``, which are
        those that the sketches sum up."""
        year = F.col(self.year).cast("int")
        data = rows.select(*self.by, F.col(self.value).cast("double").alias("_x"), year.alias("_year")).filter(
            F.col("_x").isNotNull() & F.col("_year").isNotNull())
        if years is not None:
            data = data.filter(F.col("_year").isin(list(years)))
        try:
            bands = cut_lineage(self.bands(probs, years))
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return exact_quantiles(data.withColumnRenamed("_x", self.value), self.value, probs, self.by)
        found = cut_lineage(quantiles_in_bands(data, bands, probs, self.by))
        missed = F.lit(False)
        for name in probs:
            missed = missed | F.col(name).isNull()
        if not found.filter(missed).isEmpty() or found.count() != bands.count():
            return exact_quantiles(data.withColumnRenamed("_x", self.value), self.value, probs, self.by)
        return found
