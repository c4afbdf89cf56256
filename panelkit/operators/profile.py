"""Descriptive statistics behind the reference's plots.

Only bounded values reach the driver (a min and a max for a histogram). Quantiles are
exact and never gather a class: see :func:`panelkit.operators.ordered.exact_quantiles`.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.functions.scalar import ROA_BIN_EDGES, bin_label, clip, cut_bins, map_label, percent_label
from panelkit.operators.ordered import approx_quantiles, exact_quantiles
from panelkit.session import cut_lineage
from panelkit.sources.publish import counted, rows_of

# Ratios of the correlation heat map, in order.
CORR_COLUMNS = ["tobinq", "revtq", "bm", "roa", "roe", "de_ratio", "pe_op_basic"]
HIST_BINS = 40
WHIS = 1.5


def firm_status_counts(df: DataFrame, company: str = "permno", label: str = "delist") -> DataFrame:
    """Max label per firm, then the number of firms per value."""
    per_firm = df.groupBy(company).agg(F.max(label).alias("status"))
    return per_firm.groupBy("status").agg(F.count(F.lit(1)).alias("n_firms"))


def delist_rate_by_year(df: DataFrame, year_col: str = "public_year",
                        label: str = "delist") -> DataFrame | None:
    """Mean label per year (None when there is no year column)."""
    if year_col not in df.columns:
        return None
    return df.groupBy(year_col).agg(F.avg(label).alias("delist_rate"))


def delist_rate_by_bin(df: DataFrame, col: str = "roa", label: str = "delist",
                       edges: Sequence[float] = ROA_BIN_EDGES) -> DataFrame:
    """A10: clip to the edge range, right-closed equal-width bins, mean label and row
    count per bin; empty bins are kept (count 0, rate NULL)."""
    lo, hi = edges[0], edges[-1]
    binned = df.select(cut_bins(clip(col, lo, hi), list(edges)).alias("bin"), label)
    stats = binned.filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.avg(label).alias("delist_rate"), F.count(F.lit(1)).alias("n_obs"))
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, bin_label(edges[i], edges[i + 1]))
                                  for i in range(len(edges) - 1)], "bin int, bin_label string")
    out = F.broadcast(bins).join(stats, on="bin", how="left")
    return out.select("bin", "bin_label", "delist_rate",
                      F.coalesce(F.col("n_obs"), F.lit(0).cast("long")).alias("n_obs")).withColumn(
        "annotation", percent_label("delist_rate", "n_obs"))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """Pearson matrix in long form (row, column, corr), pairwise complete.
    Absent columns are skipped; one aggregate computes every pair."""
    present = [c for c in cols if c in df.columns]
    pairs = list(combinations_with_replacement(present, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries.append((a, b, i))
        if a != b:
            entries.append((b, a, i))
    stack = ", ".join(f"'{a}', '{b}', `{i}`" for a, b, i in entries)
    return row.selectExpr(f"stack({len(entries)}, {stack}) AS (var_row, var_col, corr)")


def _bounds(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS,
              zoom: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width bins over the data's min..max, the last bin closed (numpy rules,
    including its edge corrections); ``zoom`` first keeps lo <= x <= hi (F22) and the
    bounds then come from that subset. All bins are returned, empty ones with count 0."""
    data = df.select(col).filter(F.col(col).isNotNull())
    if zoom is not None:
        data = C.positive_range_zoom(data, col, *zoom)
    lo, hi = _bounds(data, col)
    spark = df.sparkSession
    if lo is None:
        lo, hi = 0.0, 1.0
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    x = F.col(col)

    def edge(i):  # numpy.linspace: i * step + lo, the last edge exactly hi
        return F.when(i >= bins, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    idx0 = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))).cast("int")
    idx1 = F.when(idx0 == bins, bins - 1).otherwise(idx0)
    idx2 = F.when(x < edge(idx1), idx1 - 1).otherwise(idx1)
    idx3 = F.when((x >= edge(idx2 + 1)) & (idx2 != bins - 1), idx2 + 1).otherwise(idx2)
    counts = data.select(idx3.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    frame = frame.select("bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"))
    return (F.broadcast(frame).join(counts, on="bin", how="left")
            .select("bin", "bin_lo", "bin_hi",
                    F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count")))


def boxplot_stats(df: DataFrame, value: str = "roa", label: str = "delist",
                  whis: float = WHIS, approx: int | None = None) -> DataFrame:
    """Per label group: quartiles (linear interpolation), median, mean, whiskers (the
    farthest points within whis x IQR of the box) and the number of outliers beyond them.
    ``approx`` (an accuracy, e.g. 10000) switches the quartiles to mergeable sketches."""
    data = df.select(map_label(label).alias("group"), F.col(value).alias("x")).filter(
        F.col("group").isNotNull() & F.col("x").isNotNull())
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    q = (approx_quantiles(data, "x", probs, by=["group"], accuracy=approx) if approx
         else exact_quantiles(data, "x", probs, by=["group"]))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("_lo", F.col("q1") - whis * F.col("iqr")).withColumn(
        "_hi", F.col("q3") + whis * F.col("iqr"))
    j = data.join(F.broadcast(q.select("group", "_lo", "_hi")), on="group")  # <= 2 groups
    x = F.col("x")
    w = j.groupBy("group").agg(
        F.avg(x).alias("mean"),
        F.min(F.when(x >= F.col("_lo"), x)).alias("_wlo"),
        F.max(F.when(x <= F.col("_hi"), x)).alias("_whi"),
        F.count(F.when((x < F.col("_lo")) | (x > F.col("_hi")), 1)).alias("n_outliers"))
    out = q.join(w, on="group")
    return out.select("group", "n", "q1", "median", "q3", "iqr", "mean",
                      F.coalesce("_wlo", "q1").alias("whisker_lo"),
                      F.coalesce("_whi", "q3").alias("whisker_hi"), "n_outliers")


class StageCounts:
    """Rows per named stage, counted by the stages' own runs.

    ``watch`` gives a stage's rows an observed count; whatever action runs over them first
    (a write, a cut of the lineage) fills it in, and no job is run for counting.
    """

    def __init__(self):
        self._seen = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        out, self._seen[name] = counted(df, name)
        return out

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """The stage written once to the shared folder and read back, its rows counted."""
        return cut_lineage(self.watch(name, df))

    def counts(self) -> dict[str, int]:
        """Rows per stage, in order; every watched stage must have run."""
        return {name: rows_of(seen) for name, seen in self._seen.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.counts().items()), "stage string, n_rows bigint")


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per named stage, as one small table. Each stage is written once, which counts
    it; use :class:`StageCounts` where a stage's own write does."""
    seen = StageCounts()
    spark = None
    for name, df in stages.items():
        spark = df.sparkSession
        seen.write(name, df)
    return seen.table(spark)
