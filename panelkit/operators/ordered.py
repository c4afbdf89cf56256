"""Skew-safe ordered scans: ranks, previous/next non-null values, lag/lead, prefix sums.

A window ``partitionBy(firm).orderBy(time)`` puts every row of one firm into one task.
When one firm (or one label class, or the whole table) holds a large share of the rows,
that task becomes the job. The scan here cuts every group into *segments* instead:

1. range bounds of the order columns come from one small aggregate (approximate
   percentiles, collected as literals); a row's bucket is a plain expression of its own
   values, so every evaluation of the plan gives a row the same segment (group, bucket);
2. windows run inside segments (hash shuffle on group and bucket);
3. the last row of each segment carries its summary; a window over the summaries, at most
   one per bucket and group, gives what earlier and later segments contribute;
4. that is joined back on the real columns (group, bucket).

Nothing depends on Spark reusing an exchange: each row finds its segment by value. The
tie-break appends every remaining orderable column, so the order is total up to rows that
are equal in all of them. A NULL group key forms its own group (callers that follow pandas
``groupby`` drop such rows first).
"""

from __future__ import annotations

import os.path
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from panelkit.session import cut_lineage

#: Most buckets of the order columns (the bucket expression is a search tree of literals).
MAX_BUCKETS = 1024
#: Rank error of the percentile sketches: rows / ACCURACY.
ACCURACY = 10_000

_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BooleanType, T.BinaryType)


def tiebreak_columns(df: DataFrame, used: set[str]) -> list[str]:
    """Every remaining orderable column."""
    return [f.name for f in df.schema.fields
            if f.name not in used and isinstance(f.dataType, _ORDERABLE)]


# --- segments ----------------------------------------------------------------------------

def _as_number(df: DataFrame, name: str) -> Column | None:
    """A double that never falls as the column rises (NULL and NaN give NULL: they sort
    last). None for types without one."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return c.cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(c.cast("date")).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # the first six bytes as a number; strings compare by their bytes
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return None


def _exact(kind: T.DataType) -> bool:
    """Whether different values always have different numbers."""
    return (isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType, T.FloatType, T.DoubleType,
                              T.DateType)) or isinstance(kind, T.DecimalType) and kind.precision <= 15)


def _rest(df: DataFrame, name: str, low, high) -> Column | None:
    """A double that never falls as the column rises from ``low`` to ``high``, all of whose
    values have the same number; for what that number leaves out."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c).cast("double")
    if isinstance(kind, (T.LongType, T.DecimalType)):
        return F.try_subtract(c, F.lit(low).cast(kind)).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        same = len(os.path.commonprefix([bytes(low), bytes(high)]))
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), same + 1, 6)), 12, "0"), 16, 10).cast("double")
    return None


def _tree(x: Column, cuts: list[float], base: int = 0) -> Column:
    """base + the number of cuts that are <= x, by binary search; x is not NULL."""
    if not cuts:
        return F.lit(base)
    mid = len(cuts) // 2
    return (F.when(x < F.lit(cuts[mid]), _tree(x, cuts[:mid], base))
            .otherwise(_tree(x, cuts[mid + 1:], base + mid + 1)))


def order_bucket(df: DataFrame, order: Sequence[str], buckets: int | None = None) -> Column:
    """An expression that cuts the order of the rows into ranges of similar size.

    A number of the first order column that fills several ranges by itself is cut further:
    by the second column if a single value has it, else by what the number leaves out of
    the first one (later bytes, the time of day, low digits). Bounds are literals from one
    aggregate (up to three if there are such numbers); they only balance the ranges and
    never decide a result.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(n, MAX_BUCKETS))
    first = _as_number(df, order[0])
    if n == 1 or first is None:
        return F.lit(0)
    probs = [i / n for i in range(1, n)]
    got = df.agg(F.percentile_approx(first, probs, ACCURACY)).first()[0] or []
    cuts = sorted(set(got))
    heavy = {v: got.count(v) for v in cuts if got.count(v) > 1}
    out = F.when(first.isNull(), F.lit(len(cuts) + 1)).otherwise(_tree(first, cuts)).cast("long") * F.lit(2 * n)
    if not heavy:
        return out
    second = _as_number(df, order[1]) if len(order) > 1 else None
    inner_of = {v: second for v in heavy}
    kind = df.schema[order[0]].dataType
    if not _exact(kind):
        full = F.col(order[0])
        if isinstance(kind, (T.StringType, T.BinaryType)):
            full = full.cast("binary")               # by bytes, as the order is
        ends = df.select(first.alias("_v"), full.alias("_f")).filter(F.col("_v").isin(list(heavy)))
        for v, low, high in ends.groupBy("_v").agg(F.min("_f"), F.max("_f")).collect():
            if low != high:
                inner_of[v] = _rest(df, order[0], low, high)
    if not any(c is not None for c in inner_of.values()):
        return out
    by_value = None
    for v, c in inner_of.items():
        c = F.lit(None).cast("double") if c is None else c
        by_value = F.when(first == F.lit(v), c) if by_value is None else by_value.when(first == F.lit(v), c)
    rows = df.select(first.alias("_v"), by_value.alias("_w")).filter(F.col("_v").isin(list(heavy)))
    within = None
    for r in rows.groupBy("_v").agg(F.percentile_approx("_w", probs, ACCURACY)).collect():
        inner_number = inner_of[r[0]]
        step = max(1, n // (heavy[r[0]] + 1))           # as many ranges as the value fills
        inner = sorted(set((r[1] or [])[step - 1::step]))
        sub = F.lit(0) if inner_number is None else F.when(
            inner_number.isNull(), F.lit(len(inner) + 1)).otherwise(_tree(inner_number, inner))
        hit = first == F.lit(r[0])
        within = F.when(hit, sub) if within is None else within.when(hit, sub)
    # rows beyond the heavy value but within its range come after all its sub-ranges
    return out + within.otherwise(F.lit(n + 1)) if within is not None else out


def ordered_scan(df: DataFrame, by: Sequence[str], order: Sequence[str], *,
                 prev_nonnull: Mapping[str, str] | None = None,
                 next_nonnull: Mapping[str, str] | None = None,
                 lag: Mapping[str, str] | None = None,
                 lead: Mapping[str, str] | None = None,
                 cumsum: Mapping[str, str] | None = None,
                 group_count: Mapping[str, str] | None = None,
                 rank: str | None = None, size: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """Add ordered-scan columns within each ``by`` group, in ``order`` (ascending, nulls last).

    Mappings are ``{output_column: source_column}``:

    * ``prev_nonnull`` -- last non-null value strictly before the row
    * ``next_nonnull`` -- first non-null value strictly after the row
    * ``lag`` / ``lead`` -- value of the previous / next row (null at the ends)
    * ``cumsum`` -- inclusive running sum (null values count as 0)
    * ``group_count`` -- non-null values in the whole group
    * ``rank`` -- 0-based position of the row; ``size`` -- rows in its group

    Every input row comes out exactly once, with all its columns.
    """
    prev_nonnull, next_nonnull = dict(prev_nonnull or {}), dict(next_nonnull or {})
    lag, lead, cumsum = dict(lag or {}), dict(lead or {}), dict(cumsum or {})
    group_count = dict(group_count or {})
    by, order = list(by), list(order)
    names = list(df.columns)
    keys = order + tiebreak_columns(df, set(by) | set(order))
    rows = df.withColumn("__os_bucket", order_bucket(df, order, buckets))
    seg = by + ["__os_bucket"]
    up = W.partitionBy(*seg).orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    down = W.partitionBy(*seg).orderBy(*[F.col(k).desc_nulls_first() for k in keys])
    start = W.unboundedPreceding
    cols = [F.row_number().over(up).alias("__os_pos"),
            F.count(F.lit(1)).over(W.partitionBy(*seg)).alias("__os_n")]
    # inside the segment: the value seen from the row, and what the segment hands on
    for i, src in enumerate(prev_nonnull.values()):
        cols += [F.last(src, True).over(up.rowsBetween(start, -1)).alias(f"__os_p{i}"),
                 F.last(src, True).over(up.rowsBetween(start, 0)).alias(f"__os_pe{i}")]
    for i, src in enumerate(next_nonnull.values()):
        # backward as a forward scan of the reverse order, so it stays linear
        cols += [F.last(src, True).over(down.rowsBetween(start, -1)).alias(f"__os_x{i}"),
                 F.last(src, True).over(down.rowsBetween(start, 0)).alias(f"__os_xe{i}")]
    for i, src in enumerate(group_count.values()):
        cols.append(F.count(src).over(W.partitionBy(*seg)).alias(f"__os_g{i}"))
    for i, src in enumerate(lag.values()):
        cols.append(F.lag(src).over(up).alias(f"__os_l{i}"))
    for i, src in enumerate(lead.values()):
        cols.append(F.lag(src).over(down).alias(f"__os_d{i}"))
    for i, src in enumerate(cumsum.values()):
        cols.append(F.sum(F.coalesce(F.col(src), F.lit(0))).over(up.rowsBetween(start, 0)).alias(f"__os_c{i}"))
    rows = rows.select("*", *cols)

    first_row, last_row = F.col("__os_pos") == 1, F.col("__os_pos") == F.col("__os_n")

    # one summary per segment, from its first and last rows only
    ends = rows.filter(first_row | last_row)
    aggs = [F.max("__os_n").alias("__os_sn")]
    picks: list[tuple[str, Column, str]] = []
    for i, src in enumerate(prev_nonnull.values()):
        picks.append((f"__os_sp{i}", last_row, f"__os_pe{i}"))
    for i, src in enumerate(next_nonnull.values()):
        picks.append((f"__os_sx{i}", first_row, f"__os_xe{i}"))
    for i, src in enumerate(lag.values()):
        picks.append((f"__os_sl{i}", last_row, src))
    for i, src in enumerate(lead.values()):
        picks.append((f"__os_sd{i}", first_row, src))
    for i, src in enumerate(cumsum.values()):
        picks.append((f"__os_sc{i}", last_row, f"__os_c{i}"))
    picks += [(f"__os_sg{i}", last_row, f"__os_g{i}") for i, _ in enumerate(group_count)]
    for out, cond, c in picks:
        aggs.append(F.first(F.when(cond, F.struct(F.col(c).alias("v"))), True).alias(out))
    summary = ends.groupBy(*seg).agg(*aggs).select(
        *seg, "__os_sn", *[F.col(f"{out}.v").alias(out) for out, _, _ in picks])

    # what other segments of the group contribute; one row per bucket and group
    wg = W.partitionBy(*by).orderBy("__os_bucket")
    before, after = wg.rowsBetween(start, -1), W.partitionBy(*by).orderBy(
        F.col("__os_bucket").desc()).rowsBetween(start, -1)
    carry = [F.col(k).alias(f"__os_k{i}") for i, k in enumerate(seg)]
    carry += [F.coalesce(F.sum("__os_sn").over(before), F.lit(0)).alias("__os_off"),
              F.sum("__os_sn").over(W.partitionBy(*by)).alias("__os_size")]
    for i, _ in enumerate(prev_nonnull):
        carry.append(F.last(f"__os_sp{i}", True).over(before).alias(f"__os_cp{i}"))
    for i, _ in enumerate(next_nonnull):
        carry.append(F.last(f"__os_sx{i}", True).over(after).alias(f"__os_cx{i}"))
    for i, _ in enumerate(lag):
        carry.append(F.lag(f"__os_sl{i}").over(wg).alias(f"__os_cl{i}"))
    for i, _ in enumerate(lead):
        carry.append(F.lead(f"__os_sd{i}").over(wg).alias(f"__os_cd{i}"))
    for i, _ in enumerate(cumsum):
        carry.append(F.coalesce(F.sum(f"__os_sc{i}").over(before), F.lit(0)).alias(f"__os_cc{i}"))
    for i, _ in enumerate(group_count):
        carry.append(F.sum(f"__os_sg{i}").over(W.partitionBy(*by)).alias(f"__os_cg{i}"))
    carried = summary.select(*carry)
    if not by:
        carried = F.broadcast(carried)          # one row per bucket: 2 * MAX_BUCKETS at most

    same = [rows[k].eqNullSafe(carried[f"__os_k{i}"]) for i, k in enumerate(seg)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    joined = rows.join(carried, cond, "inner")
    final = [F.col(c) for c in names]
    for i, out in enumerate(prev_nonnull):
        final.append(F.coalesce(f"__os_p{i}", f"__os_cp{i}").alias(out))
    for i, out in enumerate(next_nonnull):
        final.append(F.coalesce(f"__os_x{i}", f"__os_cx{i}").alias(out))
    for i, out in enumerate(lag):
        final.append(F.when(first_row, F.col(f"__os_cl{i}")).otherwise(F.col(f"__os_l{i}")).alias(out))
    for i, out in enumerate(lead):
        final.append(F.when(last_row, F.col(f"__os_cd{i}")).otherwise(F.col(f"__os_d{i}")).alias(out))
    for i, out in enumerate(cumsum):
        final.append((F.col(f"__os_cc{i}") + F.col(f"__os_c{i}")).alias(out))
    for i, out in enumerate(group_count):
        final.append(F.col(f"__os_cg{i}").alias(out))
    if rank:
        final.append((F.col("__os_off") + F.col("__os_pos") - 1).alias(rank))
    if size:
        final.append(F.col("__os_size").alias(size))
    return joined.select(*final)


def global_rank(df: DataFrame, order: Sequence[str], rank: str = "rank", size: str | None = None) -> DataFrame:
    """0-based rank over the whole table without a one-partition window."""
    return ordered_scan(df, [], order, rank=rank, size=size)


# --- quantiles ---------------------------------------------------------------------------

def approx_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                     by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """Scale option: quantile sketches (``percentile_approx``), merged across partitions;
    memory per group is bounded by ``accuracy``, rank error about n / accuracy.
    Same output columns as :func:`exact_quantiles`."""
    by = list(by)
    names = list(probs)
    x = F.col(value)
    g = df.filter(x.isNotNull()).groupBy(*by) if by else df.filter(x.isNotNull()).groupBy()
    q = g.agg(F.count(x).alias("n"),
              F.percentile_approx(x, [float(probs[k]) for k in names], accuracy).alias("_q"))
    return q.select(*by, "n", *[F.col("_q")[i].alias(k) for i, k in enumerate(names)])


def _band(p: float, accuracy: int) -> tuple[float, float]:
    """Quantiles that surely enclose quantile p, given the sketch's rank error."""
    return max(0.0, p - 3 / accuracy), min(1.0, p + 3 / accuracy)


def _picked(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the value with linear interpolation between ranks floor(h), ceil(h).
    ``ranked`` has per key and distinct value: _x, _from, _to (0-based ranks), _h."""
    lo, hi = F.floor("_h"), F.ceil("_h")
    has = lambda r: (F.col("_from") <= r) & (r <= F.col("_to"))
    got = ranked.groupBy(*keys).agg(F.max(F.when(has(lo), F.col("_x"))).alias("_a"),
                                    F.max(F.when(has(hi), F.col("_x"))).alias("_b"),
                                    F.max(F.col("_h") - lo).alias("_t"))
    return got.select(*keys, (F.col("_a") + F.col("_t") * (F.col("_b") - F.col("_a"))).alias("_value"))


def exact_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                    by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy ``linear``) per ``by`` group.

    Nulls are skipped. Sketches give a narrow band of values around each quantile (written
    once, so that all that follows sees the same band); one pass counts the values below
    the bands, and only the values inside, about 6 n / accuracy, are counted one by one and
    ranked. No group is sorted or gathered.
    Output: ``by`` columns, ``n`` (non-null count) and one column per ``probs`` key.
    """
    by, names = list(by), list(probs)
    data = df.select(*by, F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    ends = [q for k in names for q in _band(float(probs[k]), accuracy)]
    sketch = data.groupBy(*by).agg(F.count("_x").alias("n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                   F.percentile_approx("_x", ends, accuracy).alias("_q"))
    whole = F.col("n") <= accuracy                   # few values: all of them
    bands = cut_lineage(sketch.select(
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], "n",
        *[F.when(whole, F.col("_min")).otherwise(F.col("_q")[2 * i]).alias(f"_lo{i}") for i in range(len(names))],
        *[F.when(whole, F.col("_max")).otherwise(F.col("_q")[2 * i + 1]).alias(f"_hi{i}") for i in range(len(names))]))
    return quantiles_in_bands(data, bands, probs, by)


def quantiles_in_bands(data: DataFrame, bands: DataFrame, probs: Mapping[str, float],
                       by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of ``_x`` per ``by`` group from bands of values around them.

    ``bands`` has a row per group: the group's columns as ``_by0``, ..., its number of values
    ``n`` and bounds ``_lo0``, ``_hi0``, ... per quantile. A quantile whose band does not hold
    its neighbours in order comes out null.
    """
    by, names = list(by), list(probs)
    cond = F.lit(True)
    for i, b in enumerate(by):
        cond = cond & data[b].eqNullSafe(bands[f"_by{i}"])
    j = data.join(bands, cond) if by else data.join(F.broadcast(bands))       # one row of bounds
    x = F.col("_x")
    inside = F.array_compact(F.array(*[F.when((x >= F.col(f"_lo{i}")) & (x <= F.col(f"_hi{i}")), F.lit(i))
                                       for i in range(len(names))]))
    keys = [f"_by{i}" for i in range(len(by))]
    near = (j.select(*keys, "_x", F.explode(inside).alias("_p"))
            .groupBy(*keys, "_p", "_x").agg(F.count(F.lit(1)).alias("_c")))
    below = j.groupBy(*keys).agg(F.max("n").alias("n"), *[F.sum((x < F.col(f"_lo{i}")).cast("long")).alias(f"_b{i}")
                                                          for i in range(len(names))])
    rename = {k: f"{k}_" for k in keys}
    counted = below.withColumnsRenamed(rename)
    cond = F.lit(True)
    for k in keys:
        cond = cond & near[k].eqNullSafe(counted[f"{k}_"])
    r = near.join(counted, cond) if keys else near.join(F.broadcast(counted))
    base = F.array(*[F.col(f"_b{i}") for i in range(len(names))])[F.col("_p")]
    run = F.sum("_c").over(W.partitionBy(*keys, "_p").orderBy("_x"))
    prob = F.array(*[F.lit(float(probs[k])) for k in names])[F.col("_p")]
    r = r.select(*keys, "_p", "n", "_x", (base + run - F.col("_c")).alias("_from"), (base + run - 1).alias("_to"),
                 ((F.col("n") - 1) * prob).alias("_h"))
    got = _picked(r, [*keys, "_p", "n"])
    return got.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_p") == i, F.col("_value"))).alias(k)
                                         for i, k in enumerate(names)]).select(
        *[F.col(k).alias(b) for k, b in zip(keys, by)], "n", *names)


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """(feature, median): the exact median of each numeric column; columns without values
    are absent. Same method as :func:`exact_quantiles`, all columns in each of three passes:
    sketches, counts below the bands, and the values inside the bands."""
    columns = list(columns)
    x = {c: F.col(c).cast("double") for c in columns}
    lo_p, hi_p = _band(0.5, accuracy)
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.count(x[c]).alias(f"n{i}"), F.min(x[c]).alias(f"a{i}"), F.max(x[c]).alias(f"b{i}"),
        F.percentile_approx(x[c], [lo_p, hi_p], accuracy).alias(f"q{i}"))]).first()
    bands = {}
    for i, c in enumerate(columns):
        if row[f"n{i}"]:
            few = row[f"n{i}"] <= accuracy
            bands[c] = (row[f"n{i}"], row[f"a{i}"] if few else row[f"q{i}"][0], row[f"b{i}"] if few else row[f"q{i}"][1])
    spark = df.sparkSession
    if not bands:
        return spark.createDataFrame([], "feature string, median double")
    below = df.agg(*[F.sum((x[c] < F.lit(lo)).cast("long")).alias(f"b{i}")
                     for i, (c, (_, lo, _)) in enumerate(bands.items())]).first()
    # only values inside a band become rows, not every value of every column
    entry = lambda c, lo, hi: F.when((x[c] >= F.lit(lo)) & (x[c] <= F.lit(hi)),
                                     F.struct(F.lit(c).alias("feature"), x[c].alias("_x")))
    inside = F.array_compact(F.array(*[entry(c, lo, hi) for c, (_, lo, hi) in bands.items()]))
    near = (df.select(F.explode(inside).alias("_e")).select("_e.*")
            .groupBy("feature", "_x").agg(F.count(F.lit(1)).alias("_c")))
    known = spark.createDataFrame([(c, int(below[f"b{i}"] or 0), (n - 1) * 0.5)
                                   for i, (c, (n, _, _)) in enumerate(bands.items())],
                                  "feature string, _below long, _h double")
    run = F.sum("_c").over(W.partitionBy("feature").orderBy("_x"))
    r = near.join(F.broadcast(known), "feature").select(       # one row per column
        "feature", "_x", "_h", (F.col("_below") + run - F.col("_c")).alias("_from"),
        (F.col("_below") + run - 1).alias("_to"))
    return _picked(r, ["feature"]).withColumnRenamed("_value", "median")
