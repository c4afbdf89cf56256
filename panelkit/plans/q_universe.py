"""Queries: sources, filters, schema shaping and the listing/delisting universe."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import universe as U
from panelkit.plans.registry import END, EXCHANGE, START, W_, fx, register
from panelkit.session import cut_lineage
from panelkit.sources import io

_RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"


# --- S: sources -------------------------------------------------------------------------

@register("read_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def q_read_table(spark, d):
    return io.read_table(spark, f"{d}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal")


@register("require_columns", W_("SELECT * FROM ipo", "ipo"))
def q_require_columns(spark, d):
    return io.require_columns(fx.ipo(spark, d), ["permno", "ipo_date"], "IPO file")


@register("first_nonempty_source", W_("SELECT *, 'firms_c' AS source_name FROM ipo", "ipo"))
def q_first_nonempty_source(spark, d):
    ranked = [("names_a", f"{d}/no_such_table.parquet"),
              ("names_b", lambda: fx.ipo(spark, d).filter(F.year("ipo_date") < 1900)),
              ("firms_c", lambda: fx.ipo(spark, d))]
    df, name = io.first_nonempty_source(spark, ranked)
    return df.withColumn("source_name", F.lit(name))


_W2_SQL = f"""SELECT permno, comnam, ticker, delist_date, exchcd, shrcd, dlstcd FROM (
  SELECT d.permno, n.comnam, n.ticker, d.dlstdt AS delist_date, n.exchcd, n.shrcd, d.dlstcd,
    ROW_NUMBER() OVER (PARTITION BY d.permno ORDER BY d.dlstdt DESC NULLS LAST,
      n.comnam DESC NULLS LAST, n.ticker DESC NULLS LAST, n.exchcd DESC NULLS LAST,
      n.shrcd DESC NULLS LAST, d.dlstcd DESC NULLS LAST) AS rn
  FROM (SELECT permno, dlstdt, dlstcd FROM dlst WHERE dlstdt {_RANGE}) d
  JOIN names n ON n.permno = d.permno
   AND (n.namedt IS NULL OR n.namedt <= d.dlstdt)
   AND (n.nameenddt IS NULL OR n.nameenddt >= d.dlstdt)
  WHERE n.shrcd IN (10, 11) AND n.exchcd IN (1, 2, 3)) t WHERE rn = 1"""


@register("first_nonempty_pair", W_(
    f"SELECT *, 'exits_b' AS delist_source, 'names_b' AS names_source "
    f"FROM ({_W2_SQL}) w", "dlst", "names"))
def q_first_nonempty_pair(spark, d):
    delists = [("exits_a", lambda: fx.delist_events(spark, d).filter(F.lit(False))),
               ("exits_b", lambda: fx.delist_events(spark, d))]
    names = [("names_a", f"{d}/no_such_names.parquet"),
             ("names_b", lambda: fx.names(spark, d))]
    df, (dn, nn) = io.first_nonempty_pair(
        spark, delists, names, lambda de, na: U.delist_latest(de, na, EXCHANGE, START, END))
    return df.withColumn("delist_source", F.lit(dn)).withColumn("names_source", F.lit(nn))


# --- F: filters and shaping ----------------------------------------------------------------

@register("exchange_filter", W_("SELECT * FROM ipo WHERE exchcd IN (1, 3)", "ipo"))
def q_exchange_filter(spark, d):
    return C.exchange_filter(fx.ipo(spark, d), "NYSE, NASDAQ")


@register("share_class_filter", W_("SELECT * FROM names WHERE shrcd IN (10, 11)", "names"))
def q_share_class_filter(spark, d):
    return C.share_class_filter(fx.names(spark, d))


@register("date_range_filter", W_(f"SELECT * FROM names WHERE namedt {_RANGE}", "names"))
def q_date_range_filter(spark, d):
    return C.date_range_filter(fx.names(spark, d), "namedt", START, END)


@register("not_null_filter", W_("SELECT * FROM company WHERE ipodate IS NOT NULL", "company"))
def q_not_null_filter(spark, d):
    return C.not_null_filter(fx.company(spark, d), "ipodate")


@register("std_format_filter", W_(
    "SELECT * FROM funda WHERE indfmt = 'INDL' AND datafmt = 'STD' AND popsrc = 'D' "
    "AND consol = 'C'", "funda"))
def q_std_format_filter(spark, d):
    return C.std_format_filter(fx.funda(spark, d))


@register("standardize_ipo", W_(
    "SELECT permno, comnam, ticker, ipo_date, exchcd, shrcd FROM ipo", "ipo"))
def q_standardize_ipo(spark, d):
    raw = fx.ipo(spark, d).withColumnsRenamed(
        {"ipo_date": "NAMEDT", "comnam": "CompanyName", "ticker": "cusip8", "permno": "PERMNO"})
    return C.standardize_ipo(raw)


@register("standardize_delist", W_(
    "SELECT permno, comnam AS comnam_delist, ticker AS ticker_delist, delist_date, "
    "exchcd AS exchcd_delist, shrcd AS shrcd_delist FROM delist", "delist"))
def q_standardize_delist(spark, d):
    raw = fx.delist(spark, d).withColumnsRenamed({"delist_date": "dlstdt", "comnam": "comnamename"})
    return C.standardize_delist(raw)


@register("project_rename", W_(
    'SELECT gvkey, datadate, "at" AS total_assets, lt AS total_liabilities FROM funda', "funda"))
def q_project_rename(spark, d):
    f = fx.funda(spark, d).select("gvkey", "datadate", "at", "lt")
    return C.project_rename(f, {"at": "total_assets", "lt": "total_liabilities", "absent": "x"})


# --- J1-J3, W1, W1b, W2, J10 -------------------------------------------------------------------

@register("link_join", W_(
    """SELECT c.gvkey, c.conm, c.ipodate, l.lpermno, l.linktype, l.linkprim, l.linkdt, l.linkenddt
    FROM company c LEFT JOIN (SELECT * FROM link WHERE linktype IN ('LU', 'LC')
      AND linkprim IN ('P', 'C')) l ON c.gvkey = l.gvkey""", "company", "link"))
def q_link_join(spark, d):
    return U.link_join(fx.company(spark, d), fx.link(spark, d), "left")


@register("validity_join_left", W_(
    """SELECT i.permno, i.ipo_date, n.namedt, n.nameenddt, n.comnam, n.ticker, n.exchcd, n.shrcd
    FROM (SELECT permno, ipo_date FROM ipo) i LEFT JOIN names n ON i.permno = n.permno
     AND n.namedt <= i.ipo_date AND (n.nameenddt >= i.ipo_date OR n.nameenddt IS NULL)""",
    "ipo", "names"))
def q_validity_join_left(spark, d):
    i = fx.ipo(spark, d).select("permno", "ipo_date")
    return U.validity_join_left(i, fx.names(spark, d), "ipo_date")


@register("validity_join_inner", W_(
    """SELECT d.permno, d.dlstdt, d.dlstcd, n.namedt, n.nameenddt, n.comnam, n.ticker,
       n.exchcd, n.shrcd
    FROM dlst d JOIN names n ON n.permno = d.permno
     AND (n.namedt IS NULL OR n.namedt <= d.dlstdt)
     AND (n.nameenddt IS NULL OR n.nameenddt >= d.dlstdt)""", "dlst", "names"))
def q_validity_join_inner(spark, d):
    return U.validity_join_inner(fx.delist_events(spark, d), fx.names(spark, d), "dlstdt")


_W1_SQL = f"""SELECT permno, comnam, ticker, ipo_date, exchcd, shrcd FROM (
  SELECT permno, comnam, ticker, namedt AS ipo_date, exchcd, shrcd,
    ROW_NUMBER() OVER (PARTITION BY permno ORDER BY namedt ASC NULLS LAST, comnam ASC NULLS LAST,
      ticker ASC NULLS LAST, exchcd ASC NULLS LAST, shrcd ASC NULLS LAST) AS rn
  FROM names WHERE shrcd IN (10, 11) AND exchcd IN (1, 2, 3)) t
WHERE rn = 1 AND ipo_date {_RANGE}"""


@register("first_per_firm", W_(_W1_SQL, "names"))
def q_first_per_firm(spark, d):
    return U.ipo_from_names(fx.names(spark, d), EXCHANGE, START, END)


@register("limit_n", W_(f"SELECT * FROM ({_W1_SQL}) w ORDER BY ipo_date, permno LIMIT 100", "names"))
def q_limit_n(spark, d):
    """O2: the first N IPOs in date order (the limit is the feature)."""
    return U.ipo_from_names(fx.names(spark, d), EXCHANGE, START, END).orderBy(
        "ipo_date", "permno").limit(100)


@register("ipo_from_company", W_(
    f"""SELECT gvkey, comnam, ticker, ipo_date, exchcd, shrcd, permno FROM (
  SELECT c.gvkey, c.conm AS comnam, n.ticker, c.ipodate AS ipo_date, n.exchcd, n.shrcd, n.permno,
    ROW_NUMBER() OVER (PARTITION BY n.permno ORDER BY c.ipodate ASC NULLS LAST,
      c.gvkey ASC NULLS LAST, c.conm ASC NULLS LAST, n.ticker ASC NULLS LAST,
      n.exchcd ASC NULLS LAST, n.shrcd ASC NULLS LAST) AS rn
  FROM company c
  LEFT JOIN link l ON c.gvkey = l.gvkey AND l.linktype IN ('LU', 'LC') AND l.linkprim IN ('P', 'C')
  LEFT JOIN names n ON l.lpermno = n.permno AND n.namedt <= c.ipodate
   AND (n.nameenddt >= c.ipodate OR n.nameenddt IS NULL)
  WHERE c.ipodate IS NOT NULL AND c.ipodate {_RANGE}
    AND n.shrcd IN (10, 11) AND n.exchcd IN (1, 2, 3)) t WHERE rn = 1""",
    "company", "link", "names"))
def q_ipo_from_company(spark, d):
    return U.ipo_from_company(fx.company(spark, d), fx.link(spark, d), fx.names(spark, d),
                              EXCHANGE, START, END)


@register("latest_per_firm", W_(_W2_SQL, "dlst", "names"))
def q_latest_per_firm(spark, d):
    return U.delist_latest(fx.delist_events(spark, d), fx.names(spark, d), EXCHANGE, START, END)


_J10_SQL = """SELECT i.permno, COALESCE(i.comnam, d.comnam) AS comnam,
    COALESCE(i.ticker, d.ticker) AS ticker, i.ipo_date, d.delist_date, i.exchcd, i.shrcd
  FROM ipo i JOIN delist d ON i.permno = d.permno
  WHERE d.delist_date >= i.ipo_date AND d.delist_date <= i.ipo_date + INTERVAL 5 YEAR"""


@register("delist_within_years", W_(_J10_SQL, "ipo", "delist"))
def q_delist_within_years(spark, d):
    return U.delist_within_years(fx.ipo(spark, d), fx.delist(spark, d), 5)


@register("order_by", W_(
    f"SELECT *, ROW_NUMBER() OVER (ORDER BY ipo_date, delist_date, permno) - 1 AS position FROM ({_J10_SQL}) t",
    "ipo", "delist"))
def q_order_by(spark, d):
    """O1: final output ordering (ipo date, delist date, permno), with each row's place in the
    sorted output: its partition and its place there, ranked."""
    from panelkit.operators.ordered import global_rank
    out = U.delist_within_years(fx.ipo(spark, d), fx.delist(spark, d), 5)
    placed = cut_lineage(out.withColumn("_place", F.monotonically_increasing_id()))
    return global_rank(placed, ["_place"], rank="position").drop("_place")


@register("write_table", W_("SELECT * FROM ipo", "ipo"))
def q_write_table(spark, d):
    """Write a result partitioned for pruning into the shared folder, read it back."""
    import uuid

    from panelkit.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}/ipo.parquet"
    written = io.write_table(fx.ipo(spark, d), path, partition_by=["exchcd"])
    return io.read_table(spark, written).select(*fx.ipo(spark, d).columns)


_LINE = "CAST(permno AS VARCHAR) || ',' || comnam || ',' || CAST(ipo_date AS VARCHAR)"


@register("quarantine_read", W_(
    f"""SELECT CASE WHEN permno % 13 = 0 THEN CAST(permno AS VARCHAR) || ',' || comnam
           WHEN permno % 17 = 0 THEN 'x' || {_LINE} ELSE {_LINE} END AS record,
         CASE WHEN permno % 13 = 0 THEN 'not 3 fields'
           WHEN permno % 17 = 0 THEN 'permno is not bigint: x' || CAST(permno AS VARCHAR) END AS reason
       FROM ipo""", "ipo"))
def q_quarantine_read(spark, d):
    """A CSV table with damaged lines (a field missing, a firm that is no number): the rows
    that can be read, and the quarantine table with the lines that cannot, as text."""
    from panelkit.session import intermediate_path
    from panelkit.sources.quarantine import read_quarantined
    firm = F.col("permno").cast("string")
    line = F.concat_ws(",", F.when(F.col("permno") % 13 == 0, firm).when(F.col("permno") % 17 == 0, F.concat(
        F.lit("x"), firm)).otherwise(firm), "comnam", F.when(F.col("permno") % 13 != 0, F.col("ipo_date").cast("string")))
    path = intermediate_path(spark) + ".csv"
    fx.ipo(spark, d).select(line.alias("permno,comnam,ipo_date")).write.option("header", "true").option(
        "quote", "").option("sep", "\x01").csv(path)
    good, bad = read_quarantined(spark, path, {"permno": "bigint", "ipo_date": "date"})
    kept = F.concat_ws(",", F.col("permno").cast("string"), "comnam", F.col("ipo_date").cast("string"))
    return good.select(kept.alias("record"), F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("record", "reason"))
