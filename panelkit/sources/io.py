"""Reading and writing tables."""

from __future__ import annotations

import itertools
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from panelkit.sources.publish import publish, recover
from panelkit.sources.schemas import COLUMN_TYPES

_READERS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc"}


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas has one missing value; Spark has NULL and NaN. Map NaN to NULL (trap T2)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _sibling_csv(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[0] + ".csv"


def _no_such_path(err: Exception) -> bool:
    return isinstance(err, AnalysisException) and err.getCondition() == "PATH_NOT_FOUND"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None) -> DataFrame:
    """CSV with a header. Without a schema the columns get the types declared for their
    names in :mod:`panelkit.sources.schemas`, others stay text: no pass over the data."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.csv(path)
    return df.select(*[F.col(f"`{c}`").try_cast(COLUMN_TYPES[c.strip().lower()]).alias(c)
                       if c.strip().lower() in COLUMN_TYPES else F.col(f"`{c}`") for c in df.columns])


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read a table; the extension picks the reader.

    A file that is missing or cannot be read falls back to a same-named ``.csv`` file (the
    reference does the same for its spreadsheet format). Only Spark is asked whether a path
    exists, so it may lie in any file system.
    """
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    kind = fmt or _READERS.get(ext, "parquet")
    try:
        if kind == "csv":
            return _read_csv(spark, path, schema)
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.format(kind).load(path)
    except Exception as err:  # noqa: BLE001 - any read failure (footer, schema, permissions)
        if _no_such_path(err) and recover(spark, path):      # a write died between its renames
            return read_table(spark, path, schema, fmt)
        alt = _sibling_csv(path)
        if alt != path:
            try:
                return _read_csv(spark, alt, schema)
            except AnalysisException as second:
                if not _no_such_path(second):
                    raise
        if _no_such_path(err):
            raise FileNotFoundError(f"no table at {path}") from err
        raise


def require_columns(df: DataFrame, required: Sequence[str], what: str = "table") -> DataFrame:
    """Fail early if required columns are missing (metadata only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return df


Source = Callable[[], DataFrame] | str | DataFrame


def _resolve(spark: SparkSession, src: Source) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    if callable(src):
        return src()
    if "/" not in src and spark.catalog.tableExists(src):   # a catalog table name
        return spark.table(src)
    return read_table(spark, src)


def first_nonempty_source(spark: SparkSession, sources: Sequence[tuple[str, Source]],
                          build: Callable[[DataFrame], DataFrame] | None = None
                          ) -> tuple[DataFrame, str]:
    """The first ranked source that exists and yields rows, with its name.

    ``build`` turns a source into the wanted result (filters, joins); emptiness is tested
    on that result with ``isEmpty`` (a ``limit 1`` job that stops at the first row).
    Re-raises the last error when every source failed; ``RuntimeError`` otherwise.
    """
    last_error: Exception | None = None
    for name, src in sources:
        try:
            df = _resolve(spark, src)
            if build is not None:
                df = build(df)
            if not df.isEmpty():
                return df, name
        except Exception as err:  # noqa: BLE001 - a source that fails in any way is passed over
            last_error = err
    if last_error is not None:
        raise last_error
    raise RuntimeError("no source gave rows")


def first_nonempty_pair(spark: SparkSession, left: Sequence[tuple[str, Source]],
                        right: Sequence[tuple[str, Source]],
                        build: Callable[[DataFrame, DataFrame], DataFrame]
                        ) -> tuple[DataFrame, tuple[str, str]]:
    """S3: S2 over the product left x right, the right names varying fastest."""
    last_error: Exception | None = None
    for (ln, ls), (rn, rs) in itertools.product(left, right):
        try:
            df = build(_resolve(spark, ls), _resolve(spark, rs))
            if not df.isEmpty():
                return df, (ln, rn)
        except Exception as err:  # noqa: BLE001 - a source that fails in any way is passed over
            last_error = err
    if last_error is not None:
        raise last_error
    raise RuntimeError("no pair of sources gave rows")


def write_table(df: DataFrame, path: str, fmt: str | None = None,
                partition_by: Sequence[str] = ()) -> str:
    """Write a result (many files per dataset); on failure fall back to CSV.

    Returns the path written. ``partition_by`` lays the output out for partition
    pruning, e.g. ``["public_year"]`` for the panel. What the path held before stays until
    the new table is whole (:mod:`panelkit.sources.publish`).
    """
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    kind = fmt or _READERS.get(ext, "parquet")
    header = {"header": "true"}
    try:
        publish(df, path, kind, partition_by, header if kind == "csv" else None)
        return path
    except Exception:
        if kind == "csv":
            raise
        alt = _sibling_csv(path)
        publish(df, alt, "csv", partition_by, header)
        return alt
