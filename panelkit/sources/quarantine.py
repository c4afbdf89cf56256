"""Bad records beside the good ones.

:func:`read_quarantined` gives the rows that can be read and a table of what cannot: a line
of a CSV file that has too many or too few fields, or a field that is not of its column's
type; a Parquet (or ORC, JSON) file that cannot be read. Each comes with the file's name, the
record (lines) and the reason. Nothing is dropped without an entry.

CSV is one pass: lines are split by Spark's reader, which keeps a malformed one whole, and
fields are cast by expressions. Columnar files are proved by reading them, as ``load`` looks
at one footer only: one Spark job decodes every column of every file; where it stops, the
error names the file, which is set aside, and the rest is proved again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources.schemas import COLUMN_TYPES

QUARANTINE = "file string, record string, reason string"
_FORMATS = {".csv": "csv", ".json": "json", ".orc": "orc"}


def read_quarantined(spark: SparkSession, path: str, types: Mapping[str, str] | None = None,
                     fmt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of the table at ``path``.

    ``types`` gives CSV columns their types (by default those declared for their names);
    others stay text. An empty table gives two empty frames; a path without files is an
    error, and so is one none of whose columnar files can be read.
    """
    kind = fmt or _FORMATS.get(os.path.splitext(path.rstrip("/"))[1].lower(), "parquet")
    return _csv(spark, path, types) if kind == "csv" else _columnar(spark, path, kind)


def _csv(spark: SparkSession, path: str, types: Mapping[str, str] | None) -> tuple[DataFrame, DataFrame]:
    reader = spark.read.option("header", "true")
    names = reader.csv(path).columns
    types = types if types is not None else {c: COLUMN_TYPES[c.strip().lower()] for c in names
                                             if c.strip().lower() in COLUMN_TYPES}
    # All fields as text: the only malformed lines are those with another number of fields.
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_line"]])
    rows = (reader.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path)
            .withColumn("_file", F.col("_metadata.file_path")))
    reason = F.when(F.col("_line").isNotNull(), F.lit(f"not {len(names)} fields"))
    for c in names:
        if c in types:
            bad = F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(types[c]).isNull()
            reason = reason.when(bad, F.concat(F.lit(f"{c} is not {types[c]}: "), F.col(f"`{c}`")))
    rows = rows.withColumn("_reason", reason)
    good = rows.filter(F.col("_reason").isNull()).select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in names])
    record = F.coalesce(F.col("_line"), F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names]))
    bad = rows.filter(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), record.alias("record"), F.col("_reason").alias("reason"))
    return good, bad


def _files(spark: SparkSession, path: str) -> list[str]:
    """Data files under a path, as Spark lists them (hidden names left out)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, each = [], fs.listFiles(root, True)
    base = len(fs.makeQualified(root).toString())
    while each.hasNext():
        place = each.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in place[base:].split("/")):
            found.append(place)
    return sorted(found)


def _blamed(err: BaseException, files: list[str]) -> str | None:
    """The one of ``files`` that an error is about."""
    said = str(err)
    named = [f for f in files if re.search(re.escape(re.sub(r"^file:/+", "/", f)) + r"(?![\w-]|\.\w)", said)]
    return max(named, key=len) if named else None


def _reason(err: BaseException) -> str:
    """Spark's error condition and the innermost cause."""
    said = str(err)
    condition = re.search(r"\[([A-Z_]+(?:\.[A-Z_]+)*)\]", said)
    causes = re.findall(r"^Caused by: (?:[\w.$]+: )*(.+)$", said, re.MULTILINE)
    return ": ".join([condition[1] if condition else type(err).__name__, *causes[-1:]])[:500]


def _columnar(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    files, aside = _files(spark, path), []
    if not files:
        raise FileNotFoundError(f"no table at {path}")
    while True:
        try:
            df = spark.read.option("basePath", path).format(kind).load(files) if _is_folder(files, path) \
                else spark.read.format(kind).load(files)
            # Every value is decoded, none is kept.
            df.agg(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))).collect()
            break
        except Exception as err:  # noqa: BLE001 - whatever the reader raises; files that it does not name are raised
            file = _blamed(err, files)
            if file is None:
                raise
            aside.append((file, None, _reason(err)))
            files.remove(file)
            if not files:
                raise
    return df, spark.createDataFrame(aside, QUARANTINE)


def _is_folder(files: list[str], path: str) -> bool:
    return not (len(files) == 1 and files[0].rstrip("/").endswith(path.rstrip("/").split("/")[-1]))


def write_quarantine(bad: DataFrame, path: str) -> int:
    """Add entries to the quarantine table at ``path``; how many were added."""
    from panelkit.sources.publish import counted, rows_of
    rows, seen = counted(bad, "quarantine")
    rows.withColumn("seen_at", F.current_timestamp()).write.mode("append").parquet(path)
    return rows_of(seen)
