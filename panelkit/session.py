"""Session construction and cluster-shared locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins from runtime sizes (broadcast only
# below the threshold, sort-merge beyond it) and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Skip PySpark's per-call Python stack capture (error-context only): it costs several
    # JVM round trips per DataFrame call while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "panelkit",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's directory). Only a local-mode
    session without one gets a fresh scratch folder; a cluster without one is an error,
    because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    path = tempfile.mkdtemp(prefix="panelkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


#: Intermediate tables of this process, for :func:`drop_intermediates`.
_WRITTEN: list[str] = []
#: Those of them that are tables of the catalog: path -> name.
_TABLES: dict[str, str] = {}


def intermediate_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, remembered for :func:`drop_intermediates`."""
    import uuid
    _WRITTEN.append(f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def intermediate_table(spark: SparkSession) -> tuple[str, str]:
    """Name and path of a new table in the shared checkpoint folder, remembered likewise; the
    catalog entry goes with the files."""
    path = intermediate_path(spark)
    name = f"panelkit_{path.rsplit('/', 1)[1]}"
    _TABLES[path] = name
    return name, path


def cut_lineage(df, partition_by=()):
    """Cut the lineage by writing a table into the shared checkpoint folder.

    One job writes parquet (an eager ``checkpoint()`` of an unpersisted plan runs it twice:
    once to count, once to save); reading it back gives a columnar scan with pruning and
    statistics. Types parquet cannot hold fall back to a reliable ``checkpoint()``; any
    other failure is raised. Never a local checkpoint: the files survive the loss of any
    executor. :func:`drop_intermediates` removes them once their readers are done.
    """
    from pyspark.errors import AnalysisException
    spark = df.sparkSession
    path = intermediate_path(spark)
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "UNSUPPORTED_DATA_TYPE_FOR_DATASOURCE":
            raise
        return df.checkpoint(eager=True)
    return spark.read.parquet(path)


def drop_intermediates(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process wrote; frames over them must no
    longer be used. Returns how many were removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        place = _WRITTEN.pop()
        if place in _TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(place)}")
        path = jvm.org.apache.hadoop.fs.Path(place)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
