"""Spark session settings shared by the library, the tests and the benchmark.

On a cluster the session already exists and carries the cluster's settings;
``configure`` only fills in what is unset.  ``local_session`` is for tests and
the benchmark on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library relies on.  UTC keeps dates stable across
# executors in different zones; ANSI makes bad casts fail loudly, which is why
# all parsing goes through try_* functions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # HotSpot never compiles a method of more than 8,000 bytes.  A projection
    # that renders or parses a whole sales line fuses into one of 30,000, which
    # is interpreted for every row; above this limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Set those of the core settings that the session leaves unset; what the
    caller has set stays."""
    given = _given(spark)
    for k, v in CORE_CONF.items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


def _given(spark: SparkSession) -> set[str]:
    """Names of the settings that somebody has set."""
    return {r["key"] for r in spark.sql("SET").collect()}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only a local
    session, where driver and executors are one machine, may leave it unset
    and gets a private folder; on a cluster an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="starflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it,
    unless the session already says where they find it.  On a cluster the
    library is shipped with the job (``--py-files``) or installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    # Whole texts cross to the workers: batches of fewer rows than the default
    # 10,000 keep both sides' buffers small.
    if _BATCH_ROWS not in _given(spark):
        spark.conf.set(_BATCH_ROWS, "2000")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for one intermediate table or file set.

    It lies in a folder of this application, which Spark's file system API
    removes when the application ends.
    """
    sc = spark.sparkContext
    base = f"{checkpoint_dir(spark).rstrip('/')}/starflow-{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{fs.makeQualified(path).toString()}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage
    cut that survives lost executors and keeps column pruning and pushdown.
    Row ids hardly repeat: a dictionary of them is built and thrown away."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    # Nothing reads the shuffle files of this job once its table is written.
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").option("parquet.enable.dictionary#_row_id", "false").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARFLOW_DRIVER_MEM", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("STARFLOW_LOG", "ERROR"))
    checkpoint_dir(spark)
    return spark
