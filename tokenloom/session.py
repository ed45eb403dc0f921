"""Session helpers: building a session, the shared scratch folder, landings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tokenloom", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests.  On a cluster, use the cluster's
    session as given and pass it to the library functions instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting is read from the session.  Only when it is unset and the
    session is local (tests) a private folder is created; on a cluster an
    unset folder is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="tokenloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tokenloom-{name}-{uuid.uuid4().hex[:12]}"


#: Array elements of a column that a scan of a landed table decodes at a time.
SCAN_ELEMENTS = 1 << 19


def land(df: DataFrame, name: str = "landing", elements: int | None = None) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared checkpoint
    folder and read it back.  Computed once, survives lost executors, and
    later reads get column pruning and filter push-down.

    ``elements``: the length of the arrays.  A scan decodes 4,096 rows of a
    row group at a time, whatever their size, so a table with long arrays is
    written in row groups of about ``SCAN_ELEMENTS`` elements."""
    path = scratch_path(df.sparkSession, name)
    out = df.write.mode("overwrite")
    if elements:
        out = out.option("parquet.block.row.count.limit", max(1, SCAN_ELEMENTS // elements))
    out.parquet(path)
    return df.sparkSession.read.parquet(path)



_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tokenloom`` importable on executors (the Python data sources
    run there): zip the package once per application and ``addPyFile`` it."""
    import shutil

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tokenloom-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "tokenloom"), "zip",
                                  os.path.dirname(pkg_dir), os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


#: Rows of one Arrow batch between Spark and a Python worker (rows are whole documents here).
BATCH_ROWS = 512
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """At most ``rows`` rows in an Arrow batch of this session, so that what a
    Python worker holds does not grow with the rows of its task.  A setting
    that is lower already stays."""
    now = int(spark.conf.get(_ARROW_ROWS))
    if now <= 0 or now > rows:
        spark.conf.set(_ARROW_ROWS, str(rows))


_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batch_bytes(spark: SparkSession, size: int) -> None:
    """At most about ``size`` bytes, or one row, in an Arrow batch of this
    session; a setting that is lower already stays."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ARROW_BYTES))
    if now <= 0 or now > size:
        spark.conf.set(_ARROW_BYTES, str(size))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-repartition ``df`` when its scan yields fewer splits than the
    cluster has cores (a small file, or one row group), so the per-row work
    after it runs in parallel.  A large input already has many splits and
    is left as it is: no shuffle is added at scale."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key) if key else df.repartition(cores)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
