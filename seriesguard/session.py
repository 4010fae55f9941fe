"""Session settings shared by batch, streaming, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # each column expression would ask the JVM for its call site several times; plans of a few hundred take seconds
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "seriesguard", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.setdefault("spark.driver.memory", os.environ.get("SERIESGUARD_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


_SHIPPED: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, applied to a session someone else built.

    Arrow batches are kept small: rows may hold whole documents, and a Python worker holds a few batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``seriesguard`` importable in Python workers (pandas UDFs and ``mapInPandas`` pickle our
    functions by reference). A zip of the package goes to every executor through ``addPyFile`` once per
    application; with ``--py-files`` on a cluster this is already done and is harmless."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = checkpoint_dir(spark)
    if base.startswith("file:") or "://" not in base:
        path = scratch_path(spark, f"pyfiles-{app}/seriesguard.zip")
    else:
        # a remote checkpoint URI cannot be written with os calls; addPyFile ships the driver's file
        path = os.path.join(tempfile.mkdtemp(prefix="seriesguard-pyfiles-"), "seriesguard.zip")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read from the session; without it we refuse to go on, because
    every executor would write to a folder of its own and later reads would miss rows. Only a local session, whose
    tasks share one machine, gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf missing
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="seriesguard-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a stage table inside the shared checkpoint folder, in this application's part of it."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "seriesguard-tables", spark.sparkContext.applicationId, name)


#: Part of its largest size that the driver's heap may grow to before a stage table's end collects its garbage.
HEAP_SHARE = 0.5
#: Stage tables that this process has written and not removed yet.
_TABLES: list[str] = []


def materialize(df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a stage table under the shared checkpoint folder and read it back; filters on ``partition_by`` columns read only their files.

    Cuts lineage (a lost executor re-reads the table instead of recomputing the chain), keeps logical
    plans small when a stage is read several times, and gives the optimizer real size statistics for
    its broadcast decisions. Computed once (unlike an eager RDD checkpoint, which runs the job twice).
    Tables live until the ``stage_scope`` around them ends, ``drop_tables`` is called or the process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    _TABLES.append(path)
    collect_garbage(spark)
    return spark.read.parquet(path)


def collect_garbage(spark: SparkSession, share: float = HEAP_SHARE) -> bool:
    """Let the driver's JVM collect its garbage if its heap has grown beyond ``share`` of the largest one; whether it was asked to.

    Plans of finished jobs are garbage, and a chain of many jobs lets the heap grow to its limit with them. Spark drops the
    shuffle files and broadcasts of finished jobs only after a collection, too."""
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() <= share * heap.maxMemory():
        return False
    spark._jvm.java.lang.System.gc()
    return True


def drop_tables(spark: SparkSession, since: int = 0) -> int:
    """Remove the stage tables written since the ``since``-th one; returns how many. Frames that read them end here."""
    gone, _TABLES[since:] = _TABLES[since:], []
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(gone)


@contextmanager
def stage_scope(spark: SparkSession):
    """Stage tables written inside are removed at the end; write or collect results before."""
    since = len(_TABLES)
    try:
        yield
    finally:
        drop_tables(spark, since)


@atexit.register
def _drop_at_exit() -> None:
    """What is left at the end of the process, if its session still runs."""
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None and _TABLES:
            drop_tables(spark)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        _TABLES.clear()


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files under ``path`` (two levels), as the file system lists them."""
    import hashlib

    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    seen = []
    for status in fs.listStatus(root):
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        seen += [f"{x.getPath().toString()} {x.getLen()} {x.getModificationTime()}" for x in inside]
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]
