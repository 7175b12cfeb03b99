"""Session helpers: building a local session for tests/bench and cutting lineage.

Cluster rule: the checkpoint folder comes from the session (``spark.checkpoint.dir``).
We only set our own when none is configured *and* the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local session with AQE on, UI off, UTC time zone and Arrow enabled."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...) "
            "before running operators that cut lineage")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors and (unlike ``checkpoint``) computes
    the frame only once."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def stage_observed(df: DataFrame, *sums) -> tuple[DataFrame, dict]:
    """``stage_table`` and the values of the aggregate columns ``sums`` over its rows, observed
    while it is written: no query of its own."""
    from pyspark.sql import Observation

    seen = Observation()
    out = stage_table(df.observe(seen, *sums))
    return out, seen.get


def free(*tables: DataFrame) -> None:
    """Delete tables that ``stage_table`` wrote, once their last reader is done; other frames
    are left alone."""
    for t in tables:
        path = getattr(t, "_stage_path", None)
        if path:
            jvm = t.sparkSession.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def forget(*shared) -> None:
    """Remove broadcasts, which lie on the disk of the driver and of each executor, once all that
    reads them is stored."""
    for b in shared:
        b.destroy()


@contextmanager
def cached(df: DataFrame, cols=None):
    """Persist (memory, spilling to disk) the projected fit frame for the few passes of a
    fit; released afterwards.  Lost blocks are recomputed from lineage."""
    from pyspark import StorageLevel
    d = df.select(*[F.col(f"`{c}`") for c in cols]) if cols is not None else df
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield d
    finally:
        d.unpersist()


def concurrently(tasks, width: int = 4) -> list:
    """Results of the given functions in order, run from at most ``width`` driver threads: jobs
    of independent small fits share the cluster instead of waiting for each other.  Threads
    inherit the caller's job group and local properties; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    tasks = list(tasks)
    if len(tasks) < 2:
        return [t() for t in tasks]
    spark = SparkSession.active()
    with ThreadPoolExecutor(min(width, len(tasks))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
        return [r.result() for r in running]


_SHIPPED: set = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers (Arrow UDFs, applyInPandas):
    zip the package once per SparkContext and register it with ``addPyFile`` (Spark copies
    it to every executor, as ``--py-files`` would)."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    with _SHIPPING:
        if key in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        out = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for base, _dirs, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(base, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
        _SHIPPED.add(key)
