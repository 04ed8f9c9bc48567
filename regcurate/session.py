"""Session helpers.

On a cluster the session comes configured; these helpers only fill in what
is unset (tests, bench) and never override cluster settings.
"""

from __future__ import annotations

import contextlib
import os
import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# settings this library relies on; applied only where the session has none
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "regcurate", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("REGCURATE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    folder = checkpoint_dir or os.environ.get("SPARK_CHECKPOINT_DIR")
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Fill in the library defaults on an existing session where unset."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = _context(spark)
    if sc is not None:
        d = sc.getCheckpointDir()
        if d is None:
            d = sc.getConf().get("spark.checkpoint.dir", None)
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the session names in
    ``spark.checkpoint.dir``. Only a local session, which has one machine, gets
    a scratch folder where none is named; on a cluster that is an error, as
    executors would write to their own disks."""
    d = checkpoint_dir(spark)
    sc = _context(spark)
    if not d:
        master = sc.master if sc is not None else ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all "
                               "executors share")
        d = tempfile.mkdtemp(prefix="regcurate-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    return d


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, inputs, target_bytes: int = 256 << 20):
    """Shuffles inside get about ``target_bytes`` per partition of ``inputs``, by
    Spark's own size statistics (no job). A value set at launch or on the session
    is left alone, and the session is as before afterwards."""
    key, sc = "spark.sql.shuffle.partitions", _context(spark)
    old = spark.conf.get(key)
    if sc is None or sc.getConf().contains(key) or old != "200":     # 200: Spark's default
        yield
        return
    size = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
               for df in inputs)
    spark.conf.set(key, str(max(int(old), min(-(-size // target_bytes), 1 << 20))))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def fine_scans(spark: SparkSession, most: int = 32 << 20) -> SparkSession:
    """A session beside the caller's, with its settings, whose scans read at most
    ``most`` bytes a task: for rows that are sorted or written where they are read."""
    own, key = spark.newSession(), "spark.sql.files.maxPartitionBytes"
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    now = re.fullmatch(r"(\d+)([kmgt]?)b?", own.conf.get(key).lower())
    if not now or int(now[1]) << 10 * " kmgt".index(now[2] or " ") > most:
        own.conf.set(key, str(most))
    return own


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers: a zip of
    it is added to the running application, once. Nothing is done if the package
    itself came in an archive (``--py-files``) or on a Connect session, where
    the client adds it as an artifact."""
    here, sc = Path(__file__).resolve().parent, _context(spark)
    if sc is None or not here.is_dir() or sc.applicationId in _SHIPPED:
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="regcurate-code-"))
    shutil.copytree(here, f"{folder}/src/{here.name}", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{folder}/{here.name}", "zip", f"{folder}/src"))
    _SHIPPED.add(sc.applicationId)
