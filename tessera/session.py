"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    cores = os.cpu_count() or 8
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    # off local masters the cluster's own setting stands unless one is passed
    if shuffle_partitions or (master and master.startswith("local")):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    if master and master.startswith("local"):
        # local mode: executors live in the driver JVM, so its heap is the only memory knob
        conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", _local_heap())
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions passed to ``mapInPandas`` and the like are pickled by reference,
    so a worker must be able to import ``tessera``. Applications started with
    ``--py-files tessera.zip`` may skip this.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(tempfile.mkdtemp(prefix="tessera-package-"), "tessera.zip")
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(top, n)
                    z.write(path, os.path.join("tessera", os.path.relpath(path, here)))
    sc.addPyFile(to)
    _SHIPPED.add(sc.applicationId)


def _local_heap() -> str:
    """60 % of physical memory, at most 8 GB, at least 1 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "2g"
    mb = int(total * 0.6 / 2**20)
    return f"{max(1024, min(8192, mb))}m"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``; a temporary folder stands
    in only on local masters. Elsewhere a session without the setting raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-staging/{name}-{uuid.uuid4().hex[:12]}"
