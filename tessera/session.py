"""Session and scratch-space helpers.

On a cluster the session comes pre-configured (``spark.checkpoint.dir``
names a shared folder); these helpers only fill settings that are unset,
which is the case in local tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the caller has not set them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide rows (images, vectors): bound the bytes of each Arrow batch sent to Python
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Return the active session, or build a local one for tests / bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: dict[str, str] = {}  # application id -> zip shipped to its executors


def ship_package(spark: SparkSession) -> str:
    """Make ``tessera`` importable in the executors' Python workers.

    Arrow UDFs defined in this package are pickled by module reference, so
    the workers must import it. The package is zipped once per process and
    added with ``SparkContext.addPyFile`` once per application: Spark serves
    it to every executor (local mode or cluster); tasks put it on their path.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return _SHIPPED[app]
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    zip_path = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zip_path)
    _SHIPPED[app] = zip_path
    return zip_path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir`` when the cluster
    names one; otherwise (tests, local bench) a fresh local temp folder. A
    cluster without the setting is an error: its executors do not see the
    driver's local folders."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared scratch folder (survives executor
    loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
