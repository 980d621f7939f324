"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder read from the session (never a machine-local default on a
cluster)."""

from __future__ import annotations

import atexit
import hashlib
import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quillmart", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster use the platform session
    and only make sure the same SQL settings are present."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("QUILLMART_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A local session without one gets a private scratch folder; on any other
    master that folder would be a machine's own, so it is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quillmart-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their
    Python workers can import it, whatever the master. A package that is not a
    plain folder was itself shipped with the application. Executors fetch the
    archive when their first task starts, so it stays until the driver ends.

    An application takes a file name once, and this module may be loaded anew
    while the application goes on: the archive is named by its content, and
    what the application has already is not sent again."""
    sc, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(package):
        return
    content = hashlib.sha256()
    for f in sorted(pathlib.Path(package).rglob("*.py")):
        content.update(f"{f.relative_to(package)}\0".encode() + f.read_bytes() + b"\0")
    name = f"{os.path.basename(package)}-{content.hexdigest()[:16]}"
    if not any(os.path.basename(f) == f"{name}.zip" for f in sc.listFiles):
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(sc.applicationId)


def run_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder for one run's files,
    removed when the Python process ends."""
    path = shared_scratch(spark, f"{tag}-{uuid.uuid4().hex[:12]}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    fs.deleteOnExit(jvm.org.apache.hadoop.fs.Path(path))
    return path


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate
    tables (lineage cuts that survive executor loss)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
