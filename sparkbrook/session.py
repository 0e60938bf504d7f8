"""Session construction; every setting can be overridden from the environment."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: environment variable -> Hadoop S3A setting; credentials never live in code.
_OBJECT_STORE = {
    "OBJECT_STORE_ENDPOINT": "spark.hadoop.fs.s3a.endpoint",
    "OBJECT_STORE_ACCESS_KEY": "spark.hadoop.fs.s3a.access.key",
    "OBJECT_STORE_SECRET_KEY": "spark.hadoop.fs.s3a.secret.key",
    "OBJECT_STORE_PATH_STYLE": "spark.hadoop.fs.s3a.path.style.access",
    "OBJECT_STORE_CONNECTIONS": "spark.hadoop.fs.s3a.connection.maximum",
    "OBJECT_STORE_ATTEMPTS": "spark.hadoop.fs.s3a.attempts.maximum",
}


def object_store_conf(env: dict[str, str] | None = None) -> dict[str, str]:
    """Hadoop S3A settings for the variables that are set in ``env``."""
    env = dict(os.environ) if env is None else env
    return {key: env[name] for name, key in _OBJECT_STORE.items() if env.get(name)}


def build_session(app: str = "sparkbrook", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with AQE, UTC and Arrow on; ``conf`` wins over the defaults.

    ``master`` is left to spark-submit when None, so the same code runs on a cluster.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings |= object_store_conf()
    settings |= conf or {}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()

#: Rows that a Python worker gets at once: whole texts, so a batch of Spark's default length may take gigabytes.
ROWS_PER_BATCH = 1000
_DEFAULT_ROWS = 10_000


def bound_batches(spark: SparkSession) -> None:
    """Shortens the batches between the JVM and Python workers, unless the session sets another length than the default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == _DEFAULT_ROWS:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable for Python workers that don't have it on their path, and bounds what they are given at once."""
    bound_batches(spark)
    root = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    # only workers on this machine are known to share the driver's path
    if app in _shipped or spark.sparkContext.master.startswith("local") and str(root.parent) in on_path:
        return
    folder = tempfile.mkdtemp(prefix="sparkbrook-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = Path(folder) / "sparkbrook.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
