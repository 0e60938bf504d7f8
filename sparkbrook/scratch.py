"""Shared scratch space and lineage cuts.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``, which every
executor and the driver can reach, so a lost executor costs a re-read and nothing else.
Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULT = "/tmp/checkpoints"
_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """One folder per application below the shared checkpoint folder."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = _LOCAL_DEFAULT
            atexit.register(shutil.rmtree, f"{base}/{app}", ignore_errors=True)
        _roots[app] = f"{base.rstrip('/')}/{app}"
    return _roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path; nothing exists there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the path's own Hadoop file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file through the path's own Hadoop file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def clean(spark: SparkSession) -> bool:
    """Removes this application's scratch tables; frames that read them can't be used any more.

    Scratch tables belong to the application and stay until it calls this, because results
    that are returned lazily read them. A local session without a folder of its own is
    cleaned when its process ends.
    """
    return remove_path(spark, scratch_root(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the written table.

    Cuts the lineage, fixes every non-deterministic choice made upstream and lets several
    later passes read the rows without computing them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
