"""Intermediate tables in the cluster's shared folder.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``, which every
executor and the driver can reach, so that an executor lost later costs no
recomputation of what stands before the cut.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; local sessions without one get their own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tickloom-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return "file://" + _local[app]


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tickloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tickloom_path = path
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides: a table that grows with the corpus must not be built in the driver, however small its file is."""
    return df.hint("merge")


def release(*tables: DataFrame) -> None:
    """Delete tables made by :func:`cut` that no later plan reads."""
    for df in tables:
        path = getattr(df, "_tickloom_path", None)
        if path:
            jvm = df.sparkSession._jvm
            hadoop = jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


def sweep(spark: SparkSession) -> None:
    """Let the driver forget the plans of finished steps; Spark deletes shuffle files once no plan refers to them.

    Python hands its references back in the background, so the JVM collects twice, with time for that in between.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
