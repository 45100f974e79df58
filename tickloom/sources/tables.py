"""Tables in folders that all executors share: places, existence, and overwriting some days of a table."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; local sessions without one get their own."""
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


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tickloom/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back, which cuts its lineage."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of each folder of a table, as a catalog of its parts: (part, files, bytes)."""
    p, fs = _at(spark, path)
    rows = []
    for entry in fs.listStatus(p):
        if entry.isDirectory():
            s = fs.getContentSummary(entry.getPath())
            rows.append((entry.getPath().getName(), s.getFileCount(), s.getLength()))
    return spark.createDataFrame(rows, "part string, files long, bytes long")


def replace_days(fresh: DataFrame, keep: DataFrame | None, days: list[str], path: str) -> None:
    """Make ``keep`` and ``fresh`` (both with ``date``) the whole content of the given days of the table at ``path``.

    The new content is written aside first, so it may come from the table itself; a writer that is
    lost before the last step leaves the table as it was, and one that runs again gives the same days.
    """
    spark = fresh.sparkSession
    both = fresh if keep is None else keep.select(fresh.columns).unionByName(fresh)
    aside = new_path(spark, "days")
    both.write.parquet(aside)
    new = spark.read.schema(both.schema).parquet(aside)
    found = {str(r["date"]) for r in new.select("date").distinct().collect()}
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    for day in set(days) - found:
        delete(spark, f"{path}/date={day}")
    delete(spark, aside)
