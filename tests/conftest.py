from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted(Path(DATA).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def canonical(frame) -> list[tuple]:
    """Rows with columns by name, numbers as rounded floats, nulls as None, sorted."""
    import math

    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return str(v)
        return f"{v:.6f}"

    cols = sorted(frame.columns)
    return sorted((tuple(one(v) for v in row) for row in frame[cols].itertuples(index=False)), key=str)


@pytest.fixture(scope="session")
def same():
    def check(spark_df, sql_frame):
        got = spark_df.toPandas()
        assert sorted(got.columns) == sorted(sql_frame.columns)
        assert canonical(got) == canonical(sql_frame)

    return check
