"""Tables between the steps of a long job, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []
_staged: dict[str, SparkSession] = {}


def _clear() -> None:
    for path, spark in _staged.items():
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone; a cleaner of the shared folder does the rest
            return


atexit.register(_clear)


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a session on this machine alone has a temporary folder, and a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _own or _own.append("file://" + tempfile.mkdtemp(prefix="outletry-"))
        found = _own[0]
    return found.rstrip("/")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write and read back, which cuts the plan and survives lost executors; deleted when the driver exits."""
    spark = df.sparkSession
    path = f"{folder(spark)}/outletry/{tag}-{uuid.uuid4().hex}"
    _staged[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_few(df: DataFrame, rows: int = 200_000, n: int | None = None) -> DataFrame:
    """A staged table of narrow rows, marked for broadcasting if it has so few (n, where known); else for a join that sorts.

    Left to itself Spark broadcasts what its files are small enough for, and names take many
    times their files' size in the driver.
    """
    return F.broadcast(df) if (df.count() if n is None else n) <= rows else df.hint("merge")
