"""Parts as a stream: files of new results are merged into the store as they arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from outletry.operators.store import no_clobber
from outletry.sources.tables import PART

BUCKETS = 64  # folders of a store; a batch rewrites those that its banks fall into


def _files(spark: SparkSession, store: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = fs.Path(store)
    return fs, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, store: str) -> dict[int, list[str]]:
    """Each bucket's versions, ascending."""
    fs, disk = _files(spark, store)
    if not disk.exists(fs.Path(store)):
        return {}
    buckets = [s.getPath().getName() for s in disk.listStatus(fs.Path(store))]
    return {int(b[2:]): sorted(s.getPath().getName() for s in disk.listStatus(fs.Path(f"{store}/{b}"))) for b in buckets if b.startswith("b=")}


def merge_results(spark: SparkSession, new: DataFrame, store: str) -> None:
    """Upsert parts into a Parquet store; a failed result never replaces a success, and the latest of a batch counts.

    The store has a folder a bucket of banks, with versions in it. Only the buckets of the batch's banks
    are read, written beside the store, and then moved in as new versions, each whole: a
    lost driver leaves old or new versions, and merging the batch once more changes nothing.
    """
    order = F.struct(F.col("status") == "success", F.xxhash64(F.to_json(F.struct(*new.columns))))
    latest = new.groupBy("_bank").agg(F.max_by(F.struct(*new.columns), order).alias("r")).select("r.*")
    bucket = F.pmod(F.xxhash64("_bank"), F.lit(BUCKETS)).cast("int")
    touched = sorted(r["b"] for r in new.select(bucket.alias("b")).distinct().collect())  # BUCKETS at most
    if not touched:
        return
    versions = _versions(spark, store)
    old = [f"{store}/b={b}/{versions[b][-1]}" for b in touched if versions.get(b)]
    merged = no_clobber(spark.read.schema(new.schema).parquet(*old), latest, "_bank") if old else latest
    beside = f"{store}/_new/{uuid.uuid4().hex}"
    merged.withColumn("b", bucket).repartition("b").write.partitionBy("b").parquet(beside)
    fs, disk = _files(spark, store)
    for b in touched:
        have = versions.get(b, [])
        disk.mkdirs(fs.Path(f"{store}/b={b}"))
        disk.rename(fs.Path(f"{beside}/b={b}"), fs.Path(f"{store}/b={b}/v{int(have[-1][1:]) + 1 if have else 0:09d}"))
        for name in have[:-1]:  # readers of the version before may still be at it
            disk.delete(fs.Path(f"{store}/b={b}/{name}"), True)
    disk.delete(fs.Path(beside), True)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The latest version of every bucket."""
    paths = [f"{store}/b={b}/{names[-1]}" for b, names in sorted(_versions(spark, store).items()) if names]
    return spark.read.schema(PART).parquet(*paths) if paths else spark.createDataFrame([], PART)


def stream_results(spark: SparkSession, incoming: str, store: str, checkpoint: str) -> StreamingQuery:
    """Follow a folder of part JSON lines until what is there is merged; run again for more."""
    rows = spark.readStream.schema(PART).json(incoming)
    return rows.writeStream.foreachBatch(lambda df, _: merge_results(spark, df, store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
