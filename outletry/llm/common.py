"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The six code points that separate words: space, tab, LF, VT, FF, CR.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where it is unset a session on this machine alone (tests, a laptop) uses a temporary
    folder of its process; on a cluster that is an error, since executors
    couldn't read it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = _own.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="outletry-"))
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; a cleaner of the shared folder does the rest
        pass


_staged: dict[str, SparkSession] = {}


def _clear() -> None:
    for path, spark in list(_staged.items()):
        _delete(spark, path)
    _staged.clear()


atexit.register(_clear)


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder, deleted by :func:`release` or when the driver exits."""
    path = f"{shared_dir(spark)}/outletry/{tag}-{uuid.uuid4().hex}"
    _staged[path] = spark
    return path


def staged() -> set[str]:
    """The paths staged so far that are still there."""
    return set(_staged)


def release(spark: SparkSession, paths: set[str]) -> None:
    """Delete staged tables; only where all results drawn from them are written."""
    for path in paths & set(_staged):
        _delete(spark, path)
        del _staged[path]


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what is read later survives the loss of any executor, and
    nothing upstream is computed twice.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, rows: int = 400_000, mb: int = 64) -> DataFrame:
    """A staged table, marked for broadcasting if it has at most so many rows and, by a look at all of
    them, so many MB of strings and arrays; else as it is, to be shuffled. Results don't depend on it."""
    wide = [F.length(c) if t in ("string", "binary") else 8 * F.size(c) if t.startswith("array<") else F.lit(8) for c, t in df.dtypes]
    size = F.sum(sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(16)).cast("long"))
    n, held = df.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= mb << 20 else df


def numbered(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """Staged `rows` with `no`, their places from 0 in the order of columns, without a task that sees them all.

    Tasks hold ranges of the order and count their own rows; the places before each task
    are summed over a table of one row a task.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # the task above bit 33, the place in it below
    s = stage(spread.withColumn("no", at), tag)
    task = F.shiftright("no", 33)
    own = F.col("no").bitwiseAND(F.lit((1 << 33) - 1))
    counts = s.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = counts.select("task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return s.withColumn("task", task).join(F.broadcast(before), "task").withColumn("no", own + F.col("base")).drop("task", "base")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches of whole texts small: fewer rows and at most 16 MB each."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null: empty), whatever else the table carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_array(text: Column) -> Column:
    """The words of a text: runs of anything but blanks."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def word_count(text: Column) -> Column:
    """How many words a text has (null: 0); long."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def let(x: Column, then) -> Column:
    """``then(x)`` with x evaluated once, however often `then` names it, also inside lambdas."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def scanned(items: Column, start: Column, step, kind: str, chunk: int = 128) -> Column:
    """Runs ``step(state, item) -> (state, out)`` over an array; gives the array of outs, of SQL type `kind`.

    Arrays grow by copying, so a plain aggregate takes a time in proportion to the square of
    their length. Here chunks are run each for itself and appended whole, which stays
    in proportion for millions of items.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(a: Column, x: Column) -> Column:
        state, out = step(a["s"], x)
        return F.struct(state.alias("s"), F.concat(a["out"], F.array(out)).alias("out"))

    def all_of(it: Column) -> Column:
        def many(a: Column, k: Column) -> Column:
            inner = F.aggregate(F.slice(it, k * chunk + 1, F.lit(chunk)), F.struct(a["s"].alias("s"), none.alias("out")), one)
            return let(inner, lambda i: F.struct(i["s"].alias("s"), F.concat(a["out"], F.array(i["out"])).alias("out")))

        empty = F.struct(start.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        chunks = F.sequence(F.lit(0), F.floor((F.size(it) - 1) / chunk).cast("int"))
        return F.when(F.size(it) > 0, F.flatten(F.aggregate(chunks, empty, many)["out"])).otherwise(none)

    return let(items, all_of)


def rows_of(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-side rows as a DataFrame, without a Python worker."""
    import json

    text = json.dumps(rows)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))
