"""A corpus pipeline of five stages over ``documents``.

Each stage's result is written before the next one begins, which then deletes the
tables that its predecessors staged in the shared folder.

In every stage a null text counts as an empty one, a null id is an id like others, rows
that repeat are rows of their own where nothing else is said, an empty table gives no
rows, and columns beyond those of documents are carried along, whatever their names. All
but the last stage return the columns that they were given.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from outletry.llm import mixing, packing, privacy, quality, shingles
from outletry.llm.common import documents, fresh_path, release, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go; empty and short ones fail the base rule, repeated rows fare alike."""
    return quality.keep_good(docs)


def shingle_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays, the one of the smallest id; of rows that repeat id and text one, and texts without words all stay."""
    return shingles.keep_one(docs)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span found is replaced by its kind; of spans that overlap the first by start names them. A null text stays null."""
    return privacy.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source weights: a document comes as often as the mix takes it, in its shards' order; a null source is a source, and equal rows are taken one by one."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: every piece of every document with its sequence and offset; an empty text is one piece, the end id."""
    return packing.pack(docs)


_tables: set[str] = set()  # what the stage before staged


def _alone(stage):
    """The stage, after the tables that the stages before it staged are gone."""

    @functools.wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _tables)
        others = staged()
        out = stage(spark, docs, sf_dir)
        _tables.clear()
        _tables.update(staged() - others)
        return out

    return begin


STAGES = [("quality", _alone(quality_stage)), ("shingles", _alone(shingle_stage)), ("privacy", _alone(privacy_stage)), ("mixing", _alone(mixing_stage)), ("packing", _alone(packing_stage))]

#: The mean references, the random paths of the join, the drawn blocks and the cutting-stock program can't be stated in SQL; tests hold the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each over all that its predecessor kept."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
